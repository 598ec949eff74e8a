"""Approximate nearest neighbours by a permutation index, ranked by footrule distance and reranked by cosine.

A vector is represented by the order of its ``PREFIX`` nearest pivots. Vectors are dealt into shards by the hash of id and vector; a shard's
index is an inverted file with a list for each pivot: the vectors that have it in their prefix, and where. A query adds up, over the lists of its
own prefix, what every vector shares with it. With w = PREFIX - place for a pivot in the prefix and 0 otherwise, the footrule distance of two
prefixes is PREFIX * (PREFIX + 1) - 2 * sum(min(w_query, w_vector)) over the shared pivots, so the largest sums are the smallest distances. The
nearest ``SHARE`` of a shard (``LEAST`` at least, and all at the same distance as the last) are reranked by the cosine of the original vectors;
the same way leads to every result, however few vectors there are.

Pivots are up to ``PIVOTS`` different vectors out of a bounded sample picked by hash. Every vector is indexed. Repeated rows are taken out before
anything is grouped, so an id on a third of all rows is dealt like any other. Equal vectors are one entry of a
shard with all their ids, so a vector that a third of all rows hold is compared once. Queries meet shards in blocks.

Cases: vectors that are null, zero or hold null or non-finite components take no part, nor do those of another dimension than most, or with a null
id; ties go to the smaller id; repeated rows count as one if id and vector are equal; fewer candidates than wanted are all returned; an empty
table gives an empty result; other columns are not kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from gondola.llm.common import stage

PIVOTS = 256
PREFIX = 64
PIVOT_ROWS = 2048
SHARD_ROWS = 8192
QUERY_ROWS = 1024
SHARE = 0.2
LEAST = 128


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part, as doubles."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0))


def prefixes(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The numbers of the pivots nearest to each vector by angle, nearest first; ties to the smaller number."""
    near = vectors @ pivots.T / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.argsort(-near, axis=1, kind="stable")[:, :PREFIX]


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


class Shard:
    """The inverted file of some vectors; made from rows (ids, vectors) in any order, or from stored parts."""

    PARTS = ("ids", "cuts", "vectors", "starts", "members", "weights")

    def __init__(self, dimension: int, **parts: np.ndarray):
        self.ids, self.cuts, self.starts = (parts[n] for n in ("ids", "cuts", "starts"))
        self.members, self.weights = parts["members"], parts["weights"]
        self.vectors = parts["vectors"].reshape(-1, dimension)
        self.norms = _norms(self.vectors)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray) -> Shard:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order]) + 0.0
        _, first, group = np.unique(vectors.view(f"V{vectors.shape[1] * 8}").ravel(), return_index=True, return_inverse=True)
        by = np.argsort(group, kind="stable")
        cuts = np.concatenate([[0], np.cumsum(np.bincount(group))])
        distinct = vectors[first]
        prefix = prefixes(distinct, pivots)
        owner = np.repeat(np.arange(len(distinct)), prefix.shape[1])
        weight = np.tile(np.arange(prefix.shape[1], 0, -1), len(distinct))
        listed = np.argsort(prefix.ravel(), kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(prefix.ravel(), minlength=len(pivots)))])
        return cls(
            vectors.shape[1], ids=ids[by], cuts=cuts.astype(np.int64), vectors=distinct, starts=starts.astype(np.int64),
            members=owner[listed].astype(np.int32), weights=weight[listed].astype(np.int16),
        )

    def shared(self, prefix: np.ndarray) -> np.ndarray:
        """For each entry the sum that falls as the footrule distance to a query's prefix rises."""
        out = np.zeros(len(self.vectors), np.int32)
        for place, pivot in enumerate(prefix.tolist()):
            part = slice(self.starts[pivot], self.starts[pivot + 1])
            out[self.members[part]] += np.minimum(self.weights[part], len(prefix) - place)
        return out

    def nearest(self, own: int, query: np.ndarray, prefix: np.ndarray, wanted: int, share: float, least: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.vectors)
        keep = min(n, max(least, math.ceil(share * n)))
        shared = self.shared(prefix)
        some = np.flatnonzero(shared >= np.partition(shared, n - keep)[n - keep])
        rough = self.vectors[some] @ query / self.norms[some]
        if len(some) > wanted + 1:
            border = np.partition(rough, len(rough) - wanted - 1)[len(rough) - wanted - 1]
            some = some[rough >= border - 1e-9 * math.sqrt(float(query @ query))]
        # The same sums in the same order for every shard, so equal vectors have equal scores.
        score = (self.vectors[some] * query).sum(axis=1) / (self.norms[some] * _norms(query[None])[0])
        ids, scores = [], []
        for entry, s in zip(some, score, strict=True):
            # Ids of an entry are in order and may repeat with their rows.
            mine = self.ids[self.cuts[entry] : self.cuts[entry + 1]]
            mine = np.unique(mine[mine != own])[:wanted]
            ids.append(mine)
            scores.append(np.full(len(mine), s))
        ids, scores = np.concatenate([*ids, np.zeros(0, np.int64)]), np.concatenate([*scores, np.zeros(0)])
        order = np.lexsort((ids, -scores))[:wanted]
        return ids[order], scores[order]


def _drawn(rows: DataFrame, count: int) -> list[Row]:
    """The ``PIVOT_ROWS`` different rows with the smallest hashes, of ``count`` that may repeat.

    Only rows with hashes below a bound are compared, so each task sends the driver few of them, however many tasks there are. The bound rises
    while repeated rows leave too few.
    """
    # Ordered by the vector's hash too: an id with many vectors must not decide by the order of its rows.
    place = F.xxhash64(F.lit("pivot"), "vec_id", "embedding")
    share = 4 * PIVOT_ROWS / count
    while True:
        some = rows if share >= 1 else rows.where(place < F.lit(int(share * 2**64) - 2**63))
        drawn = some.dropDuplicates(["vec_id", "embedding"]).orderBy(place, "vec_id", "embedding").limit(PIVOT_ROWS).collect()
        if share >= 1 or len(drawn) == PIVOT_ROWS:
            return drawn
        share *= 8


def search(vectors: DataFrame, queries: DataFrame, wanted: int = 5, share: float = SHARE, least: int = LEAST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``wanted`` nearest of ``vectors`` found for each row of ``queries`` but itself."""
    spark = vectors.sparkSession
    results = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors)
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return spark.createDataFrame([], results)
    dimension = sizes["n"]
    rows = rows.where(F.size("embedding") == dimension)
    shards = math.ceil(sizes["count"] / shard_rows)
    unique = list(dict.fromkeys(tuple(r.embedding) for r in _drawn(rows, sizes["count"])))[:PIVOTS]
    pivots = np.array(unique)
    pivots /= _norms(pivots)[:, None]
    shared = spark.sparkContext.broadcast(pivots)

    def index(group: pa.Table) -> pa.Table:
        ids = group.column("vec_id").to_numpy()
        values = group.column("embedding").combine_chunks().flatten().to_numpy().reshape(-1, dimension)
        shard = Shard.build(ids, values, shared.value)
        return pa.table({"shard": group.column("shard").slice(0, 1), **{n: pa.array([getattr(shard, n).tobytes()], pa.binary()) for n in Shard.PARTS}})

    shard = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int")
    rows = rows.dropDuplicates(["vec_id", "embedding"])
    files = rows.select("vec_id", "embedding", shard.alias("shard")).groupBy("shard").applyInArrow(index, "shard int, " + ", ".join(f"{n} binary" for n in Shard.PARTS))
    files = stage(files.drop("shard"), "permutation-index", 1)

    asked = usable(queries).where(F.size("embedding") == dimension).dropDuplicates(["vec_id", "embedding"])
    n_asked = asked.count()
    blocks = max(1, math.ceil(n_asked / QUERY_ROWS))

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("vec_id")
        values = group.column("embedding").combine_chunks().flatten().to_numpy()
        return pa.table(
            {"block": group.column("block").slice(0, 1), "query_ids": pa.array([group.column("vec_id").to_numpy().tobytes()], pa.binary()), "query_vectors": pa.array([values.tobytes()], pa.binary())}
        )

    block = F.pmod(F.xxhash64(F.lit("query"), "vec_id", "embedding"), F.lit(blocks)).cast("int")
    packs = asked.select("vec_id", "embedding", block.alias("block")).groupBy("block").applyInArrow(pack, "block int, query_ids binary, query_vectors binary")
    packs = stage(packs.drop("block"), "permutation-queries", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"ids": np.int64, "cuts": np.int64, "vectors": np.float64, "starts": np.int64, "members": np.int32, "weights": np.int16}
        for batch in batches:
            for row in range(batch.num_rows):
                values = {n: batch.column(batch.schema.get_field_index(n))[row].as_py() for n in [*Shard.PARTS, "query_ids", "query_vectors"]}
                part = Shard(dimension, **{n: np.frombuffer(values[n], types[n]) for n in Shard.PARTS})
                ids = np.frombuffer(values["query_ids"], np.int64)
                asked = np.frombuffer(values["query_vectors"], np.float64).reshape(-1, dimension)
                found = [part.nearest(i, v, p, wanted, share, least) for i, v, p in zip(ids.tolist(), asked, prefixes(asked, shared.value), strict=True)]
                counts = [len(x) for x, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, counts)), pa.array(np.concatenate([x for x, _ in found])), pa.array(np.concatenate([x for _, x in found]))],
                    ["query_id", "vec_id", "score"],
                )

    # One shard and one block of queries make a unit of work. A task reads some files of both and takes all units of these, so nothing is
    # copied for every unit; stored one a file, shards and blocks are dealt to tasks by their bytes.
    units = files.crossJoin(packs.hint("shuffle_replicate_nl"))
    found = units.mapInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= wanted).select("query_id", "rank", "vec_id", "score")
