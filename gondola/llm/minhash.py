"""MinHash fingerprints of whole texts and of a text whose second half gives way to its neighbour's first; near duplicates by bands.

A fingerprint has 128 values of 16 bits: for each of as many random permutations of the 32-bit numbers (odd factor, added constant) the low bits
of the scrambled smallest image of the text's shingles of five words. The smallest image itself has leading zeros, the more the longer a text is;
scrambled, unlike texts agree on 2^-16 of the values at any length. All is worked out over slices of many texts with array operations.

The next document is the one that follows in the order of doc_id. Ids picked by their hash cut the order into ranges; the row that begins a
range is also sent to the range before, so every range can be walked alone, with one text held over. Nothing is sorted in one task.

``near_duplicates`` joins bands of the signatures and verifies the Jaccard likeness of the shingle sets. Texts with equal shingles are one class
and meet once. In a band's bucket classes are first compared with a neighbour and with the bucket's first, which joins most groups. Buckets that
still hold several parts are then compared whole: cut into blocks, each two of which meet in a group of their own, where every pair that is not
joined yet is verified. Such a group returns at most one link for each member, so no list of pairs is ever written.

Cases: null is the empty text, whose fingerprint is all f; two empty ones are alike (1), an empty and another are not (0); fewer than five words
are one shingle; repeated ids stand in the order of their texts, each with the next as its neighbour; null ids come last; a single row is its
own neighbour; an empty table gives an empty result; other columns are not kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.common import WHITE, Spans, components, shingle_hashes, slices, span_hashes, stage

PERMUTATIONS = 128
WIDTH = 5
#: A pair of likeness 0.8 shares one of the bands with a probability of 0.998.
BANDS, ROWS = 20, 6
#: Rows in a range of ids, on average; more where there would be over MOST_RANGES ranges, whose first ids (8 bytes each) go to all tasks.
RANGE_ROWS = 4096
MOST_RANGES = 1_000_000
CHUNK = 2048
#: Classes, and shingles of them, in a block of a bucket on average.
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 500_000
_draw = np.random.default_rng(20240229)
FACTORS = _draw.integers(0, 2**31, PERMUTATIONS, np.uint32) * np.uint32(2) + np.uint32(1)
ADDED = _draw.integers(0, 2**32, PERMUTATIONS, np.uint32)
EMPTY = 0xFFFF


def shingles(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, and where each text's begin."""
    words = Spans(texts, ~WHITE)
    return shingle_hashes(span_hashes(words.data, words.starts, words.ends), words.first, width)


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of the 32-bit numbers (shift, multiply, shift)."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x85EBCA6B)
    x = x ^ (x >> np.uint32(13))
    x = x * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def signatures(texts: list[bytes]) -> np.ndarray:
    """A row of 16-bit values for each text."""
    out = np.full((len(texts), PERMUTATIONS), 0xFFFFFFFF, np.uint32)
    for part in slices(texts):
        hashes, begin = shingles(texts[part])
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        mine = out[part]
        owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        for i in range(0, len(short), CHUNK):
            images = short[i : i + CHUNK, None] * FACTORS
            images += ADDED
            of = owner[i : i + CHUNK]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1])
            lowest = np.minimum.reduceat(images, edges, axis=0)
            mine[of[edges]] = np.minimum(mine[of[edges]], lowest)
        mine[:] = scrambled(mine)
        mine[np.diff(begin) == 0] = EMPTY
    return out.astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal values, less what 16 bits agree on by chance."""
    same = (a == b).mean(axis=1)
    return np.clip((same - 2.0**-16) / (1 - 2.0**-16), 0, 1)


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    every = max(RANGE_ROWS, docs.count() // MOST_RANGES)
    begins = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("doc_id").union(docs.agg(F.min("doc_id").alias("doc_id")))
    places = np.array(sorted({r[0] for r in begins.distinct().collect() if r[0] is not None}), np.int64)
    shared = spark.sparkContext.broadcast(places)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Give every row its range (null ids: the last) and copy the rows that begin one to the range before (the first: to the last)."""
        cuts = shared.value
        last = max(len(cuts) - 1, 0)
        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            number = ids.fill_null(0).cast(pa.int64()).to_numpy()
            place = np.where(known, np.searchsorted(cuts, number, "right") - 1, last)
            opens = np.flatnonzero(known & np.isin(number, cuts)) if len(cuts) else np.flatnonzero(~known)
            before = np.where(place[opens] > 0, place[opens] - 1, last)
            copies = batch.take(pa.array(opens))
            for rows, to, extra in ((batch, place, False), (copies, before, True)):
                flags = pa.array(np.full(len(to), extra))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(to.astype(np.int64)), flags], ["doc_id", "text", "place", "extra"])

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    dealt = texts.mapInArrow(deal, f"doc_id {kind.simpleString()}, text string, place long, extra boolean")
    walked = dealt.repartition("place").sortWithinPartitions("place", "extra", F.col("doc_id").asc_nulls_last(), "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            rows = list(zip(*[c.to_pylist() for c in batch.columns], strict=True))
            sizes = [r[1] for r in rows]
            for part in slices(sizes):
                held += rows[part]
                if len(held) > 1:
                    yield done(held)
                    held = held[-1:]

    def done(rows: list) -> pa.RecordBatch:
        """Results of all rows but the last, which is the neighbour of the one before."""
        plain = signatures([r[1].encode() for r in rows])
        use = [i for i in range(len(rows) - 1) if not rows[i][3] and rows[i][2] == rows[i + 1][2]]
        changed = [edited(rows[i][1], rows[i + 1][1]).encode() for i in use]
        other = signatures(changed)
        mine, following = plain[use], plain[[i + 1 for i in use]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][0] for i in use], pa.int64()),
                pa.array([len(rows[i][1]) for i in use], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
                pa.array([x.astype(">u2").tobytes().hex() for x in mine], pa.string()),
                pa.array([x.astype(">u2").tobytes().hex() for x in other], pa.string()),
                pa.array(likeness(mine, other), pa.float64()),
                pa.array(likeness(mine, following), pa.float64()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    return walked.mapInArrow(
        walk,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def _number(data: bytes, band: int = 0) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8, person=bytes([band])).digest(), "big", signed=True)


def signed_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, class, size, bands): a number for the set of shingles, its size, and a number for each band of the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
            for part in slices(texts):
                mine = texts[part]
                hashes, begin = shingles(mine)
                sets = [np.unique(hashes[a:b]) for a, b in zip(begin, begin[1:], strict=False)]
                bands = [[_number(row[ROWS * k : ROWS * (k + 1)].tobytes(), k) for k in range(BANDS)] for row in signatures(mine)]
                same = [batch.column(i).slice(part.start, len(mine)) for i in range(2)]
                rest = [pa.array([_number(x.tobytes()) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*same, *rest], ["doc_id", "text_hash", "class", "size", "bands"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, class long, size long, bands array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """(class, shingles) of documents: the sets themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(0).to_pylist()]
            for part in slices(texts):
                hashes, begin = shingles(texts[part])
                sets = [np.unique(hashes[a:b]) for a, b in zip(begin, begin[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_number(x.tobytes()) for x in sets], pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], ["class", "shingles"]
                )

    return docs.select("text").mapInArrow(run, "class long, shingles array<long>")


def block_links(classes: np.ndarray, roots: np.ndarray, side: np.ndarray, begin: np.ndarray, values: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links that join all classes of different ``side`` (or all, if there is one side) with a likeness of ``least`` or more and different ``roots``.

    The set of class i is ``values[begin[i]:begin[i + 1]]``. Those whose shingles are the most frequent go first, for they join the most.
    """
    _, label = np.unique(roots, return_inverse=True)
    if not len(label) or not label.any():
        return []
    sizes, across = np.diff(begin), bool((side != side[0]).any())
    _, at, times = np.unique(values, return_inverse=True, return_counts=True)
    sums = np.concatenate([[0], np.cumsum(times[at])])
    order = np.argsort(-(sums[begin[1:]] - sums[begin[:-1]]) / np.maximum(sizes, 1), kind="stable")
    present = np.zeros(len(times), bool)
    links = []
    for place, i in enumerate(order):
        other = order[place + 1 :]
        near = (label[other] != label[i]) & (np.minimum(sizes[other], sizes[i]) >= least * np.maximum(sizes[other], sizes[i])) & (sizes[other] > 0)
        other = other[near & (side[other] != side[i])] if across else other[near]
        if not len(other):
            continue
        mine = at[begin[i] : begin[i + 1]]
        present[mine] = True
        ends = np.concatenate([[0], np.cumsum(sizes[other])])
        found = np.concatenate([[0], np.cumsum(present[at[np.repeat(begin[other] - ends[:-1], sizes[other]) + np.arange(ends[-1])]])])
        present[mine] = False
        common = found[ends[1:]] - found[ends[:-1]]
        for j in other[common >= least * (sizes[other] + sizes[i] - common)].tolist():
            if label[j] != label[i]:
                links.append((int(classes[i]), int(classes[j])))
                label[label == label[j]] = label[i]
    return links


def _all_met(posted: DataFrame, sets: Callable[[DataFrame], DataFrame], least: float) -> DataFrame:
    """Links (u, v) that join the different roots in buckets. ``posted``: class, size, bucket, root; ``sets``: those of the classes of a frame."""
    several = posted.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n"), F.sum("size").alias("shingles")).where("a <> b")
    blocks = F.ceil(F.greatest(F.col("n") / F.lit(BLOCK_CLASSES), F.col("shingles") / F.lit(BLOCK_SHINGLES), F.lit(1.0))).cast("int")
    rows = stage(posted.where("size > 0").join(several.select("bucket", blocks.alias("blocks")), "bucket"), "minhash-mixed")
    side = F.pmod(F.xxhash64("class", "bucket"), F.col("blocks").cast("long")).cast("int")
    cells = rows.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("bucket", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "class", "root")
    dealt = cells.join(sets(rows.select("class").distinct()), "class")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        lists = group.column("shingles").combine_chunks()
        lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
        begin = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        classes, roots, side = (group.column(c).to_numpy() for c in ("class", "root", "side"))
        links = block_links(classes, roots, side, begin, lists.flatten().to_numpy(), least)
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    return dealt.groupBy("bucket", "i", "j").applyInArrow(run, "u long, v long")


def class_links(docs: DataFrame, signed: DataFrame, least: float) -> DataFrame:
    """Links (u, v) that join all classes of the rows ``signed`` of ``docs`` that share a band and have a likeness of ``least`` or more."""
    known = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = stage(signed.groupBy("class").agg(F.any_value("bands").alias("bands"), F.any_value("size").alias("size"), F.min(known).alias("first")), "minhash-classes")

    def sets(wanted: DataFrame) -> DataFrame:
        """The sets of wanted classes, each from one text."""
        rows = classes.join(wanted, "class").select("first.*")
        same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_hash") == F.col("w.text_hash"))
        texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").alias("d").join(rows.alias("w"), same).select("d.*")
        return stage(_sets(texts).dropDuplicates(["class"]), "minhash-sets")

    posted = classes.select("class", "size", "first", F.explode("bands").alias("bucket"))
    lowest = posted.groupBy("bucket").agg(F.min(F.struct("first", "class")).alias("low"), F.count("*").alias("n")).where("n > 1")
    shared = posted.join(lowest.select("bucket", F.col("low.class").alias("low")), "bucket")
    # In a bucket each meets the one with the smallest id, and a neighbour in an order of the bucket's own.
    turn = Window.partitionBy("bucket").orderBy(F.xxhash64("bucket", "class"), "class")
    met = shared.withColumn("next", F.lead("class").over(turn))
    met = met.select("class", F.explode(F.array("low", "next")).alias("other")).where("class <> other")
    pairs = stage(met.select(F.least("class", "other").alias("u"), F.greatest("class", "other").alias("v")).distinct(), "minhash-pairs")
    found = sets(pairs.select(F.explode(F.array("u", "v")).alias("class")).distinct())
    both = pairs.join(found.toDF("u", "a"), "u").join(found.toDF("v", "b"), "v")
    common = F.size(F.array_intersect("a", "b"))
    links = both.where((common >= F.lit(least) * (F.size("a") + F.size("b") - common)) & (F.size("a") > 0)).select("u", "v")
    roots = components(links, "minhash-links").toDF("class", "root")
    # What this leaves apart in a bucket is compared pair by pair.
    rooted = shared.select("class", "size", "bucket").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    rest = _all_met(rooted, lambda wanted: found.join(wanted, "class"), least)
    return stage(roots.toDF("u", "v").union(rest), "minhash-joined")


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, component_id): documents joined by shingle sets with a Jaccard likeness of ``least`` or more, through bands of the signatures."""
    signed = stage(signed_sets(docs), "minhash")
    roots = components(class_links(docs, signed, least), "minhash-parts").toDF("class", "root")
    rooted = signed.groupBy("class").agg(F.min("doc_id").alias("first")).join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return signed.select("doc_id", "class").join(rooted.join(smallest, "root").select("class", "component_id"), "class").select("doc_id", "component_id")
