"""SimHash near-duplicates: all links within a few differing bits, found by a Gray-order hierarchical index.

A bit of a fingerprint is 1 if it is set in over half of the hashes of a text's shingles. For links within d bits a fingerprint is cut into
d + 4 blocks; two linked fingerprints agree on at least four of them. For each choice of four blocks the bits are rearranged with these in
front and the fingerprints sorted by the Gray rank of the result, so those which share the four blocks are neighbours: the upper nodes. With
d = 2 a node is left with at most 22 free bits, so it never has more than 4 million different fingerprints (32 MB), whatever the input.
Below an upper node runs of neighbours form a binary hierarchy. A node holds the mask of the bits its members share and their pattern; pairs
of nodes are compared from the top, and a pair whose patterns differ in more than d shared bits is dropped with all its members.

Equal fingerprints are one row of the index, with their smallest id, so copies never meet in pairs. A node returns at most one link for each
member (to the root of its part), and ``common.components`` joins the parts of all nodes.

Cases: null and empty texts have the fingerprint zero and link like any other; null ids take part but are never the smallest of a component
unless it has no other; repeated rows get the same component each; an empty table gives an empty result; other columns are not kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import components, slices, stage, text_column

SEED = 42
#: Blocks that two linked fingerprints share at least.
AGREE = 4
LEAF = 16
#: Pairs of nodes that are compared at once.
PAIRS = 4096


def fingerprints(texts: list[bytes], width: int) -> np.ndarray:
    """The fingerprints of texts already lower-cased; counts of set bits are added up in byte lanes, 255 shingles at a time."""
    out = np.zeros(len(texts), np.uint64)
    split = [t.split() for t in texts]
    used = [i for i, w in enumerate(split) if w]
    if not used:
        return out
    joined = b" ".join(b" ".join(split[i]) for i in used)
    counts = np.array([len(split[i]) for i in used])
    lengths = np.fromiter((len(w) for i in used for w in split[i]), np.int64, counts.sum())
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = starts + lengths
    first = np.concatenate([[0], np.cumsum(counts)])
    several = np.maximum(counts - width + 1, 1)
    begin = np.concatenate([[0], np.cumsum(several)])
    at = np.repeat(first[:-1] - begin[:-1], several) + np.arange(begin[-1])
    last = at + np.repeat(np.minimum(counts, width), several) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[at].tolist(), ends[last].tolist(), strict=True)), np.uint64, begin[-1])
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    parts = (several + 254) // 255
    part_first = np.concatenate([[0], np.cumsum(parts)])
    cuts = np.repeat(begin[:-1], parts) + 255 * (np.arange(part_first[-1]) - np.repeat(part_first[:-1], parts))
    lanes = np.add.reduceat(bits.view(np.uint64), cuts, axis=0)
    ones = np.add.reduceat(np.ascontiguousarray(lanes).view(np.uint8).astype(np.uint32), part_first[:-1], axis=0)
    majority = np.packbits(ones * 2 > several[:, None], axis=1, bitorder="little")
    out[used] = np.ascontiguousarray(majority).view(np.uint64).ravel()
    return out


def with_fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, code): the fingerprint of every whole text as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode().lower() for t in text_column(batch)]
            codes = np.concatenate([fingerprints(texts[s], width) for s in slices(texts)] or [np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes.view(np.int64))], ["doc_id", "code"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, code long")


def layouts(distance: int) -> list[tuple[list[tuple[int, int]], int]]:
    """For each choice of blocks: the (offset, width) of the blocks from the top down, and the number of bits of the chosen ones."""
    n = distance + AGREE
    sizes = [64 // n + (i < 64 % n) for i in range(n)]
    blocks = [(sum(sizes[:i]), sizes[i]) for i in range(n)]
    out = []
    for chosen in combinations(range(n), AGREE):
        order = [*chosen, *(i for i in range(n) if i not in chosen)]
        out.append(([blocks[i] for i in order], sum(sizes[i] for i in chosen)))
    return out


def arranged(codes: np.ndarray, blocks: list[tuple[int, int]]) -> np.ndarray:
    """The bits of the codes with the blocks from the top down."""
    out, top = np.zeros(len(codes), np.uint64), 64
    for offset, width in blocks:
        top -= width
        out |= (codes >> np.uint64(offset) & np.uint64((1 << width) - 1)) << np.uint64(top)
    return out


def gray_rank(words: np.ndarray) -> np.ndarray:
    """The places of code words in the Gray sequence. Words with equal leading bits have places with equal leading bits."""
    for step in (1, 2, 4, 8, 16, 32):
        words = words ^ (words >> np.uint64(step))
    return words


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the parts of linked members; a label points to the smallest member of its part."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label[:] = label[label]


def tree_parts(codes: np.ndarray, distance: int) -> np.ndarray:
    """The label of each of ``codes`` (different, in Gray order): the place of the first member of its part."""
    n = len(codes)
    label = np.arange(n)
    starts = np.arange(0, n, LEAF)
    levels = [(np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts))]
    while len(levels[-1][0]) > 1:
        low, high = levels[-1]
        pairs = np.arange(0, len(low), 2)
        levels.append((np.bitwise_and.reduceat(low, pairs), np.bitwise_or.reduceat(high, pairs)))
    nodes = [(low, ~(low ^ high)) for low, high in levels]
    padded = np.arange(len(starts) * LEAF).reshape(-1, LEAF)
    filled = codes[np.minimum(padded, n - 1)]
    stack = [(len(nodes) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        if len(a) > PAIRS:
            stack += [(level, a[i : i + PAIRS], b[i : i + PAIRS]) for i in range(0, len(a), PAIRS)]
            continue
        pattern, mask = nodes[level]
        near = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= distance
        a, b = a[near], b[near]
        if not len(a):
            continue
        if level == 0:
            for i in range(0, len(a), 512):
                x, y = a[i : i + 512], b[i : i + 512]
                p, j, k = np.nonzero(np.bitwise_count(filled[x][:, :, None] ^ filled[y][:, None, :]) <= distance)
                left, right = padded[x[p], j], padded[y[p], k]
                real = (left < n) & (right < n) & (left < right)
                unite(label, left[real], right[real])
            continue
        width = len(nodes[level - 1][0])
        a2 = np.concatenate([2 * a, 2 * a, 2 * a + 1, 2 * a + 1])
        b2 = np.concatenate([2 * b, 2 * b + 1, 2 * b + 1, 2 * b])
        real = (a2 < width) & (b2 < width) & (a2 <= b2)
        stack.append((level - 1, a2[real], b2[real]))
    return label


def code_links(codes: DataFrame, distance: int = 2) -> DataFrame:
    """Links (u, v) between different fingerprints of the column ``code`` that join all within ``distance`` bits."""
    plans = layouts(distance)
    free = np.array([64 - bits for _, bits in plans], np.uint64)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0)
            for i, (blocks, _) in enumerate(plans):
                ranks = gray_rank(arranged(code.to_numpy().view(np.uint64), blocks))
                columns = [pa.array(np.full(len(code), i, np.int32)), pa.array((ranks >> free[i]).view(np.int64)), pa.array(ranks.view(np.int64)), code]
                yield pa.RecordBatch.from_arrays(columns, ["plan", "node", "rank", "code"])

    ranked = codes.select("code").mapInArrow(rank, "plan int, node long, rank long, code long")
    dealt = ranked.repartition("plan", "node").sortWithinPartitions("plan", "rank").select("plan", "rank", "code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            kept = [np.concatenate(x) for x in zip(kept, new, strict=True)] if kept else new
            plan, node = kept[0], kept[1].view(np.uint64) >> free[kept[0]]
            cuts = np.flatnonzero((np.diff(plan) != 0) | (node[1:] != node[:-1])) + 1
            if len(cuts):
                yield linked(kept[2][: cuts[-1]], np.concatenate([[0], cuts]))
                kept = [x[cuts[-1] :] for x in kept]
        if kept:
            yield linked(kept[2], np.array([0, len(kept[2])]))

    def linked(code: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        sizes, bits = np.diff(cuts), code.view(np.uint64)
        twos = cuts[:-1][sizes == 2]
        twos = twos[np.bitwise_count(bits[twos] ^ bits[twos + 1]) <= distance]
        u, v = [code[twos]], [code[twos + 1]]
        for k in np.flatnonzero(sizes > 2):
            members = code[cuts[k] : cuts[k + 1]]
            label = tree_parts(members.view(np.uint64), distance)
            some = np.flatnonzero(label != np.arange(len(label)))
            u.append(members[some])
            v.append(members[label[some]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], ["u", "v"])

    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, code, component_id) of every document."""
    marked, of_code = classes(docs, width, distance)
    return marked.join(of_code, "code").select("doc_id", "code", "component_id")


def classes(docs: DataFrame, width: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, code) of every document, and (code, component_id) of every fingerprint."""
    marked = stage(with_fingerprints(docs, width), "simhash")
    codes = marked.groupBy("code").agg(F.min("doc_id").alias("first"))
    roots = components(code_links(codes.select("code"), distance), "simhash-links")
    rooted = codes.join(roots.withColumnRenamed("node", "code"), "code", "left").withColumn("root", F.coalesce("root", "code"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked, rooted.join(smallest, "root").select("code", "component_id")


def one_of_each(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest doc_id stays (null last, then by the text's hash)."""
    text = F.xxhash64("text")
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", text.alias("text")).alias("doc_id"), "text")
    marked, of_code = classes(named, width, distance)
    return of_keys(docs, of_code.select(F.col("component_id").alias("first")).distinct(), marked)


def of_keys(docs: DataFrame, first: DataFrame, marked: DataFrame) -> DataFrame:
    """One row of ``docs`` for each key of ``first``. Keys are structs (none, doc_id, text: hash); ``marked`` has that of every row as ``doc_id``."""
    counts = marked.groupBy("doc_id").agg(F.count("*").alias("rows"))
    key = ["id", "none", "text"]
    keyed = [F.coalesce("key.doc_id", F.lit(0)).alias("id"), F.col("key.none").alias("none"), F.col("key.text").alias("text")]
    stay = first.select(F.col("first").alias("key")).select(*keyed).join(counts.withColumnRenamed("doc_id", "key").select(*keyed, "rows"), key)
    text = F.xxhash64("text").alias("text")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), text)
    kept = whole.join(stay, key)
    # Only rows that repeat as a whole have to meet to leave one.
    once = kept.where("rows = 1").select("row.*")
    twice = kept.where("rows > 1").dropDuplicates(key).select("row.*")
    return once.union(twice)


def hexadecimal(code: Column) -> Column:
    return F.lower(F.lpad(F.hex(code), 16, "0"))
