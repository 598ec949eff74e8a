"""Collocations: phrases of two and three words that occur together more often than their parts would let one expect.

Two passes over the texts. The first hashes every run of one to three words and deals the hashes to partitions of the hash range. Tasks send
mergeable Misra-Gries summaries, one for each partition and about ``FLUSH`` runs; they are merged in one summary a partition, whose capacity exceeds
the partition's mass (all occurrences of all its runs) divided by the threshold. A summary's counts fall short by less than the threshold then, so
every run that is frequent enough survives. The number of partitions follows the amount of text, so a summary has the same bound at every size; a
very common run is one entry of each summary sent.

The survivors set bits in a filter of bounded size (``FILTER_BITS``, the only thing that all tasks get). The second pass counts what passes the
filter, exactly and by the words themselves; what the filter lets through by chance (all of it, were the filter full) has its exact count too and
falls below the threshold like anything else.

Cases: null text is empty; a null language is ``und``, and one with that name; repeated rows and null ids count as they stand; very long texts are
cut between pieces, where no phrase is lost, so a piece is what has to fit in memory; an empty table gives an empty result; other columns are not
read. Ties of a score are in the order of the phrase's bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.common import LOW_BYTES, Spans, mixed, slices, span_hashes, stage, text_column

UNKNOWN = "und"
LONGEST = 3
#: Occurrences of a hash partition, and of a summary that a task sends.
PARTITION_MASS, FLUSH = 6_000_000, 4_000_000
FILTER_BITS = 28
SLICE, ENTRIES = 1_000_000, 100_000

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~SEPARATOR
WORD[[0x20, 0x09]] = False
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Runs:
    """All runs of 1 to ``LONGEST`` words within the pieces of some texts (lower-case bytes), text by text of language ``langs[i]``."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        spans = Spans(texts, WORD)
        self.data, self.starts, self.ends = spans.data, spans.starts, spans.ends
        self.text = np.repeat(np.arange(len(texts)), spans.counts)
        # Words of a piece have the same number of separators before them; the newline between texts is one.
        self.piece = np.cumsum(SEPARATOR[self.data[: spans.offsets[-1]]], dtype=np.int64)[self.starts]
        seeds = {lang: np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")) for lang in set(langs)}
        self.seed = np.array([seeds[lang] for lang in langs], np.uint64)[self.text]
        self.word = span_hashes(self.data, self.starts, self.ends)

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the runs of so many words."""
        first = np.arange(max(len(self.starts) - length + 1, 0))
        first = first[self.piece[first] == self.piece[first + length - 1]]
        return first, self.hashed(self.word, first, length)

    def hashed(self, word: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
        out = self.seed[first] + np.uint64(length)
        for j in range(length):
            out = out * _ODD + word[first + j]
        return mixed(out)

    def check(self, first: np.ndarray, length: int) -> np.ndarray:
        """A second value of the runs, from the words' first and last eight bytes: tells runs of equal hashes apart."""
        lanes = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        left = self.ends - self.starts
        head = lanes[self.starts] & LOW_BYTES[np.minimum(left, 8)]
        tail = lanes[np.maximum(self.ends - 8, self.starts)] & LOW_BYTES[np.minimum(left, 8)]
        return self.hashed(mixed(head) ^ tail ^ left.astype(np.uint64) * _ODD, first, length)

    def phrase(self, first: int, length: int) -> bytes:
        return b" ".join(self.data[self.starts[first] : self.ends[first + length - 1]].tobytes().split())


def pieces_of(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts of a batch in lower case and their languages, in slices; a long text is cut behind a separator."""
    texts, langs = [], []
    for text, lang in zip(text_column(batch), text_column(batch, "lang"), strict=True):
        data, at = text.encode().lower(), 0
        while len(data) - at > SLICE:
            window = np.frombuffer(data, np.uint8, SLICE, at)
            places = np.flatnonzero(SEPARATOR[window])
            if len(places):
                end = at + int(places[-1]) + 1
            else:
                rest = np.flatnonzero(SEPARATOR[np.frombuffer(data, np.uint8, -1, at + SLICE)])
                end = at + SLICE + int(rest[0]) + 1 if len(rest) else len(data)
            texts.append(data[at:end])
            langs.append(lang)
            at = end
        if at < len(data):
            texts.append(data[at:])
            langs.append(lang)
    for part in slices(texts, SLICE):
        yield texts[part], langs[part]


def partition_keys(hashes: np.ndarray, partitions: int) -> np.ndarray:
    """The partition of a hash above 32 bits of it."""
    high = hashes >> np.uint64(32)
    return (high * np.uint64(partitions) & ~np.uint64(0xFFFFFFFF)) | (hashes & np.uint64(0xFFFFFFFF))


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs; the given values are sorted where they are."""
    keys.sort()
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[begin], np.diff(np.append(begin, len(keys)))


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """32 bits a key; counts of those that occur more than once."""
    several = np.flatnonzero(counts > 1)
    return b"".join(x.astype("<u4").tobytes() for x in (np.array([len(keys)]), keys, several, counts[several]))


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    values = np.frombuffer(data, "<u4")
    n = int(values[0])
    counts = np.ones(n, np.int64)
    several, more = np.split(values[n + 1 :], 2)
    counts[several] = more
    return values[1 : n + 1], counts


class Summary:
    """Misra-Gries: at most ``capacity`` keys. A key's count falls short by at most ``lost``, which stays below mass / capacity."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.waiting += len(keys)
        if self.waiting > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        if len(keys):
            begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, counts = keys[begin], np.add.reduceat(counts, begin)
        if len(keys) > self.capacity:
            # The count of rank capacity + 1 is taken from all: from more than `capacity` keys in full.
            place = len(keys) - self.capacity - 1
            cut = int(np.partition(counts, place)[place])
            counts = counts - cut
            keys, counts = keys[counts > 0], counts[counts > 0]
            self.lost += cut
        self.keys, self.counts, self.waiting = [keys], [counts], 0

    def frequent(self, threshold: int) -> np.ndarray:
        """All keys that can have occurred so often."""
        self.merge()
        return self.keys[0][self.counts[0] + self.lost >= threshold]


def summaries(docs: DataFrame, partitions: int) -> DataFrame:
    """Rows of (partition, mass) and, behind them in order, of (partition, summary)."""
    names = ["part", "kind", "mass", "summary"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            together = np.concatenate(waiting)
            waiting.clear()
            keys, counts = counted(together)
            places = np.searchsorted(keys, np.arange(partitions + 1, dtype=np.uint64) << np.uint64(32))
            sums = np.concatenate([[0], np.cumsum(counts)])
            used = np.flatnonzero(np.diff(places))
            low = keys.astype(np.uint32)
            data = [packed(low[places[p] : places[p + 1]], counts[places[p] : places[p + 1]]) for p in used]
            mass = [int(sums[places[p + 1]] - sums[places[p]]) for p in used]
            for kind, m, d in ((0, mass, [b""] * len(used)), (1, [0] * len(used), data)):
                columns = [pa.array(used, pa.int32()), pa.array([kind] * len(used), pa.int32()), pa.array(m, pa.int64()), pa.array(d, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for texts, langs in pieces_of(batch):
                runs = Runs(texts, langs)
                for length in range(1, LONGEST + 1):
                    waiting.append(partition_keys(runs.of(length)[1], partitions))
                    n += len(waiting[-1])
                if n >= FLUSH:
                    yield from flush()
                    n = 0
        if n:
            yield from flush()

    return docs.mapInArrow(run, "part int, kind int, mass long, summary binary")


def survivors(sent: DataFrame, partitions: int, threshold: int) -> DataFrame:
    """Keys (partition and 32 bits) of all runs that can be frequent, from merged summaries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None

        def finished() -> Iterator[pa.RecordBatch]:
            if summary:
                keys = summary.frequent(threshold).astype(np.int64) | (part << 32)
                for at in range(0, len(keys), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + 100_000], pa.int64())], ["key"])

        for batch in batches:
            for p, kind, m, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if p != part:
                    yield from finished()
                    part, mass, summary = p, 0, None
                if kind == 0:
                    mass += m
                else:
                    summary = summary or Summary(mass // threshold)
                    summary.add(*unpacked(data))
        yield from finished()

    dealt = sent.repartition(partitions, "part").sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(run, "key long")


def filter_of(keys: DataFrame, bits: int) -> np.ndarray:
    """Bytes with the bits of all keys; ``2 ** bits`` bits whatever the number of keys."""
    # The built-in bitmaps count from 1, places and buckets of 32,768 bits alike.
    place = F.shiftrightunsigned(F.xxhash64("key"), 64 - bits) + 1
    rows = keys.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("bucket"))
    found = rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    out = np.zeros(max(1 << (bits - 3), 4096), np.uint8)
    for row in found:
        at = (row["bucket"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def spark_hash(keys: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of longs (XXH64 of eight bytes, seed 42)."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def rotated(x: np.ndarray, n: int) -> np.ndarray:
        return (x << np.uint64(n)) | (x >> np.uint64(64 - n))

    h = (np.uint64(42 + 8) + p5) ^ (rotated(keys * p2, 31) * p1)
    h = rotated(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def grouped(hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct pair, and how often the pair occurs."""
    order = np.argsort(hashes, kind="stable")
    new = hashes[order][1:] != hashes[order][:-1]
    if np.any(~new & (checks[order][1:] != checks[order][:-1])):
        order = np.lexsort((checks, hashes))
        new = (hashes[order][1:] != hashes[order][:-1]) | (checks[order][1:] != checks[order][:-1])
    begin = np.flatnonzero(np.concatenate([[True], new])) if len(order) else np.zeros(0, np.int64)
    return order[begin], np.diff(np.append(begin, len(order)))


def exact_counts(docs: DataFrame, bitmap: np.ndarray, bits: int, partitions: int) -> DataFrame:
    """(lang, words, phrase, n) of all runs that pass the filter; ``words`` 0 has a language's number of words."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    names = ["lang", "words", "phrase", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing, found = shared.value, {}

        def rows() -> pa.RecordBatch:
            keys = list(found)
            columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.int32(), pa.binary()))]
            columns[2] = columns[2].cast(pa.string())
            return pa.RecordBatch.from_arrays([*columns, pa.array(list(found.values()), pa.int64())], names)

        for batch in batches:
            for texts, langs in pieces_of(batch):
                runs = Runs(texts, langs)
                words = np.bincount(runs.text, minlength=len(langs))
                for lang, n in zip(langs, words.tolist(), strict=True):
                    if n:
                        found[lang, 0, b""] = found.get((lang, 0, b""), 0) + n
                for length in range(1, LONGEST + 1):
                    first, hashes = runs.of(length)
                    place = spark_hash(partition_keys(hashes, partitions)) >> np.uint64(64 - bits)
                    passed = np.flatnonzero(passing[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                    first, hashes = first[passed], hashes[passed]
                    at, counts = grouped(hashes, runs.check(first, length))
                    chosen = first[at]
                    begins, ends = runs.starts[chosen].tolist(), runs.ends[chosen + length - 1].tolist()
                    data = runs.data.tobytes()
                    for text, begin, end, n in zip(runs.text[chosen].tolist(), begins, ends, counts.tolist(), strict=True):
                        key = langs[text], length, b" ".join(data[begin:end].split())
                        found[key] = found.get(key, 0) + n
                if len(found) >= ENTRIES:
                    yield rows()
                    found = {}
        if found:
            yield rows()

    counts = docs.mapInArrow(run, "lang string, words int, phrase string, n long")
    return counts.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


def frequent_runs(docs: DataFrame, threshold: int, partition_mass: int = PARTITION_MASS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Exact counts of all runs of 1 to 3 words that occur ``threshold`` times or more in a language (a staged table); ``words`` 0 as above."""
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # A word has six bytes or so with its blank; the number of partitions needs no more than an estimate.
    partitions = size * LONGEST // 6 // partition_mass + 1
    keys = stage(survivors(summaries(rows, partitions), partitions, threshold), "phrase-keys")
    bits = min(filter_bits, max(16, (16 * keys.count()).bit_length()))
    counts = exact_counts(rows, filter_of(keys, bits), bits, partitions)
    return stage(counts.where((F.col("n") >= threshold) | (F.col("words") == 0)), "phrase-counts")


def collocations(docs: DataFrame, threshold: int = 10, kept_percent: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language."""
    return scored(frequent_runs(docs, threshold), kept_percent, top)


def scored(counts: DataFrame, kept_percent: int, top: int) -> DataFrame:
    """Scores of the phrases of a table of counts, which has all parts of every phrase in it."""
    phrases = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    known = counts.where("words > 0").select("lang", "phrase", "n")

    def part(begin: str, length: str) -> F.Column:
        return F.expr(f"array_join(slice(split(phrase, ' '), {begin}, {length}), ' ')")

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part("1", "k").alias("first"), part("k + 1", "words - k").alias("rest"))
    cuts = cuts.join(known.toDF("lang", "first", "l"), ["lang", "first"]).join(known.toDF("lang", "rest", "r"), ["lang", "rest"])
    # Counts of up to 15 digits, so products of up to 36; the whole-number quotient is at most a million.
    score = F.expr("1000000 * (cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    longer = phrases.where("words = 3")
    inner = longer.select("lang", "a", F.explode(F.array(part("1", "2"), part("2", "2"))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < kept_percent * F.col("a")))

    # The best of each share of a language's phrases first, so that no task has all phrases of a language.
    shares = int((phrases.count() / top) ** 0.5) + 1
    best_first = [F.desc("score"), F.desc("a"), F.col("phrase")]
    listed = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(shares)).alias("share"))
    for by in (["lang", "share"], ["lang"]):
        listed = listed.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*best_first))).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", "n")
    return listed.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
with docs as (
  select row_number() over () as d, coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
), pieces as (
  select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from docs
), worded as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), runs as (
  select lang, 1 as m, unnest(w) as phrase from worded
  union all select lang, 2, unnest(list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2])) from worded where len(w) > 1
  union all select lang, 3, unnest(list_transform(list_zip(w[:-3], w[2:-2], w[3:]), lambda p: p[1] || ' ' || p[2] || ' ' || p[3])) from worded where len(w) > 2
), counts as materialized (
  select lang, m, phrase, count(*) as f from runs group by all
), totals as (
  select lang, cast(sum(f) as bigint) as n from counts where m = 1 group by lang
), candidates as materialized (
  select lang, m, phrase, f as a, string_split(phrase, ' ') as w from counts where m > 1 and f >= 10
), splits as materialized (
  select lang, m, phrase, a, 1 as k, w[1] as head, array_to_string(w[2:], ' ') as rest from candidates
  union all select lang, m, phrase, a, 2, w[1] || ' ' || w[2], w[3] from candidates where m = 3
), cuts as (
  select c.lang, c.m, c.phrase, c.a, c.k, x.f as l, y.f as r, (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as score
  from splits c join counts x on x.lang = c.lang and x.phrase = c.head join counts y on y.lang = c.lang and y.phrase = c.rest
), best as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inside as (
  select lang, phrase, max(a) as longer
  from (select lang, w[1] || ' ' || w[2] as phrase, a from candidates where m = 3 union all select lang, w[2] || ' ' || w[3], a from candidates where m = 3)
  group by all
), ranked as (
  select b.*, row_number() over (partition by b.lang order by b.score desc, b.a desc, b.phrase) as rank
  from best b left join inside i on b.lang = i.lang and b.phrase = i.phrase
  where i.longer is null or 100 * i.longer < 50 * b.a
)
select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score from ranked join totals using (lang) where rank <= 2000
"""
