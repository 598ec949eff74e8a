import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from gondola.llm import phrases
from gondola.llm.queries import op11_collocations

from .helpers import AWKWARD, SMALL, documents, with_clashes

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def counts_of(rows):
    """Counters of runs by language, and of words."""
    found, words = {}, Counter()
    for r in rows:
        lang = "und" if r["lang"] is None else r["lang"]
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"] or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall("[^ \t]+", piece)
            words[lang] += len(w)
            for m in (1, 2, 3):
                for i in range(len(w) - m + 1):
                    found.setdefault(lang, Counter())[" ".join(w[i : i + m])] += 1
    return found, words


def expected(rows, threshold=10, top=2000):
    found, words = counts_of(rows)
    out = []
    for lang, f in found.items():
        candidates = {p: n for p, n in f.items() if " " in p and n >= threshold}
        scored = []
        for phrase, a in candidates.items():
            w = phrase.split(" ")
            cuts = [(1_000_000 * a * a // (f[" ".join(w[:k])] * f[" ".join(w[k:])]), k, f[" ".join(w[:k])], f[" ".join(w[k:])]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            inside = [n for p, n in candidates.items() if len(p) > len(phrase) and f" {phrase} " in f" {p} "]
            if not any(100 * n >= 50 * a for n in inside):
                scored.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def got(frame):
    return sorted(map(tuple, frame.select(COLUMNS).collect()))


ROWS = [*AWKWARD, *[(100 + i, "New York city, new\tYORK  state. the new york; É né é né a b a b a b", "en" if i % 2 else None, "s", 1) for i in range(30)]]


def test_awkward_rows(spark):
    frame = with_clashes(documents(spark, ROWS), "phrase", "score", "n", "words")
    assert got(phrases.collocations(frame)) == expected(frame.collect())
    assert phrases.collocations(documents(spark, [])).count() == 0


def test_many_small_partitions_and_a_full_filter(spark, monkeypatch):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    wanted = expected(frame.collect(), 5, 50)
    few = phrases.frequent_runs(frame, 5, partition_mass=500, filter_bits=16)
    assert got(phrases.scored(few, 50, 50)) == wanted
    # A filter that lets everything through changes nothing.
    monkeypatch.setattr(phrases, "filter_of", lambda keys, bits: np.full(1 << (bits - 3), 255, np.uint8))
    assert got(phrases.scored(phrases.frequent_runs(frame, 5), 50, 50)) == wanted


def test_long_text_is_cut_between_pieces(spark, monkeypatch):
    rows = [(i, "red fox, red fox jumps. " * 200 + "x " * 300, "en", "s", 1) for i in range(3)]
    monkeypatch.setattr(phrases, "SLICE", 101)
    texts = [t for batch in documents(spark, rows).select("text", "lang").toArrow().to_batches() for part, _ in phrases.pieces_of(batch) for t in part]
    assert len(texts) > 100
    assert b"".join(texts) == "".join(r[1] for r in rows).encode()
    assert all(t[-1:] in (b".", b",") for t in texts if not t.endswith(b"x "))


def test_summaries_lose_nothing_frequent():
    random = np.random.default_rng(1)
    for trial in range(20):
        stream = random.zipf(1.3, 20_000).astype(np.uint32) % np.uint32(5000)
        threshold = int(random.integers(5, 200))
        summary = phrases.Summary(len(stream) // threshold)
        for part in np.array_split(stream, 7):
            summary.add(*phrases.unpacked(phrases.packed(*phrases.counted(part))))
            summary.merge()
            assert len(summary.keys[0]) <= summary.capacity
        keys, counts = phrases.counted(stream)
        assert set(keys[counts >= threshold].tolist()) <= set(summary.frequent(threshold).tolist())
        assert summary.lost < threshold


def test_equal_hashes_are_told_apart():
    hashes, checks = np.array([5, 5, 5, 1], np.uint64), np.array([1, 2, 1, 9], np.uint64)
    at, n = phrases.grouped(hashes, checks)
    assert sorted(zip(hashes[at].tolist(), checks[at].tolist(), n.tolist(), strict=True)) == [(1, 9, 1), (5, 1, 2), (5, 2, 1)]


def test_hash_is_that_of_spark(spark):
    keys = np.array([0, 1, -1, 123456789012345, 2**62], np.int64)
    rows = spark.createDataFrame([(int(k),) for k in keys], "key long").selectExpr("key", "xxhash64(key) h").collect()
    assert [r.h for r in rows] == phrases.spark_hash(keys.astype(np.uint64)).astype(np.int64).tolist()


@pytest.mark.parametrize("a", [10**14, 999_999_999_999_901])
def test_scores_beyond_64_bits_are_exact(spark, a):
    rows = [("en", 1, "x", a + 7), ("en", 1, "y", a + 11), ("en", 2, "x y", a), ("en", 0, "", 5 * a)]
    counts = spark.createDataFrame(rows, "lang string, words int, phrase string, n long")
    (row,) = phrases.scored(counts, 50, 10).collect()
    assert row.score == 1_000_000 * a * a // ((a + 7) * (a + 11))


def test_query_equals_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    sql = connection.execute(f"select {', '.join(COLUMNS)} from ({phrases.ORACLE})").fetchall()
    assert got(op11_collocations(spark, SMALL)) == sorted(sql) and len(sql) > 100


def test_batches_of_long_texts_are_bounded(spark, tmp_path):
    from gondola.llm.common import BATCH_BYTES, bounded_batches, table

    spark.range(4000, numPartitions=1).selectExpr("id as doc_id", "repeat(sha2(cast(id as string), 256), 50) as text").write.parquet(str(tmp_path / "documents.parquet"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    bounded_batches(spark)
    found = table(spark, str(tmp_path), "documents").mapInArrow(sizes, "n long").collect()
    assert max(r.n for r in found) < 1.2 * BATCH_BYTES and len(found) > 2
