import numpy as np
import xxhash

from gondola.llm import simhash
from gondola.llm.queries import op5_simhash

from .helpers import SMALL, documents, with_clashes


def fingerprint(text, width=3):
    words = text.encode().lower().split()
    runs = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def parts(codes, distance):
    """Label of each code by brute force."""
    codes = np.array(codes, np.uint64)
    label = np.arange(len(codes))
    for i in range(len(codes)):
        near = np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= distance)
        lowest = label[near].min()
        label[np.isin(label, label[near])] = lowest
    return label


def expected(rows, distance=2):
    codes = [fingerprint(r["text"] or "") for r in rows]
    label = parts(codes, distance)
    least = {}
    for r, k in zip(rows, label.tolist(), strict=True):
        if r["doc_id"] is not None:
            least[k] = min(least.get(k, r["doc_id"]), r["doc_id"])
    return sorted(((r["doc_id"], f"{c:016x}", least.get(k)) for r, c, k in zip(rows, codes, label.tolist(), strict=True)), key=str)


def test_given_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert sorted(map(tuple, op5_simhash(spark, SMALL).collect()), key=str) == expected(rows)


def test_awkward_rows(spark):
    docs = with_clashes(documents(spark), "code", "component_id")
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hexadecimal("code"), "component_id").collect()
    assert sorted(map(tuple, got), key=str) == expected(docs.collect())
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_hash_equals_that_of_the_engine(spark):
    texts = ["", "a", "one two three", "日本語 の テキスト", "x" * 100]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) as h")
    assert all(r.h % 2**64 == xxhash.xxh64_intdigest(r.t.encode(), 42) for r in frame.collect())


def clusters(rng, centres, members, flips):
    out = []
    for c in rng.integers(0, 2**64, centres, np.uint64):
        for _ in range(members):
            bits = rng.choice(64, rng.integers(0, flips + 1), replace=False)
            out.append(int(c) ^ sum(1 << int(b) for b in bits))
    return np.unique(np.array(out, np.uint64))


def test_tree_finds_every_part():
    rng = np.random.default_rng(4)
    for codes in (clusters(rng, 1, 900, 5), clusters(rng, 60, 10, 3), clusters(rng, 500, 1, 0), np.arange(700, dtype=np.uint64) * np.uint64(5)):
        order = np.argsort(simhash.gray_rank(codes), kind="stable")
        codes = codes[order]
        for distance in (0, 1, 2, 3):
            got, want = simhash.tree_parts(codes, distance), parts(codes, distance)
            assert (got == want).all()


def test_links_join_all_near_codes(spark):
    rng = np.random.default_rng(5)
    codes = np.unique(np.concatenate([clusters(rng, 30, 12, 4), clusters(rng, 1, 400, 6), clusters(rng, 400, 1, 0)]))
    frame = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code long").repartition(7)
    for distance in (1, 2, 3):
        roots = dict(map(tuple, simhash.components(simhash.code_links(frame, distance)).collect()))
        want = parts(codes, distance)
        got = [roots.get(int(c), int(c)) for c in codes.view(np.int64)]
        pairs = set(zip(got, want.tolist(), strict=True))
        assert len(pairs) == len(set(got)) == len(set(want.tolist()))


def test_neighbours_share_blocks_and_gray_order_keeps_them_together():
    for distance in (1, 2, 3):
        plans = simhash.layouts(distance)
        rng = np.random.default_rng(6)
        a = rng.integers(0, 2**64, 200, np.uint64)
        b = a.copy()
        for i in range(200):
            for bit in rng.choice(64, distance, replace=False):
                b[i] ^= np.uint64(1) << np.uint64(bit)
        met = np.zeros(200, bool)
        for blocks, bits in plans:
            x, y = (simhash.gray_rank(simhash.arranged(c, blocks)) >> np.uint64(64 - bits) for c in (a, b))
            met |= x == y
            assert 64 - bits <= {1: 13, 2: 22, 3: 28}[distance]
        assert met.all()


def test_one_of_each_stays(spark):
    rows = [(3, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (2, "something else entirely", "en", "s", 5), (2, "A B C", "en", "s", 5), (None, "a b c", "en", "s", 5), (None, "only this", "en", "s", 9), (None, "only this", "en", "s", 9), (7, None, "en", "s", 0), (8, "", "en", "s", 0)]
    docs = with_clashes(documents(spark, rows), "code", "rows", "id", "none")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, "a b c"), (2, "something else entirely"), (7, None), (None, "only this")], key=str)
