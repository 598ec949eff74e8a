import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.llm import permutation
from gondola.llm.queries import op8_permutation_index

from .helpers import SMALL

VECTORS = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, queries, wanted=5):
    kept = {(r["vec_id"], tuple(r["embedding"])) for r in rows if r["vec_id"] is not None and r["embedding"] is not None and all(x is not None and math.isfinite(x) for x in r["embedding"]) and any(r["embedding"])}
    ids = np.array([i for i, _ in sorted(kept)])
    x = np.array([v for _, v in sorted(kept)], float)
    x = x.reshape(len(ids), -1)
    out = {}
    for q in queries:
        for own in np.flatnonzero(ids == q):
            s = (x * x[own]).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((x[own] * x[own]).sum()))
            order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:wanted]
            out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.1"])
def test_recall_and_exact_scores(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    want = brute(rows, [r.vec_id for r in rows if r.vec_id % 50 == 0])
    got = found(op8_permutation_index(spark, folder))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    print(f"recall {hits:.3f} of {len(rows)} vectors")
    assert hits >= 0.95
    exact = {(q, i): s for q in want for i, s in want[q]}
    assert all(s == pytest.approx(exact[q, i], abs=1e-12) for q in got for i, s in got[q] if (q, i) in exact)


def test_full_rerank_over_many_shards_is_exact(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = frame.collect()
    got = found(permutation.search(frame, frame.where("vec_id % 20 = 0"), share=1.0, shard_rows=90))
    want = brute(rows, [r.vec_id for r in rows if r.vec_id % 20 == 0])
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_ties_and_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 0.0], 0, "x") for i in range(40)] + [(100, [0.0, 0.0, 0.0], 0, "x"), (101, None, 0, "x"), (102, [1.0, None, 0.0], 0, "x"), (103, [nan, 1.0, 1.0], 0, "x"), (104, [inf, 1.0, 1.0], 0, "x"), (None, [1.0, 2.0, 0.0], 0, "x"), (50, [2.0, 1.0, 1.0], 0, "x"), (50, [2.0, 1.0, 1.0], 0, "x"), (105, [], 0, "x"), (106, [1.0], 0, "x"), (60, [-0.0, 1.0, 5.0], 0, "x"), (61, [0.0, 1.0, 5.0], 0, "x")]
    frame = spark.createDataFrame(rows, VECTORS)
    got = found(permutation.search(frame, frame, shard_rows=9))
    want = brute([r for r in frame.collect() if r.embedding is None or len(r.embedding) == 3], [i for i in [*range(40), 50, 60, 61]])
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert found(permutation.search(spark.createDataFrame([], VECTORS), spark.createDataFrame([], VECTORS))) == {}
    two = frame.where("vec_id in (50, 60)")
    assert [i for i, _ in found(permutation.search(two, two))[50]] == [60]


def test_a_third_of_the_rows_under_one_id(spark):
    rng = np.random.default_rng(5)
    some = [(i, [float(x) for x in v], 0, "x") for i, v in enumerate(rng.normal(size=(300, 4)))]
    # One row over and over, and one id with many vectors: both are dealt over all shards.
    many = [(7, some[7][1], 0, "x")] * 300 + [(900, [float(x) for x in v], 0, "x") for v in rng.normal(size=(200, 4))]
    frame = spark.createDataFrame(some + many, VECTORS)
    got = found(permutation.search(frame, frame.where("vec_id between 1 and 60"), share=1.0, shard_rows=50))
    want = brute(frame.collect(), range(1, 61))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_few_vectors_come_through_the_index_too(monkeypatch):
    asked = []
    shared = permutation.Shard.shared
    monkeypatch.setattr(permutation.Shard, "shared", lambda self, prefix: asked.append(len(self.vectors)) or shared(self, prefix))
    vectors = np.random.default_rng(2).normal(size=(30, 5))
    shard = permutation.Shard.build(np.arange(30), vectors, vectors[:8])
    ids, _ = shard.nearest(0, vectors[0], permutation.prefixes(vectors[:1], vectors[:8])[0], 5, permutation.SHARE, permutation.LEAST)
    assert asked == [30] and len(ids) == 5


def test_shared_sum_is_the_footrule_distance():
    rng = np.random.default_rng(13)
    vectors, pivots = rng.normal(size=(50, 6)), rng.normal(size=(80, 6))
    shard = permutation.Shard.build(np.arange(50), vectors, pivots)
    prefix = permutation.prefixes(vectors, pivots)
    n = prefix.shape[1]
    place = {i: {int(p): k for k, p in enumerate(row)} for i, row in enumerate(prefix)}
    order = {tuple(v): i for i, v in enumerate(shard.vectors)}
    for q in range(5):
        shared = shard.shared(prefix[q])
        for v in range(50):
            far = sum(abs(place[q].get(p, n) - place[v].get(p, n)) for p in set(place[q]) | set(place[v]))
            assert far == n * (n + 1) - 2 * shared[order[tuple(vectors[v])]]


def test_what_the_driver_gets_does_not_follow_the_number_of_tasks(spark):
    named, unit = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}, F.lit(1.0)
    frame = spark.range(0, 40_000, 1, 40).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(1), F.lit(64)), lambda k: F.sin(F.col("id") * k) + unit).alias("embedding"))
    before = {name: spark.conf.get(name) for name in named}
    limits = spark.sparkContext._jsc.sc().conf()
    for name, value in named.items():
        spark.conf.set(name, value)
    # 40 tasks with a thousand vectors each, or 20 MB.
    limits.set("spark.driver.maxResultSize", "8m")
    try:
        got = found(permutation.search(frame, frame.where("vec_id < 3")))
    finally:
        limits.remove("spark.driver.maxResultSize")
        for name, value in before.items():
            spark.conf.set(name, value)
    assert [len(got[q]) for q in range(3)] == [5, 5, 5]


@pytest.mark.parametrize("repeats", [1, 400])
def test_drawn_rows_are_those_with_the_smallest_hashes(spark, monkeypatch, repeats):
    monkeypatch.setattr(permutation, "PIVOT_ROWS", 20)
    once = spark.range(2000).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("embedding"))
    # Repeated rows of one vector leave few others below the first bound.
    rows = once.union(once.where("vec_id = 7").crossJoin(spark.range(repeats * 100)).drop("id"))
    want = once.orderBy(F.xxhash64(F.lit("pivot"), "vec_id", "embedding")).limit(20).collect()
    assert permutation._drawn(rows, rows.count()) == want


def test_shards_are_not_shuffled_for_every_block_of_queries(spark, monkeypatch):
    monkeypatch.setattr(permutation, "QUERY_ROWS", 100)
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    plan = permutation.search(frame, frame, shard_rows=90)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and not [line for line in plan.splitlines() if "Exchange" in line and "vectors" in line]
