import hashlib
import re
from collections import defaultdict
from fractions import Fraction
from itertools import cycle

import duckdb
import pytest

from gondola.llm import mixing
from gondola.llm.queries import op1_mixing

from .helpers import SMALL, documents, with_clashes


def expected(rows, share=Fraction(3, 2), most=2):
    """{(doc_id, size): [taken]} by dealing out the excess round after round."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows]
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is None, s or ""))
    weight = dict(zip(sources, cycle((3, 1, 2)), strict=False))
    total = {s: sum(n for n, r in zip(sizes, rows, strict=True) if r["source"] == s) for s in sources}
    target, left, open_ = dict.fromkeys(sources, Fraction(0)), share * sum(sizes), set(sources)
    while left > 0 and open_:
        part = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        left = Fraction(0)
        for s, p in part.items():
            target[s] += p
        for s in list(open_):
            if target[s] >= most * total[s]:
                left += target[s] - most * total[s]
                target[s] = Fraction(most * total[s])
                open_.discard(s)
    taken = defaultdict(list)
    for s in sources:
        mine = [(r["doc_id"], n) for r, n in zip(rows, sizes, strict=True) if r["source"] == s]
        name = lambda i: "" if i is None else str(i)
        mine.sort(key=lambda x: (hashlib.md5(f"mix:{name(x[0])}".encode()).hexdigest()[:15], x[0] or 0, x[1]))
        budget = int(target[s])
        epochs = budget // total[s] if total[s] else 0
        rest = budget - epochs * total[s]
        for i, n in mine:
            now = min(n, rest)
            rest -= now
            taken[i, n].append(epochs * n + now)
    return {k: sorted(v) for k, v in taken.items()}, target


@pytest.mark.parametrize("rows", ["given", "awkward"])
def test_against_brute_force(spark, rows):
    docs = documents(spark) if rows == "awkward" else spark.read.parquet(f"{SMALL}/documents.parquet")
    want, targets = expected(docs.collect())
    got = defaultdict(list)
    for r in mixing.mix(docs, ["doc_id", "source"]).collect():
        got[r.doc_id, r["size"]].append(r.taken)
        assert r.target == pytest.approx(float(targets[r.source]))
        assert 0 <= r.taken <= 2 * r["size"]
    assert {k: sorted(v) for k, v in got.items()} == want


def test_query_equals_sql_twice(spark):
    first, again = (sorted(map(tuple, op1_mixing(spark, SMALL).collect())) for _ in range(2))
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    assert first == again == sorted(connection.execute(mixing.ORACLE).fetchall())


def test_no_window_of_all_rows_and_no_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = mixing.mix(docs, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_given_weights(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    weights = spark.createDataFrame([("src0", 1), ("src1", 3)], "source string, weight int")
    rows = mixing.mix(docs, ["source"], share=0.05, weights=weights).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    found = {r.source: (r["sum(taken)"], r["max(target)"]) for r in rows}
    assert all(taken == int(target) for taken, target in found.values())
    assert found["src1"][1] == pytest.approx(min(3 * found["src0"][1], found["src1"][1]))
    assert all(target == 0 for s, (_, target) in found.items() if s not in ("src0", "src1"))


def test_whole_documents_come_near_the_target(spark):
    docs = with_clashes(documents(spark), "size", "taken", "target", "mix_words")
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    assert all(r.text and r.text.split() for r in rows)
    taken = defaultdict(int)
    for r in rows:
        taken[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    _, target = expected(docs.collect())
    largest = {s: max(len((r.text or "").split()) for r in docs.collect() if r.source == s) for s in target}
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)


def test_empty_table(spark):
    assert mixing.mix(documents(spark, []), ["doc_id"]).count() == 0
    assert mixing.mix_documents(documents(spark, [])).count() == 0
