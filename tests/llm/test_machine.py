import numpy as np
import pytest

from gondola.llm import machine
from gondola.llm.queries import op10_quality

from .helpers import documents, with_clashes

MIDDLE = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int, text string"


def drawn():
    rng = np.random.default_rng(11)
    return machine.Machine(0.3, rng.normal(size=machine.SIZE), rng.normal(size=(machine.SIZE, machine.FACTORS)))


def test_linear_time_score_equals_all_pairs():
    learned = drawn()
    texts = ["One two two three. One!", "", "AAA BBB\nAAA BBB\n| x | y |", "é" * 50 + " ü"]
    who, what, value = machine.text_features(texts, np.array([23, 0, -1, 52]))
    got = machine.margins(learned, who, what, value, len(texts))
    for i in range(len(texts)):
        x = np.bincount(what[who == i], value[who == i], machine.SIZE)
        used = np.flatnonzero(x)
        want = learned.constant + learned.linear[used] @ x[used]
        for p, a in enumerate(used):
            for b in used[p + 1 :]:
                want += learned.factors[a] @ learned.factors[b] * x[a] * x[b]
        assert got[i] == pytest.approx(want)


def test_features_do_not_depend_on_the_company():
    texts = ["one two", "", "three | four!! five", "x " * 500]
    learned, lengths = drawn(), np.array([7, 0, 19, 1000])
    together = machine.margins(learned, *machine.text_features(texts, lengths), 4)
    alone = [machine.margins(learned, *machine.text_features([t], lengths[i : i + 1]), 1)[0] for i, t in enumerate(texts)]
    assert together == pytest.approx(alone)


def test_statistics_by_hand():
    plain = machine.Spans([b"AB ab 12!\nAB ab 12!", b"w w w w"], ~machine.WHITE)
    got = dict(zip(machine.STATISTICS, machine.statistics([b"AB ab 12!\nAB ab 12!", b"w w w w"], plain).T, strict=True))
    assert got["upper"] == pytest.approx([4 / 19, 0]) and got["line"] == pytest.approx([1 / 19, 0]) and got["white"] == pytest.approx([5 / 19, 3 / 7])
    assert got["distinct_words"] == pytest.approx([0.5, 0.25]) and got["repeated_lines"] == pytest.approx([0.5, 0]) and got["repeated_words"] == pytest.approx([0, 0.75])
    assert got["marked_words"] == pytest.approx([1 / 3, 0])


def test_slopes_learn_an_interaction():
    rng = np.random.default_rng(12)
    a, b = rng.integers(0, 2, 2000), rng.integers(0, 2, 2000)
    y = (a ^ b).astype(float)
    who = np.repeat(np.arange(2000), 2)
    what = np.stack([a, 2 + b], axis=1).ravel()
    learned = machine.fit(who, what, np.ones(4000), y, np.ones(2000))
    p = machine.margins(learned, who, what, np.ones(4000), 2000) > 0
    assert (p == y).mean() == 1


def test_accuracy_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    rows = op10_quality(spark, MIDDLE).collect()
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    held_out = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held_out) / len(held_out) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op10_quality(spark, MIDDLE).collect()))


def test_awkward_rows(spark):
    docs = with_clashes(documents(spark), "score", "quality", "fm_text")
    labels = spark.createDataFrame([(1, 1, 0, "x"), (6, 0, 1, "x"), (2, None, None, "x"), (None, 1, 1, "x"), (3, 0, 1, "x")], LABELS)
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        got = machine.score(docs, machine.train(docs, known), ["doc_id"]).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    empty = documents(spark, [])
    assert machine.score(empty, machine.train(empty, labels), ["doc_id"]).count() == 0
