import numpy as np
import pytest

from gondola.llm import chains, queries
from gondola.llm.queries import op7_toxicity, toxicity

from .helpers import documents, with_clashes

MIDDLE = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int, text string"


def test_word_features_by_hand():
    owner, feature = chains.word_features(["Ab abcdef-ABCDEFG", "", "abcdefx"])
    assert set(owner.tolist()) == {0, 2}
    whole = [set(feature[owner == i].tolist()) for i in (0, 2)]
    # Words of over six bytes that begin alike share all three beginnings.
    assert len(whole[0] & whole[1]) == 3
    assert len(owner) == 3 + 5 + 1 + 3


def test_fit_separates_and_is_the_optimum():
    rng = np.random.default_rng(9)
    x = rng.integers(0, 2, (400, 5)).astype(float)
    y = ((x[:, 0] + 0.3 * rng.normal(size=400)) > 0.5).astype(float)
    w = chains.fit(x, y)
    p = chains.probability(x, w)
    slope = np.hstack([x, np.ones((400, 1))]).T @ (p - y) + np.r_[w[:-1], 0]
    assert np.abs(slope).max() < 1e-4 and ((p > 0.5) == y).mean() > 0.9


def test_later_links_see_earlier_probabilities_out_of_fold():
    rng = np.random.default_rng(10)
    n = 600
    first = rng.integers(0, 2, n)
    names = np.array([11, 22, 33], np.uint32)
    owner = np.concatenate([np.flatnonzero(first), np.arange(n)])
    feature = np.concatenate([np.full(first.sum(), names[0]), names[1 + rng.integers(0, 2, n)]])
    labels = np.stack([first, first], axis=1).astype(float)
    chain = chains.fit_chain(["a", "b"], owner, feature, labels, np.arange(n) % chains.FOLDS, np.array([0.5, 0.5]))
    assert [len(w) for w in chain.weights] == [len(chain.features) + 1, len(chain.features) + 2]
    assert chain.weights[1][-2] > 0


def test_accuracy_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    rows = op7_toxicity(spark, MIDDLE).collect()
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    assert all(0 <= p <= 1 for r in rows for p in (r.insult, r.contempt, r.score))
    held_out = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held_out) / len(held_out) > 0.9
    assert rows[0].asDict().keys() == {"doc_id", "held_out", "insult", "contempt", "score", "predicted"}
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op7_toxicity(spark, MIDDLE).collect()))


def test_awkward_rows(spark):
    docs = with_clashes(documents(spark), "toxic", "insult", "chain_text")
    labels = spark.createDataFrame([(1, 1, 0, "x"), (6, 1, 1, "x"), (2, 1, None, "x"), (None, 1, 1, "x"), (99, 1, 1, "x"), (7, 1, 1, "x")], LABELS)
    got = toxicity(docs, labels, docs, ["doc_id"]).collect()
    assert len(got) == docs.count() and all(0 <= r.toxic <= 1 for r in got)
    assert len({r.toxic for r in got if r.doc_id in (2, 3, 5)}) == 1
    for few in (labels.limit(0), labels.where("toxic = 0")):
        assert toxicity(docs, few, docs, ["doc_id"]).count() == docs.count()
    assert toxicity(documents(spark, []), labels, documents(spark, []), ["doc_id"]).count() == 0


@pytest.mark.parametrize("text", ["", "plain words"])
def test_presence_without_features(text):
    assert chains.presence(np.zeros(0, np.uint32), [text]).shape == (1, 0)


def test_learning_equals_that_from_all_features_and_sees_400(spark):
    rng = np.random.default_rng(12)
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 2
        own = rng.integers(0, 400, 12) + 400 * toxic
        rows.append((i, " ".join(f"q{k:03}" for k in own), "en", "a", 1))
        labels.append((i, 1, toxic, "x"))
    docs, known = documents(spark, rows), spark.createDataFrame(labels, LABELS)
    chain = chains.train(docs, known.select("doc_id", "toxic"), ["toxic"])
    assert (chains.SAMPLE, chains.FEATURES, queries.TOXIC_FROM) == (3000, 400, 0.5)
    assert len(chain.features) == 400 and len(chain.weights[0]) == 401
    owner, feature = chains.word_features([r[1] for r in rows])
    both = np.unique(np.stack([owner, feature.astype(np.int64)], axis=1), axis=0)
    plain = chains.fit_chain(["toxic"], both[:, 0], both[:, 1].astype(np.uint32), np.array([[x[2]] for x in labels], float), np.zeros(1200, int), np.array([0.5]))
    assert (plain.features == chain.features).all() and np.allclose(plain.weights[0], chain.weights[0], atol=1e-6)
