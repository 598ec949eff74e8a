import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gondola.llm import ppm
from gondola.llm.queries import op9_language

from .helpers import SMALL, documents, with_clashes


class Plain:
    """Partial matching by dictionaries, a byte at a time."""

    def __init__(self, texts, order, least):
        self.order, self.after = order, defaultdict(Counter)
        for t in texts:
            symbols = [256] * order + list(t)
            for i in range(order, len(symbols)):
                for k in range(order + 1):
                    self.after[tuple(symbols[i - k : i])][symbols[i]] += 1
        self.known = {c for c, n in self.after.items() if sum(n.values()) >= least or not c}

    def bits(self, text):
        symbols, total = [256] * self.order + list(text), 0.0
        for i in range(self.order, len(symbols)):
            for k in range(self.order, -2, -1):
                if k < 0:
                    total += 8
                    break
                context = tuple(symbols[i - k : i])
                if context not in self.known:
                    continue
                n = self.after[context]
                whole, kinds = sum(n.values()), len(n)
                if symbols[i] in n:
                    total -= math.log2(n[symbols[i]] / (whole + kinds))
                    break
                total -= math.log2(kinds / (whole + kinds))
        return total


def model_of(texts, order=3, least=2):
    langs, contexts, symbols, counts = [], [], [], []
    for lang, mine in enumerate(texts.values()):
        values, n = np.unique(ppm.grams(mine, order), return_counts=True)
        langs += [lang] * len(values)
        contexts += (values >> 9).tolist()
        symbols += (values & 511).tolist()
        counts += n.tolist()
    return ppm.build(list(texts), np.array(langs), np.array(contexts), np.array(symbols), np.array(counts), order, least)


@pytest.mark.parametrize(("order", "least"), [(3, 2), (2, 1), (3, 5)])
def test_code_lengths_equal_plain_ones(order, least):
    texts = {"a": [b"the cat sat on the mat", b"", b"the hat"], "b": ["über die Brücke".encode(), b"der Hut", b"xyz"]}
    model = model_of(texts, order, least)
    probes = [b"the cat", b"die Hut", b"", "日本".encode(), b"\x00\xff", b"t", b"on the mat on the mat", bytes(range(256))]
    got = ppm.code_lengths(model, probes)
    for i, lang in enumerate(model.languages):
        plain = Plain(texts[lang], order, least)
        for j, p in enumerate(probes):
            assert got[j, i] == pytest.approx(plain.bits(p), rel=1e-5, abs=1e-4)


def test_counting_in_spark_equals_plain_counting(spark):
    docs = documents(spark)
    got = {(r.lang, r.gram): r.n for r in ppm.counted(docs).collect()}
    want = Counter()
    for r in docs.collect():
        if r.text is not None and r.lang is not None:
            values, n = np.unique(ppm.grams([r.text.encode()]), return_counts=True)
            for v, k in zip(values.tolist(), n.tolist(), strict=True):
                want[r.lang, v] += k
    assert got == dict(want)


def test_query(spark):
    rows = {r.doc_id: r for r in op9_language(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(rows) == len(docs)
    held_out = [r for r in docs if rows[r.doc_id].held_out]
    assert all(rows[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in docs)
    assert sum(rows[r.doc_id].lang_pred == r.lang for r in held_out) / len(held_out) > 0.95
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_awkward_rows(spark):
    docs = with_clashes(documents(spark), "lang_pred", "score", "ppm_text")
    got = ppm.predict(docs, ppm.train(docs), ["doc_id"]).collect()
    assert len(got) == docs.count()
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {2, 3, 5, 10}
    assert {r.lang_pred for r in got if r.doc_id == 8} == {"ja"}
    assert ppm.train(documents(spark, [])) is None
    assert [r.lang_pred for r in ppm.predict(docs.where("doc_id = 1"), None, ["doc_id"]).collect()] == ["und"]
    assert ppm.predict(documents(spark, []), None, ["doc_id"]).count() == 0


def test_learning_keeps_all_contexts_and_languages(spark):
    rng = np.random.default_rng(6)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x4E00 + 20_000, 20_000))), "".join(map(chr, rng.integers(97, 123, 40_000)))]
    rows = [(i, t, lang, "a", len(t)) for i, (t, lang) in enumerate(zip(texts, ("zh", "xx"), strict=True))]
    model = ppm.train(documents(spark, rows))
    probes = [texts[0][:40].encode(), texts[1][:200].encode(), "日本 text".encode()]
    got = ppm.code_lengths(model, probes)
    for lang, text in zip(("zh", "xx"), texts, strict=True):
        plain = Plain([text.encode()], ppm.ORDER, ppm.LEAST)
        assert sum(len(c) == ppm.ORDER for c in plain.after) > 10_000
        for j, p in enumerate(probes):
            assert got[j, model.languages.index(lang)] == pytest.approx(plain.bits(p), rel=1e-5)
    many = documents(spark, [(i, "some words", f"l{i:04}", "a", 10) for i in range(1100)])
    assert ppm.counted(many).select("lang").distinct().count() == 1100
