from collections import Counter

import numpy as np
import regex
from tokenizers import Tokenizer

import corpus_pipeline
from gondola.llm import simhash
from gondola.llm.queries import VOCABULARY

from .helpers import AWKWARD, documents
from .test_minhash import sets as shingle_sets
from .test_mixing import expected as mixed
from .test_simhash import expected as near

MIDDLE = "/root/testdata/sf0.01"
LIBRARY = Tokenizer.from_file(VOCABULARY)


def test_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_duplicates", "mixture", "tokens"]


def test_each_stage_against_a_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    for i, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = f"file://{tmp_path}/{i}"
        step(spark, docs, MIDDLE).write.parquet(out)
        docs = spark.read.parquet(out)
        rows = docs.collect()
        if name != "tokens":
            assert docs.columns == columns
        if name == "language":
            assert {r.doc_id for r in rows} == {r.doc_id for r in before if regex.search(r"\p{L}", r.text or "")}
        if name == "toxicity":
            toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
            gone = {r.doc_id for r in before} - {r.doc_id for r in rows}
            stayed = {r.doc_id for r in rows}
            known = [d for d in gone if d in toxic]
            assert sum(toxic[d] for d in known) / len(known) > 0.8
            assert sum(toxic[d] for d in stayed if d in toxic) < 0.25 * sum(toxic.values())
        if name == "near_duplicates":
            first = {i for i, _, c in near(before) if i == c}
            kept, texts = {r.doc_id for r in rows}, {r.doc_id: r.text for r in before}
            assert len(rows) == len(kept) and kept <= first
            # Whatever else went is like one that stayed or went; none that stayed is like another that did.
            sets = {i: shingle_sets(texts[i]) for i in first}
            like = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
            assert all(any(like(i, j) for j in first if j != i) for i in first - kept)
            by_shingle = {}
            for i in kept:
                for x in sets[i]:
                    by_shingle.setdefault(x, set()).add(i)
            close = {(i, j) for i in kept for j in set().union(*(by_shingle[x] for x in sets[i])) if i < j and like(i, j)}
            assert not close
        if name == "mixture":
            _, target = mixed(before)
            words = Counter()
            for r in rows:
                words[r.source] += len(r.text.split())
            largest = max(len((r.text or "").split()) for r in before)
            assert all(abs(words[s] - t) <= largest for s, t in target.items())
            assert max(Counter(r.doc_id for r in rows).values()) <= 2
            assert {tuple(r) for r in rows} <= {tuple(r) for r in before}
        if name == "tokens":
            want = Counter((r.doc_id, np.array(LIBRARY.encode(r.text or "", add_special_tokens=False).ids, "<u4").tobytes(), r.text or "") for r in before)
            assert Counter((r.doc_id, bytes(r.ids), r.text) for r in rows) == want
        before = rows


def test_run_equals_the_stages_and_reruns_agree(spark):
    first, again = (Counter((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, MIDDLE).collect()) for _ in range(2))
    assert first == again and first


def test_awkward_and_empty_tables(spark, tmp_path):
    for rows in (AWKWARD, []):
        folder = f"{tmp_path}/{len(rows)}"
        documents(spark, rows).selectExpr("*", "'x' as score", "'y' as toxic").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (6, 0, 1), (2, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        got = corpus_pipeline.run(spark, folder)
        assert set(got.columns) >= {"doc_id", "n_tokens", "ids", "text"}
        assert (got.count() > 0) == bool(rows)


def groups(texts):
    """The group of each text by brute force: fingerprints within two bits or a likeness of 0.8."""
    codes = simhash.fingerprints([t.encode().lower() for t in texts], 3).tolist()
    sets, label = [shingle_sets(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            union = sets[i] | sets[j]
            if label[i] != label[j] and ((codes[i] ^ codes[j]).bit_count() <= 2 or (union and len(sets[i] & sets[j]) >= 0.8 * len(union))):
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    return label


def chains_of_both_links():
    """Texts B, B', C: the fingerprints of B and B' are within two bits, C is like B' to 0.8 or more but not like B."""
    rng, out = np.random.default_rng(8), []
    while len(out) < 9:
        words = [f"w{i}" for i in rng.integers(0, 10**6, 120)]
        second = [*words[:-4], *(f"v{i}" for i in rng.integers(0, 10**6, 4))]
        at = int(rng.integers(0, 90))
        third = [*second[:at], *(f"u{i}" for i in rng.integers(0, 10**6, 7)), *second[at + 7 :]]
        texts = [" ".join(t) for t in (words, second, third)]
        code = simhash.fingerprints([t.encode().lower() for t in texts], 3).tolist()
        like = lambda a, b: len(shingle_sets(a) & shingle_sets(b)) / len(shingle_sets(a) | shingle_sets(b))
        if (code[0] ^ code[1]).bit_count() <= 2 < (code[0] ^ code[2]).bit_count() and like(texts[1], texts[2]) >= 0.8 > like(texts[0], texts[2]):
            out += texts
    return out


def test_groups_of_the_whole_input(spark):
    texts = chains_of_both_links()
    label = groups(texts)
    assert label == [0] * 3 + [3] * 3 + [6] * 3
    kept = corpus_pipeline.distinct(spark, documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)]), "").collect()
    assert sorted(r.doc_id for r in kept) == [0, 3, 6]


def test_null_and_repeated_ids_keep_one_row_of_each_group(spark):
    texts = chains_of_both_links()
    other = "something else that is not like any of those at all"
    # No id in the first group; the second's near copy has the id of a text of its own; the third's smallest id is not its first text's.
    ids = [None, None, None, 1, 2, 2, 9, 8, None]
    rows = [(i, t, "en", "a", 1) for i, t in zip([*ids, 2, 1], [*texts, other, texts[3]], strict=True)]
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.distinct(spark, documents(spark, rows), "").collect()]
    assert len(kept) == len(set(kept)) == 4
    assert {(1, texts[3]), (2, other), (8, texts[7])} < set(kept)
    assert [i for i, t in kept if t in texts[:3]] == [None]
