import hashlib

import numpy as np

from gondola.llm import minhash
from gondola.llm.common import Spans, span_hashes
from gondola.llm.queries import op3_fingerprints

from .helpers import SMALL, documents, text_of, with_clashes


def sets(text):
    words = text.encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = sets(a), sets(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(frame, result):
    rows = sorted(frame.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, text_of(r)))
    got = sorted(result.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256))
    want, errors = [], []
    texts = [text_of(r) for r in rows]
    for r, text, after in zip(rows, texts, texts[1:] + texts[:1], strict=True):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        want.append((r.doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), jaccard(text, changed), jaccard(text, after)))
    want.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    assert [(r.doc_id, r.n_chars, r.edited_sha256) for r in got] == [w[:3] for w in want]
    for r, w in zip(got, want, strict=True):
        errors += [abs(r.near_edited - w[3]), abs(r.near_next - w[4])]
    assert max(errors) < 0.2 and np.mean(errors) < 0.03
    return got


def test_given_table(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    prints = {}
    for r in check(docs, op3_fingerprints(spark, SMALL)):
        prints.setdefault(r.fingerprint, r.doc_id)
    # Many short ranges give the same rows as few long ones.
    few = sorted(map(tuple, minhash.fingerprints(docs).collect()))
    monkeypatch.setattr(minhash, "RANGE_ROWS", 7)
    assert sorted(map(tuple, minhash.fingerprints(docs).collect())) == few
    by_id = {r[0]: r[3] for r in few}
    texts = {r.doc_id: r.text for r in docs.collect()}
    first = {}
    for i, t in texts.items():
        assert by_id[first.setdefault(t, i)] == by_id[i]


def test_awkward_rows(spark):
    docs = with_clashes(documents(spark), "fingerprint", "place", "extra")
    got = check(docs, minhash.fingerprints(docs))
    empty = "f" * 4 * minhash.PERMUTATIONS
    assert all((r.fingerprint == empty) == (r.n_chars in (0, 7)) for r in got)
    one = documents(spark, [(1, "a b c d e f g", "en", "a", 1)])
    assert [r.near_next for r in minhash.fingerprints(one).collect()] == [1.0]
    assert minhash.fingerprints(documents(spark, [])).count() == 0
    assert minhash.fingerprints(documents(spark, [(None, "a", "a", "a", 1)])).count() == 1


def test_span_hashes_tell_words_apart():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in rng.integers(1, 40, 3000)]
    spans = Spans([b" ".join(words)], np.arange(256) > 32)
    hashes = span_hashes(spans.data, spans.starts, spans.ends)
    names = {}
    for w, h in zip(words, hashes.tolist(), strict=True):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_long_texts_against_exact_likeness():
    texts = [" ".join(f"{side}{i}" for i in range(120_000)) for side in "ab"]
    texts.append(" ".join([*texts[0].split()[:60_000], *texts[1].split()[:60_000]]))
    prints = minhash.signatures([t.encode() for t in texts])
    for i, j in ((0, 1), (0, 2), (1, 2)):
        assert abs(minhash.likeness(prints[[i]], prints[[j]])[0] - jaccard(texts[i], texts[j])) < 0.15


def test_near_duplicates(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(2000)]
    base = [" ".join(rng.choice(words, 200)) for _ in range(20)]
    rows, n = [], 0
    for t in base:
        for k in range(6):  # copies with up to one changed word: likeness 0.95
            parts = t.split()
            if k > 1:
                parts[30 * k] = "changed"
            rows.append((n, " ".join(parts), "en", "a", 1))
            n += 1
    rows += [(n, None, "en", "a", 0), (n + 1, "", "en", "a", 0)]
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert {found[i] for i in range(120)} == {6 * i for i in range(20)}
    assert all(found[i] == i // 6 * 6 for i in range(120)) and found[n] == found[n + 1] == n
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def star(n, size=150, changed=10, seed=4):
    """A base text and ``n`` copies with a run of other words in a place of their own, 0.87 like the base and less than 0.8 like most others."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(size)]
    copies = []
    for k in range(n):
        at = int(rng.integers(0, size - changed))
        copies.append(" ".join([*base[:at], *(f"x{k}_{j}" for j in range(changed - 4)), *base[at + changed - 4 :]]))
    return " ".join(base), copies


def test_star_whose_smallest_id_is_not_the_base(spark):
    base, copies = star(1500)
    like = [jaccard(base, c) for c in copies]
    assert min(like) >= 0.8 and np.median([jaccard(copies[0], c) for c in copies[1:]]) < 0.8
    rows = [(i, t, "en", "a", 1) for i, t in enumerate([*copies, base])]
    found = [r.component_id for r in minhash.near_duplicates(documents(spark, rows)).collect()]
    assert found == [0] * len(rows)


def test_block_links_join_what_all_pairs_join():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 40, rng.integers(1, 30))) for _ in range(120)]
    begin = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    for sides in (1, 2):
        side, roots = np.arange(120) % sides, rng.integers(0, 100, 120)

        def parts(links, roots=roots):
            label = roots.copy()
            for i, j in links:
                label[label == label[j]] = label[i]
            return len(set(label.tolist())), [int(np.flatnonzero(label == x)[0]) for x in label]

        pairs = [(i, j) for i in range(120) for j in range(i) if (sides == 1 or side[i] != side[j]) and len(np.intersect1d(sets[i], sets[j])) >= 0.5 * len(np.union1d(sets[i], sets[j]))]
        got = minhash.block_links(np.arange(120), roots, side, begin, np.concatenate(sets), 0.5)
        assert parts(got) == parts(pairs) and len(got) < 120
