import hashlib
import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gondola.llm import bpe
from gondola.llm.queries import VOCABULARY, op6_bpe

from .helpers import SMALL, documents, text_of, with_clashes

os.environ["TOKENIZERS_PARALLELISM"] = "false"
LIBRARY = Tokenizer.from_file(VOCABULARY)
CODEC = bpe.codec(VOCABULARY)


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def by_tree(text, piece):
    places = bpe.cuts(text, piece)
    return CODEC.tree(text, [(a, b, CODEC.encode(text[a:b])) for a, b in zip(places, places[1:], strict=False)]).tolist(), len(places) - 1


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8")) | st.text(alphabet="ab '<|>endoftxsr1\n é日", max_size=60) | st.lists(st.sampled_from(["<|endoftext|>", "'s", " the", "  ", "\n", "ing", "!!", "7"])).map("".join))
def test_equal_to_the_library(text):
    got = CODEC.encode(text)
    assert got.tolist() == ids(text)
    assert CODEC.decode(got) == LIBRARY.decode(ids(text), skip_special_tokens=False)


RNG = np.random.default_rng(8)
LONG = {
    "words": " ".join("".join(RNG.choice(list("etaoinshr"), 6)) for _ in range(2000)),
    "letters": "".join(RNG.choice(list("etaoinshrdlu"), 20_000)),
    "one letter": "a" * 15_000,
    "digits": "".join(RNG.choice(list("0123456789"), 15_000)),
    "marks": "".join(RNG.choice(list("!?-=*#'"), 15_000)),
    "blanks": "x" + " " * 9000 + "\n" * 5000 + " y",
    "han": "".join(RNG.choice(list("日本語文字列中國人大小上下"), 12_000)),
    "accents": "".join(RNG.choice(list("éèêàüöß"), 12_000)),
    "emoji": "\U0001f600" * 6000,
    "letters and digits": "".join(RNG.choice(list("abc123"), 15_000)),
    "mixed": "".join(RNG.choice(list("ab1! '.\n"), 15_000)),
    "special": "a<|endoftext|>" * 1500,
    "apostrophes": "'" * 3000 + "s" * 3000 + "'re" * 2000,
}


@pytest.mark.parametrize("name", LONG)
@pytest.mark.parametrize("piece", [200, 1000, 5000])
def test_tree_of_long_text(name, piece):
    got, n = by_tree(LONG[name], piece)
    assert got == ids(LONG[name])
    assert n > 1 or name in ("special",)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "the", "é", "日", "1", "!", "'", " ", "\n", "'s", "x y", "in", "<|endoftext|>"]), st.integers(1, 200)), max_size=12), st.integers(20, 300))
def test_tree_of_any_text(parts, piece):
    text = "".join(p * n for p, n in parts)
    assert by_tree(text, piece)[0] == ids(text)


def check(frame, got):
    want = sorted(((r.doc_id, len(i := ids(text_of(r))), np.array(i, "<u4").tobytes(), LIBRARY.decode(i, skip_special_tokens=False)) for r in frame.collect()), key=str)
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got.collect()), key=str) == want


def test_awkward_rows(spark):
    docs = with_clashes(documents(spark), "ids", "n_tokens", "decoded", "bpe_text")
    check(docs, bpe.encode(docs, ["doc_id"], VOCABULARY, piece=2000))
    check(docs, bpe.encode(docs, ["doc_id"], VOCABULARY))
    assert bpe.encode(documents(spark, []), ["doc_id"], VOCABULARY).count() == 0


def test_given_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = sorted((r.doc_id, len(i := ids(text_of(r))), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(text_of(r).encode()).hexdigest()) for r in docs.collect())
    assert sorted(map(tuple, op6_bpe(spark, SMALL).collect())) == want
