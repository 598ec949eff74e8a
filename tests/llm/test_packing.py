import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from gondola.llm import packing
from gondola.llm.queries import WORD_VOCABULARY, op12_packing

from .helpers import AWKWARD, SMALL, documents, text_of, with_clashes


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_VOCABULARY)


def whole(library, text):
    return [*library.encode(text, add_special_tokens=False).ids, packing.END]


def check(library, frame, rows):
    """Documents in order of doc_id (null first), one after another, with the library's ids."""
    rows = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r["doc_id"] for r in frame), key=lambda d: (d is not None, d))
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    found = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in rows)
    assert found == sorted((str(r["doc_id"]), whole(library, text_of(r))) for r in frame)


def test_awkward_rows(spark, library):
    frame = with_clashes(documents(spark, AWKWARD), "tie", "place", "ids", "start").coalesce(2)
    folder, segments = packing.write(frame, WORD_VOCABULARY, file_bytes=100_000, segment=500)
    assert segments.select("file").distinct().count() > 1
    check(library, frame.collect(), packing.read(folder, segments, 3).collect())
    empty = packing.write(documents(spark, []), WORD_VOCABULARY)
    assert packing.read(*empty).count() == 0


def test_one_id_on_most_rows_goes_to_several_files(spark, library):
    rows = [(7 if i % 3 else None, f"text {i % 40}", "en", "a", 1) for i in range(900)]
    frame = documents(spark, rows)
    folder, segments = packing.write(frame, WORD_VOCABULARY, file_bytes=500)
    assert segments.count() > 5
    assert max(r.docs for r in segments.collect()) < 300
    check(library, frame.collect(), packing.read(folder, segments).collect())


def test_words_of_one_hash(library, monkeypatch):
    monkeypatch.setattr(packing, "span_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    coder, texts = packing.Words(WORD_VOCABULARY), ["one two", "six ten three", ""]
    for i, part in coder.encode(texts):
        assert np.frombuffer(part, "<u4").tolist() == whole(library, texts[i])[:-1]


def test_words_give_the_librarys_ids(library, monkeypatch):
    draw = random.Random(3)
    monkeypatch.setattr(packing, "SLICE", 64)
    monkeypatch.setattr(packing, "WORDS", 50)
    signs = "aB é́   \t\n\x0b\x1c\x1fΣσİß'st've123 日本語\U0001f600.,!?<|endoftext|>ẞ̈́ﬁ"
    coder = packing.Words(WORD_VOCABULARY)
    for _ in range(100):
        choice = [*signs, "<|endoftext|>", "<|startoftext|>", "'s", "  ", "then,", "wort.", "İs"]
        texts = ["".join(draw.choice(choice) for _ in range(draw.randrange(200))) for _ in range(draw.randrange(5))]
        found = [b""] * len(texts)
        for i, part in coder.encode(texts):
            found[i] += part
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == [whole(library, t)[:-1] for t in texts]


@pytest.mark.parametrize("width", [1, 7, 8, 13, 16, 17, 31, 32])
def test_packing_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1003).astype(np.uint32)
    data = packing.pack(ids, width)
    assert len(data) == (1003 * width + 7) // 8
    assert np.array_equal(packing.unpack(data, 1003, width), ids)


def test_random_access(tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 100)
    ids = np.random.default_rng(0).integers(0, 8000, 1234).astype("<u4")
    writer = packing.Writer(f"file://{tmp_path}", 5, 13)
    cuts = [0, 0, 7, 650, 1200, 1234]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        writer.add(ids[a : (a + b) // 2].tobytes())
        assert writer.end(i or None, ids[(a + b) // 2 : b].tobytes()) == b - a
    writer.close()
    file = packing.Reader(f"file://{tmp_path}", 5)
    assert (file.width, file.n_ids, file.n_docs) == (13, 1234, 5)
    assert [p.name for p in tmp_path.iterdir()] == ["ids-000005.bits"]
    doc_ids, borders = file.docs(2, 3)
    assert doc_ids == [2, 3, 4] and borders.tolist() == cuts[2:]
    assert file.docs(0, 1)[0] == [None]
    for a, b in [(0, 1234), (99, 101), (100, 200), (1233, 1234), (5, 5), (0, 1)]:
        assert np.array_equal(file.ids(a, b), ids[a:b])


def test_query(spark, library):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    at, wanted = 0, []
    for r in frame:
        ids = whole(library, text_of(r))
        wanted.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, op12_packing(spark, SMALL).collect())) == wanted
