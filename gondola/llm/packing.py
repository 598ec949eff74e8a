"""Token ids in files of fixed-width bit packing.

Every id takes as many bits as the vocabulary's largest id needs. A file holds the ids of consecutive documents, cut into blocks of ``BLOCK`` ids
that begin at whole bytes, then the documents' ids and places, the offsets of the blocks, and a footer. Any run of ids is read by one range of the
file and unpacked with array operations.

    magic | blocks | doc_id of each document (int64), whether it has one (1 byte), its end in ids (uint64) | block offsets (uint64) | footer

Documents are in ascending order of doc_id: a range of the order is one file, so the files by number are the whole sequence. A task writes a file under a
name of its attempt and then moves it to its final name; a repeated attempt writes the same bytes. Files go through ``pyarrow.fs``.

Texts are encoded by the tokenizer's own library word by word: at ASCII white space, and between an ASCII letter and a full stop or its like, the
splitting pattern always cuts, and neither the normalisation nor a special token reaches across. So each word's ids are kept, found again by its
hash with array operations, and put together.

Cases: a null text is the empty text, which has the end id alone; null ids come first; rows of one id are in the order of a hash of the text, and rows
that are equal throughout are one beside the other, so a repeated id is dealt to several files; very long texts are encoded in slices at white
space and leave as blocks; an empty table writes no file and gives no row; other columns are not kept.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.llm.common import LOW_BYTES, WHITE, mixed, new_folder, span_hashes, stage, text_column

END = 2
BLOCK = 1 << 16
#: Text of a file, ids of a segment (what a reading task takes at once), and known words of a process.
FILE_BYTES, SEGMENT, WORDS = 64 << 20, 1 << 20, 1_000_000
MAGIC = b"GONDIDS1"
#: Width, ids of a block, ids, documents, place of the documents, place of the block offsets.
FOOTER = struct.Struct("<IIQQQQ8s")
#: Marks that the splitting pattern cuts from the letters before them.
MARKS, WORD_END = b".,;:!?", "</w>"
_SPACE = re.compile(rb"[ \t-\r]")
SLICE = 2 << 20


class Store:
    """Ids of the words seen so far, found by the words' hashes; ``checks`` tells words of equal hashes apart."""

    def __init__(self):
        self.hashes, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begins, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where these hashes are or would be, and which are there."""
        at = np.searchsorted(self.hashes, hashes)
        there = at < len(self.hashes)
        there[there] = self.hashes[at[there]] == hashes[there]
        return at, there

    def add(self, hashes: np.ndarray, checks: np.ndarray, coded: list[bytes]) -> None:
        """Words whose hashes, in ascending order, are not there yet."""
        at = np.searchsorted(self.hashes, hashes)
        lengths = np.array([len(c) // 4 for c in coded], np.int64)
        begins = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(coded), "<u4")])
        for name, new in (("hashes", hashes), ("checks", checks), ("begins", begins), ("lengths", lengths)):
            setattr(self, name, np.insert(getattr(self, name), at, new))


class Words:
    """The ids of texts by a tokenizer's file, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.coder.no_truncation()
        self.coder.no_padding()
        self.special = [t.content.encode() for t in self.coder.get_added_tokens_decoder().values()]
        if any(_SPACE.search(t) or set(t) & set(MARKS) for t in self.special):
            raise ValueError("an added token of this vocabulary has a place where texts are cut")
        vocabulary = self.coder.get_vocab(with_added_tokens=True)
        self.width = max(max(vocabulary.values()).bit_length(), END.bit_length())
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith(WORD_END)]] = True
        self.store = Store()

    def small(self, text: str) -> bytes:
        """A text with small letters: they are made small in any case, but only after special tokens have been looked for."""
        data = text.encode()
        small = data.lower()
        return data if any(t.lower() in small for t in self.special) else small

    def encode(self, texts: list[str]) -> Iterator[tuple[int, bytes]]:
        """The ids of texts: each text's place in the list with its ids, a long text's in parts."""
        waiting, size = [], 0
        for i, text in enumerate(texts):
            data, at = self.small(text), 0
            while at < len(data):
                cut = _SPACE.search(data, at + SLICE) if len(data) - at > SLICE else None
                end = cut.start() if cut else len(data)
                waiting.append((i, data[at:end]))
                size, at = size + end - at, end
                if size >= SLICE:
                    yield from self.together(waiting)
                    waiting, size = [], 0
        if waiting:
            yield from self.together(waiting)

    def together(self, parts: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        data, starts, ends, first = words_of([part for _, part in parts])
        lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        hashes = span_hashes(data, starts, ends)
        low = LOW_BYTES[np.minimum(ends - starts, 8)]
        checks = mixed(lanes[starts] & low) ^ (lanes[np.maximum(ends - 8, starts)] & low) ^ (ends - starts).astype(np.uint64)
        distinct, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        at, there = self.store.places(distinct)
        new = one[~there]
        if len(new):
            if len(self.store.hashes) + len(new) > WORDS:
                self.store, new = Store(), one
            words = [data[a:b].tobytes() for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
            self.store.add(hashes[new], checks[new], self.learned(words))
            at, _ = self.store.places(distinct)
        store, at = self.store, at[which]
        if np.any(store.checks[at] != checks):  # two words of one hash
            coded = self.coder.encode_batch_fast([part.decode() for _, part in parts], add_special_tokens=False)
            yield from ((i, np.array(c.ids, "<u4").tobytes()) for (i, _), c in zip(parts, coded, strict=True))
            return
        lengths = store.lengths[at]
        stops = np.cumsum(lengths)
        total = int(stops[-1]) if len(stops) else 0
        ids = store.ids[np.repeat(store.begins[at] - (stops - lengths), lengths) + np.arange(total)]
        borders = np.concatenate([[0], stops])[first].tolist()
        for (i, _), a, b in zip(parts, borders, borders[1:], strict=False):
            yield i, ids[a:b].tobytes()

    def learned(self, words: list[bytes]) -> list[bytes]:
        """Words of letters alone are encoded as one text: each ends with the only end of a word in its ids."""
        texts = [w.decode() for w in words]
        letters = [t for t in texts if t.isalpha()]
        found = dict(zip(letters, self.joined(letters), strict=False))
        rest = [t for t in texts if t not in found]
        for text, coded in zip(rest, self.coder.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            found[text] = np.array(coded.ids, "<u4").tobytes()
        return [found[t] for t in texts]

    def joined(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        ids = np.array(self.coder.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        borders = np.flatnonzero(self.ends[ids]) + 1
        if len(borders) != len(words):  # some letter becomes several words
            return []
        data, borders = ids.tobytes(), (4 * borders).tolist()
        return [data[a:b] for a, b in zip([0, *borders], borders, strict=False)]


_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[97:123] = True
_MARK[list(MARKS)] = True


def words_of(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all parts (padded), starts and ends of their words, and where each part's words begin.

    Words end at white space, and between an ASCII letter and one of ``MARKS``, where the splitting pattern always cuts too.
    """
    data = np.frombuffer(b"\n".join([*parts, b"\0" * 8]), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
    text = data[: offsets[-1]]
    inside, letter, mark = ~WHITE[text], _LETTER[text], _MARK[text]
    cut = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    starts, ends = inside.copy(), np.zeros_like(inside)
    starts[1:] &= ~inside[:-1] | cut
    ends[1:] = inside[:-1] & (~inside[1:] | cut)
    starts = np.flatnonzero(starts)
    return data, starts, np.flatnonzero(ends), np.searchsorted(starts, offsets)


@cache
def coder(path: str) -> Words:
    """One for each worker process."""
    return Words(path)


def pack(ids: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bits of each id one after another, lowest bit first, filled up to a whole byte."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint64)[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype(np.uint32)
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    lanes = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    at = np.arange(n, dtype=np.int64) * width
    return ((lanes[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


class Writer:
    def __init__(self, folder: str, number: int, width: int):
        self.files, root = fs.FileSystem.from_uri(folder)
        self.final, self.working = f"{root}/{name_of(number)}", f"{root}/_{name_of(number)}-{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.working)
        self.out.write(MAGIC)
        self.width, self.at, self.ids = width, len(MAGIC), 0
        self.offsets: list[int] = []
        self.waiting: list[bytes] = []
        self.filled = 0
        self.docs: list[int] = []
        self.named: list[bool] = []
        self.ends: list[int] = []

    def add(self, part: bytes) -> None:
        """Some ids of the document at hand."""
        self.waiting.append(part)
        self.filled += len(part) // 4
        self.ids += len(part) // 4
        if self.filled >= BLOCK:
            self.flush(False)

    def end(self, doc_id: int | None, tail: bytes) -> int:
        """Its last ids; returns how many it has."""
        self.add(tail)
        self.docs.append(doc_id or 0)
        self.named.append(doc_id is not None)
        self.ends.append(self.ids)
        return self.ids - (self.ends[-2] if len(self.ends) > 1 else 0)

    def flush(self, all_of_it: bool) -> None:
        data = b"".join(self.waiting)
        ids = np.frombuffer(data, "<u4")
        whole = len(ids) if all_of_it else len(ids) // BLOCK * BLOCK
        for begin in range(0, whole, BLOCK):
            packed = pack(ids[begin : min(begin + BLOCK, whole)], self.width)
            self.offsets.append(self.at)
            self.out.write(packed)
            self.at += len(packed)
        self.waiting, self.filled = [data[4 * whole :]], len(ids) - whole

    def close(self) -> None:
        self.flush(True)
        table = np.array(self.docs, "<i8").tobytes() + np.array(self.named, np.uint8).tobytes() + np.array(self.ends, "<u8").tobytes()
        self.out.write(table)
        self.out.write(np.array([*self.offsets, self.at], "<u8").tobytes())
        self.out.write(FOOTER.pack(self.width, BLOCK, self.ids, len(self.docs), self.at, self.at + len(table), MAGIC))
        self.out.close()
        self.files.move(self.working, self.final)


class Reader:
    """Random access to a file: documents by their place, ids by theirs."""

    def __init__(self, folder: str, number: int):
        files, root = fs.FileSystem.from_uri(folder)
        self.source = files.open_input_file(f"{root}/{name_of(number)}")
        size = self.source.size()
        self.width, self.block, self.n_ids, self.n_docs, self.documents, at, magic = FOOTER.unpack(self.source.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{name_of(number)} is not a file of packed ids")
        self.offsets = np.frombuffer(self.source.read_at(size - FOOTER.size - at, at), "<u8").astype(np.int64)

    def _column(self, dtype: str, place: int, first: int, n: int) -> np.ndarray:
        item = np.dtype(dtype).itemsize
        return np.frombuffer(self.source.read_at(item * n, self.documents + place * self.n_docs + item * first), dtype)

    def docs(self, first: int, n: int) -> tuple[list[int | None], np.ndarray]:
        """The doc_ids of ``n`` documents, and their borders in ids."""
        ids, named = self._column("<i8", 0, first, n), self._column("u1", 8, first, n)
        ends = self._column("<u8", 9, first, n).astype(np.int64)
        begin = int(self._column("<u8", 9, first - 1, 1)[0]) if first else 0
        return [d if k else None for d, k in zip(ids.tolist(), named.tolist(), strict=True)], np.concatenate([[begin], ends])

    def ids(self, begin: int, end: int) -> np.ndarray:
        if begin >= end:
            return np.zeros(0, np.uint32)
        one, last = begin // self.block, (end - 1) // self.block
        data = self.source.read_at(int(self.offsets[last + 1] - self.offsets[one]), int(self.offsets[one]))
        parts = []
        for b in range(one, last + 1):
            n = min(self.block, self.n_ids - b * self.block)
            parts.append(unpack(data[self.offsets[b] - self.offsets[one] : self.offsets[b + 1] - self.offsets[one]], n, self.width))
        return np.concatenate(parts)[begin - one * self.block : end - one * self.block]


def name_of(number: int) -> str:
    return f"ids-{number:06d}.bits"


@lru_cache(4)
def reader(folder: str, number: int) -> Reader:
    return Reader(folder, number)


def write(docs: DataFrame, path: str, folder: str | None = None, end: int = END, file_bytes: int = FILE_BYTES, segment: int = SEGMENT) -> tuple[str, DataFrame]:
    """Encode texts and write them into files of a shared folder.

    Returns the folder and its segments (staged): file, first document, documents, ids, and ``start``, the ids of all files and segments before.
    ``docs`` must come from a table: the last key of the order is the row's place in it.
    """
    folder = folder or new_folder(docs.sparkSession, "ids")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    rows = rows.withColumns({"tie": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("place")]
    dealt = rows.repartitionByRange(int(size // file_bytes) + 1, *order).sortWithinPartitions(*order).select("doc_id", "text")
    names = ["file", "first", "docs", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, writer, found = TaskContext.get().partitionId(), None, []
        first = docs = ids = 0
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            code = coder(path)
            writer = writer or Writer(folder, number, code.width)
            doc_ids, coded, at = batch.column(0).to_pylist(), code.encode(text_column(batch)), 0
            for place, part in chain(coded, [(len(doc_ids), b"")]):
                for doc_id in doc_ids[at:place]:
                    ids += writer.end(doc_id, tail)
                    docs += 1
                    if ids >= segment:
                        found.append((number, first, docs, ids))
                        first, docs, ids = first + docs, 0, 0
                at = max(at, place)
                writer.add(part)
        if docs:
            found.append((number, first, docs, ids))
        if writer:
            writer.close()
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names)

    segments = stage(dealt.mapInArrow(run, "file long, first long, docs long, ids long"), "ids-index")
    files = segments.groupBy("file").agg(F.sum("ids").alias("whole"))
    # One row a file.
    before = F.sum("whole").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("file", F.coalesce(before, F.lit(0)).alias("files_before"))
    inside = F.sum("ids").over(Window.partitionBy("file").orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
    starts = segments.withColumn("inside", F.coalesce(inside, F.lit(0))).join(files, "file")
    return folder, stage(starts.select(*names, (F.col("files_before") + F.col("inside")).alias("start")), "ids-segments")


def read(folder: str, segments: DataFrame, tasks: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents of some segments; ``ids`` little-endian unsigned 32-bit."""
    names = ["doc_id", "start", "n_tokens", "ids"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, first, docs, _, start in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                file = reader(folder, number)
                doc_ids, borders = file.docs(first, docs)
                ids = file.ids(int(borders[0]), int(borders[-1]))
                at = (borders - borders[0]).tolist()
                rows, size = [], 0
                for d, begin, stop in zip(doc_ids, at, at[1:], strict=False):
                    rows.append((d, start + begin, stop - begin, ids[begin:stop].astype("<u4").tobytes()))
                    size += stop - begin
                    if size >= SEGMENT:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    # A number of tasks by the ids, not by the few bytes of the segments' rows.
    tasks = tasks or segments.count() // 4 + 1
    return segments.select("file", "first", "docs", "ids", "start").repartition(tasks, "file", "first").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
