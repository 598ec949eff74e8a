"""Byte-pair encoding and decoding of whole texts, long ones by tree concatenation.

Short texts are encoded where they are read. A longer one is cut into pieces that Spark deals out and encodes in parallel, and its pieces are
joined pairwise, a tree level at a time, in one task for each text. Where a cut lies between two pieces that the splitting pattern separates
in any case (a letter or digit before a blank), their ids are simply put together. Where it lies inside unsplit text, a run of one kind of
character, a window of ids around the join is decoded and encoded again; it grows until the ids at both of its ends come out as before. If it
would leave the run, both halves are encoded as one text. A sequence of ids is the encoding of unsplit text exactly if every two neighbours
are the encoding of their own bytes, so agreement of one id at either end makes the whole exact.

The vocabulary and the order of merges are read from the tokenizer's file. Ids are equal to those of that file's own library, special tokens in
the text included, without padding and truncation.

Cases: a null text is the empty text, which has no ids; very long texts need memory for one text only; repeated rows and null ids are kept; an
empty table gives an empty result; the columns to keep are named by the caller.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import slices, text_column

PIECE = 16_384
WINDOW = 4
#: Splitting pattern of the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Whatever the text around, the pattern splits before a blank that follows an ASCII letter or digit, between ASCII letters and digits, and before
#: these marks that follow a letter or number. No special token may have such a place in it.
SAFE = re.compile(r"(?<=[A-Za-z0-9])(?=[ \n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[^\W\d_])(?=[.,;:!?。，、！？])")
#: A cut inside unsplit text has so many characters of one kind on either side; windows stay within this many.
MARGIN, REACH = 64, 1024


def _byte_of_character() -> dict[str, int]:
    """The vocabulary file spells a byte as the character of that number where it is printable, others as those from 256 on in turn."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


#: Start and end in the text, and the ids.
Piece = tuple[int, int, np.ndarray]


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        plain, vocabulary = _byte_of_character(), content["model"]["vocab"]
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        ranks = {bytes(map(plain.__getitem__, word)): i for word, i in vocabulary.items() if word not in special}
        merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in content["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("the ids of this vocabulary do not follow the order of its merges")
        if any(SAFE.search(word) for word in special):
            raise ValueError("a special token of this vocabulary has a place where texts are cut")
        self.coding = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = set(special)
        spelled = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for word, i in [*ranks.items(), *((w.encode(), i) for w, i in special.items())]:
            spelled[i] = word
        self.lengths = np.array([len(w) for w in spelled])
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)

    def encode(self, text: str) -> np.ndarray:
        return self.coding.encode_to_numpy(text, allowed_special=self.special).astype(np.uint32, copy=False)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        n = self.lengths[ids]
        ends = np.cumsum(n)
        at = np.repeat(self.begins[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        return self.letters[at].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.bytes_of(ids).decode("utf-8", errors="replace")

    def join(self, text: str, left: Piece, right: Piece) -> Piece:
        """The encoding of two neighbouring pieces of a text."""
        (start, cut, a_ids), (_, end, b_ids) = left, right
        if SAFE.match(text, cut):
            return start, end, np.concatenate([a_ids, b_ids])
        before = len(text[max(start, cut - same_kind(text, cut, -1) + 3) : cut].encode())
        after = len(text[cut : min(end, cut + same_kind(text, cut, 1) - 1)].encode())
        a_bytes = np.cumsum(self.lengths[a_ids[: -REACH - 1 : -1]])
        b_bytes = np.cumsum(self.lengths[b_ids[:REACH]])
        reach = WINDOW
        while True:
            a, b = reach, reach
            while a < len(a_bytes) and self.letters[self.begins[a_ids[-a]]] & 0xC0 == 0x80:
                a += 1
            while b < len(b_bytes) and self.letters[self.begins[b_ids[b]]] & 0xC0 == 0x80:
                b += 1
            if a >= len(a_bytes) or b >= len(b_bytes) or a_bytes[a - 1] > before or b_bytes[b - 1] > after:
                return start, end, self.encode(text[start:end])
            new = self.encode(self.decode(np.concatenate([a_ids[-a:], b_ids[:b]])))
            if new[0] == a_ids[-a] and new[-1] == b_ids[b - 1]:
                return start, end, np.concatenate([a_ids[:-a], new, b_ids[b:]])
            reach *= 2

    def tree(self, text: str, pieces: list[Piece]) -> np.ndarray:
        while len(pieces) > 1:
            pieces = [self.join(text, *pieces[i : i + 2]) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
        return pieces[0][2]


@cache
def codec(path: str) -> Codec:
    """One for each worker process."""
    return Codec(path)


def kind(character: str) -> str:
    """Letter, number, blank or other, as the splitting pattern has them."""
    return "S" if character.isspace() else category if (category := unicodedata.category(character)[0]) in "LN" else "O"


def same_kind(text: str, cut: int, step: int) -> int:
    """How many characters before (step -1) or after a cut are of the kind of the character there, up to ``REACH``."""
    at = cut if step > 0 else cut - 1
    wanted, n = kind(text[cut]), 0
    while n < REACH and 0 <= at < len(text) and kind(text[at]) == wanted:
        at, n = at + step, n + 1
    return n


def cuts(text: str, piece: int = PIECE) -> list[int]:
    """Where to cut a text: about every ``piece`` characters, at a place the pattern splits anyway or well inside unsplit text."""
    out, at = [0], piece
    while at < len(text):
        place = SAFE.search(text, at, at + piece)
        inside = None if place else next((p for p in range(at, min(at + piece, len(text)), MARGIN) if min(same_kind(text, p, -1), same_kind(text, p, 1)) > MARGIN), None)
        if not place and inside is None:
            place = SAFE.search(text, at + piece)
        if not place and inside is None:
            break
        out.append(place.start() if place else inside)
        at = out[-1] + piece
    return [*out, len(text)]


def encode(docs: DataFrame, keep: list[str], path: str, piece: int = PIECE) -> DataFrame:
    """The columns ``keep`` of every document with ``n_tokens``, ``ids`` (binary: little-endian unsigned 32-bit) and ``decoded`` (the ids' text)."""
    kept = [f"bpe_keep_{c}" for c in keep]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], F.coalesce("text", F.lit("")).alias("bpe_text"))
    is_long = F.char_length("bpe_text") > 2 * piece
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "bpe_text")
    types += ", " if types else ""
    names = [*kept, "n_tokens", "ids", "decoded"]

    def batch_of(columns: list[pa.Array], ids: list[np.ndarray], decoded: list[str]) -> pa.RecordBatch:
        counts = pa.array([len(x) for x in ids], pa.int64())
        return pa.RecordBatch.from_arrays([*columns, counts, pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(decoded, pa.string())], names)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            texts = text_column(batch, "bpe_text")
            for part in slices(texts):
                ids = [coder.encode(t) for t in texts[part]]
                columns = [c.slice(part.start, part.stop - part.start) for c in batch.columns[:-1]]
                yield batch_of(columns, ids, [coder.decode(x) for x in ids])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(text_column(batch, "bpe_text")):
                places = cuts(text, piece)
                n = len(places) - 1
                columns = [pa.concat_arrays([c.slice(i, 1)] * n) for c in batch.columns[:-1]]
                texts = pa.array([text[a:b] for a, b in zip(places, places[1:], strict=False)], pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(range(n), pa.int32()), texts], [*kept, "bpe_row", "bpe_piece", "bpe_text"])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            ids = pa.array([coder.encode(t).tobytes() for t in text_column(batch, "bpe_text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "ids"])

    def joined(group: pa.Table) -> pa.Table:
        coder = codec(path)
        group = group.sort_by("bpe_piece")
        texts = group.column("bpe_text").to_pylist()
        ends = np.cumsum([len(t) for t in texts]).tolist()
        ids = [np.frombuffer(x, np.uint32) for x in group.column("ids").to_pylist()]
        whole = coder.tree("".join(texts), list(zip([0, *ends], ends, ids, strict=False)))
        columns = [group.column(c).slice(0, 1).combine_chunks() for c in kept]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.Table.from_batches([batch_of(columns, [whole], [coder.decode(whole)])])

    results = f"{types}n_tokens long, ids binary, decoded string"
    direct = rows.where(~is_long).mapInArrow(short, results)
    long = rows.where(is_long).select(*kept, F.monotonically_increasing_id().alias("bpe_row"), "bpe_text")
    pieces = long.mapInArrow(cut, f"{types}bpe_row long, bpe_piece int, bpe_text string").repartition("bpe_row", "bpe_piece")
    pieces = pieces.mapInArrow(encoded, f"{types}bpe_row long, bpe_piece int, bpe_text string, ids binary")
    out = direct.union(pieces.groupBy("bpe_row").applyInArrow(joined, results))
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], "n_tokens", "ids", "decoded")
