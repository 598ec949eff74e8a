"""Language identification by partial matching: a byte context tree for each language, its statistics frozen, and exact code lengths.

For each language the tree counts which byte followed each context of up to ``order`` bytes; a context takes part from ``least`` occurrences on.
A byte seen in the longest known context costs -log2(count / (total + kinds)), kinds being the number of different bytes seen there; another
costs the escape -log2(kinds / (total + kinds)) and is looked up in the next shorter context, down to one of 256 equal bytes. The text's
language is that of the shortest code, and the score its share when code lengths are turned to probabilities.

Counting is a Spark job over the labelled rows; a document counts as far as ``sample`` documents for each language allow (picked by hash, whole
texts). What is collected is the whole table of counts. The costs of all (context, byte) pairs that were seen are worked out once and kept
sparse, with the escape of each context, so a text is scored by a few table look-ups a byte.

Cases: null texts and texts without a letter are ``und`` with score 0; a text before which nothing stands has a start mark as its context; with
no labelled rows every text is ``und``; repeated rows and null ids are scored each; an empty table gives an empty result; other columns
(``lang``, ``source``) are never read to predict.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import bounded_sample, slices, text_column

ORDER = 3
SAMPLE = 4000
LEAST = 2
START = 256
NONE = "und"
_LETTER = regex.compile(r"\p{L}")


def grams(texts: list[bytes], order: int = ORDER) -> np.ndarray:
    """A number for each byte of the texts: the ``order`` symbols before it and itself, nine bits each; each text begins with start marks."""
    lead = np.full(order, START, np.int64)
    symbols = np.concatenate([x for t in texts for x in (lead, np.frombuffer(t, np.uint8))] or [lead])
    codes = symbols.copy()
    for back in range(1, order + 1):
        codes[back:] |= symbols[:-back] << (9 * back)
    return codes[symbols != START]


@dataclass
class Model:
    """Costs in bits; contexts are rows, those of a shorter length before the longer ones.

    ``symbol``: byte to column (0: never seen); ``row``: three symbols to the row of their longest known context; ``shorter``: row to that of the
    longest known context below it (-1: none); ``bits``: which columns were seen in a row, 64 to a word; ``before``: how many in all words before;
    ``cost``: by pair seen in any language, in the order of row and column, and language; ``escape``: by row and language.
    """

    languages: list[str]
    width: int
    symbol: np.ndarray
    row: np.ndarray
    shorter: np.ndarray
    bits: np.ndarray
    before: np.ndarray
    cost: np.ndarray
    escape: np.ndarray
    order: int

    def costs(self, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Bits of each (row, column), by language."""
        out = np.zeros((len(rows), len(self.languages)), np.float32)
        open_ = np.arange(len(rows))
        for _ in range(self.order + 1):
            word, bit = columns >> 6, (columns & 63).astype(np.uint64)
            held = self.bits[rows, word]
            seen = (held >> bit & np.uint64(1)).astype(bool)
            below = held[seen] & ((np.uint64(1) << bit[seen]) - np.uint64(1))
            out[open_[seen]] += self.cost[self.before[rows[seen], word[seen]] + np.bitwise_count(below)]
            if seen.all():
                return out
            open_, rows, columns = open_[~seen], rows[~seen], columns[~seen]
            out[open_] += self.escape[rows]
            rows = self.shorter[rows]
            over = rows < 0
            out[open_[over]] += 8
            open_, rows, columns = open_[~over], rows[~over], columns[~over]
            if not len(open_):
                return out
        return out


def counted(docs: DataFrame, order: int = ORDER, sample: int = SAMPLE) -> DataFrame:
    """(lang, gram, n) over the texts of a bounded number of documents of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = [t.encode() for t in text_column(batch)], batch.column(1).to_pylist()
            for part in slices(texts):
                for lang in sorted(set(langs[part])):
                    values, n = np.unique(grams([t for t, k in zip(texts[part], langs[part], strict=True) if k == lang], order), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(values), pa.array(n)], ["lang", "gram", "n"])

    rows = bounded_sample(docs.where("text is not null and lang is not null").select("doc_id", "text", "lang"), "lang", sample)
    return rows.select("text", "lang").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, order: int = ORDER, sample: int = SAMPLE, least: int = LEAST) -> Model | None:
    """Learn from the columns ``text`` and ``lang``; rows without either are left out. No model if nothing is left."""
    flat = counted(docs, order, sample).select("lang", F.shiftright("gram", 9).alias("context"), F.col("gram").bitwiseAND(F.lit(511)).alias("symbol"), "n").toArrow()
    if not flat.num_rows:
        return None
    lang = flat.column("lang").combine_chunks().dictionary_encode()
    names = lang.dictionary.to_pylist()
    return build(names, lang.indices.to_numpy(), *[flat.column(c).to_numpy() for c in ("context", "symbol", "n")], order, least)


def build(names: list[str], lang: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray, order: int = ORDER, least: int = LEAST) -> Model:
    """From the counts of each (language by its number in ``names``, context, symbol)."""
    languages = sorted(names)
    seen = np.zeros(257, bool)
    seen[symbol] = True
    column = np.zeros(257, np.int64)
    column[seen] = np.arange(1, seen.sum() + 1)
    width = int(seen.sum()) + 2
    column[START] = width - 1
    number = sum((column[(context >> (9 * j)) & 511] * width**j for j in range(order)), np.zeros(len(n), np.int64))
    which, of = np.argsort(np.argsort(names))[lang].astype(np.int64), column[symbol]
    row, rows = np.full(1, -1, np.int32), 0
    shorter, escapes, cells, costs = [], [], [], []
    for k in range(order + 1):
        # Contexts of k symbols: a number in base ``width`` of the last k. Only one with ``least`` occurrences in some language takes part.
        grams, at = np.unique((number % width**k * width + of) * len(names) + which, return_inverse=True)
        count = np.bincount(at, n, len(grams))
        pair, j = grams // len(names), grams % len(names)
        own, at = np.unique(pair // width * len(names) + j, return_inverse=True)
        total, kinds = np.bincount(at, count, len(own)), np.bincount(at, minlength=len(own))
        part = (total >= least) | (k == 0)
        known = np.unique(own[part] // len(names))
        lower = row[known % width ** max(k - 1, 0)]
        escape = np.zeros((len(known), len(names)), np.float32)
        escape[np.searchsorted(known, own[part] // len(names)), own[part] % len(names)] = -np.log2(kinds[part] / (total + kinds)[part])
        # A pair seen in any language that takes part has the costs of all: the escape and the shorter context's where it was not seen.
        use = part[at]
        pairs = np.unique(pair[use])
        mine = np.searchsorted(known, pairs // width)
        if k:
            below = Model(languages, width, column, row, *_sparse(shorter, escapes, cells, costs, width), order)
            cost = below.costs(lower[mine], pairs % width) + escape[mine]
        else:
            cost = 8 + escape[mine]
        cost[np.searchsorted(pairs, pair[use]), j[use]] = -np.log2(count[use] / (total + kinds)[at[use]])
        shorter.append(lower)
        escapes.append(escape)
        cells.append((mine + rows) * width + pairs % width)
        costs.append(cost.astype(np.float32))
        row = np.tile(row, width) if k else row.copy()
        row[known] = np.arange(rows, rows + len(known))
        rows += len(known)
    return Model(languages, width, column[:256].astype(np.int64), row, *_sparse(shorter, escapes, cells, costs, width), order)


def _sparse(shorter: list[np.ndarray], escapes: list[np.ndarray], cells: list[np.ndarray], costs: list[np.ndarray], width: int) -> tuple[np.ndarray, ...]:
    """``shorter``, ``bits``, ``before``, ``cost`` and ``escape`` of a model, from those of each length of contexts."""
    down, cell = np.concatenate(shorter), np.concatenate(cells)
    words = (width + 63) // 64
    bits = np.zeros((len(down), words), np.uint64)
    at, column = cell // width, cell % width
    np.bitwise_or.at(bits, (at, column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    held = np.bitwise_count(bits).astype(np.int64).ravel()
    before = (np.cumsum(held) - held).reshape(bits.shape)
    return down, bits, before, np.concatenate(costs), np.concatenate(escapes)


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of each text in each language."""
    width, order = model.width, model.order
    out = np.zeros((len(texts), len(model.languages)))
    sizes = np.array([len(t) for t in texts])
    if not sizes.sum():
        return out
    lead = b"\0" * order
    raw = np.frombuffer(b"".join(x for t in texts for x in (lead, t)), np.uint8)
    symbols = model.symbol[raw]
    begins = np.concatenate([[0], np.cumsum(sizes + order)[:-1]])
    for j in range(order):
        symbols[begins + j] = width - 1
    context = np.zeros(len(symbols), np.int64)
    for back in range(1, order + 1):
        context[back:] += symbols[:-back] * width ** (back - 1)
    bits = model.costs(model.row[context], symbols)
    for j in range(order):
        bits[begins + j] = 0
    some = sizes > 0
    out[some] = np.add.reduceat(bits, begins[some], axis=0, dtype=np.float64)
    return out


def predict(docs: DataFrame, model: Model | None, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``keep`` with the language and its score under ``names``, from the text alone."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = [f"ppm_keep_{c}" for c in keep]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], F.col("text").alias("ppm_text"))
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "ppm_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = text_column(batch, "ppm_text")
            best, score = [NONE] * len(texts), np.zeros(len(texts))
            for part in slices(texts, 500_000) if model else ():
                bits = code_lengths(model, [t.encode() for t in texts[part]])
                share = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
                for i, (k, s) in enumerate(zip(bits.argmin(axis=1), share, strict=True), part.start):
                    if _LETTER.search(texts[i]):
                        best[i], score[i] = model.languages[k], s
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(best, pa.string()), pa.array(score)], [*kept, "ppm_lang", "ppm_score"])

    out = rows.mapInArrow(run, f"{types}ppm_lang string, ppm_score double")
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], F.col("ppm_lang").alias(names[0]), F.col("ppm_score").alias(names[1]))
