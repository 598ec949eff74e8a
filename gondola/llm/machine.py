"""Document quality by a factorisation machine.

A text's features are its words (hashed to ``BUCKETS``, each weighted by its share of the words), fifteen structure statistics, each put into one
of ``BINS`` bins, and a bin for the length that the table states. The score is the logistic of

    constant + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

so all pairwise interactions of features take time linear in their number. Learning takes about ``SAMPLE`` labelled rows of each class, picked by
hash, whole texts, and weighs them back to the shares among all labelled rows.

Cases: null and empty texts have no words and statistics of zero, and get a score; a null length has a bin of its own; null labels are left out;
without rows of both classes the score is the share of ones; repeated rows and null ids are scored each; an empty table gives an empty result; the
columns to keep are named by the caller.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import ALNUM, WHITE, Spans, bounded_sample, slices, span_hashes, text_column

SAMPLE = 2000
BUCKETS = 1 << 13
BINS = 16
FACTORS = 8
STEPS = 80
RATE = 0.05
RIDGE = 1e-4
_CLASSES = {"upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "far": range(128, 256), "line": [10], "sentence": b".,;:?", "mark": b"!#$%&*|<>{}[]\\^~=+_@/"}
STATISTICS = [*_CLASSES, "white", "word_length", "long_words", "distinct_words", "repeated_lines", "line_length", "marked_words", "repeated_words"]
FIRST_LENGTH = BUCKETS + len(STATISTICS) * BINS
SIZE = FIRST_LENGTH + 34


def _shares(data: np.ndarray, wanted: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(wanted[data])])
    return np.diff(total[offsets])


def _distinct(owner: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    mixed_up = hashes ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(mixed_up, return_index=True)
    return np.bincount(owner[at], minlength=texts)


def statistics(texts: list[bytes], plain: Spans) -> np.ndarray:
    """A row of numbers between 0 and 1 for each text; ``plain``: the words between white space."""
    n = len(texts)
    size = np.maximum(np.diff(plain.offsets) - 1, 1).astype(float)
    out = np.zeros((n, len(STATISTICS)))
    body = plain.data[: plain.offsets[-1]]
    for i, members in enumerate(_CLASSES.values()):
        table = np.zeros(256, np.int64)
        table[list(members)] = 1
        got = _shares(body, table, plain.offsets)
        out[:, i] = (got - (1 if 10 in members else 0)) / size
    words, length = np.maximum(plain.counts, 1), plain.ends - plain.starts
    owner = np.repeat(np.arange(n), plain.counts)
    lines = Spans(texts, np.arange(256) != 10)
    line_owner = np.repeat(np.arange(n), lines.counts)
    line_count = np.maximum(lines.counts, 1)
    last = body[plain.ends - 1] if len(length) else np.zeros(0, np.uint8)
    marks = np.zeros(256, bool)
    marks[list(_CLASSES["mark"])] = True
    i = len(_CLASSES)
    out[:, i] = (_shares(body, WHITE.astype(np.int64), plain.offsets) - 1) / size
    out[:, i + 1] = np.bincount(owner, length, n) / words / 20
    out[:, i + 2] = np.bincount(owner, length > 12, n) / words
    hashes = span_hashes(plain.data, plain.starts, plain.ends)
    out[:, i + 3] = _distinct(owner, hashes, n) / words
    out[:, i + 4] = 1 - _distinct(line_owner, span_hashes(lines.data, lines.starts, lines.ends), n) / line_count
    out[:, i + 5] = np.log2(1 + size / line_count) / 16
    out[:, i + 6] = np.bincount(owner, marks[last], n) / words
    out[:, i + 7] = np.bincount(owner[1:], (owner[1:] == owner[:-1]) & (hashes[1:] == hashes[:-1]), n) / words
    return np.clip(out, 0, 1)


def text_features(texts: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value), by text; ``lengths``: -1 where unknown."""
    raw = [t.encode() for t in texts]
    plain = Spans(raw, ~WHITE)
    numbers = statistics(raw, plain)
    words = Spans([t.lower().encode() for t in texts], ALNUM)
    owner = np.repeat(np.arange(len(texts)), words.counts)
    bucket = (span_hashes(words.data, words.starts, words.ends) % np.uint64(BUCKETS)).astype(np.int64)
    share = 1 / np.maximum(words.counts, 1)[owner]
    # Square-root bins, finer near zero.
    bins = np.minimum((np.sqrt(numbers) * BINS).astype(np.int64), BINS - 1) + BUCKETS + np.arange(len(STATISTICS)) * BINS
    size_bin = FIRST_LENGTH + np.where(lengths < 0, 33, np.minimum(np.log2(np.maximum(lengths, 0) + 1).astype(np.int64), 32))
    fixed = np.hstack([bins, size_bin[:, None]])
    who = np.concatenate([owner, np.repeat(np.arange(len(texts)), fixed.shape[1])])
    what = np.concatenate([bucket, fixed.ravel()])
    value = np.concatenate([share, np.full(fixed.size, 1 / np.sqrt(fixed.shape[1]))])
    order = np.argsort(who, kind="stable")
    return who[order], what[order], value[order]


@dataclass
class Machine:
    constant: float
    linear: np.ndarray
    factors: np.ndarray


def margins(machine: Machine, who: np.ndarray, what: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """The score before the logistic, in time linear in the number of features. Repeats of a feature are one feature with the sum of their values."""
    who, what, value = merged(who, what, value)
    return _margins(machine, who, what, value, n)[0]


def merged(who: np.ndarray, what: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pair = who * SIZE + what
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])[: len(pair)])
    total = np.add.reduceat(value[order], first) if len(first) else value[:0]
    return pair[first] // SIZE, pair[first] % SIZE, total


def _margins(machine: Machine, who: np.ndarray, what: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    begin = np.searchsorted(who, np.arange(n))  # every text has its statistics, so none is without features
    vx = machine.factors[what] * value[:, None]
    sums = np.add.reduceat(vx, begin, axis=0)
    squares = np.add.reduceat((vx * vx).sum(axis=1), begin)
    return machine.constant + np.add.reduceat(machine.linear[what] * value, begin) + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def fit(who: np.ndarray, what: np.ndarray, value: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Machine:
    """Adam steps over the whole sample; the start is drawn from a fixed seed."""
    draw = np.random.default_rng(7)
    n = len(y)
    share = float(np.average(y, weights=weight)) if n else 0.5
    machine = Machine(float(np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))), np.zeros(SIZE), draw.normal(0, 0.05, (SIZE, FACTORS)))
    if not n or y.min() == y.max():
        machine.factors[:] = 0
        return machine
    who, what, value = merged(who, what, value)
    used, at = np.unique(what, return_inverse=True)
    small = Machine(machine.constant, machine.linear[used], machine.factors[used])
    by = np.argsort(at, kind="stable")
    cut = np.searchsorted(at[by], np.arange(len(used)))
    moments = [[np.zeros(1), np.zeros(1)], [np.zeros(len(used)), np.zeros(len(used))], [np.zeros((len(used), FACTORS)), np.zeros((len(used), FACTORS))]]
    for step in range(1, STEPS + 1):
        margin, sums = _margins(small, who, at, value, n)
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / weight.sum()
        ex = error[who] * value
        slopes = [
            np.array([error.sum()]),
            np.add.reduceat(ex[by], cut) + RIDGE / n * small.linear,
            np.add.reduceat((ex[:, None] * (sums[who] - small.factors[at] * value[:, None]))[by], cut, axis=0) + RIDGE / n * small.factors,
        ]
        moves = []
        for (m, v), g in zip(moments, slopes, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            moves.append(RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9))
        small.constant -= float(moves[0][0])
        small.linear -= moves[1]
        small.factors -= moves[2]
    machine.constant = small.constant
    machine.linear[used] = small.linear
    machine.factors[:] = 0
    machine.factors[used] = small.factors
    return machine


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Machine:
    """``labels``: doc_id and a 0/1 column; ``docs``: doc_id, text and n_chars."""
    known = labels.where(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("y"))
    picked = bounded_sample(known, "y", sample)
    # At most about two times ``sample`` rows of a few bytes.
    rows = docs.select("doc_id", "text", F.col("n_chars").cast("long").alias("n")).join(F.broadcast(picked), "doc_id").select("text", "n", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out = text_column(batch), []
            lengths = batch.column(1).fill_null(-1).to_numpy()
            for part in slices(texts):
                who, what, value = merged(*text_features(texts[part], lengths[part]))
                cut = np.searchsorted(who, np.arange(part.stop - part.start + 1))
                out += [(what[a:b].astype(np.int32).tobytes(), value[a:b].astype(np.float32).tobytes()) for a, b in zip(cut, cut[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.binary())], ["y", "what", "value"])

    # Sorted, for the rows arrive in any order and sums must not depend on it.
    got = rows.mapInArrow(run, "y int, what binary, value binary").toPandas().sort_values(["y", "what", "value"], ignore_index=True)
    whats = [np.frombuffer(b, np.int32) for b in got.what]
    who = np.repeat(np.arange(len(got)), [len(w) for w in whats])
    what = np.concatenate([*whats, np.zeros(0, np.int32)]).astype(np.int64)
    value = np.concatenate([*[np.frombuffer(b, np.float32) for b in got.value], np.zeros(0, np.float32)]).astype(float)
    y = got.y.to_numpy(float)
    share = known.agg(F.avg("y")).first()[0]
    mine = y.mean() if len(y) else 0.5
    weight = np.where(y > 0, share / mine, (1 - share) / (1 - mine)) if len(y) and 0 < mine < 1 else np.ones(len(y))
    return fit(who, what, value, y, weight)


def score(docs: DataFrame, machine: Machine, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``score``, from text and stated length."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    kept = [f"fm_keep_{c}" for c in keep]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], F.col("text").alias("fm_text"), F.col("n_chars").cast("long").alias("fm_n"))
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema[: len(keep)]) if keep else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            texts = text_column(batch, "fm_text")
            lengths = batch.column(len(kept) + 1).fill_null(-1).to_numpy()
            out = np.zeros(len(texts))
            for part in slices(texts):
                margin = margins(machine, *text_features(texts[part], lengths[part]), part.stop - part.start)
                out[part] = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(out)], [*kept, "score"])

    out = rows.mapInArrow(run, f"{types}score double")
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], "score")
