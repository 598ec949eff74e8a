"""Toxicity by a classifier chain.

The categories stand in an order. The first has a linear model over words and word beginnings of a text; each later one sees these and the
probabilities of all categories before it. A later model is trained with probabilities that came from models which had not seen the row (out of
fold), and applied to those of the models fitted on the whole sample.

Features are which of the chosen words and beginnings of words (four, five and six bytes, so that inflected words count as one) a text has;
``FEATURES`` for each category are chosen by how clearly they tell the sample's classes apart. Learning takes a sample of at most about ``SAMPLE``
labelled documents of each class of the last category, picked by hash, whole texts; the models are a few thousand numbers. Features are counted by class
in Spark; the driver gets the counts of those in ``FEW`` rows or more, and then of each row only the chosen ones.

Cases: null and empty texts have no feature and get the base rates; null labels are left out of the sample; a category without rows of both
classes gets its share everywhere; repeated rows and null ids are scored each; an empty table gives an empty result; the columns to keep are
named by the caller.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gondola.llm.common import ALNUM, LOW_BYTES, Spans, bounded_sample, mixed, slices, span_hashes, stage, text_column

SAMPLE = 3000
FEATURES = 400
FOLDS = 3
#: Rows of the sample that a feature must be in.
FEW = 3
BEGINNINGS = (4, 5, 6)
BLOCK = 512


def word_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, 32-bit feature) of all words and their beginnings, lower-cased; repeats stay."""
    words = Spans([t.lower().encode() for t in texts], ALNUM)
    owner = np.repeat(np.arange(len(texts)), words.counts)
    lanes = np.ndarray((len(words.data) - 7,), "<u8", words.data, strides=(1,))[words.starts]
    length = words.ends - words.starts
    owners, features = [owner], [span_hashes(words.data, words.starts, words.ends)]
    for n in BEGINNINGS:
        some = length > n
        owners.append(owner[some])
        features.append(mixed((lanes[some] & LOW_BYTES[n]) ^ np.uint64(n << 56)))
    return np.concatenate(owners), (np.concatenate(features) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Chain:
    """``features`` sorted; ``weights[c]``: those of the features, then of the probabilities before category c, then the constant."""

    categories: list[str]
    features: np.ndarray
    weights: list[np.ndarray]


def presence(features: np.ndarray, texts: list[str]) -> np.ndarray:
    """Which of the sorted ``features`` each text has."""
    out = np.zeros((len(texts), len(features)), np.float32)
    if not len(features):
        return out
    maybe = np.zeros(1 << 16, bool)
    maybe[features & np.uint32(0xFFFF)] = True
    owner, found = word_features(texts)
    some = np.flatnonzero(maybe[found & np.uint32(0xFFFF)])
    owner, found = owner[some], found[some]
    at = np.minimum(np.searchsorted(features, found), len(features) - 1)
    hit = features[at] == found
    out[owner[hit], at[hit]] = 1
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Logistic regression by Newton steps, over blocks of rows; the last weight is the constant."""
    w = np.zeros(x.shape[1] + 1)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    w[-1] = np.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        return w
    penalty = np.full(len(w), ridge)
    penalty[-1] = 0
    for _ in range(steps):
        slope, curve = penalty * w, np.diag(penalty + 1e-9)
        for i in range(0, len(y), BLOCK):
            block = np.ones((len(y[i : i + BLOCK]), len(w)))
            block[:, :-1] = x[i : i + BLOCK]
            p = 1 / (1 + np.exp(-np.clip(block @ w, -30, 30)))
            slope += block.T @ (p - y[i : i + BLOCK])
            curve += (block * (p * (1 - p))[:, None]).T @ block
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def choose(ones: np.ndarray, counts: np.ndarray, y: np.ndarray, wanted: int) -> np.ndarray:
    """The features whose presence tells the classes apart most clearly (a two-proportion score), by their number; ``ones``: rows of class 1 with it."""
    n1, n = max(y.sum(), 1), max(len(y), 1)
    p1, p0, p = ones / n1, (counts - ones) / max(n - n1, 1), counts / n
    score = np.abs(p1 - p0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / max(n - n1, 1)) + 1e-12)
    return np.argsort(-score, kind="stable")[:wanted]


def fit_chain(categories: list[str], owner: np.ndarray, feature: np.ndarray, labels: np.ndarray, fold: np.ndarray, priors: np.ndarray) -> Chain:
    """``owner``/``feature``: each feature of each row once; ``labels``: a column for each category; ``priors``: shares among all labelled rows."""
    names, at, counts = np.unique(feature, return_inverse=True, return_counts=True)
    often = np.flatnonzero(counts >= FEW)
    ones = [np.bincount(at, labels[owner, c], len(names))[often] for c in range(len(categories))]
    chosen = names[often][chosen_of(ones, counts[often], labels)]
    x = np.zeros((len(labels), len(chosen)), np.float32)
    if len(chosen):
        place = np.minimum(np.searchsorted(chosen, feature), len(chosen) - 1)
        hit = chosen[place] == feature
        x[owner[hit], place[hit]] = 1
    return fit_links(categories, chosen, x, labels, fold, priors)


def chosen_of(ones: list[np.ndarray], counts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The numbers, sorted, of the features chosen for any category."""
    return np.unique(np.concatenate([choose(o, counts, labels[:, c], FEATURES) for c, o in enumerate(ones)]))


def fit_links(categories: list[str], chosen: np.ndarray, x: np.ndarray, labels: np.ndarray, fold: np.ndarray, priors: np.ndarray) -> Chain:
    """``x``: which of the chosen features each row has."""
    weights = []
    for c in range(len(categories)):
        y = labels[:, c]
        w = fit(x, y)
        unseen = np.zeros(len(y))
        for k in range(FOLDS):
            unseen[fold == k] = probability(x[fold == k], fit(x[fold != k], y[fold != k]))
        # The sample holds as many rows of each class; the constant goes back to the shares among all labelled rows.
        if len(y) and 0 < y.mean() < 1 and 0 < priors[c] < 1:
            shift = np.log(priors[c] / (1 - priors[c])) - np.log(y.mean() / (1 - y.mean()))
            w[-1] += shift
            odds = np.exp(shift) * unseen / np.maximum(1 - unseen, 1e-12)
            unseen = odds / (1 + odds)
        weights.append(w)
        x = np.hstack([x, unseen[:, None].astype(np.float32)])
    return Chain(categories, chosen, weights)


def train(docs: DataFrame, labels: DataFrame, categories: list[str], sample: int = SAMPLE, prior: float | None = None) -> Chain:
    """``labels``: doc_id and a 0/1 column for each category; the last one is what the sample is balanced by, ``prior`` its share among all rows."""
    spark, last = docs.sparkSession, categories[-1]
    known = labels.where(F.col(last).isNotNull()).select("doc_id", *categories)
    picked = bounded_sample(known, last, sample)
    # At most about two times ``sample`` rows of a few bytes.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", *categories, F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = text_column(batch), []
            for part in slices(texts):
                owner, feature = word_features(texts[part])
                order = np.lexsort((feature, owner))
                owner, feature = owner[order], feature[order]
                fresh = np.concatenate([[True], (np.diff(owner) != 0) | (feature[1:] != feature[:-1])])[: len(owner)]
                owner, feature = owner[fresh], feature[fresh]
                cut = np.searchsorted(owner, np.arange(part.stop - part.start + 1))
                found += [feature[a:b].astype(np.int64) for a, b in zip(cut, cut[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, pa.list_(pa.int64()))], [*batch.schema.names[1:], "features"])

    types = ", ".join(f"`{c}` int" for c in categories)
    rows = rows.select("text", *[F.col(c).cast("int").alias(c) for c in categories], "fold")
    found = stage(rows.mapInArrow(run, f"{types}, fold int, features array<long>"), "chain-features")
    each = found.select(*categories, F.explode("features").alias("feature"))
    ones = [F.sum(F.when(F.col(c) > 0, 1).otherwise(0)).alias(f"ones_{i}") for i, c in enumerate(categories)]
    counts = each.groupBy("feature").agg(F.count("*").alias("n"), *ones).where(F.col("n") >= FEW).toArrow().sort_by("feature")
    # Sorted, for the rows arrive in any order and sums must not depend on it.
    labels_ = found.select(*categories).toArrow()
    table = np.stack([labels_.column(c).to_numpy() for c in categories], axis=1).astype(np.float64)
    ones = [counts.column(f"ones_{i}").to_numpy() for i in range(len(categories))]
    names = counts.column("feature").to_numpy()
    chosen = names[chosen_of(ones, counts.column("n").to_numpy(), table)].astype(np.int64)
    del counts, labels_, ones, names
    wanted = spark.sparkContext.broadcast(chosen)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [np.flatnonzero(np.isin(wanted.value, x.values.to_numpy())).astype(np.uint32).tobytes() for x in batch.column(len(categories) + 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(kept, pa.binary())], batch.schema.names)

    got = found.mapInArrow(pick, f"{types}, fold int, features binary").toArrow()
    got = got.sort_by([(c, "ascending") for c in [*categories, "fold", "features"]])
    if prior is None:
        prior = known.agg(F.avg(F.col(last).cast("double"))).first()[0] or 0.0
    x = np.zeros((got.num_rows, len(chosen)), np.float32)
    for i, b in enumerate(got.column("features").to_pylist()):
        x[i, np.frombuffer(b, np.uint32)] = 1
    table = np.stack([got.column(c).to_numpy() for c in categories], axis=1).astype(np.float64)
    fold = got.column("fold").to_numpy()
    del got
    mine = table[:, -1].mean() if len(table) else 0.0
    weight = np.where(table[:, -1] > 0, prior / mine, (1 - prior) / (1 - mine)) if 0 < mine < 1 else np.ones(len(table))
    priors = weight @ table / weight.sum() if len(table) else np.zeros(len(categories))
    return fit_links(categories, chosen.astype(np.uint32), x, table, fold, priors)


def predict(docs: DataFrame, chain: Chain, keep: list[str], names: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` with a double for each category, its probability, under the category's name or ``names``."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    kept = [f"chain_keep_{c}" for c in keep]
    results = [f"chain_{i}" for i in range(len(chain.categories))]
    rows = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], F.col("text").alias("chain_text"))
    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "chain_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch in batches:
            texts = text_column(batch, "chain_text")
            out = np.zeros((len(texts), len(chain.categories)))
            for part in slices(texts):
                x = presence(chain.features, texts[part])
                for c, w in enumerate(chain.weights):
                    p = probability(x, w)
                    out[part, c] = p
                    x = np.hstack([x, p[:, None]])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(p) for p in out.T]], [*kept, *results])

    out = rows.mapInArrow(run, types + ", ".join(f"{c} double" for c in results))
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], *[F.col(r).alias(n) for r, n in zip(results, names or chain.categories, strict=True)])
