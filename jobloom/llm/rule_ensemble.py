"""Quality classifier as a sparse rule ensemble (operator 8).

Statistics of each text are taken in one pass over its bytes and words. Shallow
boosted trees are grown on a bounded sample of labelled rows; every path from a root to
a node is a rule, a conjunction of bounds on statistics. A logistic regression with an
absolute penalty weighs the rules, most of them with 0. The rules that stay are compiled into one Spark
expression over the statistics, so scoring is a scan.

Only the sample (`sample` rows at most, the training rows with the smallest hash of
their id, each a handful of numbers) comes to the driver.

Defined cases: a null or empty text has all statistics 0 and is scored like any other;
labels other than 0 and 1 and null ids are not learnt from; of several labels of one id the largest
counts; without labelled rows of both kinds every score is the smoothed share of label 1; repeated rows are
scored each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from jobloom.llm.textkit import Words, slices

SAMPLE = 10_000
TREES, DEPTH, LEAST_LEAF, BINS, RATE = 24, 3, 20, 24, 0.3
PENALTY, ROUNDS = 0.002, 400


def _mask(members) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_BYTES = {
    "capitals": _mask(range(65, 91)),
    "digits": _mask(range(48, 58)),
    "symbols": _mask(b"#*$%&<>=_/\\{}[]@~^+"),
    "bars": _mask(b"|"),
    "stops": _mask(b".,;:"),
    "calls": _mask(b"!?"),
    "lines": _mask(b"\n"),
}
STATISTICS = ("words", "word_length", "long_words", "echoes", "variety", *_BYTES)


def _statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    words = Words(texts)
    n, bounds = words.counts(), words.bounds
    sizes = words.end - words.begin
    total = lambda flags, at: np.diff(np.append(0, np.cumsum(flags))[at])
    chars, some = np.maximum(total(sizes, bounds), 1), np.maximum(n, 1)
    hashes, owner = words.hashes(lower=True), np.repeat(np.arange(len(n)), n)
    echo = np.zeros(len(hashes), bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    out = {
        "words": np.log1p(n), "word_length": chars / some * (n > 0), "long_words": total(sizes > 20, bounds) / some,
        "echoes": total(echo, bounds) / some,
        # Heaps' law: a text of n words is expected to hold about n ** 0.9 different ones.
        "variety": total(new, bounds) / some**0.9,
    }
    return out | {name: total(mask[words.data], words.offsets) / chars for name, mask in _BYTES.items()}


def text_statistics(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and the statistics, one row per document."""
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = _statistics(part["text"])
                yield pa.RecordBatch.from_arrays([part["doc_id"], *[pa.array(found[s].astype(float)) for s in STATISTICS]], names=["doc_id", *STATISTICS])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{name} double" for name in STATISTICS))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, whether above, bound): all must hold


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    base: float

    def score(self) -> Column:
        """The probability of label 1 as an expression over the statistics' columns."""
        def holds(rule: Rule) -> Column:
            return reduce(and_, [(F.col(STATISTICS[s]) > bound) if above else (F.col(STATISTICS[s]) <= bound) for s, above, bound in rule])

        margin = F.lit(self.base)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            margin = margin + F.when(holds(rule), F.lit(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-margin))


def _held(rule: Rule, x: np.ndarray) -> np.ndarray:
    return reduce(and_, [(x[:, s] > bound) == above for s, above, bound in rule])


def _grow(x, binned, bounds, slope, curve, rows, path, paths, update) -> None:
    """One node: store its path, split it where the gain in log likelihood is best."""
    if path:
        paths.append(tuple(path))
    total, weight = slope[rows].sum(), curve[rows].sum()
    best = (1e-6, 0, 0)
    if len(path) < DEPTH and len(rows) >= 2 * LEAST_LEAF:
        for s in range(x.shape[1]):
            place = binned[rows, s]
            size = len(bounds[s]) + 1
            left, mass, count = (np.cumsum(np.bincount(place, w, size))[:-1] for w in (slope[rows], curve[rows], None))
            if not len(left):
                continue
            gain = left**2 / (mass + 1) + (total - left) ** 2 / (weight - mass + 1) - total**2 / (weight + 1)
            gain[(count < LEAST_LEAF) | (len(rows) - count < LEAST_LEAF)] = 0
            at = int(gain.argmax())
            best = max(best, (float(gain[at]), s, at))
    if best[0] <= 1e-6:
        update[rows] = RATE * total / (weight + 1)
        return
    _, s, at = best
    low = binned[rows, s] <= at
    for above, side in ((False, rows[low]), (True, rows[~low])):
        _grow(x, binned, bounds, slope, curve, side, [*path, (s, above, float(bounds[s][at]))], paths, update)


def fit(x: np.ndarray, y: np.ndarray, seed: int = 0) -> Ensemble:
    """Rules and weights from statistics and 0/1 labels."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Ensemble((), (), base)
    random = np.random.default_rng(seed)
    bounds = [np.unique(np.quantile(column, np.arange(1, BINS) / BINS)) for column in x.T]
    # Rare statistics are 0 for most rows: their bounds also come from the rows that have any.
    bounds = [np.unique(np.append(b, np.quantile(c[c > 0], np.arange(0, BINS) / BINS))) if (c > 0).any() else b for b, c in zip(bounds, x.T, strict=True)]
    binned = np.stack([np.searchsorted(b, c, "left") for b, c in zip(bounds, x.T, strict=True)], 1)
    margin, paths = np.full(len(y), base), []
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(random.random(len(y)) < 0.7)
        found: list[Rule] = []
        _grow(x, binned, bounds, y - chance, chance * (1 - chance), rows, [], found, np.zeros(len(y)))
        # The tree's value for all rows, also those it was not grown on.
        update = np.zeros(len(y))
        leaves = [r for r in found if not any(len(o) > len(r) and o[: len(r)] == r for o in found)]
        for rule in leaves:
            held = _held(rule, x)
            update[held] = RATE * (y - chance)[held].sum() / ((chance * (1 - chance))[held].sum() + 1)
        margin += update
        paths += found
    rules = sorted(set(paths))
    if not rules:
        return Ensemble((), (), base)
    columns = np.stack([_held(rule, x) for rule in rules], 1).astype(float)
    scale = np.sqrt(np.maximum(columns.mean(0) * (1 - columns.mean(0)), 1e-4))
    columns /= scale
    # Proximal gradient steps with momentum; the base is not penalised.
    rate = 4.0 * len(y) / (np.linalg.norm(columns, 2) ** 2 + len(y))
    weights, ahead, shift, shift_ahead, t = np.zeros(len(rules)), np.zeros(len(rules)), base, base, 1.0
    for _ in range(ROUNDS):
        error = 1 / (1 + np.exp(-(columns @ ahead + shift_ahead))) - y
        moved = ahead - rate * (columns.T @ error) / len(y)
        new = np.sign(moved) * np.maximum(np.abs(moved) - rate * PENALTY, 0)
        new_shift = shift_ahead - rate * error.mean()
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, shift_ahead = new + (t - 1) / later * (new - weights), new_shift + (t - 1) / later * (new_shift - shift)
        weights, shift, t = new, new_shift, later
    kept = np.flatnonzero(weights)
    return Ensemble(tuple(rules[i] for i in kept), tuple(float(weights[i] / scale[i]) for i in kept), float(shift))


def training_sample(docs: DataFrame, labels: DataFrame, trained: Column, label: str = "quality", key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most `sample` rows; `trained` speaks of doc_id."""
    known = (
        labels.select(F.col(key).alias("doc_id"), F.col(label).alias("label"))
        .where(trained & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    chosen = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")
    # Rows that repeat an id are chosen by their content, so that reruns learn from the same ones.
    rows = text_statistics(chosen).join(F.broadcast(known), "doc_id").orderBy("doc_id", F.xxhash64(*STATISTICS)).limit(sample).collect()
    x = np.array([[row[name] for name in STATISTICS] for row in rows], float).reshape(len(rows), len(STATISTICS))
    return x, np.array([row["label"] for row in rows], float)


def classify(docs: DataFrame, labels: DataFrame, trained: Column, **options) -> DataFrame:
    """doc_id, the statistics, score and predicted for every document."""
    columns = {name: options[name] for name in ("key", "text") if name in options}
    ensemble = fit(*training_sample(docs, labels, trained, **options))
    scored = text_statistics(docs, **columns).withColumn("score", ensemble.score())
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
