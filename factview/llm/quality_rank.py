"""Quality scores by Bradley-Terry ranking.

A document's worth is a weighted sum of features of its text. The weights are
learned from all preference pairs (a document labelled good before one labelled
bad) by the logistic loss of the difference of their worths. Documents are
then parted at the quantile of scores that equals the share of bad labels.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factview.llm.common import forget, packed, stored, text_of, unpacked

#: Bins of worth: rows of a bin count by the mean worth of them, in each class.
BINS = 1024
#: Deviations of worth that the bins reach to.
WIDEST = 8
#: Groups of bins that have matrices of second moments, for the curvature only.
CURVES = 16
#: Bins of a pass that looks for the parting quantile; two passes.
QUANTILE_BINS = 1 << 16
#: Newton steps at most, the gain at which they end, and the weight of the squared weights beside the mean loss of a pair.
STEPS = 40
LEAST_GAIN = 1e-6
RIDGE = 1e-3
#: Sums are of whole numbers, so that their order changes nothing: ones of features, of standard features and of their products.
ONE, STANDARD_ONE, PRODUCT_ONE = 1 << 30, 1 << 20, 1 << 10
#: Rows that are summed at once, and sums that reach the driver at most.
ROWS_AT_ONCE = 20_000
SUMS = 16
#: The score at the parting quantile.
PARTING = 0.7
#: Documents whose remainder modulo FOLDS is HELD_OUT are never learned from.
FOLDS, HELD_OUT = 4, 2
#: Sums a tally, which makes whole numbers of rows of features and whether they are good, over all rows: (their number, tally).
Summed = Callable[[int, Callable[[np.ndarray, np.ndarray], np.ndarray]], np.ndarray]

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_POINTS = b".,;:!?"


def features(text: str) -> list[float]:
    """Properties of a text, each between about 0 and 1; an empty text has zeros."""
    data = text.encode("utf-8", "surrogatepass")
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    n, m = len(data) or 1, len(words) or 1
    share = lambda some: (len(data) - len(data.translate(None, some))) / n
    threes = max(1, m - 2)
    return [
        min(1.0, math.log1p(len(words)) / 10),
        share(_SYMBOLS),
        share(_UPPER),
        share(_DIGITS),
        share(_POINTS),
        share(b"!"),
        share(b" \t\n\r\x0b\x0c"),
        sum(map(eq, words, words[1:])) / m,
        1 - len(set(zip(words, words[1:], words[2:], strict=False))) / threes if len(words) > 2 else 0.0,
        1 - len(set(lines)) / (len(lines) or 1) if lines else 0.0,
        sum(len(w) == 1 for w in words) / m,
        min(1.0, len(data) / m / 20) if words else 0.0,
        min(1.0, len(lines) / m * 5),
    ]


def expanded(rows: np.ndarray) -> np.ndarray:
    """The features and their roots, so that small shares tell more."""
    return np.hstack([rows, np.sqrt(rows)])


@dataclass(frozen=True)
class Ranking:
    weights: np.ndarray
    middle: np.ndarray
    spread: np.ndarray
    parting: float
    scale: float

    def standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((expanded(rows) - self.middle) / self.spread, -8, 8)

    def worth(self, rows: np.ndarray) -> np.ndarray:
        return self.standard(rows) @ self.weights

    def most(self) -> float:
        """What no worth exceeds in either direction."""
        return 8 * float(np.abs(self.weights).sum()) or 1.0

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; PARTING at the parting quantile."""
        at = (self.worth(rows) - self.parting) * self.scale + math.log(PARTING / (1 - PARTING))
        return 1 / (1 + np.exp(-np.clip(at, -30, 30)))


def _standards(summed: Summed) -> tuple[Ranking, int, int]:
    """An indifferent ranking with the mean and spread of all rows, and how many rows are bad and good."""
    d = 2 * len(features(""))

    def tally(rows: np.ndarray, good: np.ndarray) -> np.ndarray:
        x = expanded(rows)
        return np.concatenate([[(~good).sum(), good.sum()], np.rint(x * ONE).sum(axis=0), np.rint(x * x * ONE).sum(axis=0)]).astype(np.int64)

    held = summed(2 + 2 * d, tally)
    n = int(held[:2].sum())
    middle, squares = (held[2:].reshape(2, d) / ONE / max(1, n)).copy()
    spread = np.maximum(np.sqrt(np.maximum(squares - middle**2, 0)), 1e-3) if n else np.ones(d)
    return Ranking(np.zeros(d), middle, spread, 0.0, 1.0), int(held[0]), int(held[1])


def _binned(at: Ranking, most: float, summed: Summed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By class and bin of worth, those beyond ``most`` in the outermost: rows and sums of their standard features; by class and group of bins: second moments."""
    d = len(at.weights)
    cuts = np.cumsum([2 * BINS, 2 * BINS * d, 2 * CURVES * d * d])

    def tally(rows: np.ndarray, good: np.ndarray) -> np.ndarray:
        z = at.standard(rows)
        bins = np.clip(((z @ at.weights / most + 1) / 2 * BINS).astype(np.int64), 0, BINS - 1)
        place = good * BINS + bins
        whole = np.rint(z * STANDARD_ONE)
        sums = np.stack([np.bincount(place, whole[:, k], 2 * BINS) for k in range(d)], axis=1)
        rough, curves = np.rint(z * PRODUCT_ONE), good * CURVES + bins * CURVES // BINS
        second = np.zeros((2 * CURVES, d, d))
        for k in np.unique(curves):
            some = rough[curves == k]
            second[k] = some.T @ some
        return np.concatenate([np.bincount(place, minlength=2 * BINS), sums.ravel(), second.ravel()]).astype(np.int64)

    n, sums, second = np.split(summed(int(cuts[-1]), tally), cuts[:-1])
    return n.reshape(2, BINS), sums.reshape(2, BINS, d) / STANDARD_ONE, second.reshape(2, CURVES, d, d) / PRODUCT_ONE**2


def _all_pairs(weights: np.ndarray, n: np.ndarray, sums: np.ndarray, second: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The mean loss of all pairs of a good and a bad row, its gradient and its curvature."""
    bad, good = (np.flatnonzero(n[k]) for k in (0, 1))
    mean_bad, mean_good = (sums[k][at] / n[k][at, None] for k, at in ((0, bad), (1, good)))
    gap = np.clip((mean_good @ weights)[:, None] - (mean_bad @ weights)[None, :], -500, 500)
    share = (n[1][good] / n[1].sum())[:, None] * (n[0][bad] / n[0].sum())[None, :]
    doubt = 1 / (1 + np.exp(gap))
    loss = float((share * np.logaddexp(0, -gap)).sum() + RIDGE / 2 * weights @ weights)
    pull = share * doubt
    gradient = pull.sum(axis=0) @ mean_bad - pull.sum(axis=1) @ mean_good + RIDGE * weights
    bend = pull * (1 - doubt)
    cross = mean_good.T @ bend @ mean_bad
    curvature = RIDGE * np.eye(len(weights)) - cross - cross.T
    for k, at, of in ((0, bad, bend.sum(axis=0)), (1, good, bend.sum(axis=1))):
        group = at * CURVES // BINS
        rows = np.bincount(group, n[k][at], CURVES)
        curvature += np.tensordot(np.bincount(group, of, CURVES) / np.maximum(rows, 1), second[k], 1)
    return loss, gradient, curvature


def _parted(ranking: Ranking, n_bad: int, n: int, summed: Summed) -> Ranking:
    """The ranking with the quantile of worth at the share of bad labels, in the middle of the gap it falls in, and the scale of scores."""
    places, spread = (n_bad, min(n_bad + 1, n)), 0.0
    found = [(-ranking.most(), ranking.most(), 0)] * 2
    for turn in range(2):

        def tally(rows: np.ndarray, good: np.ndarray, found: list = found) -> np.ndarray:
            worth = ranking.worth(rows)
            out = [[np.rint(worth * STANDARD_ONE).sum(), np.rint(worth**2 * STANDARD_ONE).sum()]]
            for low, high, _ in found:
                at = np.floor((worth - low) / (high - low) * QUANTILE_BINS)
                at = np.minimum(at[(at >= 0) & (at <= QUANTILE_BINS)], QUANTILE_BINS - 1).astype(np.int64)
                out.append(np.bincount(at, minlength=QUANTILE_BINS))
            return np.concatenate(out).astype(np.int64)

        held = summed(2 + 2 * QUANTILE_BINS, tally)
        if not turn:
            mean, square = held[:2] / STANDARD_ONE / n
            spread = math.sqrt(max(0.0, square - mean**2))
        narrower = []
        for place, (low, high, before), counts in zip(places, found, held[2:].reshape(2, -1), strict=True):
            upto = before + np.cumsum(counts)
            k = min(int(np.searchsorted(upto, place)), QUANTILE_BINS - 1)
            width = (high - low) / QUANTILE_BINS
            narrower.append((low + k * width, low + (k + 1) * width, int(upto[k] - counts[k])))
        found = narrower
    return Ranking(ranking.weights, ranking.middle, ranking.spread, float((found[0][1] + found[1][0]) / 2), float(2 / max(1e-6, spread)))


def learned(summed: Summed, steps: int = STEPS) -> Ranking:
    """A ranking from sums over all labelled rows; one that is indifferent where a class is missing.

    The loss is that of all pairs, by the numbers and mean worths of both
    classes in bins of worth; Newton steps, halved where they overshoot.
    """
    best, n_bad, n_good = _standards(summed)
    if not n_bad or not n_good:
        return best
    at = lambda weights: Ranking(weights, best.middle, best.spread, 0.0, 1.0)
    here, least, step = best.weights, math.inf, np.zeros_like(best.weights)
    moments = None
    for _ in range(steps):
        new = at(here + step)
        most = new.most() if moments is None else min(new.most(), WIDEST * math.sqrt(new.weights @ moments @ new.weights)) or 1.0
        held = _binned(new, most, summed)
        moments = held[2].sum(axis=(0, 1)) / (n_bad + n_good) if moments is None else moments
        loss, gradient, curvature = _all_pairs(new.weights, *held)
        if loss > least + LEAST_GAIN:
            step = step / 2
            continue
        here, gain, least = new.weights, least - loss, loss
        if gain < LEAST_GAIN:
            break
        values, axes = np.linalg.eigh(curvature)
        step = -axes @ ((axes.T @ gradient) / np.maximum(values, RIDGE))
    return _parted(at(here), n_bad, n_bad + n_good, summed)


def fit(rows: np.ndarray, good: np.ndarray, steps: int = STEPS) -> Ranking:
    """A ranking from features and labels."""
    rows = np.asarray(rows, dtype=float).reshape(len(rows), -1) if len(rows) else np.zeros((0, len(features(""))))
    return learned(lambda size, tally: tally(rows, good), steps)


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def features_of(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t) for t in texts], dtype=object)

    return run(text)


def _summed(rows: DataFrame) -> Summed:
    """Sums over rows (good, x), made on the executors in two steps."""

    def over(size: int, tally: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, held = np.zeros(size, dtype=np.int64), []

            def add() -> None:
                nonlocal total
                some = pa.Table.from_batches(held).combine_chunks()
                held.clear()
                x = some["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(some), -1)
                total += tally(x, some["good"].to_numpy())

            for batch in batches:
                if batch.num_rows:
                    held.append(batch)
                if sum(b.num_rows for b in held) >= ROWS_AT_ONCE:
                    add()
            if held:
                add()
            if total.any():
                yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId() % SUMS], pa.int32()), "total": pa.array([total.tobytes()], pa.binary())})

        def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, dtype=np.int64)
            for batch in batches:
                for one in batch.column("total"):
                    total += np.frombuffer(one.as_py(), dtype=np.int64)
            if total.any():
                yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary())})

        sums = rows.mapInArrow(run, "part int, total binary").repartition(SUMS, "part").mapInArrow(both, "total binary").collect()
        return sum((np.frombuffer(r["total"], dtype=np.int64) for r in sums), np.zeros(size, dtype=np.int64))

    return over


def train(docs: DataFrame, labels: DataFrame) -> Ranking:
    """A ranking from all labels outside the held-out fold; ``quality`` 1 is good, 0 bad, all else is left out.

    The largest label of a doc_id counts; each row of ``docs`` that has it
    counts as a document.
    """
    learns = F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT)
    known = labels.where(F.col("quality").isin(0, 1) & learns).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = docs.where(learns).select("doc_id", features_of(text_of()).alias("x")).join(known, "doc_id")
    rows = stored(rows.select((F.col("quality") == 1).alias("good"), "x"))
    ranking = learned(_summed(rows))
    forget(rows)
    return ranking


def scored(docs: DataFrame, ranking: Ranking) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``held_out``, row by row; equally named columns are replaced.

    A null text is scored as the empty text; a null doc_id is in fold 0.
    """

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(ranking.score(np.array([features(t) for t in texts]).reshape(len(texts), -1)) if len(texts) else [], dtype="float64")

    out = packed(docs, "doc_id", "text").withColumn("score", run(text_of()))
    out = out.withColumns({"predicted": (F.col("score") >= PARTING).cast("int"), "held_out": fold(F.col("doc_id")) == HELD_OUT})
    return unpacked(out, docs.columns, ("doc_id", "text"), ("score", "predicted", "held_out"))
