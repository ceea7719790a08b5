"""K-Means for several numbers of clusters and several starts at once.

All runs share every pass over the data: a round of Lloyd's algorithm is one aggregation that
sums, for each run and cluster still moving, the rows nearest to its centre. Starting points are
drawn by k-means++ for all runs together, one pass per centre: each row draws a key from a hash
of itself, scaled by its squared distance to the centres so far, and the smallest key is taken,
which chooses rows in proportion to that distance whatever their order. What reaches the driver
are the centres. Distances of a batch of rows to all centres are one matrix product in numpy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import materialise

# Sums of fractions differ in the last digits between rounds; a centre that moves less stands still.
STILL = 1e-11
SUMS = "run int, cluster int, n bigint, cost double, squares double, sums array<double>"
DRAWN = "run int, key double, point array<double>"


@dataclass(frozen=True)
class Fit:
    """Centres of one run, its cost (sum of squared distances) and rounds."""

    centers: np.ndarray
    cost: float
    rounds: int


def points(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as a stored table of one array per row, with a hash of the whole row."""
    row = F.array(*[F.col(c).cast("double") for c in columns])
    return materialise(df.select(row.alias("x"), F.xxhash64(*df.columns).alias("h")), "points")


def _rows(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(-1, size)


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances; a matrix product of the differences' parts, never below zero."""
    far = (x * x).sum(1)[:, None] - 2 * x @ centers.T + (centers * centers).sum(1)
    return np.maximum(far, 0)


def _sums(runs: dict[int, np.ndarray], size: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {r: np.zeros((len(c), size + 3)) for r, c in runs.items()}
        for batch in batches:
            x = _rows(batch.column(0), size)
            squares = (x * x).sum(1)
            for r, centers in runs.items():
                near = _distances(x, centers).argmin(1)
                cost = ((x - centers[near]) ** 2).sum(1)
                for i, v in enumerate((None, cost, squares, *x.T)):
                    totals[r][:, i] += np.bincount(near, v, len(centers))
        out = [(r, k, int(t[0]), t[1], t[2], t[3:].tolist()) for r, own in totals.items() for k, t in enumerate(own)]
        names = ["run", "cluster", "n", "cost", "squares", "sums"]
        kinds = pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return work


def _pass(stored: DataFrame, runs: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per run one row per cluster: rows, cost, sum of squared norms, sums of the coordinates."""
    size = next(iter(runs.values())).shape[1]
    parts = stored.select("x").mapInArrow(_sums(runs, size), SUMS)
    added = parts.groupBy("run", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.sum("squares").alias("squares"),
        *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)],
    )
    totals = {r: np.zeros((len(c), size + 3)) for r, c in runs.items()}
    for r in added.collect():
        totals[r["run"]][r["cluster"]] = list(r)[2:]
    return totals


def lloyd(
    stored: DataFrame, starts: Sequence[np.ndarray], max_iter: int = 300, tol: float = 1e-4
) -> list[Fit]:
    """Lloyd steps from each of the starts until no centre of a run moves by more than ``tol``.

    A cluster without rows keeps its centre.
    """
    centers = {r: np.array(s, float) for r, s in enumerate(starts)}
    rounds = dict.fromkeys(centers, 0)
    moving = dict(centers)
    while moving:
        for r, t in _pass(stored, moving).items():
            filled = t[:, :1] > 0
            new = np.where(filled, t[:, 3:] / np.maximum(t[:, :1], 1), centers[r])
            shift = np.sqrt(((new - centers[r]) ** 2).sum(1)).max()
            centers[r], rounds[r] = new, rounds[r] + 1
            if shift <= max(tol, STILL) or rounds[r] >= max_iter:
                del moving[r]
            else:
                moving[r] = new
    last = _pass(stored, centers)
    return [Fit(centers[r], float(last[r][:, 1].sum()), rounds[r]) for r in sorted(centers)]


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) per row and salt."""
    z = h + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def _draw(runs: dict[int, tuple[int, np.ndarray]], size: int, place: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[float, list[float]]] = {}
        for batch in batches:
            x = _rows(batch.column(0), size)
            if not len(x):
                continue
            h = batch.column(1).to_numpy().view(np.uint64)
            for r, (seed, chosen) in runs.items():
                weight = _distances(x, chosen).min(1) if len(chosen) else np.ones(len(x))
                with np.errstate(divide="ignore"):
                    key = np.where(weight > 1e-12, -np.log(_mixed(h, seed * 1009 + place)) / weight, np.inf)
                i = int(key.argmin())
                if key[i] < best.get(r, (np.inf,))[0]:
                    best[r] = float(key[i]), x[i].tolist()
        rows = [(r, *found) for r, found in best.items()]
        if rows:
            kinds = pa.int32(), pa.float64(), pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["run", "key", "point"])

    return work


def starts(stored: DataFrame, size: int, settings: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    """k-means++ starts for each (k, seed); fewer centres where there are fewer distinct points."""
    chosen = {r: np.zeros((0, size)) for r in range(len(settings))}
    for place in range(max(k for k, _ in settings)):
        runs = {r: (settings[r][1], c) for r, c in chosen.items() if len(c) == place < settings[r][0]}
        if not runs:
            break
        found = stored.mapInArrow(_draw(runs, size, place), DRAWN).groupBy("run").agg(
            F.min(F.struct("key", "point")).alias("best")
        )
        for r in found.collect():
            chosen[r["run"]] = np.vstack([chosen[r["run"]], r["best"]["point"]])
    return [chosen[r] for r in range(len(settings))]


def nearest(columns: Sequence[str], centers: np.ndarray) -> Column:
    """Number of the nearest centre, the lower one at a tie."""
    def squared(center: np.ndarray) -> Column:
        total = F.lit(0.0)
        for c, v in zip(columns, center):
            total = total + (F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v)))
        return total

    options = [F.struct(squared(c).alias("d"), F.lit(k).alias("k")) for k, c in enumerate(centers)]
    return F.array_min(F.array(*options))["k"]


def _closeness(runs: dict[int, tuple[np.ndarray, np.ndarray]], size: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = dict.fromkeys(runs, 0.0)
        for batch in batches:
            x = _rows(batch.column(0), size)
            squares = (x * x).sum(1)[:, None]
            for r, (centers, t) in runs.items():
                own, n = _distances(x, centers).argmin(1), t[:, 0]
                with np.errstate(divide="ignore", invalid="ignore"):
                    mean = squares + t[:, 2] / n - 2 * (x @ t[:, 3:].T) / n
                mean = np.where(n > 0, np.maximum(mean, 0), np.inf)
                at = np.arange(len(x))
                inside = mean[at, own] * n[own] / np.maximum(n[own] - 1, 1)
                mean[at, own] = np.inf
                outside = mean.min(1)
                with np.errstate(invalid="ignore"):
                    score = (outside - inside) / np.maximum(outside, inside)
                totals[r] += float(np.where((n[own] > 1) & np.isfinite(score), score, 0).sum())
        rows = list(totals.items())
        kinds = pa.int32(), pa.float64()
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["run", "total"])

    return work


def silhouettes(stored: DataFrame, fits: Sequence[Fit]) -> list[float]:
    """Mean silhouette of each fit under squared distances: two passes for all of them.

    The mean squared distance of a row to a cluster follows from the cluster's rows, sums and
    squares, so no two rows meet. Rows alone in their cluster count as 0.
    """
    centers = {r: f.centers for r, f in enumerate(fits)}
    size = fits[0].centers.shape[1]
    totals = _pass(stored, centers)
    runs = {r: (centers[r], totals[r]) for r in centers}
    found = stored.select("x").mapInArrow(_closeness(runs, size), "run int, total double").groupBy("run").agg(
        F.sum("total").alias("total")
    )
    sums = {r["run"]: r["total"] for r in found.collect()}
    return [float(sums.get(r, 0.0) / max(totals[r][:, 0].sum(), 1)) for r in range(len(fits))]
