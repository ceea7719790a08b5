"""Isotonic calibration by merging convex hulls.

The best non-decreasing fit of rates by score is the slope of the greatest convex line below the
points (rows up to a score, positives up to it). Such hulls merge: the hull of all points is the
hull of the hulls of any parts of them. Running totals give the points, each task keeps the hull
of its own, half-merged hulls are merged again by fewer tasks, and the driver merges the last. A
hull of whole-numbered points within n rows has at most some n^(2/3) corners, so what leaves a
task is small however many scores there are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.order_stats import running_totals
from basketry.session import materialise

Point = tuple[int, int, float]
CORNERS = "n bigint, s bigint, score double"
# Tasks of the second round of merging.
MERGERS = 16


def lower_hull(points: list[Point]) -> list[Point]:
    """Corners of the greatest convex line below the points (n, s, score), by rising n.

    Whole numbers throughout, so corners on a straight line are recognised and left out.
    """
    out: list[Point] = []
    for n, s, score in sorted(points):
        while len(out) > 1 and (out[-1][1] - out[-2][1]) * (n - out[-2][0]) >= (s - out[-2][1]) * (out[-1][0] - out[-2][0]):
            out.pop()
        out.append((n, s, score))
    return out


def _hulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    corners: list[Point] = []
    for batch in batches:
        corners = lower_hull(corners + list(zip(*[c.to_pylist() for c in batch.columns])))
    if corners:
        kinds = pa.int64(), pa.int64(), pa.float64()
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*corners), kinds)], ["n", "s", "score"])


def _first_scores(borders: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.full(len(borders), np.inf)
        for batch in batches:
            score = batch.column(0).to_numpy()
            np.minimum.at(least, np.searchsorted(borders, score), score)
        block = np.flatnonzero(np.isfinite(least))
        yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(least[block])], ["block", "first"])

    return run


def isotonic_steps(scored: DataFrame, prob: str, label: str) -> list[tuple[float, float, float]]:
    """Blocks of equal rate: (first score, last score, rate), by rising score."""
    y = F.col(label).cast("long")
    counts = scored.where(F.col(prob).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(prob).cast("double").alias("score")).agg(
        F.sum(y).alias("s"), F.count(F.lit(1)).alias("n")
    )
    totals = materialise(
        running_totals(counts, F.col("score"), ["s", "n"]).select(
            (F.col("n_before") + F.col("n")).alias("n"), (F.col("s_before") + F.col("s")).alias("s"), "score"
        ),
        "rates",
    )
    hulls = totals.mapInArrow(_hulls, CORNERS).repartition(MERGERS).mapInArrow(_hulls, CORNERS)
    corners = lower_hull([(0, 0, -np.inf), *[(r["n"], r["s"], r["score"]) for r in hulls.collect()]])
    if len(corners) < 2:
        return []
    borders = np.array([c[2] for c in corners[1:]])
    firsts = totals.select("score").mapInArrow(_first_scores(borders), "block int, first double").groupBy("block").agg(
        F.min("first").alias("first")
    )
    first = {r["block"]: r["first"] for r in firsts.collect()}
    return [
        (first[k], b[2], (b[1] - a[1]) / (b[0] - a[0])) for k, (a, b) in enumerate(zip(corners, corners[1:]))
    ]


class IsotonicCalibration(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``calibrated_prob``: the rate of the score's block, between blocks on a straight line."""

    steps = Param(Params._dummy(), "steps", "blocks (first, last, rate) as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, steps: str = "[]"):
        super().__init__()
        self._set(steps=steps)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        steps = json.loads(self.getOrDefault("steps"))
        xs = np.array([x for first, last, _ in steps for x in (first, last)])
        ys = np.array([rate for *_, rate in steps for _ in range(2)])

        @F.pandas_udf("double")
        def rate(score: pd.Series) -> pd.Series:
            return pd.Series(np.interp(score, xs, ys) if len(xs) else np.full(len(score), np.nan))

        return dataset.withColumn("calibrated_prob", rate(vector_to_array("probability")[1]))


def fit_isotonic(scored: DataFrame, label: str) -> IsotonicCalibration:
    """Isotonic calibration of the base model's ``probability``."""
    plain = scored.select(vector_to_array("probability")[1].alias("_p"), F.col(label).alias("_y"))
    return IsotonicCalibration(steps=json.dumps(isotonic_steps(plain, "_p", "_y")))
