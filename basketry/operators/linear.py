"""Logistic models by Newton steps: one aggregation of the normal equations a round.

A round sums the upper triangle of ``X'VX``, the gradient and the loss over all rows; the driver
solves a system of as many unknowns as the model has coefficients (14 for the purchase model).
Everything per row is a column expression.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from basketry.operators.metrics import class_weights
from basketry.params import ModelParams


def _sum(parts: Sequence[Column]) -> Column:
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def newton(
    rows: DataFrame,
    columns: Sequence[Column],
    target: Column,
    weight: Column,
    ridge: Sequence[float],
    max_iter: int = 100,
    tol: float = 1e-9,
) -> np.ndarray:
    """Coefficients that minimise the weighted logistic loss plus ``ridge`` / 2 times their squares.

    ``target`` lies between 0 and 1. Ends when no coefficient moves by more than ``tol``; a step
    that does not lower the loss is halved.
    """
    size = len(columns)
    stored = rows.select(
        *[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
        target.cast("double").alias("t"),
        weight.cast("double").alias("w"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    x = [F.col(f"x{i}") for i in range(size)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    penalty = np.array(ridge, float)
    best, point, least = np.zeros(size), np.zeros(size), math.inf
    for _ in range(max_iter):
        m, p = F.col("m"), F.col("p")
        loss = F.greatest(m, F.lit(0.0)) - F.col("t") * m + F.log1p(F.exp(-F.abs(m)))
        placed = (
            stored.withColumn("m", _sum([F.lit(float(b)) * c for b, c in zip(point, x)]))
            .withColumn("p", 1 / (1 + F.exp(-m)))
            .withColumn("v", F.col("w") * p * (1 - p))
            .withColumn("r", F.col("w") * (p - F.col("t")))
        )
        sums = placed.agg(
            F.sum(F.col("w") * loss),
            *[F.sum(F.col("r") * c) for c in x],
            *[F.sum(F.col("v") * x[i] * x[j]) for i, j in pairs],
        ).first()
        if sums[0] is None:
            break
        value = sums[0] + float(penalty @ (point * point)) / 2
        if value > least + 1e-12 * abs(least):
            point = (point + best) / 2
            if np.abs(point - best).max() <= tol:
                break
            continue
        best, least = point, value
        gradient = np.array(sums[1 : size + 1]) + penalty * best
        curve = np.diag(penalty)
        for (i, j), s in zip(pairs, sums[size + 1 :]):
            curve[i, j] += s
            if i != j:
                curve[j, i] += s
        step = np.linalg.lstsq(curve, gradient, rcond=None)[0]
        if np.abs(step).max() <= tol:
            break
        point = best - step
    stored.unpersist()
    return best


class LogisticModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted logistic model. Adds ``rawPrediction``, ``probability`` and ``prediction``."""

    spec = Param(Params._dummy(), "spec", "features, scale, coefficients and intercept as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, spec: str = "{}"):
        super().__init__()
        self._set(spec=spec)

    @property
    def content(self) -> dict:
        return json.loads(self.getOrDefault("spec"))

    @property
    def coefficients(self) -> dict[str, float]:
        """Coefficients of the scaled features."""
        return dict(zip(self.content["features"], self.content["coefficients"]))

    def scaled(self, df: DataFrame, *keys: str) -> DataFrame:
        """The features on the model's scale, beside ``keys``."""
        content = self.content
        columns = [(F.col(f) / F.lit(s)).alias(f) for f, s in zip(content["features"], content["scale"])]
        return df.select(*keys, *columns)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        content = self.content
        parts = [
            F.lit(float(b)) * (F.col(f).cast("double") / F.lit(float(s)))
            for f, s, b in zip(content["features"], content["scale"], content["coefficients"])
        ]
        m, p = F.col("_margin"), F.col("_p")
        out = dataset.withColumn("_margin", _sum([F.lit(float(content["intercept"])), *parts]))
        return out.withColumn("_p", 1 / (1 + F.exp(-m))).withColumns(
            {
                "rawPrediction": array_to_vector(F.array(-m, m)),
                "probability": array_to_vector(F.array(1 - p, p)),
                "prediction": (m > 0).cast("double"),
            }
        ).drop("_margin", "_p")


def fit_logistic(df: DataFrame, params: ModelParams = ModelParams()) -> LogisticModel:
    """Features scaled by their deviation, not centred; balanced classes; L2 penalty 1 / C.

    The intercept is not penalised. A constant feature keeps its own scale.
    """
    names = list(params.features)
    classes = class_weights(df, params.target).collect()
    weights = F.create_map(*[F.lit(v) for r in classes for v in (r["label"], r["weight"])])
    spread = df.agg(*[F.stddev_pop(f).alias(f) for f in names]).first()
    scale = [float(spread[f] or 1.0) for f in names]
    columns = [F.col(f) / F.lit(s) for f, s in zip(names, scale)] + [F.lit(1.0)]
    ridge = [1.0 / params.lr_c] * len(names) + [0.0]
    known = df.dropna(subset=[*names, params.target])
    found = newton(known, columns, F.col(params.target), weights[F.col(params.target)], ridge, params.lr_max_iter, params.lr_tol)
    content = {"features": names, "scale": scale, "coefficients": found[:-1].tolist(), "intercept": float(found[-1])}
    return LogisticModel(spec=json.dumps(content))


class SigmoidCalibration(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``calibrated_prob``, a sigmoid of the base model's margin."""

    slope = Param(Params._dummy(), "slope", "factor of the margin", TypeConverters.toFloat)
    offset = Param(Params._dummy(), "offset", "added to it", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, slope: float = 1.0, offset: float = 0.0):
        super().__init__()
        self._set(slope=slope, offset=offset)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        margin = vector_to_array("rawPrediction")[1]
        z = F.lit(self.getOrDefault("slope")) * margin + F.lit(self.getOrDefault("offset"))
        return dataset.withColumn("calibrated_prob", 1 / (1 + F.exp(-z)))


def fit_sigmoid(scored: DataFrame, label: str) -> SigmoidCalibration:
    """Platt scaling with smoothed targets, (N+ + 1) / (N+ + 2) and 1 / (N- + 2)."""
    margins = scored.select(vector_to_array("rawPrediction")[1].alias("_m"), F.col(label).alias("_y"))
    sizes = margins.agg(F.struct(F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"))).scalar()
    target = F.when(F.col("_y") == 1, (sizes["pos"] + 1) / (sizes["pos"] + 2)).otherwise(1 / (sizes["neg"] + 2))
    slope, offset = newton(margins, [F.col("_m"), F.lit(1.0)], target, F.lit(1.0), [0.0, 0.0])
    return SigmoidCalibration(slope=float(slope), offset=float(offset))
