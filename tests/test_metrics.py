"""Metrics against direct computation, and the model's own properties."""

import math
import random
from dataclasses import replace

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.operators import metrics, models
from basketry.params import ModelParams


def scored(seed=0, n=400):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        p = round(rng.random(), 2)
        data.append((int(rng.random() < p), p))
    # A third of all rows share one score.
    return data + [(i % 3 == 0 and 1 or 0, 0.5) for i in range(n // 2)]


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(scored(), "y int, p double")


def auc(data):
    pos, neg = [p for y, p in data if y], [p for y, p in data if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_and_threshold_metrics(df):
    data = scored()
    r = metrics.binary_metrics(df, "y", "p", 0.5).first()
    tp = sum(y and p >= 0.5 for y, p in data)
    fp = sum((not y) and p >= 0.5 for y, p in data)
    fn = sum(y and p < 0.5 for y, p in data)
    assert r["roc_auc"] == pytest.approx(auc(data))
    assert r["brier"] == pytest.approx(sum((p - y) ** 2 for y, p in data) / len(data))
    assert (r["precision"], r["recall"]) == (pytest.approx(tp / (tp + fp)), pytest.approx(tp / (tp + fn)))
    assert r["f05"] == pytest.approx(1.25 * tp / (1.25 * tp + 0.25 * fn + fp))


def test_one_class_gives_no_auc_and_no_error(spark):
    df = spark.createDataFrame([(0, 0.2), (0, 0.7)], "y int, p double")
    r = metrics.binary_metrics(df, "y", "p", 0.5).first()
    assert (r["roc_auc"], r["precision"], r["recall"], r["f05"]) == (None, 0.0, 0.0, 0.0)


def test_pr_curve(df):
    data = scored()
    total = sum(y for y, _ in data)
    for r in metrics.pr_curve(df, "y", "p").collect():
        hits = [y for y, p in data if p >= r["threshold"]]
        assert r["precision"] == pytest.approx(sum(hits) / len(hits))
        assert r["recall"] == pytest.approx(sum(hits) / total)


def test_pr_points_take_the_next_score(spark):
    curve = spark.createDataFrame([(0.2, 0.1, 0.9), (0.45, 0.5, 0.5)], "threshold double, precision double, recall double")
    assert rows(metrics.pr_at(curve)) == [(0.3, 0.45, 0.5, 0.5), (0.4, 0.45, 0.5, 0.5)]


def test_edges_belong_to_the_lower_bin(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.1), (1, 0.11), (1, 1.0)], "y int, p double")
    assert rows(metrics.calibration_curve(df, "y", "p"), "bin", "rows") == [(0, 2), (1, 1), (9, 1)]


def test_report_adds_up(df):
    rep = {r["class"]: r for r in metrics.classification_report(df, "y", "p", 0.5).collect()}
    assert rep["0"]["support"] + rep["1"]["support"] == rep["accuracy"]["support"] == len(scored())
    assert rep["macro avg"]["recall"] == pytest.approx((rep["0"]["recall"] + rep["1"]["recall"]) / 2)
    assert rep["weighted avg"]["recall"] == pytest.approx(rep["accuracy"]["recall"])


def test_backtest_counts(spark, day):
    who = "date date, client string"
    actual = spark.createDataFrame([(day("2024-01-01"), c) for c in "aabc"] + [(day("2024-02-01"), "z")], who)
    chosen = spark.createDataFrame([(day("2024-01-01"), c) for c in "bbd"] + [(day("2024-01-02"), "x")], who)
    out = metrics.backtest_daily(actual, chosen, F.lit(day("2024-01-01")), F.lit(day("2024-01-03")))
    assert rows(out.select("fecha", "TP", "FP", "FN", "Clientes_Compraron", "Clientes_Predichos")) == [
        (day("2024-01-01"), 1, 1, 2, 3, 2), (day("2024-01-02"), 0, 1, 0, 0, 1), (day("2024-01-03"), 0, 0, 0, 0, 0),
    ]
    assert metrics.backtest_average(out).first()["Precision"] == pytest.approx(0.5 / 3)


def test_splits(spark, day):
    data = [(day(f"2024-01-{i:02d}"), int(i <= 20)) for i in range(1, 26)]
    df = spark.createDataFrame(data, "date date, purchased int")
    a = {r["date"].day: r["split"] for r in metrics.temporal_split(df, 5).collect()}
    assert (a[15], a[16], a[20], a[21]) == ("train", "valid", "valid", None)
    b = {r["date"].day: r["split"] for r in metrics.calibration_split(df, 5).collect()}
    assert (b[15], b[16], b[17], b[18], b[20], b[21]) == (None, "calibration", "calibration", "test", "test", None)
    none = metrics.temporal_split(df.withColumn("purchased", F.lit(0)), 5)
    assert none.where("split = 'train'").agg(F.max("date")).first()[0] == day("2024-01-15")


# --- model ------------------------------------------------------------------------------

PARAMS = ModelParams(features=("f", "g"), target="y", trees=5, depth=3, min_leaf=5, permutation_repeats=3)


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(1)
    data = []
    for i in range(600):
        f, g = rng.gauss(0, 1), rng.gauss(0, 1)
        data.append((i, f, g, int(rng.random() < 1 / (1 + math.exp(1 - 2 * f)))))
    return spark.createDataFrame(data, "id int, f double, g double, y int").cache()


def test_calibration_keeps_the_order_and_fits_the_rate(points):
    base = models.train_gbt(points, PARAMS)
    calibrated = models.calibrate_sigmoid(base, points, "y")
    both = models.score(calibrated, models.score(base, points, "base"), "cal")
    one = metrics.roc_auc(both, "y", "base").first()[0]
    assert one == pytest.approx(metrics.roc_auc(both, "y", "cal").first()[0])
    means = both.agg(F.avg("cal"), F.avg("y")).first()
    assert means[0] == pytest.approx(means[1], abs=0.01)


def test_platt_optimum_has_no_gradient(points):
    base = models.train_logistic(points, PARAMS)
    calibrated = models.calibrate_sigmoid(base, points, "y")
    out = calibrated.transform(points).select("y", models.vector_to_array("rawPrediction")[1].alias("m"), F.col("calibrated_prob").alias("p")).collect()
    pos = sum(r["y"] for r in out)
    neg = len(out) - pos
    target = {1: (pos + 1) / (pos + 2), 0: 1 / (neg + 2)}
    assert sum(r["p"] - target[r["y"]] for r in out) == pytest.approx(0, abs=1e-7)
    assert sum((r["p"] - target[r["y"]]) * r["m"] for r in out) == pytest.approx(0, abs=1e-7)


def test_logistic_optimum_has_no_gradient(points):
    """Balanced weights, features scaled by their deviation, penalty 1 / C on all but the intercept."""
    p = replace(PARAMS, lr_c=0.5)
    model = models.train_logistic(points, p).stages[0]
    data = [(r["f"], r["g"], r["y"]) for r in points.collect()]
    x, y = np.array([d[:2] for d in data]), np.array([d[2] for d in data])
    x = x / x.std(axis=0)
    w = len(y) / (2 * np.bincount(y)[y])
    b = np.array(list(model.coefficients.values()))
    r = w * (1 / (1 + np.exp(-(x @ b + model.content["intercept"]))) - y)
    assert x.T @ r + b / 0.5 == pytest.approx(np.zeros(2), abs=1e-6) and r.sum() == pytest.approx(0, abs=1e-6)


def test_saved_model_scores_the_same(spark, points, tmp_path):
    from pyspark.ml import PipelineModel

    model = models.calibrate_sigmoid(models.train_logistic(points, PARAMS), points, "y")
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert rows(models.score(model, points), "id", "prob") == rows(models.score(again, points), "id", "prob")


def test_isotonic_is_monotone(points):
    base = models.train_logistic(points, PARAMS)
    out = models.score(models.calibrate_isotonic(base, points, "y"), models.score(base, points, "b"), "c")
    ordered = [r["c"] for r in out.orderBy("b").collect()]
    assert ordered == sorted(ordered)


@pytest.mark.parametrize("train", [models.train_logistic, models.train_gbt])
def test_permutation_finds_the_feature_that_matters(points, train):
    model = train(points, PARAMS)
    got = {r["feature"]: r["importance"] for r in models.permutation_importance(model, points, PARAMS, ["id"]).collect()}
    assert got["f"] > 0.1 > abs(got["g"])


def test_coefficients_and_shap(points):
    top = models.coef_importance(models.train_logistic(points, PARAMS), PARAMS).collect()
    assert top[0]["feature"] == "f"
    shap = {r["feature"]: r["mean_abs_shap"] for r in models.linear_shap(points, {"f": 2.0}, 50, ["id"]).collect()}
    assert shap["f"] > 0


def test_unknown_model_type(points):
    with pytest.raises(ValueError):
        models.train(points, replace(PARAMS, model_type="x"))
