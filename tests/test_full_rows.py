"""Queries of fitted models return full rows, and their model-dependent columns are right."""

import math
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.operators import models, recommend, segmentation
from basketry.operators.clean import normalise_sales, validate_client_ids
from basketry.operators.patterns import filter_recent_clients, segmentation_features
from basketry.params import SegmentParams
from basketry.session import materialise
from workload import q_model, q_segments
from workload.fixtures import FX_EXCLUDED, Fixtures
from workload.registry import joined

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, FOLDER)


def test_scores_follow_from_coefficients(fx):
    """Both logistic steps, base and calibration, computed by hand from their coefficients."""
    params = q_model.FX_LOGISTIC
    base = models.train_logistic(q_model.parts(fx, params)[0], params)
    calibration, test = q_model.halves(fx, params)
    model = models.calibrate_sigmoid(base, calibration, "purchased")
    platt = model.stages[-1]
    slope, offset = platt.getOrDefault("slope"), platt.getOrDefault("offset")
    margins = base.transform(test).select("client", "date", F.col("rawPrediction")).collect()
    want = {
        (r["client"], r["date"]): 1 / (1 + math.exp(-(offset + slope * r["rawPrediction"][1])))
        for r in margins
    }
    got = {(r["client"], r["date"]): r["prob"] for r in q_model._score(fx).collect()}
    assert got == pytest.approx(want, abs=2e-6) and len(set(got.values())) > 10


def test_trained_probabilities_rank_buyers_first(fx):
    scored = q_model._job_train(fx).join(fx.stored_calendar.select("client", "date", "purchased"), ["client", "date"])
    mean = {r["purchased"]: r["m"] for r in scored.groupBy("purchased").agg(F.avg("prob").alias("m")).collect()}
    assert 0 <= mean[0] < mean[1] <= 1


def test_backtest_columns_agree(fx):
    found = q_model._job_backtest(fx).collect()
    assert len(found) == 7
    for r in found:
        tp, fp, fn = int(r["TP"]), int(r["FP"]), int(r["FN"])
        assert (int(r["Clientes_Compraron"]), int(r["Clientes_Predichos"])) == (tp + fn, tp + fp)
        assert float(r["Precision"]) == pytest.approx(tp / (tp + fp) if tp + fp else 0, abs=1e-4)
        assert float(r["Recall"]) == pytest.approx(tp / (tp + fn) if tp + fn else 0, abs=1e-4)
        assert r["F0.5-score"] is not None
    assert all(sum(int(r[c]) for r in found) > 0 for c in ("TP", "FP", "FN"))


def test_vip_segments_are_those_of_the_fit(fx):
    lines = fx.vip_lines.where("tiket_price > 50000")
    fitted = models.kmeans_vip(segmentation.vip_features(lines))
    names = ["user_id", "cluster_id", "cluster_nombre", "cluster_descripcion"]
    assert rows(q_segments._job_segment_vip(fx), *names) == rows(fitted, *names)


def test_segment_recs_are_those_of_the_clusters(fx):
    """The clusters of a fit depend on row order, so those the query returned are given."""
    got = q_segments._job_segment_recs(fx)
    assert got.columns == ["client", "purchase_pattern_cluster", "segment", "segment_label", "recommended_products"]
    got = materialise(got, "returned")
    recent = filter_recent_clients(normalise_sales(validate_client_ids(fx.sales)), SegmentParams().recent_months)
    clusters = got.select(
        F.col("client").alias("id_client"), F.col("purchase_pattern_cluster").alias("cluster"), "segment", "segment_label"
    ).join(segmentation_features(recent).select("id_client", "product_distinct"), "id_client")
    want = joined(recommend.recs_by_cluster(recent, clusters, fx.catalog, FX_EXCLUDED))
    assert rows(got) == rows(want) and got.select("segment").distinct().count() > 1
