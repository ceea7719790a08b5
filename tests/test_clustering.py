"""Joint K-Means against single fits in numpy and against the built-in silhouette."""

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from basketry.operators import clustering, models


def data(rows=900, seed=0):
    rng = np.random.default_rng(seed)
    centers = np.array([[0, 0], [6, 1], [0, 7], [9, 9]])
    return centers[rng.integers(0, 4, rows)] + rng.normal(size=(rows, 2))


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, *map(float, r)) for i, r in enumerate(data())]
    return spark.createDataFrame(rows, "id int, a double, b double").repartition(5)


@pytest.fixture(scope="module")
def stored(table):
    return clustering.points(table, ["a", "b"])


def lloyd(x, centers, tol=0.0, most=300):
    for n in range(1, most + 1):
        near = ((x[:, None] - centers) ** 2).sum(2).argmin(1)
        new = np.array([x[near == k].mean(0) if (near == k).any() else c for k, c in enumerate(centers)])
        shift = np.sqrt(((new - centers) ** 2).sum(1)).max()
        centers = new
        if shift <= tol:
            break
    return centers, ((x[:, None] - centers) ** 2).sum(2).min(1).sum(), n


def test_fits_together_equal_fits_alone(spark, stored):
    x = data()
    starts = [x[[1, 2, 3]], x[[5, 8]], x[[10, 11, 12, 13, 14]], np.array([[0.0, 0.0], [500.0, 500.0]])]
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    fits = clustering.lloyd(stored, starts, tol=0.0)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - len(before)
    for fit, start in zip(fits, starts):
        centers, cost, rounds = lloyd(x, start, 1e-11)
        assert fit.centers == pytest.approx(centers) and fit.cost == pytest.approx(cost) and fit.rounds == rounds
    # Each round, and the last pass for the costs, is one query of at most two jobs.
    assert jobs <= 2 * (max(f.rounds for f in fits) + 1)


def test_starts_are_rows_and_spread(stored):
    x = data()
    drawn = clustering.starts(stored, 2, [(4, s) for s in range(12)] + [(2, 5)])
    assert [len(d) for d in drawn] == [4] * 12 + [2]
    known = {tuple(r) for r in x}
    assert all(tuple(p) in known for d in drawn for p in d)
    assert len({tuple(d[0]) for d in drawn}) > 8, "seeds differ"
    # Far points are likelier: most starts hit at least three of the four groups.
    groups = [len({(p[0] > 3, p[1] > 4) for p in d}) for d in drawn[:12]]
    assert np.mean(groups) > 3
    assert (drawn[5][:2] == drawn[12]).all(), "the first centres do not depend on k"


def test_fewer_distinct_points_than_centres(spark):
    df = spark.createDataFrame([(i, 1.0 * (i % 2), 0.0) for i in range(50)], "id int, a double, b double")
    stored = clustering.points(df, ["a", "b"])
    drawn = clustering.starts(stored, 2, [(4, 0)])
    assert len(drawn[0]) == 2
    assert clustering.lloyd(stored, drawn)[0].cost == 0


def test_silhouettes_equal_the_built_in_ones(table, stored):
    fits = clustering.lloyd(stored, clustering.starts(stored, 2, [(2, 1), (3, 1), (5, 1)]))
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(table)
    for fit, found in zip(fits, clustering.silhouettes(stored, fits)):
        placed = vectors.withColumn("prediction", clustering.nearest(["a", "b"], fit.centers))
        assert found == pytest.approx(ClusteringEvaluator().evaluate(placed))


def test_scan_finds_the_groups(table):
    scan = models.elbow_scan(table, ["a", "b"], range(2, 7), seed=3)
    assert models.best_k(scan) == 4
    costs = [r["inertia"] for r in scan.orderBy("k").collect()]
    assert costs[0] > costs[1] > costs[2]


def test_nearest_takes_the_lower_at_a_tie(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (3.0,)], "a double")
    out = df.select(clustering.nearest(["a"], np.array([[0.0], [2.0]])).alias("k")).collect()
    assert [r["k"] for r in out] == [0, 0, 1]
