"""Boosted trees against a plain numpy version grown leaf by leaf."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from basketry.operators import boosting, models
from basketry.params import ModelParams
from basketry.session import work_dir

FEATURES = ("a", "b", "c")


def params(**changes):
    base = dict(features=FEATURES, target="y", trees=6, depth=4, max_leaves=9, min_leaf=20, max_bins=32, early_stopping_rows=10**9)
    return ModelParams(**(base | changes))


def data(rows=2000, seed=0, noise=0.5):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 12, rows), rng.normal(size=rows), rng.exponential(5, rows).round(1)], 1).astype(float)
    score = 0.4 * (x[:, 0] > 6) * x[:, 1] + 0.3 * x[:, 1] - 0.2 * (x[:, 2] < 3) - 0.3 + noise * rng.normal(size=rows)
    return x, (score > 0).astype(int)


def frame(spark, x, y):
    rows = [(f"c{i}", i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "client string, date int, a double, b double, c double, y int").repartition(5)


def edges_by_definition(column, max_bins):
    values = np.unique(column)
    if len(values) <= max_bins:
        return (values[:-1] + values[1:]) / 2
    return np.unique(np.quantile(column, np.arange(1, max_bins) / max_bins))


def boosted_by_definition(x, y, p):
    """Margins after all trees, and the trees as lists of (rows at split, feature, edge)."""
    edges = [edges_by_definition(x[:, f], p.max_bins) for f in range(x.shape[1])]
    w = len(y) / (2 * np.bincount(y, minlength=2)[y])
    margin = np.full(len(y), math.log(w[y == 1].sum() / w[y == 0].sum()))
    shapes = []
    for _ in range(p.trees):
        prob = 1 / (1 + np.exp(-margin))
        g, h = w * (prob - y), w * prob * (1 - prob)

        def split(rows):
            best = (0.0, None)
            part = lambda r: g[r].sum() ** 2 / (h[r].sum() + p.l2)  # noqa: E731, B023
            for f, cuts in enumerate(edges):
                for cut in cuts:
                    left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if min(len(left), len(right)) < p.min_leaf:
                        continue
                    gain = part(left) + part(right) - part(rows)
                    if gain > best[0] + 1e-9:
                        best = gain, (f, cut, left, right)
            return best

        leaves = [(np.arange(len(y)), 0)]
        options = [split(leaves[0][0])]
        shape = []
        while len(leaves) < p.max_leaves and max((o[0] for o in options), default=0) > 0:
            k = max(range(len(options)), key=lambda i: options[i][0])
            (rows, depth), (_, (f, cut, left, right)) = leaves.pop(k), options.pop(k)
            shape.append((len(rows), f, round(float(cut), 9)))
            for child in (left, right):
                leaves.append((child, depth + 1))
                options.append(split(child) if depth + 1 < p.depth else (0.0, None))
        if not shape:
            break
        shapes.append(sorted(shape))
        for rows, _ in leaves:
            margin[rows] -= p.learning_rate * g[rows].sum() / (h[rows].sum() + p.l2)
    return margin, shapes


def test_edges(spark):
    x, y = data(3000, 6)
    x[::50, 1] = np.nan
    for bins in (255, 10):
        found = boosting.bin_edges(frame(spark, x, y), FEATURES, bins)
        for f, edges in enumerate(found):
            column = x[~np.isnan(x[:, f]), f]
            want = edges_by_definition(column, bins)
            assert edges[0] == -np.inf and len(edges) == len(want) + 1 <= bins
            assert (np.searchsorted(edges[1:], column) == np.searchsorted(want, column)).all()


def margins(model, df):
    out = models.score(PipelineModel(stages=[model]), df).select("date", "prob").collect()
    return {r["date"]: math.log(r["prob"] / (1 - r["prob"])) for r in out}


@pytest.mark.parametrize("changes", [{}, {"max_bins": 16, "depth": 6, "max_leaves": 31, "trees": 4}])
def test_equals_trees_grown_leaf_by_leaf(spark, changes):
    p = params(**changes)
    x, y = data()
    df = frame(spark, x, y)
    model = boosting.fit_trees(df, p)
    want, shapes = boosted_by_definition(x, y, p)
    nodes = model.table(df).where("feature is not null").collect()
    found = [
        sorted((r["rows"], FEATURES.index(r["feature"]), round(r["threshold"], 9)) for r in nodes if r["tree"] == k)
        for k in range(len(shapes))
    ]
    assert [[s[:2] for s in t] for t in found] == [[s[:2] for s in t] for t in shapes]
    got = margins(model, df)
    assert [got[i] for i in range(len(y))] == pytest.approx(want.tolist(), abs=1e-6)


def test_leaves_depth_and_rows_keep_their_limits(spark):
    p = params(trees=5, depth=5, max_leaves=7)
    x, y = data(3000, 1)
    df = frame(spark, x, y)
    nodes = boosting.fit_trees(df, p).table(df)
    leaves = nodes.where("feature is null").groupBy("tree").agg(
        F.count(F.lit(1)).alias("n"), F.min("rows").alias("least"), F.sum("rows").alias("rows"), F.max("node").alias("last")
    ).collect()
    assert len(leaves) == 5
    assert all(r["n"] <= 7 and r["least"] >= 20 and r["rows"] == 3000 and r["last"] < 2**6 - 1 for r in leaves)


def test_stops_on_rows_held_out(spark):
    """Labels without any signal: the held-out loss rises at once."""
    x, _ = data(3000, 2)
    y = np.random.default_rng(5).integers(0, 2, 3000)
    p = params(trees=60, early_stopping_rows=1000, patience=3, hold_out=0.3)
    df = frame(spark, x, y)
    model = boosting.fit_trees(df, p)
    assert 3 <= len(model.content["trees"]) < 40
    assert len(boosting.fit_trees(df, params(trees=12, depth=2, max_leaves=4)).content["trees"]) == 12
    rows = {t["rows"][0] for t in model.content["trees"]}
    assert len(rows) == 1 and 1900 < rows.pop() < 2300, "held rows do not train"


def test_repeats_to_the_last_digit(spark):
    x, y = data(1500, 3)
    p = params(trees=9, depth=2)
    one, two = (boosting.fit_trees(frame(spark, x, y).repartition(n), p).getOrDefault("spec") for n in (3, 7))
    assert one == two


def test_stored_model_scores_alike(spark):
    x, y = data(800, 4)
    df = frame(spark, x, y)
    model = models.train(df, params(trees=3))
    path = work_dir(spark, "model")
    model.write().save(path)
    again = PipelineModel.load(path)
    a, b = (models.score(m, df).select("date", "prob").orderBy("date").collect() for m in (model, again))
    assert a == b and len({r["prob"] for r in a}) > 5
    raw = model.transform(df).first()
    assert raw["rawPrediction"][1] == -raw["rawPrediction"][0]
    assert raw["prediction"] == float(raw["probability"][1] > 0.5)


def test_nulls_few_rows_and_one_class(spark):
    kinds = "client string, date int, a double, b double, c double, y int"
    rows = [(f"c{i}", i, None if i % 3 == 0 else 1.0 * i, 1.0, float("nan"), int(i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, kinds)
    scored = models.score(models.train(df, params(trees=8, learning_rate=0.5, depth=2)), df)
    assert scored.where((F.col("prob") > 0.5) != (F.col("y") == 1)).count() == 0
    only = df.where("y = 1")
    assert models.score(models.train(only, params()), only).agg(F.min("prob")).first()[0] > 0.99
    few = df.limit(5)
    assert models.score(models.train(few, params()), few).count() == 5
