"""Exact order statistics against numpy, hot groups included."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import order_stats as o
from basketry.session import settings

P = {"lo": 0.0, "q1": 0.25, "med": 0.5, "p99": 0.99, "hi": 1.0}


def table(spark, seed=1):
    """Group a holds most rows, with heavy tails, negative values, ties and nulls."""
    rng = np.random.default_rng(seed)
    data = [("a", float(x)) for x in np.round(np.exp(rng.normal(5, 3, 4000)), 2)]
    data += [("a", 100.0)] * 2000 + [("b", float(x)) for x in rng.normal(0, 1, 501)]
    data += [("c", 7.0), ("d", 1.0), ("d", 2.0), ("e", None)]
    return data, spark.createDataFrame(data, "k string, v double")


def expected(data, keyed=True):
    groups = {}
    for k, v in data:
        if v is not None:
            groups.setdefault(k if keyed else None, []).append(v)
    return {k: [np.percentile(v, 100 * p) for p in P.values()] for k, v in groups.items()}


def check(df, data, keyed=True):
    got = {(r["k"] if keyed else None): [r[n] for n in P] for r in df.collect()}
    want = expected(data, keyed)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12, abs=1e-12)


def test_few_groups(spark):
    data, df = table(spark)
    check(o.few_group_percentiles(df, "v", P, ["k"]), data)
    check(o.few_group_percentiles(df, "v", P), data, keyed=False)


@pytest.mark.parametrize("hot", [100, 10**6])
def test_hot_and_usual_groups_agree(spark, hot):
    data, df = table(spark, 2)
    check(o.percentiles_by_key(df, "v", P, ["k"], hot_values=hot), data)


def test_no_rows(spark):
    _, df = table(spark)
    assert o.few_group_percentiles(df.where("k = 'e'"), "v", P, ["k"]).count() == 0


@pytest.mark.parametrize("scale", [1.0, 1e-7])
def test_running_totals(spark, scale):
    """Scores spread over the range, and all of them inside one piece of it."""
    rng = np.random.default_rng(3)
    scores = np.unique(np.round(rng.random(3000), 6)) * scale
    weights = rng.integers(0, 50, len(scores))
    df = spark.createDataFrame(list(zip(map(float, scores), map(int, weights))), "s double, w long")
    got = o.running_totals(df, F.col("s"), ["w"]).orderBy("s").collect()
    assert [r["w_before"] for r in got] == list(np.cumsum(weights) - weights)
    back = o.running_totals(df, -F.col("s"), ["w"]).orderBy(F.desc("s")).collect()
    assert [r["w_before"] for r in back] == list(np.cumsum(weights[::-1]) - weights[::-1])


def test_crowded_scores_are_spread(spark):
    """A hundred thousand scores below a millionth, and a few up to one: no range holds half of them."""
    crowd = spark.range(100_000).select((F.col("id") * 1e-11).alias("s"), F.lit(1).alias("w"))
    few = spark.range(1, 101).select((F.col("id") / 100).alias("s"), F.lit(1).alias("w"))
    df = crowd.union(few)
    # Ranges this small would be put together again.
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = o.running_totals(df, F.col("s"), ["w"])
    dealt = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in out.inputFiles()})
    sizes = [r["count"] for r in dealt.groupBy("_p").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 50_000
    wrong = out.where(F.col("w_before") != F.when(F.col("s") < 1e-6, F.round(F.col("s") * 1e11)).otherwise(
        100_000 + F.round(F.col("s") * 100) - 1))
    assert out.count() == 100_100 and wrong.count() == 0


def test_rows_without_order_are_left_out(spark):
    df = spark.createDataFrame([(0.5, 1), (None, 7), (0.1, 2)], "s double, w int")
    got = o.running_totals(df, F.col("s"), ["w"]).orderBy("s").collect()
    assert [(r["s"], r["w_before"]) for r in got] == [(0.1, 0), (0.5, 2)]


def test_percentiles_of_tiny_and_huge_values(spark):
    values = [0.0, -0.0, 4e-307, -4e-307, 1e-300, -2e-300, 1e300, -1e300, 3.0, -3.0, 1e-9, 2e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = o.few_group_percentiles(df, "v", {f"q{k}": k / 10 for k in range(11)}).first()
    want = np.quantile(np.array(values), np.arange(11) / 10)
    assert [got[f"q{k}"] for k in range(11)] == pytest.approx(want.tolist(), rel=1e-9, abs=0)
