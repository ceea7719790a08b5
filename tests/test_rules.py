"""Rules of the jobs that the shared tables do not reach."""

import json
import random
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from basketry.functions.text import parse_literal_list
from basketry.operators import models
from basketry.operators.linear import LogisticModel
from basketry.operators.order_stats import spread_rank
from basketry.params import ModelParams, VipParams
from basketry.plans import jobs
from basketry.session import settings

QUOTED = [
    ("[{'product': 'a, None, b', 'amount': None}]", [("a, None, b", None)]),
    ("[{'product': 'a', 'amount': 2.0},]", [("a", 2.0)]),
    ("[{'product': 'x,]', 'amount': 1.0}, ]", [("x,]", 1.0)]),
    ('[{"product": "it\'s True", "amount": 3.0}]', [("it's True", 3.0)]),
    ("[{'product': None, 'amount': 1.0}, {'product': 'None', 'amount': None}]", [(None, 1.0), ("None", None)]),
]


def test_text_inside_quotes_stays(spark):
    df = spark.createDataFrame(list(enumerate(t for t, _ in QUOTED)), "i int, s string")
    got = df.select("i", parse_literal_list("s").alias("d")).orderBy("i").collect()
    assert [[(x.product, x.amount) for x in r.d] for r in got] == [e for _, e in QUOTED]


def test_vip_reads_text_details_and_strips_ids(spark):
    """Ten weeks of tickets; every second id ends in a tab or a no-break space."""
    ids = ["1234567", "1234567\t", "1234567 ", " 1234567"]
    rows = [
        (i, ids[i % 4], 100.0, "S1", "N", "[{'product': 'p', 'amount': 1.0, 'tax': None},]") for i in range(10)
    ]
    raw = spark.createDataFrame(
        rows, "ID long, identification_doct string, invoice_value_without_iva_and_discount double, "
        "id_point_sale string, domicilio_status string, invoice_details string",
    ).withColumn("date_sale", F.expr("date_add(DATE '2024-01-01', cast(ID * 7 AS INT))"))
    out = jobs.vip_plan(raw, None, VipParams(min_weeks=10)).collect()
    assert len(out) == 10 and {r.user_id for r in out} == {"1234567"}


def test_permutation_uses_every_row(spark):
    """A feature that is constant has no importance; one that decides has much."""
    features = ModelParams().features
    base = spark.range(3000).select(
        F.col("id").cast("string").alias("client"), F.lit("2024-01-01").cast("date").alias("date"),
        (F.col("id") % 2).cast("int").alias("purchased"),
        *[((F.col("id") % 2) * 5.0 if f == "cnt_7d" else F.lit(1.0)).alias(f) for f in features],
    )
    params = ModelParams(model_type="logistic_regression", permutation_repeats=2)
    model = models.train_logistic(base, params)
    found = {r.feature: r.importance for r in models.permutation_importance(model, base, params).collect()}
    assert found["dow"] == 0 and found["cnt_7d"] == pytest.approx(0.5, abs=0.1)


STATED = {"features": ["a", "b"], "scale": [1.0, 1.0], "coefficients": [1.0, 0.0], "intercept": 0.0}


@pytest.mark.parametrize("size,repeats,buckets", [(200, 4, 1), (200, 4, 6), (3, 7, 1), (1, 2, 1)])
def test_shuffled_values_are_those_of_other_rows(spark, size, repeats, buckets):
    """Each repeat is a permutation; tables smaller than the repeats go round more than once."""
    rng = random.Random(size)
    data = [(f"c{i}", i, rng.gauss(0, 1), rng.gauss(0, 1), int(rng.random() < 0.5)) for i in range(size)]
    df = spark.createDataFrame(data, "client string, date int, a double, b double, y int")
    model, seed = LogisticModel(spec=json.dumps(STATED)), 42
    params = ModelParams(features=("a", "b"), target="y", permutation_repeats=repeats, seed=seed)
    got = {r.feature: r.importance for r in models.permutation_importance(model, df, params, buckets=buckets).collect()}
    order = lambda r: md5(f"{seed}|{r[0]}|{r[1]}".encode()).hexdigest()
    hits = 0
    for k in range(buckets):
        own = sorted((r for r in data if int(order(r)[:8], 16) % buckets == k), key=order)
        hits += sum((own[(i + j) % len(own)][2] > 0) == r[4] for i, r in enumerate(own) for j in range(1, repeats + 1))
    base = sum((r[2] > 0) == r[4] for r in data)
    assert got["b"] == 0 and got["a"] == pytest.approx(base / size - hits / size / repeats)


def test_shuffled_copies_never_cross_an_exchange(spark):
    df = spark.createDataFrame([("c", 1, 0.0, 0.0, 1)], "client string, date int, a double, b double, y int")
    params = ModelParams(features=("a", "b"), target="y", permutation_repeats=3)
    out = models.permutation_importance(LogisticModel(spec=json.dumps(STATED)), df, params)
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = out._jdf.queryExecution().executedPlan().toString()
    first = plan.index("Generate explode")
    above, below = plan[:first], plan[first:]
    assert "_bucket" in below and below.count("Exchange hashpartitioning") == 1
    # Above the copies only sums per feature travel.
    assert all(f"Exchange {kind}" in line for line in above.splitlines() if "Exchange" in line
               for kind in (["hashpartitioning(_feature"] if "_feature" in line else ["SinglePartition"]))


def test_spread_rank(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 3))
    ranked = spread_rank(df, ["k"], F.xxhash64("id"), 1000, per_bucket=50).collect()
    for k in (None, 1, 2):
        own = sorted(r._rank for r in ranked if r.k == k)
        assert own == list(range(len(own)))
