"""Calendar: density, leakage and edge cases."""

from datetime import timedelta

from conftest import rows
from pyspark.sql import functions as F

from basketry.operators.calendar import calendar_features, client_calendar
from basketry.params import MODEL_FEATURES

SCHEMA = "client string, date date, qty_tot double, amount_tot double, skus long, purchased int"


def daily(spark, day, data):
    return spark.createDataFrame([(c, day(d), 1.0, a, 2, 1) for c, d, a in data], SCHEMA)


def sample(spark, day):
    return daily(spark, day, [("a", "2024-01-03", 10.0), ("a", "2024-01-05", 20.0), ("b", "2024-01-01", 5.0), ("b", "2024-01-08", 7.0)])


def test_every_client_has_every_day_once(spark, day):
    out = client_calendar(sample(spark, day), 5)
    assert out.count() == 2 * 13 == out.select("client", "date").distinct().count()
    assert out.agg(F.min("date"), F.max("date")).first() == (day("2024-01-01"), day("2024-01-13"))
    assert out.agg(F.sum("amount_tot"), F.sum("purchased")).first() == (42.0, 4)


def test_features_look_back_only(spark, day):
    """Changing day t and later changes no feature at t or before."""
    before = [("a", "2024-01-03", 10.0), ("b", "2024-01-01", 5.0), ("b", "2024-01-08", 7.0)]
    one = calendar_features(daily(spark, day, before + [("a", "2024-01-05", 20.0)]))
    two = calendar_features(daily(spark, day, before + [("a", "2024-01-05", 99.0), ("a", "2024-01-06", 1.0)]))
    cut = F.col("date") <= F.lit(day("2024-01-05"))
    columns = ("client", "date", *MODEL_FEATURES)
    assert rows(one.where(cut), *columns) == rows(two.where(cut), *columns)


def test_values(spark, day):
    got = {r["date"]: r for r in calendar_features(sample(spark, day)).where("client = 'a'").collect()}
    first, d4, d5, d6 = (got[day(f"2024-01-0{i}")] for i in (1, 4, 5, 6))
    assert (first["days_since_last"], first["cnt_30d"], first["avg_amount_7d"]) == (365, 0, 0.0)
    assert (d4["days_since_last"], d4["cnt_3d"], d4["dow"], d4["is_quincena"]) == (1, 1, 3, 0)
    assert (d5["days_since_last"], d5["avg_amount_7d"], d5["avg_skus_7d"]) == (2, 2.5, 0.5)
    assert (d6["days_since_last"], d6["cnt_3d"], d6["is_weekend"]) == (1, 2, 1)


def test_long_gap_is_not_capped(spark, day):
    start = day("2023-01-01")
    data = [("a", str(start), 1.0), ("b", str(start + timedelta(days=400)), 1.0)]
    out = calendar_features(daily(spark, day, data)).where("client = 'a'")
    assert out.agg(F.max("days_since_last")).first()[0] == 405


def test_one_exchange_by_client(spark, day):
    plan = calendar_features(sample(spark, day))._jdf.queryExecution().executedPlan().toString()
    main = plan.split("Subquery")[0] + plan[plan.rindex("Window"):]
    assert main.count("Exchange hashpartitioning(client") == 1
    assert "Join" not in plan
