"""Patterns, segments and behaviour on small tables."""

import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.operators import behaviour, patterns, segmentation
from basketry.operators.clean import filter_vip_weeks, iso_week_key
from basketry.params import PatternParams
from basketry.plans import jobs
from basketry.schemas import SALES_VALUE

SALES = f"date_sale date, id_client string, product string, {SALES_VALUE} double, amount double"


def sales(spark, day, data):
    return spark.createDataFrame([(day(d), c, p, v, 1.0) for d, c, p, v in data], SALES)


DATA = [
    ("2024-01-01", "a", "x", 5.0), ("2024-01-01", "a", "y", 1.0), ("2024-01-11", "a", "x", 4.0),
    ("2024-01-15", "a", "z", 6.0), ("2024-03-01", "b", "x", 2.0), ("2024-03-03", "b", None, 2.0),
    ("2024-01-02", "c", "x", 1.0),
]


def test_patterns(spark, day):
    got = {r["id_client"]: tuple(r)[1:] for r in patterns.purchase_patterns(sales(spark, day, DATA)).collect()}
    assert got["a"] == (3, 7.0, pytest.approx(statistics.stdev([10, 4])), 3)
    assert got["b"] == (2, 2.0, None, 1)
    assert got["c"] == (1, None, None, 1)


def test_one_gap_has_no_deviation_and_fails(spark, day):
    found = patterns.purchase_patterns(sales(spark, day, DATA))
    kept = patterns.filter_patterns(found, PatternParams(1, 100, 100, 1))
    assert rows(kept, "id_client") == [("a",)]
    # The median limit is strict, the deviation limit is not.
    assert patterns.filter_patterns(found, PatternParams(1, 7.0, 100, 1)).count() == 0
    assert patterns.filter_patterns(found, PatternParams(1, 8.0, statistics.stdev([10, 4]), None)).count() == 1


def test_recent_clients_keep_their_whole_history(spark, day):
    out = patterns.filter_recent_clients(sales(spark, day, DATA), 1)
    assert rows(out.select("id_client").distinct()) == [("b",)]
    # Cutoff 2024-01-03: a (four lines) and b (two) stay, c does not.
    assert patterns.filter_recent_clients(sales(spark, day, DATA), 2).count() == 4 + 2


def test_first_line_or_day_total(spark, day):
    df = sales(spark, day, DATA)
    first = {r[0]: r[1] for r in patterns.pay_amount_mean(df).collect()}
    total = {r[0]: r[1] for r in patterns.pay_amount_mean(df, daily_total=True).collect()}
    assert first["a"] == pytest.approx((5 + 4 + 6) / 3) and total["a"] == pytest.approx((6 + 4 + 6) / 3)


def test_segmentation_features(spark, day):
    got = {r["id_client"]: r for r in patterns.segmentation_features(sales(spark, day, DATA)).collect()}
    a = got["a"]
    assert (a["tickets_per_month"], a["months_active_ratio"]) == (3.0, pytest.approx(1 / 3))
    assert (a["ticket_median"], a["monetary_total"]) == (6.0, 16.0)
    assert (a["products_per_visit"], a["product_distinct"]) == (pytest.approx(4 / 3), 3)
    assert (got["b"]["products_per_visit"], got["b"]["product_distinct"]) == (0.5, 1)
    bare = patterns.segmentation_features(sales(spark, day, DATA).drop(SALES_VALUE))
    assert bare.where("ticket_median is not null").count() == 0


def test_regular_clients_is_the_same_as_its_steps(spark, day):
    data = [("2024-01-0%d" % d, c, p, 1.0) for d in (1, 3, 5, 7) for c in ("1234570", "1234571", "7777777") for p in "xy"]
    data += [("2023-01-0%d" % d, "1234572", p, 1.0) for d in (1, 3, 5, 7) for p in "xy"]
    df = sales(spark, day, data)
    params = PatternParams(3, 10, 5, 2)
    valid = jobs.validate_client_ids(df)
    recent = patterns.filter_recent_clients(valid, 3)
    ids = patterns.filter_patterns(patterns.purchase_patterns(recent), params)
    want = recent.join(ids.select("id_client"), "id_client", "left_semi").select(*df.columns)
    assert rows(jobs.regular_clients(df, params).select(*df.columns)) == rows(want) != []


def profiles(spark, means):
    return spark.createDataFrame(
        [(f"c{i}", i, *m) for i, m in enumerate(means)],
        "id_client string, cluster int, tickets_per_month double, ticket_median double, months_active_ratio double",
    )


def test_five_profiles(spark):
    df = profiles(spark, [(1.0, 50.0, 0.9), (2.0, 60.0, 0.9), (9.0, 20.0, 0.9), (5.0, 900.0, 0.9), (3.0, 990.0, 0.1)])
    got = {r["cluster"]: r["segment"] for r in segmentation.label_segments_5(df).collect()}
    assert got == {0: "mensual", 1: "cotidiano", 2: "hormiga", 3: "ballena", 4: "esporadico"}
    assert segmentation.label_segments_5(df).where("segment_label is null").count() == 0


@pytest.mark.parametrize("k,names", [(1, {"esporadico"}), (2, {"esporadico", "ballena"}),
                                     (3, {"esporadico", "ballena", "cotidiano"}),
                                     (7, {"esporadico", "ballena", "hormiga", "mensual", "cotidiano"})])
def test_other_numbers_of_clusters(spark, k, names):
    df = profiles(spark, [(1.0 + i, 10.0 * i, 0.1 + i / 10) for i in range(k)])
    got = segmentation.label_segments_5(df)
    assert {r["segment"] for r in got.collect()} == names and got.count() == k


def test_constant_profiles_do_not_divide_by_zero(spark):
    df = profiles(spark, [(1.0, 1.0, 1.0)] * 5)
    assert {r["cluster"]: r["segment"] for r in segmentation.label_segments_5(df).collect()}[0] == "esporadico"


def vip_lines(spark, day, data):
    return spark.createDataFrame(
        [(t, u, p, day(d), s) for t, u, p, d, s in data],
        "tiket_id long, user_id string, tiket_price double, date_sale date, id_point_sale string",
    )


def test_vip_features_count_a_ticket_once(spark, day):
    df = vip_lines(spark, day, [(1, "u", 10.0, "2024-01-01", "S2")] * 3 + [(2, "u", 30.0, "2024-01-05", "S1")] + [(3, "w", 5.0, "2024-01-07", "S1")])
    got = {r["user_id"]: tuple(r)[1:] for r in segmentation.vip_features(df).collect()}
    assert got["u"] == (20.0, 20.0, 40.0, pytest.approx(statistics.stdev([10, 30])), 2, 2)
    assert got["w"] == (5.0, 5.0, 5.0, 0.0, 1, 0)
    assert rows(segmentation.main_point_of_sale(df)) == [("u", "S2"), ("w", "S1")]


def test_store_ties_go_to_the_lower_name(spark, day):
    df = vip_lines(spark, day, [(1, "u", 1.0, "2024-01-01", s) for s in ("S2", "S1", None, None, None)])
    assert rows(segmentation.main_point_of_sale(df)) == [("u", "S1")]


def test_vip_names(spark):
    data = [(0, 10.0, 5), (0, 10.0, 5), (1, 90.0, 9), (2, 5.0, 50), (3, 20.0, 7)]
    df = spark.createDataFrame(data, "cluster_id int, ticket_promedio double, frecuencia_total int")
    got = {r["cluster_id"]: r["segment"] for r in segmentation.name_vip_clusters(df).collect()}
    assert got == {0: "masa_critica", 1: "ballenas", 2: "reposicion", 3: "intermedio"}


def test_export_has_fixed_columns_without_contacts(spark, day):
    seg = spark.createDataFrame([("u", 0, "n", "d")], "user_id string, cluster_id int, cluster_nombre string, cluster_descripcion string")
    stores = spark.createDataFrame([("u", "S1")], "user_id string, id_point_sale string")
    out = segmentation.export_vip(seg, stores)
    assert out.columns[:5] == ["user_id", "cluster_id", "cluster_nombre", "cluster_descripcion", "id_point_sale"]
    assert len(out.columns) == 13 and out.first()["email"] is None


def test_vip_weeks(spark, day):
    data = [(i, "u", 1.0, f"2024-0{1 + i // 4}-{1 + 7 * (i % 4):02d}", "S") for i in range(12)] + [(99, "w", 1.0, "2024-01-01", "S")]
    out = filter_vip_weeks(iso_week_key(vip_lines(spark, day, data)), 10)
    assert {r["user_id"] for r in out.collect()} == {"u"}


def test_decline_uses_medians_of_months(spark, day):
    data = [("u", m, 100.0 if m <= 7 else 10.0) for m in range(1, 13)] + [("w", m, 50.0) for m in range(1, 13)]
    df = spark.createDataFrame(
        [(i, u, p, day(f"2024-{m:02d}-01"), 0) for i, (u, m, p) in enumerate(data)],
        "tiket_id long, user_id string, tiket_price double, date_sale date, cluster_id int",
    )
    out = behaviour.declining_clients(df)
    assert rows(out, "user_id", "promedio_P1", "promedio_P2", "mediana_global") == [("u", 100.0, 10.0, 50.0)]
    trend = behaviour.decline_trend(df.where("month(date_sale) < 12"), out)
    assert trend.count() == 12 and trend.where("ticket_promedio is null").count() == 1
    summary = {r["cluster_id"]: (r["clientes"], r["caidos"], r["pct_caidos"]) for r in behaviour.decline_summary(df.select("user_id", "cluster_id").distinct(), out).collect()}
    assert summary == {0: (2, 1, 50.0), None: (2, 1, 50.0)}


def test_core_and_premium(spark):
    top = spark.createDataFrame([(0, "a", "hi"), (1, "a", "lo"), (0, "b", "hi"), (1, "c", "lo")], "cluster_id int, product_name string, segment string")
    assert rows(behaviour.core_products(top)) == [("a",)]
    assert rows(behaviour.premium_products(top, ["hi"], "segment")) == [("b",)]


def test_matrix_fills_with_the_median(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", None), ("d", 8.0)], "id string, f double")
    got = {r["id"]: r["f_z"] for r in segmentation.prepare_cluster_matrix(df, ["f"]).collect()}
    mean, dev = (1 + 3 + 3 + 8) / 4, statistics.pstdev([1, 3, 3, 8])
    assert got == {k: pytest.approx((v - mean) / dev) for k, v in {"a": 1, "b": 3, "c": 3, "d": 8}.items()}
    flat = segmentation.prepare_cluster_matrix(df.withColumn("f", F.lit(2.0)), ["f"])
    assert {r["f_z"] for r in flat.collect()} == {0.0}


def test_descriptive_tables_read_their_input_once(spark, tmp_path):
    values = [float(i % 97) for i in range(1000)] + [1e6, None]
    source = spark.createDataFrame([(v, None if v is None else -v, None) for v in values], "a double, b double, e double")
    source.write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    histogram = behaviour.value_histogram(df, ["a", "b", "e"])
    tables = behaviour.bins_of_histogram(histogram), behaviour.describe_histogram(histogram)
    assert not any(str(tmp_path) in t._jdf.queryExecution().toString() for t in tables)
    bins = {(r["feature"], r["bin"]): r for r in behaviour.bins_of_histogram(histogram).collect()}
    table = {r["feature"]: r for r in behaviour.describe_histogram(histogram).collect()}
    a = [v for v in values if v is not None]
    assert table["a"]["count"] == 1001 and table["a"]["mean"] == pytest.approx(sum(a) / 1001)
    assert table["a"]["std"] == pytest.approx(statistics.stdev(a)) and table["b"]["max"] == 0
    assert table["a"]["q50"] == statistics.median(a) and table["b"]["q25"] == -table["a"]["q75"]
    assert sum(r["rows"] for k, r in bins.items() if k[0] == "a") == 1001 and len(bins) == 100
    assert "e" not in table
    described = {r["feature"]: r for r in behaviour.describe_features(source, ["a", "e"]).collect()}
    assert described["e"]["count"] == 0 and described["e"]["mean"] is None


def test_vip_features_read_their_lines_once(spark, day):
    """Everything after the distinct tickets reads those, not the lines."""
    from basketry.session import materialise

    data = [(1, "a", 10.0, day("2024-01-01")), (1, "a", 10.0, day("2024-01-01")), (2, "a", 30.0, day("2024-01-03"))]
    lines = materialise(spark.createDataFrame(data, "tiket_id long, user_id string, tiket_price double, date_sale date"), "lines")
    found = segmentation.vip_features(lines)
    assert not set(found.inputFiles()) & set(lines.inputFiles())
    assert [tuple(r)[:4] for r in found.collect()] == [("a", 20.0, 20.0, 40.0)]


def test_shuffled_lines_are_dealt_into_small_tasks(spark):
    """Lines are ten times larger in a task's hash table than in a shuffle."""
    from basketry import configure

    assert configure(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
