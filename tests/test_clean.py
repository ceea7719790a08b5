"""Cleaning rules and the traps behind them."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.functions.text import GENERIC_IDS, parse_literal_list, strip
from basketry.operators import clean
from basketry.schemas import RAW_TICKETS, SALES_VALUE


def test_strip_removes_every_kind_of_white_space(spark):
    df = spark.createDataFrame([("\t 12 \n",), ("　a b ",), (None,)], "s string")
    assert rows(df.select(strip("s"))) == [("12",), ("a b",), (None,)]


IDS = {
    "123457": True, "  987654321\t": True, "1234567890": False, "12345": False, "012345678": False,
    "12345a7": False, "7777777": False, "12345678901": False, "": False, None: False, "10000000": True,
    "١٢٣٤٥٦": False, "123456\n": False,
}


def test_validate_client_ids(spark):
    df = spark.createDataFrame([(k,) for k in IDS], "id_client string")
    kept = {r[0] for r in clean.validate_client_ids(df).collect()}
    assert kept == {k.strip() for k, ok in IDS.items() if ok}


def test_repeated_digit_outside_the_list_is_rejected(spark):
    df = spark.createDataFrame([("7777",), ("7778",)], "id_client string")
    assert rows(clean.validate_client_ids(df, min_length=3, max_length=5)) == [("7778",)]


def test_report_and_filter_agree(spark):
    df = spark.createDataFrame([(k,) for k in IDS] + [(g,) for g in GENERIC_IDS], "id_client string")
    report = {r["reason"]: r["rows"] for r in clean.id_rejection_report(df).collect()}
    assert report["valid"] == clean.validate_client_ids(df).count()
    assert sum(report.values()) == df.count()


TEXTS = [
    ("[{'product': 'a', 'amount': 1.5, 'tax': None}, {'product': 7, 'amount': 2}]", [("a", 1.5, None), ("7", 2.0, None)]),
    ("[{'product': 'None', 'amount': 1.0}]", [("None", 1.0, None)]),
    ("[{'product': 'a', 'amount': 1.5}, {'prod", []),
    ("oops", []),
    ("", []),
    ("[]", []),
    (None, []),
]


def test_parse_details(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXTS)], "i int, s string")
    out = df.select("i", parse_literal_list("s").alias("d")).orderBy("i").collect()
    got = [[(x["product"], x["amount"], x["tax"]) for x in r["d"]] for r in out]
    assert got == [e for _, e in TEXTS]


def raw(spark, day):
    line = lambda p: (p, 1.0, 10.0, 0.1)
    return spark.createDataFrame(
        [
            (1, day("2024-01-01"), " 123457 ", 20.0, "S1", "N", [line(" p1 "), line("p2")]),
            (2, day("2024-01-02"), "123457", 0.0, "S1", "N", []),
            (3, None, "123457", 5.0, "S1", "N", [line("p1")]),
            (4, day("2024-01-03"), "7777777", 5.0, "S1", "N", [line("p1")]),
            (5, day("2024-01-04"), "123457", 5.0, "S1", "N", [line(None)]),
        ],
        RAW_TICKETS,
    )


def test_explode_keeps_or_drops_empty_tickets(spark, day):
    assert clean.explode_details(raw(spark, day)).count() == 6
    assert clean.explode_details_strict(raw(spark, day)).count() == 5


def test_new_sales_drop_null_dates_products_and_bad_ids(spark, day):
    out = clean.clean_new_sales(raw(spark, day))
    assert rows(out, "date_sale", "id_client", "product") == [
        (day("2024-01-01"), "123457", "p1"), (day("2024-01-01"), "123457", "p2"),
    ]


def test_week_key_merges_late_december_with_january(spark, day):
    df = spark.createDataFrame([(day("2024-12-30"),), (day("2024-01-02"),)], "date_sale date")
    assert {r["periodo_unico"] for r in clean.iso_week_key(df).collect()} == {"2024-1"}
    assert {r["periodo_unico"] for r in clean.iso_week_key(df, iso_year=True).collect()} == {"2024-1", "2025-1"}


def test_exclusion_drops_null_descriptions(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "description string")
    assert rows(clean.exclude_products(df, ["a"])) == [("b",)]
    assert rows(clean.exclude_products(df, [])) == [("a",), ("b",)]


def sales(spark, day, data):
    return spark.createDataFrame(
        [(day(d), c, p, v, 1.0) for d, c, p, v in data],
        f"date_sale date, id_client string, product string, {SALES_VALUE} double, amount double",
    )


def test_sync_keeps_the_stored_line_and_the_window(spark, day):
    old = sales(spark, day, [("2024-01-01", "c", "p", 1.0), ("2024-06-01", "c", "p", 2.0)])
    new = sales(spark, day, [("2024-06-01", "c", "p", 0.5), ("2024-06-01", "c", "q", 3.0), ("2024-06-01", "c", "q", 2.5)])
    out = clean.incremental_sync(old, new, 1)
    assert rows(out, "product", SALES_VALUE) == [("p", 2.0), ("q", 2.5)]


def test_flatten_joins_names_by_dots(spark):
    df = spark.sql("select 1 as i, named_struct('a', 2, 'b', named_struct('c', 3)) as s")
    assert clean.flatten_struct(df).columns == ["i", "s.a", "s.b.c"]
    assert clean.flatten_struct(df, "s").columns == ["i", "a", "b.c"]


@pytest.mark.parametrize("copies", [1, 5000])
def test_dedupe_reduces_copies_before_the_exchange(spark, copies):
    df = spark.range(copies).select(F.lit("k").alias("k"), (-F.col("id")).alias("v"))
    out = clean.dedupe_keep_first(df, ["k"], ["v"])
    assert rows(out) == [("k", 1 - copies)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_texts_without_the_words_are_not_rewritten(spark):
    """Each rewriting is tried only where a plain look finds something to replace."""
    texts = ["[{'product': 'x'}]", "[{'product': 'None, ]'}]", "[{'product': None, 'tax': 1.0,},]", "[{'product': 'True', 'tax': None}]"]
    df = spark.createDataFrame([(t,) for t in texts], "s string").select(parse_literal_list("s").alias("d"))
    assert [[(x["product"], x["tax"]) for x in r["d"]] for r in df.collect()] == [
        [("x", None)], [("None, ]", None)], [(None, 1.0)], [("True", None)],
    ]
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("CASE WHEN") == plan.count("regexp_replace") == 4
