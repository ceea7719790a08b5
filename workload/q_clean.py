"""Checked queries: nested data, normalisation, filters, duplicates and unions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from basketry import materialise, work_dir
from basketry.functions.text import parse_literal_list
from basketry.operators import clean, metrics, patterns, recommend, segmentation
from basketry.plans.jobs import job_load, regular_ids
from basketry.schemas import RAW_TICKETS, SALES_VALUE
from basketry.sources import writers
from basketry.sources.months import read_months
from basketry.streaming.sync import start_sync
from workload.fixtures import FX_EXCLUDED, FX_PATTERNS
from workload.oracle_views import EXCLUDED, VALUE, oracle
from workload.registry import query, rnd, rounded

LINE = f"product, amount, {rnd(VALUE)} AS {VALUE}, tax"


@query("explode_details", oracle(f"SELECT ID, date_sale, identification_doct, {LINE} FROM raw_lines"))
def _explode_details(fx):
    out = clean.explode_details(fx.raw_tickets)
    return rounded(out.select("ID", "date_sale", "identification_doct", "product", "amount", SALES_VALUE, "tax")).withColumns(
        {c: F.round(c, 4) for c in ("amount", "tax")}
    )


@query(
    "explode_details_strict",
    oracle(f"SELECT ID, id_point_sale, product, {rnd(VALUE)} AS {VALUE} FROM raw_lines WHERE product IS NOT NULL"),
)
def _explode_details_strict(fx):
    out = clean.explode_details_strict(fx.raw_tickets)
    return rounded(out.select("ID", "id_point_sale", "product", SALES_VALUE))


@query(
    "parse_details",
    oracle("""SELECT ID, product, amount, CASE WHEN tax > 0 THEN tax END AS tax FROM raw_lines
              WHERE product IS NOT NULL AND ID % 10 <> 3"""),
)
def _parse_details(fx):
    """Details as the text of a Python list; zero taxes are written ``None`` and the
    text of every tenth ticket is cut short."""
    one = F.format_string(
        "{'product': '%s', 'amount': %s, 'tax': %s}",
        F.col("l_partkey").cast("string"),
        F.col("l_quantity").cast("string"),
        F.when(F.col("l_tax") > 0, F.col("l_tax").cast("string")).otherwise(F.lit("None")),
    )
    texts = fx.table("lineitem").groupBy(F.col("l_orderkey").alias("ID")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(one), ", "), F.lit("]")).alias("text")
    )
    cut = F.when(F.col("ID") % 10 == 3, F.expr("left(text, length(text) - 3)")).otherwise(F.col("text"))
    details = texts.select("ID", parse_literal_list(cut).alias("invoice_details"))
    return clean.explode_details_strict(details).select("ID", "product", "amount", "tax")


@query(
    "flatten_struct",
    oracle("""SELECT ID, identification_doct AS "doc.id", id_point_sale AS "doc.store.code",
                domicilio_status AS "doc.store.status" FROM raw_orders"""),
)
def _flatten_struct(fx):
    store = F.struct(F.col("id_point_sale").alias("code"), F.col("domicilio_status").alias("status"))
    nested = fx.raw_tickets.select(
        "ID", F.struct(F.col("identification_doct").alias("id"), store.alias("store")).alias("doc")
    )
    return clean.flatten_struct(nested)


@query(
    "rename_vip",
    oracle(f"""SELECT ID AS tiket_id, date_sale, identification_doct AS user_id,
                invoice_value_without_iva_and_discount AS tiket_price, amount, tax, id_point_sale,
                domicilio_status FROM raw_lines WHERE product IS NOT NULL"""),
)
def _rename_vip(fx):
    return clean.rename_vip(clean.explode_details_strict(fx.raw_tickets))


@query(
    "normalise_sales",
    oracle(f"""SELECT ID, date_sale, trim(identification_doct) AS id_client, product, {rnd(VALUE)} AS {VALUE}
               FROM raw_lines WHERE product IS NOT NULL"""),
)
def _normalise_sales(fx):
    out = clean.normalise_sales(clean.explode_details(fx.raw_tickets))
    return rounded(out.select("ID", "date_sale", "id_client", "product", SALES_VALUE))


@query(
    "iso_week_key",
    oracle("""SELECT tiket_id, cast(year(date_sale) AS INTEGER) AS anio, cast(weekofyear(date_sale) AS INTEGER) AS semana,
                concat(year(date_sale), '-', weekofyear(date_sale)) AS periodo_unico FROM tickets"""),
)
def _iso_week_key(fx):
    return clean.iso_week_key(fx.tickets).select("tiket_id", "anio", "semana", "periodo_unico")


@query(
    "normalise_tx",
    oracle(f"SELECT client, date, product, {rnd('quantity')} AS quantity, {rnd('amount_paid')} AS amount_paid FROM tx"),
)
def _normalise_tx(fx):
    padded = fx.product_day.withColumn("product", F.concat(F.lit("\t"), "product", F.lit(" ")))
    return rounded(recommend.normalise_tx(padded))


@query(
    "literal_target",
    oracle(f"""SELECT id_client AS client, date_sale AS date, {rnd('sum(amount)')} AS qty_tot, 1 AS purchased
               FROM valid GROUP BY 1, 2"""),
)
def _literal_target(fx):
    return rounded(patterns.agg_daily_client(fx.product_day).select("client", "date", "qty_tot", "purchased"))


# --- filters ------------------------------------------------------------------------


@query(
    "validate_client_ids",
    oracle(f"SELECT src_order, src_line, id_client, product, {rnd(VALUE)} AS {VALUE} FROM valid"),
)
def _validate(fx):
    return rounded(fx.valid.select("src_order", "src_line", "id_client", "product", SALES_VALUE))


@query(
    "id_rejection_report",
    oracle("SELECT reason, count(*) AS rows, count(DISTINCT cid) AS clients FROM ids GROUP BY 1"),
)
def _id_report(fx):
    return clean.id_rejection_report(fx.sales)


@query(
    "trim_window",
    oracle(f"""SELECT src_order, src_line, date_sale, id_client, product FROM fx_sales
               WHERE date_sale >= (SELECT max(date_sale) FROM fx_sales) - 180"""),
)
def _trim_window(fx):
    return clean.trim_window(fx.sales, 6).select("src_order", "src_line", "date_sale", "id_client", "product")


@query(
    "filter_recent_clients",
    oracle("SELECT src_order, src_line, date_sale, id_client, product FROM recent"),
)
def _recent(fx):
    out = patterns.filter_recent_clients(fx.valid, 3)
    return out.select("src_order", "src_line", "date_sale", "id_client", "product")


PATTERN = f"id_client, purchase_days, {rnd('median_days_between')} AS median_days_between, {rnd('std_days_between')} AS std_days_between, product_distinct"


@query("filter_patterns", oracle(f"SELECT {PATTERN} FROM kept"))
def _filter_patterns(fx):
    return rounded(regular_ids(fx.valid, FX_PATTERNS))


@query(
    "filter_vip_weeks",
    oracle("""SELECT tiket_id, user_id, product_name, amount FROM fx_vip_lines WHERE user_id IN (
                SELECT user_id FROM fx_vip_lines GROUP BY 1
                HAVING count(DISTINCT concat(year(date_sale), '-', weekofyear(date_sale))) >= 10)"""),
)
def _vip_weeks(fx):
    out = clean.filter_vip_weeks(clean.iso_week_key(fx.vip_lines), 10)
    return out.select("tiket_id", "user_id", "product_name", "amount")


@query(
    "filter_positive_ticket",
    "SELECT o_orderkey AS tiket_id, o_totalprice - 250000 AS tiket_price FROM orders WHERE o_totalprice > 250000",
)
def _positive(fx):
    shifted = fx.table("orders").select(
        F.col("o_orderkey").alias("tiket_id"), (F.col("o_totalprice") - 250000).alias("tiket_price")
    )
    return clean.filter_positive_ticket(shifted)


@query(
    "exclude_products",
    oracle(f"""SELECT src_order, src_line, product, description FROM valid JOIN (
                 SELECT product, description FROM fx_catalog) USING (product)
               WHERE description NOT IN ({EXCLUDED})"""),
)
def _exclude(fx):
    out = clean.exclude_products(fx.valid.join(fx.catalog, "product", "left"), FX_EXCLUDED)
    return out.select("src_order", "src_line", "product", "description")


@query(
    "filter_calendar_months",
    oracle("SELECT client, date, product FROM tx WHERE date >= (SELECT max(date) FROM tx) - INTERVAL 3 MONTH"),
)
def _calendar_months(fx):
    return recommend.filter_calendar_months(fx.tx, 3).select("client", "date", "product")


@query(
    "filter_dates",
    oracle("""SELECT client, date, purchased, cnt_7d FROM calendar
              WHERE date IN (DATE '2024-01-15', DATE '2024-01-31', DATE '2024-02-02')"""),
)
def _filter_dates(fx):
    out = recommend.filter_dates(fx.calendar, ["2024-01-15", "2024-01-31", "2024-02-02"])
    return out.select("client", "date", "purchased", "cnt_7d")


@query("filter_prob", oracle("SELECT client, date, prob FROM scored WHERE prob >= 0.5"))
def _filter_prob(fx):
    return recommend.filter_prob(fx.scored, 0.5).select("client", "date", "prob")


@query(
    "known_clients",
    oracle("""SELECT cast(ts AS DATE) AS date, cast(10000000 + user_id AS VARCHAR) AS client, event_id FROM events
              WHERE event_type = 'click' AND cast(10000000 + user_id AS VARCHAR) IN (SELECT client FROM fx_daily)"""),
)
def _known_clients(fx):
    clicks = fx.table("events").where(F.col("event_type") == "click").select(
        F.to_date("ts").alias("date"),
        (F.col("user_id") + 10000000).cast("string").alias("client"),
        "event_id",
    )
    return metrics.known_clients(clicks, fx.daily).select("date", "client", "event_id")


# --- set operations and duplicates ----------------------------------------------------


@query(
    "dedupe_keep_first",
    oracle(f"""SELECT date_sale, id_client, product, src_order, src_line, {rnd(VALUE)} AS {VALUE}, amount FROM (
                 SELECT *, row_number() OVER (PARTITION BY date_sale, id_client, product
                   ORDER BY src_order, src_line, {VALUE}, amount) AS r FROM valid) WHERE r = 1"""),
)
def _dedupe(fx):
    keys = ("date_sale", "id_client", "product")
    out = clean.dedupe_keep_first(fx.valid, keys, ("src_order", "src_line"))
    return out.select(*keys, "src_order", "src_line", F.round(F.col(SALES_VALUE) + 0.033e-4, 4).alias(SALES_VALUE), "amount")


@query(
    "union_by_name",
    oracle("""SELECT ID, date_sale, id_point_sale FROM raw_orders WHERE year(date_sale) < 1998
              UNION ALL SELECT ID, date_sale, NULL FROM raw_orders WHERE year(date_sale) >= 1998"""),
)
def _union(fx):
    tickets = fx.raw_tickets.select("ID", "date_sale", "id_point_sale")
    late = F.year("date_sale") >= 1998
    return clean.union_by_name(tickets.where(~late), tickets.where(late).drop("id_point_sale"))


@query("distinct_rows", oracle("SELECT tiket_id, user_id, tiket_price, date_sale FROM tickets"))
def _distinct_rows(fx):
    return segmentation.distinct_tickets(fx.vip_lines)


@query(
    "distinct_keys",
    oracle("""SELECT user_id, date_sale, product_name FROM (
                SELECT user_id, date_sale, product_name, row_number() OVER (
                  PARTITION BY user_id, date_sale ORDER BY product_name) AS r FROM fx_vip_lines) WHERE r = 1"""),
)
def _distinct_keys(fx):
    lines = fx.vip_lines.select("user_id", "date_sale", "product_name")
    return clean.dedupe_keep_first(lines, ("user_id", "date_sale"), ("product_name",))


SYNC_CUT = "2001-04-01"
SYNC_ORACLE = oracle(f"""
SELECT date_sale, id_client, product, {rnd(VALUE)} AS {VALUE}, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY date_sale, id_client, product
    ORDER BY date_sale >= DATE '{SYNC_CUT}', src_order, src_line, {VALUE}, amount) AS r FROM valid)
WHERE r = 1 AND date_sale >= (SELECT max(date_sale) FROM valid) - 180""")
SYNC_ORDER = ("src_order", "src_line", SALES_VALUE, "amount")


@query("incremental_sync", SYNC_ORACLE)
def _incremental_sync(fx):
    old = F.col("date_sale") < F.lit(SYNC_CUT).cast("date")
    out = clean.incremental_sync(fx.valid.where(old), fx.valid.where(~old), 6, SYNC_ORDER)
    return rounded(out)


@query("incremental_sync_stream", SYNC_ORACLE)
def _incremental_sync_stream(fx):
    """The same sync fed through a file stream in two runs over one state."""
    base = work_dir(fx.spark, "sync")
    old = F.col("date_sale") < F.lit(SYNC_CUT).cast("date")
    for part in (fx.valid.where(old), fx.valid.where(~old)):
        part.write.mode("append").parquet(f"{base}/in")
        start_sync(
            fx.spark, f"{base}/in", fx.valid.schema, f"{base}/sales", f"{base}/state", SYNC_ORDER
        ).awaitTermination()
    return rounded(read_months(fx.spark, f"{base}/sales", 6))


@query(
    "job_load",
    oracle(f"""SELECT date_sale, id_client, product FROM (
                 SELECT date_sale, trim(identification_doct) AS id_client, product FROM raw_lines
                 WHERE product IS NOT NULL AND regexp_full_match(trim(identification_doct), '[1-9][0-9]{{5,9}}')
                   AND trim(identification_doct) NOT IN ('7777777', '123456789')
                 GROUP BY 1, 2, 3)
               WHERE date_sale >= (SELECT max(date_sale) FROM valid) - 180"""),
)
def _job_load(fx):
    base = work_dir(fx.spark, "load")
    raw = materialise(fx.raw_tickets.select(*RAW_TICKETS.names), "raw")
    # Two days of loading: all tickets up to the cut, then those that came since.
    old = F.col("date_sale") < F.lit(SYNC_CUT).cast("date")
    for today, part in ((date.fromisoformat(SYNC_CUT), old), (date(2002, 1, 1), F.lit(True))):
        writers.sink_parquet(raw.where(part), f"{base}/raw-{today}")
        job_load(fx.spark, f"{base}/raw-{today}", f"{base}/sales", f"{base}/state", today)
    return read_months(fx.spark, f"{base}/sales", 6).select("date_sale", "id_client", "product")
