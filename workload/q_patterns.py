"""Checked queries: patterns, calendar, window functions and joins on clients."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry import work_dir
from basketry.operators import behaviour, calendar, clean, patterns, recommend
from basketry.params import CalendarParams
from basketry.plans import jobs
from basketry.sources import writers
from workload.fixtures import FX_PATTERNS
from workload.oracle_views import VALUE, oracle
from workload.q_clean import PATTERN
from workload.registry import query, rnd, rounded


def regular(fx):
    return jobs.regular_clients(fx.sales, FX_PATTERNS)


# --- aggregations -------------------------------------------------------------------

PRODUCT_DAY = f"date_sale, id_client, product, {rnd('quantity')} AS quantity, {rnd('amount_paid')} AS amount_paid"


@query("agg_client_product_day", oracle(f"SELECT {PRODUCT_DAY} FROM product_day"))
def _product_day(fx):
    return rounded(fx.product_day)


@query(
    "agg_daily_client",
    oracle(f"""SELECT id_client AS client, date_sale AS date, {rnd('sum(quantity)')} AS qty_tot,
                 {rnd('sum(amount_paid)')} AS amount_tot, count(DISTINCT product) AS skus, 1 AS purchased
               FROM product_day GROUP BY 1, 2"""),
)
def _daily(fx):
    return rounded(patterns.agg_daily_client(fx.product_day))


@query("purchase_patterns", oracle(f"SELECT {PATTERN} FROM patterns"))
def _patterns(fx):
    return rounded(patterns.purchase_patterns(patterns.filter_recent_clients(fx.valid, 3)))


@query(
    "pay_amount_mean",
    oracle(f"""SELECT id_client, {rnd('avg(a)')} AS pay_amount_mean FROM (
                 SELECT id_client, date_sale, min_by({VALUE}, r) AS a FROM (
                   SELECT *, row_number() OVER (PARTITION BY id_client, date_sale ORDER BY product, {VALUE}) AS r
                   FROM valid) GROUP BY 1, 2) GROUP BY 1"""),
)
def _pay_amount_mean(fx):
    return rounded(patterns.pay_amount_mean(fx.valid))


@query(
    "segmentation_features",
    oracle(f"""SELECT id_client, {rnd('tickets_per_month')} AS tickets_per_month,
                 {rnd('months_active_ratio')} AS months_active_ratio, {rnd('ticket_median')} AS ticket_median,
                 {rnd('monetary_total')} AS monetary_total, {rnd('products_per_visit')} AS products_per_visit,
                 product_distinct FROM segment_features"""),
)
def _segmentation_features(fx):
    return rounded(fx.segment_features)


@query(
    "seg_monetary",
    oracle(f"""SELECT id_client, {rnd('median(amt)')} AS ticket_median, {rnd('sum(amt)')} AS monetary_total
               FROM daily_sales GROUP BY 1"""),
)
def _seg_monetary(fx):
    return rounded(patterns.seg_monetary(fx.valid))


@query(
    "seg_basket",
    oracle(f"""SELECT d.id_client, {rnd('avg(n)')} AS products_per_visit, any_value(v.k) AS product_distinct
               FROM daily_sales d JOIN (SELECT id_client, count(DISTINCT product) AS k FROM valid GROUP BY 1) v
                 USING (id_client) GROUP BY 1"""),
)
def _seg_basket(fx):
    return rounded(patterns.seg_basket(fx.valid))


@query(
    "dataset_profile",
    oracle("""SELECT count(*) AS rows, count(DISTINCT user_id) AS clients, count(DISTINCT tiket_id) AS tickets,
                min(date_sale) AS first_date, max(date_sale) AS last_date FROM fx_vip_lines"""),
)
def _profile(fx):
    return behaviour.dataset_profile(fx.vip_lines, "user_id", "tiket_id", "date_sale")


# --- calendar -------------------------------------------------------------------------

MEASURES = "client, date, qty_tot, round(amount_tot, 4) AS amount_tot, skus, purchased"
FEATURES = (
    "client, date, purchased, dow, dom, month, is_weekend, is_quincena, days_since_last, cnt_3d, cnt_7d, cnt_30d, "
    + ", ".join(f"{rnd(c)} AS {c}" for c in ("avg_amount_7d", "avg_amount_30d", "avg_skus_7d", "avg_skus_30d"))
)


@query("cross_client_calendar", oracle(f"SELECT {MEASURES} FROM calendar"))
def _calendar(fx):
    out = calendar.client_calendar(fx.daily, CalendarParams().future_days)
    return out.withColumn("amount_tot", F.round("amount_tot", 4))


@query("calendar_features", oracle(f"SELECT {FEATURES} FROM calendar"))
def _calendar_features(fx):
    names = [c.strip() for c in FEATURES.split(", round")[0].split(",")]
    means = ("avg_amount_7d", "avg_amount_30d", "avg_skus_7d", "avg_skus_30d")
    return rounded(fx.calendar.select(*names, *means))


@query("recency", oracle("SELECT client, date, purchased, days_since_last FROM calendar"))
def _recency(fx):
    days = calendar.client_calendar(fx.daily, 5)
    return calendar.add_recency(days, 365).select("client", "date", "purchased", "days_since_last")


@query("rolling_counts", oracle("SELECT client, date, cnt_3d, cnt_7d, cnt_30d FROM calendar"))
def _rolling_counts(fx):
    days = calendar.client_calendar(fx.daily, 5)
    return calendar.add_rolling_counts(days, (3, 7, 30)).select("client", "date", "cnt_3d", "cnt_7d", "cnt_30d")


@query(
    "rolling_means",
    oracle("SELECT client, date, " + ", ".join(f"{rnd(c)} AS {c}" for c in ("avg_amount_7d", "avg_skus_7d", "avg_amount_30d", "avg_skus_30d")) + " FROM calendar"),
)
def _rolling_means(fx):
    days = calendar.client_calendar(fx.daily, 5)
    out = calendar.add_rolling_means(days, (7, 30))
    return rounded(out.select("client", "date", "avg_amount_7d", "avg_skus_7d", "avg_amount_30d", "avg_skus_30d"))


@query(
    "job_featurize",
    oracle(f"SELECT {FEATURES} FROM calendar"),
)
def _job_featurize(fx):
    base = work_dir(fx.spark, "featurize")
    writers.sink_parquet(fx.daily, f"{base}/daily")
    jobs.job_featurize(fx.spark, f"{base}/daily", f"{base}/calendar")
    names = [c.strip() for c in FEATURES.split(", round")[0].split(",")]
    means = ("avg_amount_7d", "avg_amount_30d", "avg_skus_7d", "avg_skus_30d")
    return rounded(fx.spark.read.parquet(f"{base}/calendar").select(*names, *means))


# --- windows ----------------------------------------------------------------------------


@query("gap_days", oracle("SELECT id_client, date_sale, days_between FROM gaps"))
def _gap_days(fx):
    return patterns.gap_days(patterns.filter_recent_clients(fx.valid, 3))


@query("topn_per_client", oracle("SELECT client, product, cnt, rank FROM c_top"))
def _topn(fx):
    return recommend.topn_per_client(recommend.filter_calendar_months(fx.tx, 3), 5)


# --- joins --------------------------------------------------------------------------------


@query("semi_join_ids", oracle("SELECT src_order, src_line, id_client, product FROM recent WHERE id_client IN (SELECT id_client FROM kept)"))
def _semi(fx):
    return regular(fx).select("src_order", "src_line", "id_client", "product")


@query(
    "join_top_pairs",
    oracle("SELECT DISTINCT t.client, t.date, t.product FROM c_tx t JOIN c_top USING (client, product)"),
)
def _top_pairs(fx):
    tx = recommend.filter_calendar_months(fx.tx, 3).select("client", "date", "product")
    return recommend.join_top_pairs(tx, recommend.topn_per_client(tx, 5))


@query("join_features_left", oracle(
    f"""SELECT d.id_client, {rnd('d.m')} AS ticket_median, p.purchase_days
        FROM (SELECT id_client, median(amt) AS m FROM daily_sales GROUP BY 1) d
        LEFT JOIN patterns p USING (id_client)"""))
def _features_left(fx):
    money = patterns.seg_monetary(fx.valid).select("id_client", "ticket_median")
    found = patterns.purchase_patterns(patterns.filter_recent_clients(fx.valid, 3))
    return rounded(money.join(found.select("id_client", "purchase_days"), "id_client", "left"))


@query(
    "job_preprocess",
    oracle(f"""SELECT id_client AS client, date_sale AS date, {rnd('sum(amount)')} AS qty_tot,
                 {rnd(f'sum({VALUE})')} AS amount_tot, count(DISTINCT product) AS skus, 1 AS purchased
               FROM recent WHERE id_client IN (SELECT id_client FROM kept) GROUP BY 1, 2"""),
)
def _job_preprocess(fx):
    base = work_dir(fx.spark, "preprocess")
    writers.sink_parquet(fx.sales.select(*clean.SALES_COLUMNS), f"{base}/sales")
    jobs.job_preprocess(fx.spark, f"{base}/sales", f"{base}/product_day", f"{base}/daily", FX_PATTERNS)
    return rounded(fx.spark.read.parquet(f"{base}/daily"))


@query(
    "sort_multi",
    oracle(f"""SELECT id_client, date_sale, product, {rnd('amount_paid')} AS amount_paid FROM product_day
               ORDER BY id_client NULLS LAST, amount_paid DESC NULLS LAST"""),
)
def _sort(fx):
    df = rounded(fx.product_day.select("id_client", "date_sale", "product", "amount_paid"))
    return behaviour.sort_multi(df, [("id_client", True), ("amount_paid", False)])


@query(
    "head_n",
    oracle(f"""SELECT product, {rnd('sum(amount)')} AS units FROM valid GROUP BY 1
               ORDER BY units DESC, product LIMIT 15"""),
)
def _head(fx):
    units = rounded(fx.valid.groupBy("product").agg(F.sum("amount").alias("units")))
    return behaviour.head_n(units, [("units", False), ("product", True)], 15)


