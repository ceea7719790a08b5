"""Checked queries: scans, landing and sinks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from basketry import schemas, work_dir
from basketry.operators.recommend import merge_recommendations, recs_by_cluster
from basketry.plans.jobs import job_land
from basketry.schemas import RAW_TICKETS
from basketry.sources import landing, readers, writers
from basketry.sources.ledger import LANDED, read_ledger
from workload.oracle_views import oracle
from workload.registry import joined, query, rnd, rounded


CALENDAR_FRACTIONS = (
    "qty_tot", "amount_tot", "avg_amount_7d", "avg_amount_30d", "avg_skus_7d", "avg_skus_30d",
)


def _catalog_csv(fx) -> str:
    """A catalogue file whose every code also occurs padded, with another description."""
    path = work_dir(fx.spark, "catalog")
    part = fx.table("part").select(
        F.col("p_partkey").cast("string").alias("codigo_unico"),
        F.col("p_name").alias("description"),
        F.col("p_type").alias("category"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("name"),
    )
    padded = part.withColumn("codigo_unico", F.concat(F.lit(" "), "codigo_unico", F.lit("  ")))
    padded = padded.withColumn("description", F.concat(F.lit("zz "), "description"))
    part.unionByName(padded).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return path


@query(
    "scan_parquet",
    "SELECT * FROM orders",
)
def _scan_parquet(fx):
    return readers.scan_parquet(fx.spark, f"{fx.folder}/orders.parquet")


@query(
    "sink_parquet",
    oracle(f"SELECT date_sale, id_client, product, {rnd('quantity')} AS quantity, {rnd('amount_paid')} AS amount_paid FROM product_day"),
)
def _sink_parquet(fx):
    path = work_dir(fx.spark, "product_day")
    writers.sink_parquet(fx.product_day, path)
    return rounded(readers.scan_parquet(fx.spark, path))


@query("load_catalog", oracle("SELECT product, description FROM fx_catalog"))
def _load_catalog(fx):
    return readers.load_catalog(fx.spark, _catalog_csv(fx))


@query(
    "load_catalog_wide",
    """SELECT cast(p_partkey AS VARCHAR) AS product, p_name AS description, p_type AS category,
              concat(p_brand, ' ', p_name) AS name FROM part""",
)
def _load_catalog_wide(fx):
    return readers.load_catalog_wide(fx.spark, _catalog_csv(fx))


@query(
    "load_calendar",
    oracle(f"""SELECT * REPLACE ({", ".join(f"{rnd(c)} AS {c}" for c in CALENDAR_FRACTIONS)}) FROM calendar"""),
)
def _load_calendar(fx):
    path = work_dir(fx.spark, "calendar")
    stored = fx.calendar.withColumn("date", F.col("date").cast("timestamp"))
    writers.sink_parquet(stored.withColumn("client", F.col("client").cast("long")), path)
    return rounded(readers.load_calendar(fx.spark, path))


@query(
    "scan_raw_months",
    oracle("""SELECT ID, date_sale, identification_doct,
                CASE WHEN year(date_sale) >= 1998 THEN domicilio_status END AS domicilio_status
              FROM raw_orders"""),
)
def _scan_raw_months(fx):
    """Months before 1998 are landed without one column; the scan brings it back as null."""
    path = work_dir(fx.spark, "raw")
    tickets = fx.raw_tickets.withColumn("month", F.date_format("date_sale", "yyyy-MM"))
    late = F.year("date_sale") >= 1998
    tickets.where(~late).drop("domicilio_status").write.partitionBy("month").parquet(path)
    tickets.where(late).write.mode("append").partitionBy("month").parquet(path)
    columns = ("ID", "date_sale", "identification_doct", "domicilio_status")
    return readers.scan_raw_months(fx.spark, path).select(*columns)


@query(
    "scan_vip",
    oracle("""SELECT tiket_id, date_sale, user_id, tiket_price, amount, category, product_name, tax,
                id_point_sale, domicilio_status FROM fx_vip_lines WHERE tiket_price > 0"""),
)
def _scan_vip(fx):
    """Only the older CSV form exists here, so the reader has to fall back to it."""
    base = work_dir(fx.spark, "vip")
    fx.vip_lines.write.option("header", True).csv(f"{base}/csv")
    return readers.scan_vip(fx.spark, f"{base}/parquet", f"{base}/csv")


@query(
    "land_raw_months",
    oracle("""SELECT ID, date_sale, strftime(date_sale, '%Y-%m') AS month, id_point_sale FROM raw_orders
              WHERE year(date_sale) <> 1996 AND date_sale < DATE '2001-01-01'"""),
)
def _land_raw_months(fx):
    """1996 is landed already, 2001 is the future; every ticket arrives twice."""
    done = fx.raw_tickets.where(F.year("date_sale") == 1996).select(
        F.date_format("date_sale", "yyyy-MM").alias("month")
    )
    twice = fx.raw_tickets.unionByName(fx.raw_tickets)
    due = landing.months_to_land(twice, done, F.lit("2000-12-31").cast("date"))
    path = work_dir(fx.spark, "landed")
    writers.overwrite_partitions(due, path, ["month"])
    landed = readers.scan_raw_months(fx.spark, path)
    return landed.select("ID", "date_sale", F.col("month").cast("string").alias("month"), "id_point_sale")


@query(
    "job_land",
    oracle("""SELECT month, cast(count(*) AS BIGINT) AS rows, cast(1 AS BIGINT) AS landings FROM (
                SELECT strftime(date_sale, '%Y-%m') AS month FROM raw_orders WHERE date_sale < DATE '2001-01-01')
              GROUP BY 1"""),
)
def _job_land(fx):
    """The ledger after three landings: up to 1996, up to 2000, and nothing more the same day."""
    base = work_dir(fx.spark, "land")
    writers.sink_parquet(fx.raw_tickets.unionByName(fx.raw_tickets).select(*RAW_TICKETS.names), f"{base}/tickets")
    for day in (date(1996, 12, 31), date(2000, 12, 31), date(2000, 12, 31)):
        job_land(fx.spark, f"{base}/tickets", f"{base}/landed", f"{base}/ledger", day)
    landed = readers.scan_raw_months(fx.spark, f"{base}/landed")
    entries = read_ledger(fx.spark, f"{base}/ledger", LANDED).groupBy("month").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("landings")
    )
    found = landed.groupBy(F.col("month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("rows"))
    return entries.join(found, ["month", "rows"], "left_semi")


@query(
    "landing_coverage",
    oracle("""SELECT cast(d AS DATE) AS day FROM (
                SELECT unnest(generate_series(DATE '2001-06-01', DATE '2002-02-28', INTERVAL 1 DAY)) AS d)
              WHERE cast(d AS DATE) NOT IN (SELECT date_sale FROM raw_orders)"""),
)
def _landing_coverage(fx):
    tickets = fx.table("orders").select(F.to_date("o_orderdate").alias("date_sale"))
    start, end = F.lit("2001-06-01").cast("date"), F.lit("2002-03-01").cast("date")
    return landing.landing_coverage(tickets, start, end)


@query(
    "load_contacts",
    oracle("SELECT client AS user_id, name, concat('3', client) AS phone, country FROM fx_contacts"),
)
def _load_contacts(fx):
    """Landed records carry source names, padded ids and a second copy of every person."""
    records = fx.contacts.select(
        F.concat(F.lit(" "), "client").alias("document"),
        "name",
        F.concat(F.lit("3"), "client").alias("cellphone"),
        "country",
        F.lit("x").alias("not_wanted"),
    )
    copies = records.withColumn("name", F.concat("name", F.lit(" (2)")))
    return readers.load_contacts(records.unionByName(copies), "user_id")


@query(
    "load_predictions_csv",
    oracle("SELECT strftime(date, '%Y-%m-%d') AS date, client, " + rnd("prob") + " AS prob FROM scored WHERE prob >= 0.5"),
)
def _load_predictions_csv(fx):
    path = work_dir(fx.spark, "predictions")
    chosen = rounded(fx.scored.where(F.col("prob") >= 0.5).select("date", "client", "prob"))
    writers.sink_csv(chosen, path, [F.asc("date"), F.desc("prob")])
    return readers.load_predictions_csv(fx.spark, path)


@query(
    "load_recs_optional",
    oracle("""SELECT s.client, s.date, c.top_product FROM scored s LEFT JOIN (
                SELECT client, min(product) AS top_product FROM c_top WHERE rank = 1 GROUP BY 1) c USING (client)
              WHERE prob >= 0.5"""),
)
def _load_recs_optional(fx):
    """One table was written and is joined, the other never was and is skipped."""
    from basketry.operators.recommend import filter_calendar_months, filter_prob, topn_per_client

    base = work_dir(fx.spark, "recs")
    top = topn_per_client(filter_calendar_months(fx.tx, 3), 1)
    recs = top.select("client", F.col("product").alias("recommended_product"))
    writers.sink_parquet(recs, f"{base}/item")
    out = filter_prob(fx.scored, 0.5).select("client", "date")
    for name in ("item", "cluster"):
        out = merge_recommendations(out, readers.load_recs_optional(fx.spark, f"{base}/{name}"), name)
    return out.withColumnRenamed("recommended_product", "top_product")


@query(
    "empty_typed_output",
    oracle("""SELECT id_client AS client, 0 AS purchase_pattern_cluster, product AS segment,
                product AS segment_label, product AS recommended_products
              FROM valid WHERE date_sale > (SELECT max(date_sale) FROM valid)"""),
)
def _empty_typed_output(fx):
    """No sales in the window: the recommendation table keeps its columns and types."""
    none = fx.valid.where(F.col("date_sale") > fx.valid.agg(F.max("date_sale")).scalar())
    from basketry.operators.patterns import segmentation_features
    from basketry.operators.segmentation import label_segments_5

    features = segmentation_features(none).withColumn("cluster", F.lit(0))
    recs = recs_by_cluster(none, label_segments_5(features), fx.catalog)
    typed = readers.empty_table(fx.spark, schemas.CLUSTER_RECS)
    return joined(typed.unionByName(recs))


@query(
    "sink_csv",
    oracle(f"""SELECT strftime(date, '%Y-%m-%d') AS date, client, printf('%.4f', {rnd('prob')}) AS prob
               FROM scored WHERE prob >= 0.5"""),
)
def _sink_csv(fx):
    path = work_dir(fx.spark, "csv")
    chosen = rounded(fx.scored.where(F.col("prob") >= 0.5).select("date", "client", "prob"))
    writers.sink_csv(chosen, path, [F.asc("date"), F.desc("prob")])
    return fx.spark.read.option("header", True).csv(path)


@query(
    "sink_metrics",
    oracle("""SELECT count(*) FILTER (purchased = 1 AND prob >= 0.5) AS tp,
                count(*) FILTER (purchased = 0 AND prob >= 0.5) AS fp,
                count(*) FILTER (purchased = 1 AND prob < 0.5) AS fn,
                count(*) FILTER (purchased = 0 AND prob < 0.5) AS tn FROM scored"""),
)
def _sink_metrics(fx):
    from basketry.operators.metrics import confusion_counts

    path = work_dir(fx.spark, "metrics")
    writers.sink_metrics(confusion_counts(fx.scored, "purchased", "prob", 0.5), path)
    return fx.spark.read.schema("tp long, fp long, fn long, tn long").json(path)


