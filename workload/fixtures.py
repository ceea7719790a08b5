"""Input views built from the shared test tables.

Each view is one SQL text that runs unchanged on Spark and on DuckDB; only the names
in braces are filled in differently.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import configure, materialise
from basketry.operators.calendar import calendar_features
from basketry.operators.clean import filter_positive_ticket, validate_client_ids
from basketry.operators.patterns import agg_client_product_day, segmentation_features
from basketry.operators.segmentation import distinct_tickets, label_segments_vip, vip_features
from basketry.params import PatternParams

# Sparse test orders: with the default limits no client would pass.
FX_PATTERNS = PatternParams(min_purchase_days=6, max_median_days=160, max_std_days=190, min_products=5)
FX_SPLIT_DAYS = 10
FX_EXCLUDED = ("small ring", "red widget")
FX_YEAR = 1997

CLIENT_ID = """CASE o.o_custkey % 20
         WHEN 0 THEN concat('0', cast(1000000 + o.o_custkey AS VARCHAR(20)))
         WHEN 1 THEN concat('AB', cast(o.o_custkey AS VARCHAR(20)))
         WHEN 2 THEN '7777777'
         WHEN 3 THEN '123456789'
         WHEN 4 THEN cast(o.o_custkey % 1000 AS VARCHAR(20))
         WHEN 5 THEN concat('  ', cast(10000000 + o.o_custkey AS VARCHAR(20)), ' ')
         ELSE cast(10000000 + o.o_custkey AS VARCHAR(20)) END"""

VIEWS = {
    "fx_sales": f"""
SELECT cast(o.o_orderdate AS DATE) AS date_sale, {CLIENT_ID} AS id_client,
       cast(l.l_partkey AS VARCHAR(20)) AS product,
       l.l_extendedprice * (1 - l.l_discount) AS invoice_value_with_discount_and_without_iva,
       l.l_quantity AS amount, o.o_orderkey AS src_order, l.l_linenumber AS src_line
FROM {{lineitem}} l JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey""",
    "fx_catalog": """
SELECT cast(p_partkey AS VARCHAR(20)) AS product, p_name AS description FROM {part}""",
    "fx_daily": """
SELECT cast(10000000 + user_id AS VARCHAR(20)) AS client, cast(ts AS DATE) AS date,
       cast(count(*) AS DOUBLE) AS qty_tot, sum(value) AS amount_tot,
       count(DISTINCT props) AS skus, 1 AS purchased
FROM {events} WHERE event_type = 'purchase'
GROUP BY cast(10000000 + user_id AS VARCHAR(20)), cast(ts AS DATE)""",
    "fx_vip_lines": """
SELECT o.o_orderkey AS tiket_id, cast(o.o_orderdate AS DATE) AS date_sale,
       cast(10000000 + o.o_custkey AS VARCHAR(20)) AS user_id, o.o_totalprice AS tiket_price,
       l.l_quantity AS amount, p.p_type AS category, p.p_name AS product_name, l.l_tax AS tax,
       concat('S', cast(l.l_suppkey % 20 AS VARCHAR(20))) AS id_point_sale,
       o.o_orderstatus AS domicilio_status
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
                JOIN {part} p ON l.l_partkey = p.p_partkey""",
    "fx_contacts": """
SELECT cast(10000000 + c_custkey AS VARCHAR(20)) AS client, c_name AS name, n_name AS country
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey WHERE c_acctbal > 0""",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Fixtures:
    """The views of one data folder on one Spark session."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    @cached_property
    def sales(self) -> DataFrame:
        return self.view("fx_sales")

    @cached_property
    def valid(self) -> DataFrame:
        return validate_client_ids(self.sales)

    @cached_property
    def product_day(self) -> DataFrame:
        return agg_client_product_day(self.valid)

    @cached_property
    def tx(self) -> DataFrame:
        return self.product_day.withColumnsRenamed({"id_client": "client", "date_sale": "date"})

    @cached_property
    def catalog(self) -> DataFrame:
        return self.view("fx_catalog")

    @cached_property
    def daily(self) -> DataFrame:
        return self.view("fx_daily")

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar_features(self.daily)

    @cached_property
    def scored(self) -> DataFrame:
        """Calendar with a fixed score in place of a model."""
        z = F.lit(0.4) * F.col("cnt_7d") - F.lit(0.3) * F.col("days_since_last")
        return self.calendar.withColumn("prob", F.round(1 / (1 + F.exp(-z)), 6))

    @cached_property
    def vip_lines(self) -> DataFrame:
        return self.view("fx_vip_lines")

    @cached_property
    def contacts(self) -> DataFrame:
        return self.view("fx_contacts")

    @cached_property
    def tickets(self) -> DataFrame:
        return distinct_tickets(self.vip_lines)

    @cached_property
    def vip(self) -> DataFrame:
        return vip_features(filter_positive_ticket(self.vip_lines))

    @cached_property
    def vip_named(self) -> DataFrame:
        """VIP features with fixed cluster ids in place of K-Means, and their names."""
        cluster = (F.col("user_id").cast("long") % 4).cast("int")
        return label_segments_vip(self.vip.withColumn("cluster_id", cluster))

    def with_cluster(self, df: DataFrame, user: str = "user_id", k: int = 4) -> DataFrame:
        return df.withColumn("cluster_id", (F.col(user).cast("long") % k).cast("int"))

    @cached_property
    def tickets_cl(self) -> DataFrame:
        return self.with_cluster(self.tickets)

    @cached_property
    def lines_cl(self) -> DataFrame:
        return self.with_cluster(self.vip_lines)

    @cached_property
    def segment_features(self) -> DataFrame:
        return segmentation_features(self.valid)

    @cached_property
    def stored_calendar(self) -> DataFrame:
        """The calendar as a written table, as the model jobs read it."""
        return materialise(self.calendar, "calendar")

    @cached_property
    def stored_features(self) -> DataFrame:
        """The segmentation features as a written table, as the segment jobs read them."""
        return materialise(self.segment_features, "features")

    def profiled(self, k: int) -> DataFrame:
        """Segmentation features with fixed cluster ids in place of K-Means."""
        cluster = (F.col("id_client").cast("long") % k).cast("int")
        return self.stored_features.withColumn("cluster", cluster)

    @cached_property
    def raw_tickets(self) -> DataFrame:
        """Orders with their lines as an array of structs; empty for orders without lines."""
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("ID"),
            F.struct(
                F.col("l_partkey").cast("string").alias("product"),
                F.col("l_quantity").alias("amount"),
                (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias(
                    "invoice_value_with_discount_and_without_iva"
                ),
                F.col("l_tax").alias("tax"),
            ).alias("d"),
        )
        nested = lines.groupBy("ID").agg(F.collect_list("d").alias("invoice_details"))
        orders = self.spark.sql(
            f"""SELECT o_orderkey AS ID, cast(o_orderdate AS DATE) AS date_sale,
                {CLIENT_ID} AS identification_doct,
                o_totalprice AS invoice_value_without_iva_and_discount,
                concat('S', o_custkey % 20) AS id_point_sale, o_orderstatus AS domicilio_status
                FROM {{orders}} o""",
            orders=self.table("orders"),
        )
        joined = orders.join(nested, "ID", "left")
        kind = nested.schema["invoice_details"].dataType
        return joined.withColumn(
            "invoice_details", F.coalesce("invoice_details", F.array().cast(kind))
        )
