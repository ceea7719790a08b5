"""Purchase patterns per client, their filters, and the two sales aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.dates import days_cutoff, month_start, months_inclusive
from basketry.operators.clean import semi_join
from basketry.params import PatternParams
from basketry.schemas import SALES_VALUE


def filter_recent_clients(
    df: DataFrame, months: int, date_col: str = "date_sale", client_col: str = "id_client"
) -> DataFrame:
    """All rows of clients with a purchase in the last ``months`` x 30 days of the data."""
    cutoff = days_cutoff(df, months, date_col)
    recent = df.where(F.col(date_col) >= cutoff).select(client_col).distinct()
    return semi_join(df, recent, client_col)


def gap_days(
    df: DataFrame, client_col: str = "id_client", date_col: str = "date_sale"
) -> DataFrame:
    """Distinct purchase dates per client with the days since the previous one."""
    days = df.select(client_col, date_col).distinct()
    previous = F.lag(date_col).over(W.partitionBy(client_col).orderBy(date_col))
    return days.withColumn("days_between", F.datediff(F.col(date_col), previous))


def client_regularity(
    df: DataFrame,
    client_col: str = "id_client",
    date_col: str = "date_sale",
    product_col: str = "product",
) -> DataFrame:
    """Purchase patterns and the last purchase of every client, in one pass of the sales.

    Each line leaves two marks, its day and its product; distinct marks are what every
    measure counts. They are reduced where the lines are read, so a hot client shrinks
    to its days and products before its rows come together.
    """
    day = F.struct(F.col(date_col).alias("_day"), F.lit(None).cast("string").alias("_product"))
    item = F.struct(F.lit(None).cast("date").alias("_day"), F.col(product_col).alias("_product"))
    marks = df.select(client_col, F.explode(F.array(day, item)).alias("_m"))
    marks = marks.select(client_col, "_m.*").distinct()
    # Product marks have no day and sort first, so they take no part in the gaps.
    previous = F.lag("_day").over(W.partitionBy(client_col).orderBy(F.asc_nulls_first("_day")))
    return (
        marks.withColumn("_gap", F.datediff("_day", previous))
        .groupBy(client_col)
        .agg(
            F.count("_day").alias("purchase_days"),
            F.median("_gap").alias("median_days_between"),
            F.stddev_samp("_gap").alias("std_days_between"),
            F.count("_product").alias("product_distinct"),
            F.max("_day").alias("last_purchase"),
        )
    )


def purchase_patterns(
    df: DataFrame,
    client_col: str = "id_client",
    date_col: str = "date_sale",
    product_col: str = "product",
) -> DataFrame:
    """Purchase days, median and sample deviation of the gaps, distinct products."""
    return client_regularity(df, client_col, date_col, product_col).drop("last_purchase")


def pay_amount_mean(
    df: DataFrame,
    client_col: str = "id_client",
    date_col: str = "date_sale",
    product_col: str = "product",
    amount_col: str = SALES_VALUE,
    daily_total: bool = False,
) -> DataFrame:
    """Mean over purchase days of the first line's amount, or of the day's total.

    The first line of a day is the lowest (product, amount).
    """
    first = F.min(F.struct(F.col(product_col), F.col(amount_col).alias("_amount")))["_amount"]
    per_day = F.sum(amount_col) if daily_total else first
    return (
        df.groupBy(client_col, date_col)
        .agg(per_day.alias("_day"))
        .groupBy(client_col)
        .agg(F.avg("_day").alias("pay_amount_mean"))
    )


def filter_patterns(patterns: DataFrame, params: PatternParams = PatternParams()) -> DataFrame:
    """Clients regular enough to model; a client without two gaps has no deviation and fails."""
    kept = (
        (F.col("purchase_days") >= params.min_purchase_days)
        & (F.col("median_days_between") < params.max_median_days)
        & (F.col("std_days_between") <= params.max_std_days)
    )
    if params.min_products is not None:
        kept = kept & (F.col("product_distinct") >= params.min_products)
    return patterns.where(kept)


def agg_client_product_day(df: DataFrame) -> DataFrame:
    """Quantity and amount per client, product and day."""
    return df.groupBy("date_sale", "id_client", "product").agg(
        F.sum("amount").alias("quantity"), F.sum(SALES_VALUE).alias("amount_paid")
    )


def agg_daily_client(product_day: DataFrame) -> DataFrame:
    """Client-day totals with the target of the model.

    The input has one row per (day, client, product), so counting rows counts products.
    """
    return (
        product_day.groupBy(F.col("id_client").alias("client"), F.col("date_sale").alias("date"))
        .agg(
            F.sum("quantity").alias("qty_tot"),
            F.sum("amount_paid").alias("amount_tot"),
            F.count("product").alias("skus"),
        )
        .withColumn("purchased", F.lit(1))
    )


def segmentation_features(
    df: DataFrame,
    client_col: str = "id_client",
    date_col: str = "date_sale",
    product_col: str = "product",
    amount_col: str = SALES_VALUE,
) -> DataFrame:
    """Six features per client: frequency, ticket value, regularity and variety.

    Lines are first summed per client, day and product. Both branches below start from
    that one exchange; later groups are bounded by the calendar or the catalogue.
    """
    has_amount = amount_col in df.columns
    total_months = df.agg(months_inclusive(F.min(date_col), F.max(date_col))).scalar()
    amount = F.sum(amount_col) if has_amount else F.sum(F.lit(None).cast("double"))
    bought = df.groupBy(client_col, date_col, product_col).agg(amount.alias("_amount"))
    daily = bought.groupBy(client_col, date_col).agg(
        F.sum("_amount").alias("_amount"), F.count(product_col).alias("_products")
    )
    # The months of one client are a handful of values, so the set stays small.
    active = F.greatest(F.lit(1), F.size(F.collect_set(month_start(date_col))))
    visits = daily.groupBy(client_col).agg(
        (F.count(F.lit(1)) / active).alias("tickets_per_month"),
        (active / total_months).alias("months_active_ratio"),
        F.median("_amount").alias("ticket_median"),
        F.avg("_products").alias("products_per_visit"),
    )
    totals = bought.groupBy(client_col).agg(
        F.sum("_amount").alias("monetary_total"),
        F.countDistinct(product_col).alias("product_distinct"),
    )
    return visits.join(totals, client_col, "left")


def seg_monetary(
    df: DataFrame,
    client_col: str = "id_client",
    date_col: str = "date_sale",
    amount_col: str = SALES_VALUE,
) -> DataFrame:
    """Median day amount and total amount per client; nulls when there is no amount column."""
    if amount_col not in df.columns:
        none = F.lit(None).cast("double")
        return df.select(client_col).distinct().select(
            client_col, none.alias("ticket_median"), none.alias("monetary_total")
        )
    daily = df.groupBy(client_col, date_col).agg(F.sum(amount_col).alias("_amount"))
    return daily.groupBy(client_col).agg(
        F.median("_amount").alias("ticket_median"), F.sum("_amount").alias("monetary_total")
    )


def seg_basket(
    df: DataFrame,
    client_col: str = "id_client",
    date_col: str = "date_sale",
    product_col: str = "product",
) -> DataFrame:
    """Mean distinct products per visit and distinct products overall, per client."""
    daily = df.groupBy(client_col, date_col).agg(F.countDistinct(product_col).alias("_products"))
    per_visit = daily.groupBy(client_col).agg(F.avg("_products").alias("products_per_visit"))
    overall = df.groupBy(client_col).agg(F.countDistinct(product_col).alias("product_distinct"))
    return per_visit.join(overall, client_col, "left")
