"""Behaviour over time: evolution, penetration, payday cycle, decline and cutback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.dates import month_start
from basketry.operators.order_stats import few_group_percentiles, percentiles_of_counts, value_counts
from basketry.params import DeclineParams
from basketry.session import materialise


def monthly_evolution(tickets: DataFrame) -> DataFrame:
    """Tickets, users, mean, median and tickets per user by cluster and month.

    A cluster's month holds any number of tickets, so its median goes through the
    histogram instead of one buffer.
    """
    monthly = tickets.withColumn("mes", month_start("date_sale"))
    totals = monthly.groupBy("cluster_id", "mes").agg(
        F.count("tiket_id").alias("total_tickets"),
        F.countDistinct("user_id").alias("usuarios_unicos"),
        F.avg("tiket_price").alias("valor_media"),
    )
    medians = few_group_percentiles(
        monthly, "tiket_price", {"valor_mediana": 0.5}, ["cluster_id", "mes"]
    )
    return totals.join(medians, ["cluster_id", "mes"], "left").withColumn(
        "frecuencia_promedio", F.col("total_tickets") / F.col("usuarios_unicos")
    )


def product_penetration(lines: DataFrame, top_n: int = 15) -> DataFrame:
    """Top products per cluster by the share of tickets that contain them."""
    per_product = (
        lines.dropna(subset=["product_name"])
        .groupBy("cluster_id", "product_name")
        .agg(F.countDistinct("tiket_id").alias("tickets"))
    )
    totals = lines.groupBy("cluster_id").agg(F.countDistinct("tiket_id").alias("_total"))
    order = W.partitionBy("cluster_id").orderBy(F.desc("tickets"), F.asc("product_name"))
    top = per_product.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)
    # One row per cluster on the broadcast side.
    return top.join(F.broadcast(totals), "cluster_id").select(
        "cluster_id",
        "product_name",
        "tickets",
        "rank",
        (F.col("tickets") / F.col("_total") * 100).alias("penetration"),
    )


def core_products(top: DataFrame) -> DataFrame:
    """Products in the top list of every cluster."""
    clusters = top.agg(F.countDistinct("cluster_id")).scalar()
    return (
        top.groupBy("product_name")
        .agg(F.countDistinct("cluster_id").alias("_k"))
        .where(F.col("_k") == clusters)
        .select("product_name")
    )


def premium_products(top: DataFrame, high_value: Sequence[str], name_col: str) -> DataFrame:
    """Products in the top list of a high-value segment and of no other."""
    high = F.col(name_col).isin(*high_value)
    return (
        top.groupBy("product_name")
        .agg(F.bool_and(high).alias("_only_high"))
        .where("_only_high")
        .select("product_name")
    )


def day_of_month_spend(tickets: DataFrame) -> DataFrame:
    """Mean ticket by cluster and day of the month."""
    return tickets.groupBy("cluster_id", F.dayofmonth("date_sale").alias("dia_mes")).agg(
        F.avg("tiket_price").alias("gasto_promedio"), F.count(F.lit(1)).alias("tickets")
    )


# --- decline --------------------------------------------------------------------


def cluster_medians(tickets: DataFrame) -> DataFrame:
    """Median ticket per cluster."""
    return few_group_percentiles(tickets, "tiket_price", {"mediana_global": 0.5}, ["cluster_id"])


def declining_clients(
    tickets: DataFrame, params: DeclineParams = DeclineParams(), year: int | None = None
) -> DataFrame:
    """Clients at or above their cluster's median early in the year and below it later.

    Periods compare the medians of monthly mean tickets. Months are told apart by
    number only; ``year`` restricts a table that spans several years.
    """
    if year is not None:
        tickets = tickets.where(F.year("date_sale") == year)
    month = F.month("date_sale")
    monthly = tickets.groupBy("cluster_id", "user_id", month.alias("_mes")).agg(
        F.avg("tiket_price").alias("_mean")
    )

    def period(months: Sequence[int]):
        # At most twelve values per client.
        return F.median(F.when(F.col("_mes").isin(*months), F.col("_mean")))

    periods = monthly.groupBy("cluster_id", "user_id").agg(
        period(params.early_months).alias("promedio_P1"),
        period(params.late_months).alias("promedio_P2"),
    )
    p1, p2, middle = F.col("promedio_P1"), F.col("promedio_P2"), F.col("mediana_global")
    # One row per cluster on the broadcast side.
    return (
        periods.join(F.broadcast(cluster_medians(tickets)), "cluster_id")
        .where((p1 >= middle) & (p2 < middle))
        .withColumn("delta_caida", p1 - p2)
    )


def decline_trend(tickets: DataFrame, declined: DataFrame) -> DataFrame:
    """Mean ticket of the declined clients for each month number and cluster."""
    theirs = tickets.join(declined.select("cluster_id", "user_id"), ["cluster_id", "user_id"], "left_semi")
    means = theirs.groupBy("cluster_id", F.month("date_sale").alias("mes_num")).agg(
        F.avg("tiket_price").alias("ticket_promedio")
    )
    spine = tickets.select("cluster_id").distinct().select(
        "cluster_id", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mes_num")
    )
    return spine.join(means, ["cluster_id", "mes_num"], "left")


def decline_summary(segments: DataFrame, declined: DataFrame) -> DataFrame:
    """Clients, declined clients and their share per cluster; a null cluster is the total."""
    marked = segments.select("cluster_id", "user_id").join(
        declined.select("user_id", F.lit(1).alias("_down")), "user_id", "left"
    )
    counts = marked.rollup("cluster_id").agg(
        F.count(F.lit(1)).alias("clientes"), F.count("_down").alias("caidos")
    )
    share = F.coalesce(F.try_divide(F.col("caidos") * 100.0, F.col("clientes")), F.lit(0.0))
    return counts.withColumn("pct_caidos", share)


def full_outer_fill0(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with zero for what one side lacks."""
    joined = left.join(right, list(keys), "full_outer")
    measures = [c for c in joined.columns if c not in keys]
    return joined.fillna(0, subset=measures)


def product_cutback(
    lines: DataFrame, declined: DataFrame, params: DeclineParams = DeclineParams()
) -> DataFrame:
    """Products whose monthly units per declined client fell most, per cluster."""
    users = declined.groupBy("cluster_id").agg(F.countDistinct("user_id").alias("_users"))
    theirs = lines.dropna(subset=["product_name"]).join(
        declined.select("cluster_id", "user_id"), ["cluster_id", "user_id"], "left_semi"
    )
    month = F.month("date_sale")

    def units(months: Sequence[int]):
        total = F.sum(F.when(month.isin(*months), F.col("amount")))
        return F.coalesce(total, F.lit(0.0)) / len(months)

    both = (*params.early_months, *params.late_months)
    sums = (
        theirs.where(month.isin(*both))
        .groupBy("cluster_id", "product_name")
        .agg(units(params.early_months).alias("_p1"), units(params.late_months).alias("_p2"))
    )
    # One row per cluster on the broadcast side.
    change = sums.join(F.broadcast(users), "cluster_id").select(
        "cluster_id",
        "product_name",
        (F.col("_p1") / F.col("_users")).alias("avg_p1"),
        (F.col("_p2") / F.col("_users")).alias("avg_p2"),
    )
    change = change.withColumn("caida", F.col("avg_p1") - F.col("avg_p2"))
    order = W.partitionBy("cluster_id").orderBy(F.desc(F.round("caida", 9)), F.asc("product_name"))
    return change.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= params.top_n)


# --- descriptive tables -----------------------------------------------------------


def value_histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per feature and distinct value, stored: all descriptive numbers are read from it.

    The caller's table is read once; equal values collapse where they are read.
    """
    numeric = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = numeric.unpivot([], list(columns), "feature", "_value")
    return materialise(value_counts(long, ["feature"], "_value"), "histogram")


def _percentiles(histogram: DataFrame, probabilities: dict[str, float]) -> DataFrame:
    return percentiles_of_counts(histogram, probabilities, ["feature"])


def describe_histogram(histogram: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per feature of a :func:`value_histogram`."""
    v, n = F.col("_v"), F.col("_n")
    basic = histogram.groupBy("feature").agg(
        F.sum(n).alias("count"), (F.sum(v * n) / F.sum(n)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max")
    )
    # One row per feature on the broadcast sides.
    centred = histogram.join(F.broadcast(basic.select("feature", F.col("mean").alias("_mean"))), "feature")
    off = v - F.col("_mean")
    spread = centred.groupBy("feature").agg(F.sqrt(F.try_divide(F.sum(off * off * n), F.sum(n) - 1)).alias("std"))
    quartiles = _percentiles(histogram, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    joined = basic.join(F.broadcast(spread), "feature").join(quartiles, "feature", "left")
    return joined.select("feature", "count", "mean", "std", "min", "max", "q25", "q50", "q75")


def bins_of_histogram(histogram: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width bins per feature of a :func:`value_histogram`, cut at the 99th percentile."""
    caps = _percentiles(histogram, {"_hi": 0.99})
    bounds = histogram.groupBy("feature").agg(F.min("_v").alias("_lo")).join(caps, "feature")
    lo, hi = F.col("_lo"), F.col("_hi")
    share = F.coalesce(F.try_divide(F.least("_v", hi) - lo, hi - lo), F.lit(0.0))
    position = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
    # One row per feature on the broadcast side.
    filled = (
        histogram.join(F.broadcast(bounds), "feature").groupBy("feature", position.alias("bin")).agg(F.sum("_n").alias("_rows"))
    )
    width = (hi - lo) / bins
    spine = bounds.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return spine.join(filled, ["feature", "bin"], "left").select(
        "feature",
        "bin",
        (lo + F.col("bin") * width).alias("bin_start"),
        F.coalesce("_rows", F.lit(0)).alias("rows"),
    )


def describe_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per feature; empty features have count 0."""
    found = describe_histogram(value_histogram(df, columns))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return names.join(found, "feature", "left").withColumn("count", F.coalesce("count", F.lit(0)))


def histogram_p99(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins per feature after cutting values at the 99th percentile."""
    return bins_of_histogram(value_histogram(df, columns), bins)


def dataset_profile(
    df: DataFrame, client_col: str, ticket_col: str, date_col: str
) -> DataFrame:
    """Rows, distinct clients and tickets, first and last date."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(client_col).alias("clients"),
        F.countDistinct(ticket_col).alias("tickets"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
    )


# --- sorts ------------------------------------------------------------------------


def sort_multi(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """Sort by several columns, ``True`` for ascending; nulls come last either way."""
    return df.orderBy(
        *[F.asc_nulls_last(c) if ascending else F.desc_nulls_last(c) for c, ascending in keys]
    )


def head_n(df: DataFrame, keys: Sequence[tuple[str, bool]], n: int) -> DataFrame:
    """The first ``n`` rows of the sort; each task sends only its own best ``n``."""
    return sort_multi(df, keys).limit(n)
