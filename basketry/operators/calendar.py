"""Client-by-day calendar with leakage-free features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.params import CalendarParams

MEASURES = ("qty_tot", "amount_tot", "skus", "purchased")


def _by_client():
    return W.partitionBy("client").orderBy("date")


def client_calendar(daily: DataFrame, future_days: int) -> DataFrame:
    """Every client on every day from the first date to the last plus ``future_days``.

    Each purchase row is stretched up to the day before the client's next purchase
    (the first one also back to the first date), so the dense table comes out of one
    shuffle of the sparse rows by client: no join with a list of days, and the
    feature windows that follow need no further exchange.
    """
    first, last = daily.agg(F.min("date")).scalar(), daily.agg(F.max("date")).scalar()
    stretched = daily.select(
        "client",
        "date",
        *MEASURES,
        F.when(F.lag("date").over(_by_client()).isNull(), first).otherwise(F.col("date")).alias("_from"),
        F.coalesce(F.date_sub(F.lead("date").over(_by_client()), 1), F.date_add(last, future_days)).alias("_to"),
    )
    days = stretched.select(
        "client", F.explode(F.sequence("_from", "_to")).alias("_day"), "date", *MEASURES
    )
    bought = F.col("_day") == F.col("date")
    return days.select(
        "client",
        F.col("_day").alias("date"),
        *[F.when(bought, F.col(c)).otherwise(F.lit(0)).cast(daily.schema[c].dataType).alias(c) for c in MEASURES],
    )


def add_date_features(df: DataFrame, paydays: Sequence[int]) -> DataFrame:
    """Weekday (Monday is 0), day, month, weekend and payday flags."""
    return df.withColumns(
        {
            "dow": F.weekday("date"),
            "dom": F.dayofmonth("date"),
            "month": F.month("date"),
            "is_weekend": F.weekday("date").isin(5, 6).cast("int"),
            "is_quincena": F.dayofmonth("date").isin(*paydays).cast("int"),
        }
    )


def add_recency(df: DataFrame, no_purchase_days: int) -> DataFrame:
    """Days since the last purchase strictly before the row; a constant when there is none."""
    earlier = _by_client().rowsBetween(W.unboundedPreceding, -1)
    previous = F.last(F.when(F.col("purchased") == 1, F.col("date")), ignorenulls=True).over(earlier)
    gap = F.coalesce(F.datediff(F.col("date"), previous), F.lit(no_purchase_days))
    return df.withColumn("days_since_last", gap)


def add_rolling_counts(df: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Purchases in the ``w`` rows before the day."""
    return df.withColumns(
        {
            f"cnt_{w}d": F.coalesce(F.sum("purchased").over(_by_client().rowsBetween(-w, -1)), F.lit(0))
            for w in windows
        }
    )


def add_rolling_means(df: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Mean amount and distinct products over the ``w`` rows before the day."""
    columns = {}
    for w in windows:
        before = _by_client().rowsBetween(-w, -1)
        for name, source in ((f"avg_amount_{w}d", "amount_tot"), (f"avg_skus_{w}d", "skus")):
            columns[name] = F.coalesce(F.avg(source).over(before), F.lit(0.0))
    return df.withColumns(columns)


def calendar_features(daily: DataFrame, params: CalendarParams = CalendarParams()) -> DataFrame:
    """The feature table the model reads; all windows share one sort by client and date."""
    df = client_calendar(daily, params.future_days)
    df = add_recency(df, params.no_purchase_days)
    df = add_rolling_counts(df, params.count_windows)
    df = add_rolling_means(df, params.mean_windows)
    return add_date_features(df, params.paydays)
