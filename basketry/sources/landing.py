"""Landing of raw tickets by month."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.clean import dedupe_keep_first
from basketry.sources.ledger import LANDED, add_entries, read_ledger
from basketry.sources.writers import overwrite_partitions


def months_to_land(
    tickets: DataFrame,
    landed: DataFrame | None,
    today: Column,
    force: bool = False,
    order: Sequence[str] = ("date_sale",),
) -> DataFrame:
    """Tickets of months not landed yet, one row per ``ID``, with their ``month``.

    Months after ``today`` are skipped; ``force`` lands the others again. ``landed`` is
    a table with a ``month`` column, one row per month.
    """
    month = F.date_format("date_sale", "yyyy-MM")
    due = tickets.where(F.trunc("date_sale", "MM") <= F.trunc(today, "MM")).withColumn("month", month)
    if landed is not None and not force:
        due = due.join(landed.select("month").distinct(), "month", "left_anti")
    # Copies of one ticket inside one month, as each month is landed by itself.
    return dedupe_keep_first(due, ("month", "ID"), order)


def land(
    spark: SparkSession,
    tickets: DataFrame,
    landed_path: str,
    ledger_path: str,
    today: date,
    batch: str,
    force: Sequence[str] = (),
    order: Sequence[str] = ("date_sale",),
) -> list[str]:
    """Land the months of ``tickets`` that the ledger does not name; gives those months.

    Months in ``force`` are landed again, months after ``today`` never. Each month replaces
    its folder; the ledger gets its entry (month, files, rows, batch) last, so that months
    whose landing was cut off are landed again. Only tickets of the due months are read.
    """
    found = tickets.where(F.trunc("date_sale", "MM") <= F.trunc(F.lit(today), "MM"))
    present = {r[0] for r in found.select(F.date_format("date_sale", "yyyy-MM")).distinct().collect()}
    known = {r["month"] for r in read_ledger(spark, ledger_path, LANDED).select("month").distinct().collect()}
    due = sorted(m for m in present if m in force or m not in known)
    if not due:
        return []
    # The months' days as literals, so that row groups of other months are skipped.
    first, last = date.fromisoformat(f"{due[0]}-01"), F.last_day(F.lit(date.fromisoformat(f"{due[-1]}-01")))
    wanted = found.where(F.col("date_sale").between(F.lit(first), last))
    wanted = wanted.where(F.date_format("date_sale", "yyyy-MM").isin(due))
    rows = months_to_land(wanted, None, F.lit(today), order=order)
    overwrite_partitions(rows, landed_path, ["month"])
    stored = spark.read.schema(T.StructType([*tickets.schema.fields, T.StructField("month", T.StringType())]))
    counts = (
        stored.parquet(landed_path).where(F.col("month").isin(due)).groupBy("month", F.input_file_name().alias("_file"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("month").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
    )
    entries = [(r["month"], r["files"], r["rows"], batch) for r in counts.collect()]
    add_entries(spark, ledger_path, LANDED, entries)
    return due


def landing_coverage(tickets: DataFrame, start: Column, end: Column) -> DataFrame:
    """Days from ``start`` up to, not including, ``end`` without any landed ticket."""
    days = tickets.sparkSession.range(1).select(
        F.explode(F.sequence(start, F.date_sub(end, 1))).alias("day")
    )
    landed = tickets.select(F.to_date("date_sale").alias("day")).distinct()
    return days.join(landed, "day", "left_anti")
