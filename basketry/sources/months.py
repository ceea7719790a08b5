"""Sales kept by month: new rows rewrite the months they touch and no other."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.dates import DAYS_PER_MONTH
from basketry.operators.clean import SALES_COLUMNS, dedupe_keep_first
from basketry.schemas import SALES
from basketry.session import materialise
from basketry.sources.ledger import MERGED, add_entries, read_ledger
from basketry.sources.readers import or_none
from basketry.sources.writers import overwrite_partitions

# Stated, as a month read back from its folder name would be taken for a date.
STORED = T.StructType([*SALES.fields, T.StructField("month", T.StringType())])
SALES_KEY = ("date_sale", "id_client", "product")


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_format("date_sale", "yyyy-MM"))


def _months(df: DataFrame) -> list[str]:
    """The months of a table with their column: a few names."""
    return sorted(r["month"] for r in df.select("month").distinct().collect())


def merge_months(
    batch: DataFrame, name: str, target: str, state: str, line_order: Sequence[str] = ()
) -> list[str]:
    """Merge a batch into the months it touches, stored rows first; gives those months.

    The new content of the months is first written in full to a folder of the batch, then
    the months are replaced. A ledger says which batches are staged and which are finished:
    a batch that is repeated after a crash only replaces its months again, so a crash between
    two months loses nothing, and a finished batch is left alone. Neither it nor a batch
    without rows touches a file.
    """
    spark = batch.sparkSession
    ledger, staged = f"{state}/ledger", f"{state}/staging/{name}"
    steps = {
        r["step"]: r["months"]
        for r in read_ledger(spark, ledger, MERGED).where(F.col("batch") == name).collect()
    }
    if "finished" in steps:
        return []
    if "staged" not in steps:
        new = with_month(batch).where(F.col("month").isNotNull())
        stored = or_none(spark.read.schema(STORED).parquet, target)
        if stored is None:
            # Nothing to merge with: the batch is read once, and its months are those it leaves.
            dedupe_keep_first(new, SALES_KEY, line_order).select(*SALES_COLUMNS, "month").write.mode("overwrite").parquet(staged)
            touched = _months(spark.read.schema(STORED).parquet(staged))
        else:
            new = materialise(new, "batch")
            # As literals the months keep the scan of the stored ones to those folders.
            touched = _months(new)
            if touched:
                kept = stored.where(F.col("month").isin(touched)).withColumn("_source", F.lit(0))
                both = kept.unionByName(new.withColumn("_source", F.lit(1)), allowMissingColumns=True)
                merged = dedupe_keep_first(both, SALES_KEY, ("_source", *line_order))
                merged.select(*SALES_COLUMNS, "month").write.mode("overwrite").parquet(staged)
        add_entries(spark, ledger, MERGED, [(name, "staged", touched)])
        steps["staged"] = touched
    if steps["staged"]:
        overwrite_partitions(spark.read.schema(STORED).parquet(staged), target, ["month"])
    add_entries(spark, ledger, MERGED, [(name, "finished", steps["staged"])])
    return steps["staged"]


def last_day(stored: DataFrame) -> date | None:
    """Latest stored date, looked up in the newest month only."""
    newest = stored.agg(F.max("month")).first()[0]
    return stored.where(F.col("month") == newest).agg(F.max("date_sale")).first()[0]


def read_months(spark: SparkSession, target: str, months: int) -> DataFrame:
    """The stored sales of the last ``months`` x 30 days.

    The latest date is looked up first, so that the months to read are literals and the
    scan skips the folders of older ones.
    """
    stored = spark.read.schema(STORED).parquet(target)
    last = last_day(stored)
    if last is None:
        return stored.select(*SALES_COLUMNS)
    first = last - timedelta(days=months * DAYS_PER_MONTH)
    recent = stored.where(F.col("month") >= f"{first:%Y-%m}")
    kept = recent.where(F.col("date_sale") >= F.lit(first)).dropna(subset=["product", "id_client"])
    return kept.select(*SALES_COLUMNS)
