"""Writers. Each file is written by the task that holds its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def csv_columns(df: DataFrame, decimals: int = 4) -> DataFrame:
    """Columns as they are printed: fractions with fixed decimals, ISO dates."""

    def printed(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.format_string(f"%.{decimals}f", c) if not field.nullable else F.when(
                c.isNotNull(), F.format_string(f"%.{decimals}f", c)
            )
        if isinstance(field.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd")
        if isinstance(field.dataType, T.ArrayType):
            return F.to_json(c)
        return c

    return df.select(*[printed(f).alias(f.name) for f in df.schema.fields])


def sink_csv(df: DataFrame, path: str, order: Sequence[Column] = (), decimals: int = 4) -> None:
    """Sorted CSV with header. The sort splits the rows by range, one file per range."""
    if order:
        df = df.orderBy(*order)
    csv_columns(df, decimals).write.mode("overwrite").option("header", True).csv(path)


def sink_metrics(df: DataFrame, path: str) -> None:
    """A one-row table of metrics, or a small report, as JSON lines."""
    df.write.mode("overwrite").json(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``.

    Rows are gathered by partition first, so a month is a few files and not one per
    task; AQE still splits a month that is too large for one task.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
