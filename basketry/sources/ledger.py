"""Ledgers: small tables that say what a job has finished, written after the data itself.

A job that stops between data and ledger does its step again; as every step replaces whole
folders, that repairs it. Rows are only added, so a ledger needs no lock for its one writer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from basketry.sources.readers import or_none

LANDED = T.StructType([
    T.StructField("month", T.StringType()),
    T.StructField("files", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("batch", T.StringType()),
])

MERGED = T.StructType([
    T.StructField("batch", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("months", T.ArrayType(T.StringType())),
])


def read_ledger(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All entries; none if there is no ledger yet."""
    found = or_none(spark.read.schema(schema).parquet, path)
    return spark.createDataFrame([], schema) if found is None else found


def add_entries(spark: SparkSession, path: str, schema: T.StructType, entries: Sequence[tuple]) -> None:
    spark.createDataFrame(list(entries), schema).coalesce(1).write.mode("append").parquet(path)
