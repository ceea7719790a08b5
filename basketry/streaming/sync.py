"""Incremental sales sync: new files in, touched months rewritten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from basketry.sources.months import merge_months


def start_sync(
    spark: SparkSession,
    source: str,
    source_schema: T.StructType,
    target: str,
    state: str,
    line_order: Sequence[str] = (),
) -> StreamingQuery:
    """Process all files of ``source`` not seen yet, then stop.

    Each micro-batch goes through the merge that the load job uses. ``target`` and
    ``state`` must be folders all executors share.
    """
    stream = spark.readStream.schema(source_schema).parquet(source)
    return (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", f"{state}/checkpoint")
        .foreachBatch(lambda df, i: merge_months(df, f"stream-{i}", target, state, line_order))
        .start()
    )
