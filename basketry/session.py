"""Session set-up shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the results or the skew handling rely on. All are runtime settings, so
# they can be applied to a session somebody else built.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join of raw sales lines with one row per client is split by AQE when a
    # client is hot, even if that costs the parent operator one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sales lines take about 13 bytes each in a shuffle and ten times that in the hash table or
    # sort of the task that reads them, so tasks get a quarter of the usual bytes.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine relies on to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Runtime settings for the actions inside the block; the caller's come back after it."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def build_session(app: str = "basketry", master: str | None = None, **settings) -> SparkSession:
    """Build a session; ``settings`` uses ``__`` for the dots of a Spark key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; on a cluster a local folder
    would be lost with the machine, so a missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="basketry-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage before iterative work: a lost executor costs a re-read, not the
    whole chain of joins, and every later plan starts at a plain scan.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
