"""Small helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.order_stats import spread_rank as distributed_rank
from basketry.session import materialise, work_dir

__all__ = [
    "connected", "distributed_rank", "free_name", "let", "materialise", "own_names", "read_table", "tune",
    "with_fields", "work_dir",
]

# Rows that one Arrow batch hands to Python. Texts are a few kB on average and some are
# very long, so batches stay small next to a worker's memory.
ARROW_ROWS = 1000


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        # Otherwise the borders of file splits follow the number of cores at hand, and an
        # executor lost between two scans of a table would move them.
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def own_names(df: DataFrame, *columns: str, **typed: str) -> DataFrame:
    """Only the named columns, cast, so that other columns of the caller cannot clash."""
    kinds = {"doc_id": "bigint", "text": "string"} | typed
    return df.select(*[df[f"`{c}`"].cast(kinds[c]).alias(c) if c in kinds else df[f"`{c}`"] for c in columns])


def with_fields(df: DataFrame, fields: Sequence[tuple[str, T.DataType]]) -> T.StructType:
    """Schema of ``df`` followed by more fields."""
    return T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in fields]])


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, even where ``body`` uses it in a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (``a``, ``b``, both long): rows (``node``, ``root``).

    ``root`` is the smallest node of the component. Alternates the large-star and small-star
    steps: every node is re-linked to the smallest neighbour it knows, by one aggregation and
    one join each, until no edge changes. Neighbour lists are never collected, and each
    round's edges are a written table, so a lost executor costs a re-read.
    """
    pairs = materialise(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = state(pairs)
    for _ in range(rounds):
        if not now[0]:
            break
        # Large star: every larger neighbour of a node moves to the node's smallest neighbour.
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        # Small star: a node's smaller neighbours, and itself, move to the smallest of them.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = (
            large.join(small, "u").select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("m").alias("v"))
        )
        pairs = materialise(moved.where("u != v").distinct(), "edges")
        before, now = now, state(pairs)
        if now == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
