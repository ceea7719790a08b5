"""Exact order statistics that never gather one group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one aggregation
buffer, and a running window reads its whole partition in one task. Both are fine
for groups of a known size (days of a client, products of a catalogue) and are used
directly there. The functions here serve groups without such a bound: a month of
all tickets, all clients at once, or one client holding a third of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.session import materialise

# Histogram buckets per doubling of |value|: about 0.07% of a value each, however small it is.
LOG_BUCKETS = 1024
# No double but zero is smaller than 2**-1074.
LEAST_EXPONENT = 1075

# A key is hot when it holds more distinct values than one aggregation buffer should.
HOT_VALUES = 1_000_000


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values per key with their row count; null values are left out."""
    # Nulls are dropped after the aggregation: a filter on the value would slip below
    # whatever made the rows, and keep an exchange there from being used twice.
    return (
        df.groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(value).alias("_n"))
        .where(F.col("_n") > 0)
    )


def few_group_percentiles(
    df: DataFrame, value: str, probabilities: dict[str, float], keys: Sequence[str] = ()
) -> DataFrame:
    """Exact interpolated percentiles of few, large groups.

    ``keys`` must be non-null and name few groups (segments, months, feature names):
    the buckets that hold the wanted ranks, two per percentile and group, are
    broadcast. The values stay spread by (keys, value); a histogram finds those
    buckets and only their values are ordered.
    """
    return _select_ranks(value_counts(df, keys, value), probabilities, keys)


def percentiles_of_counts(counts: DataFrame, probabilities: dict[str, float], keys: Sequence[str]) -> DataFrame:
    """:func:`few_group_percentiles` of a table of :func:`value_counts`."""
    return _select_ranks(counts, probabilities, keys)


def _select_ranks(
    counts: DataFrame, probabilities: dict[str, float], keys: Sequence[str], few: bool = True
) -> DataFrame:
    group = list(keys) or ["_all"]
    picked = values_at_ranks(counts if keys else counts.withColumn("_all", F.lit(0)), list(probabilities.values()), group, few)
    out = picked.groupBy(*group, "_total").agg(
        *[_interpolate(p).alias(name) for name, p in probabilities.items()]
    )
    return out.select(*keys, *probabilities)


def values_at_ranks(
    counts: DataFrame, probabilities: Sequence[float], group: Sequence[str], few: bool = True
) -> DataFrame:
    """The values just at and around each percentile, as rows (``_total``, ``_v``, ``_rank``) of a group.

    ``counts`` is a table of :func:`value_counts`; ranks count from 0.
    """
    v = F.col("_v")
    # Never decreasing in the value, so buckets are ordered like the values.
    above = (F.log2(F.abs(v)) + LEAST_EXPONENT) * LOG_BUCKETS
    bucket = F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * F.floor(above)).cast("long")
    pool = counts.withColumn("_b", bucket)

    # The histogram has one row per group and bucket, whatever the size of the group.
    total = F.sum("_c").over(W.partitionBy(*group))
    upto = F.sum("_c").over(W.partitionBy(*group).orderBy("_b"))
    histogram = (
        pool.groupBy(*group, "_b")
        .agg(F.sum("_n").alias("_c"))
        .select("*", total.alias("_total"), upto.alias("_upto"))
    )
    shares = F.array(*[F.lit(p) for p in probabilities])
    ranks = F.concat(*[F.transform(shares, lambda p: f(p * (F.col("_total") - 1)).cast("long")) for f in (F.floor, F.ceil)])
    before = F.col("_upto") - F.col("_c")
    wanted = (
        histogram.select(*group, "_b", "_total", "_upto", before.alias("_before"), F.explode(F.array_distinct(ranks)).alias("_rank"))
        .where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_upto")))
        .groupBy(*group, "_b", "_total", "_before")
        .agg(F.collect_set("_rank").alias("_ranks"))
    )
    upto_value = F.col("_before") + F.sum("_n").over(W.partitionBy(*group, "_b").orderBy("_v"))
    return (
        pool.join(F.broadcast(wanted) if few else wanted, [*group, "_b"])
        .withColumn("_to", upto_value)
        .select(*group, "_total", "_v", "_n", "_to", F.explode("_ranks").alias("_rank"))
        .where((F.col("_rank") < F.col("_to")) & (F.col("_rank") >= F.col("_to") - F.col("_n")))
        .select(*group, "_total", "_v", "_rank")
    )


def _interpolate(p: float) -> Column:
    position = F.lit(p) * (F.col("_total") - 1)

    def at(rank: Column) -> Column:
        return F.max(F.when(F.col("_rank") == rank.cast("long"), F.col("_v")))

    # The formula of the built-in percentile, so that both ways agree to the last digit.
    low, high = at(F.floor(position)), at(F.ceil(position))
    weighted = F.max(F.ceil(position) - position) * low + F.max(position - F.floor(position)) * high
    return F.when(low == high, low).otherwise(weighted)


def percentiles_by_key(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    keys: Sequence[str],
    hot_values: int = HOT_VALUES,
) -> DataFrame:
    """Exact percentiles of many groups of which some may be huge.

    Groups up to ``hot_values`` distinct values use one built-in aggregation; all larger
    ones go through the histogram of :func:`few_group_percentiles`. Whether the list of
    those is broadcast is left to its measured size.
    """
    keys = list(keys)
    counts = value_counts(df, keys, value)
    sizes = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d"))
    hot = sizes.where(F.col("_d") > hot_values).select(*keys)
    usual = (
        counts.join(hot, keys, "left_anti")
        .groupBy(*keys)
        .agg(*[F.percentile("_v", F.lit(p), F.col("_n")).alias(n) for n, p in probabilities.items()])
    )
    large = _select_ranks(counts.join(hot, keys, "left_semi"), probabilities, keys, few=False)
    return usual.unionByName(large)


def running_totals(df: DataFrame, order_by: Column, sums: Sequence[str]) -> DataFrame:
    """Add ``<column>_before``: the sum over all rows ordered strictly earlier.

    ``order_by`` is distinct per row; rows without it are left out. Instead of one window
    over the whole table, rows are dealt into ranges whose borders Spark takes from a sample
    of the values, so that crowded values are spread like any others. Each range adds up its
    own rows and starts from the totals of the ranges before it, one row each. The dealt rows
    are stored, as borders of a second sample could differ.
    """
    dealt = df.withColumn("_o", order_by).where(F.col("_o").isNotNull()).repartitionByRange("_o")
    ranges = materialise(dealt.withColumn("_p", F.spark_partition_id()), "ranges")
    totals = ranges.groupBy("_p").agg(*[F.sum(c).alias(c) for c in sums])
    # No partitioning here: one row per range, and there are as many as shuffle partitions.
    earlier = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    leaf = W.partitionBy("_p").orderBy("_o").rowsBetween(W.unboundedPreceding, -1)

    def total(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    offsets = totals.select("_p", *[total(c, earlier).alias(f"_{c}_offset") for c in sums])
    out = ranges.join(F.broadcast(offsets), "_p")
    for c in sums:
        out = out.withColumn(f"{c}_before", F.col(f"_{c}_offset") + total(c, leaf))
    return out.drop("_o", "_p", *[f"_{c}_offset" for c in sums])


def spread_rank(
    df: DataFrame, key: Sequence[str], order: Column, rows: int, name: str = "_rank", per_bucket: int = 50_000
) -> DataFrame:
    """Add the 0-based rank of each row within its key, without one task per key.

    ``order`` is a row's own hash (unique enough; ties broken arbitrarily but once). Rows
    are dealt into buckets of the hash range; bucket totals, of which there are few, give
    the offsets, and only rows of one bucket are numbered together. ``rows`` is the number
    of rows of ``df``, which sets the number of buckets. ``df`` must be stored, as it is
    read twice.
    """
    buckets = max(1, -(-rows // per_bucket))
    hashed = df.withColumn("_order", order).withColumn("_bucket", F.pmod(F.col("_order"), F.lit(buckets)))
    sizes = hashed.groupBy(*key, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = W.partitionBy(*key, F.lit(0)).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*key, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy(*key, "_bucket").orderBy("_order")
    numbered = hashed.withColumn("_inside", F.row_number().over(inside) - 1)
    named = offsets.withColumnsRenamed({"_bucket": "_bucket2"} | {k: f"_key_{k}" for k in key})
    same = F.col("_bucket") == F.col("_bucket2")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return (
        numbered.join(named, same)
        .withColumn(name, (F.col("_offset") + F.col("_inside")).cast("long"))
        .select(*df.columns, name)
    )
