"""Salting for joins that multiply rows.

AQE splits a hot partition of a plain lookup join by its bytes. That is not enough
where one input row meets many partners, because the work sits in the output. These
helpers split such keys before the join; every row still meets every partner.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Output rows of one key that one task should make.
ROWS_PER_SALT = 1_000_000


def hot_keys(
    df: DataFrame, key: str, rows_per_salt: int = ROWS_PER_SALT, partners: DataFrame | None = None
) -> DataFrame:
    """Keys whose join makes more rows than one task should, with their number of salts.

    A key makes its rows times its rows in ``partners``, or just its rows without that
    table. There is no limit on the number of such keys: each stands for more than
    ``rows_per_salt`` rows, so the table is small next to the join, and whether it is
    broadcast is left to its measured size.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    weight = F.col("_rows")
    if partners is not None:
        sizes = sizes.join(partners.groupBy(key).agg(F.count(F.lit(1)).alias("_partners")), key)
        weight = weight * F.col("_partners")
    # More salts than rows would only repeat the partners.
    salts = F.least(F.ceil(weight / rows_per_salt), F.col("_rows")).cast("int")
    return sizes.where(weight > rows_per_salt).select(key, salts.alias("_salts"))


def spread(df: DataFrame, hot: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Add ``_salt`` to the many-row side, derived from the columns ``by``."""
    salted = df.join(hot, key, "left")
    salt = F.coalesce(F.pmod(F.xxhash64(*by), F.col("_salts")).cast("int"), F.lit(0))
    return salted.withColumn("_salt", salt).drop("_salts")


def replicate(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Repeat the other side once per salt of its key."""
    salted = df.join(hot, key, "left")
    last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
    return salted.withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_salts")
