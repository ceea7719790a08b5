"""Registry of the checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workload.fixtures import Fixtures

Query = Callable[[Fixtures], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def runner(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: fn(Fixtures(spark, folder))


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every fraction for the comparison, a little off the ties, see :func:`rnd`."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`") + F.lit(0.033 * 10**-digits), digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def joined(df: DataFrame) -> DataFrame:
    """Text lists as one text each, so that every engine hands them over alike."""
    return df.select(
        *[
            F.array_join(f"`{f.name}`", " | ").alias(f.name)
            if isinstance(f.dataType, T.ArrayType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def rnd(expression: str, digits: int = 4) -> str:
    """SQL twin of :func:`rounded`.

    Averages of few prices often end exactly on a rounding tie, where engines differ;
    the small shift moves them off it.
    """
    return f"round(cast({expression} AS DOUBLE) + {0.033 * 10**-digits!r}, {digits})"
