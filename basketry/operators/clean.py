"""Row-level cleaning: ids, nested details, normalisation, windows and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.dates import days_cutoff, week_year
from basketry.functions.text import (
    MAX_ID_LENGTH,
    MIN_ID_LENGTH,
    id_rejection_reason,
    is_valid_id,
    strip,
)
from basketry.schemas import SALES_VALUE, VIP_COLUMNS

SALES_COLUMNS = ("date_sale", "id_client", "product", SALES_VALUE, "amount")


# --- client ids -------------------------------------------------------------


def validate_client_ids(
    df: DataFrame,
    id_col: str = "id_client",
    min_length: int = MIN_ID_LENGTH,
    max_length: int = MAX_ID_LENGTH,
) -> DataFrame:
    """Keep rows whose stripped id is a plausible personal number; store it stripped.

    A narrow filter, so it belongs before the first shuffle: placeholder ids are the
    hottest keys in the sales.
    """
    clean = df.withColumn(id_col, strip(id_col))
    return clean.where(is_valid_id(F.col(id_col), min_length, max_length))


def id_rejection_report(
    df: DataFrame,
    id_col: str = "id_client",
    min_length: int = MIN_ID_LENGTH,
    max_length: int = MAX_ID_LENGTH,
) -> DataFrame:
    """Rows and ids per first broken rule; ``valid`` for the rest."""
    ids = df.groupBy(strip(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_rows"))
    reason = F.coalesce(id_rejection_reason(F.col("_id"), min_length, max_length), F.lit("valid"))
    return ids.groupBy(reason.alias("reason")).agg(
        F.sum("_rows").alias("rows"), F.count("_id").alias("clients")
    )


# --- nested details ---------------------------------------------------------


def flatten_struct(df: DataFrame, column: str | None = None, sep: str = ".") -> DataFrame:
    """Turn struct columns into top-level ones; inner names are joined by ``sep``."""

    def leaves(kind: T.DataType, path: str, name: str):
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                yield from leaves(f.dataType, f"{path}.`{f.name}`", f"{name}{sep}{f.name}" if name else f.name)
        else:
            yield F.col(path).alias(name)

    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType) and column in (None, f.name):
            # One flattened column gives its fields directly, as a record would.
            columns.extend(leaves(f.dataType, f"`{f.name}`", "" if column else f.name))
        else:
            columns.append(F.col(f"`{f.name}`"))
    return df.select(*columns)


def explode_details(df: DataFrame, details: str = "invoice_details") -> DataFrame:
    """One row per ticket line; a ticket without lines keeps one row of nulls."""
    return flatten_struct(df.withColumn(details, F.explode_outer(details)), details)


def explode_details_strict(df: DataFrame, details: str = "invoice_details") -> DataFrame:
    """One row per ticket line; tickets without lines and null lines disappear."""
    exploded = df.withColumn(details, F.explode(details)).where(F.col(details).isNotNull())
    return flatten_struct(exploded, details)


# --- normalisation ----------------------------------------------------------


def normalise_sales(df: DataFrame, raw_id: str = "identification_doct") -> DataFrame:
    """Raw ticket lines to ``date_sale``, stripped ``id_client`` and ``product``.

    Rows without a date, id or product are dropped: a missing product would otherwise
    live on as a text.
    """
    source = raw_id if raw_id in df.columns else "id_client"
    return (
        df.withColumn("date_sale", F.to_date("date_sale"))
        .withColumn("id_client", strip(F.col(source).cast("string")))
        .withColumn("product", strip(F.col("product").cast("string")))
        .dropna(subset=["date_sale", "id_client", "product"])
    )


def clean_new_sales(raw: DataFrame) -> DataFrame:
    """Nested raw tickets to valid sales lines."""
    lines = normalise_sales(explode_details(raw))
    return validate_client_ids(lines).select(*SALES_COLUMNS)


def normalise_tx(df: DataFrame) -> DataFrame:
    """Client-product-day rows under the names the recommenders use."""
    return (
        df.withColumnsRenamed({"id_client": "client", "date_sale": "date"})
        .dropna(subset=["client", "product", "date"])
        .withColumn("client", F.col("client").cast("string"))
        .withColumn("product", strip(F.col("product").cast("string")))
    )


def rename_vip(df: DataFrame) -> DataFrame:
    """Source names to the VIP line schema, keeping the columns that exist."""
    renamed = df.withColumnsRenamed(
        {
            "ID": "tiket_id",
            "identification_doct": "user_id",
            "invoice_value_without_iva_and_discount": "tiket_price",
            "name": "product_name",
        }
    )
    return renamed.select(*[c for c in VIP_COLUMNS if c in renamed.columns])


def iso_week_key(df: DataFrame, date_col: str = "date_sale", iso_year: bool = False) -> DataFrame:
    """Add ``anio``, ``semana`` and ``periodo_unico``.

    The year is the calendar year, so the last days of December may share a key with
    the first week of their own year; ``iso_year`` uses the year of the week instead.
    """
    year = week_year(date_col) if iso_year else F.year(date_col)
    return (
        df.withColumn("anio", year)
        .withColumn("semana", F.weekofyear(date_col))
        .withColumn("periodo_unico", F.concat_ws("-", F.col("anio"), F.col("semana")))
    )


# --- row filters ------------------------------------------------------------


def semi_join(df: DataFrame, ids: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``ids``; AQE splits a hot key's rows."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(ids.select(*keys), keys, "left_semi")


def filter_vip_weeks(
    df: DataFrame, min_weeks: int, user_col: str = "user_id", week_col: str = "periodo_unico"
) -> DataFrame:
    """All rows of users active in at least ``min_weeks`` distinct week keys."""
    active = (
        df.groupBy(user_col)
        .agg(F.countDistinct(week_col).alias("_weeks"))
        .where(F.col("_weeks") >= min_weeks)
    )
    return semi_join(df, active, user_col)


def filter_positive_ticket(df: DataFrame, price_col: str = "tiket_price") -> DataFrame:
    return df.where(F.col(price_col) > 0)


def exclude_products(
    df: DataFrame, excluded: Sequence[str], description: str = "description"
) -> DataFrame:
    """Drop excluded descriptions and rows without one."""
    kept = F.col(description).isNotNull()
    if excluded:
        kept = kept & ~F.col(description).isin(*excluded)
    return df.where(kept)


def trim_window(df: DataFrame, months: int, date_col: str = "date_sale") -> DataFrame:
    """Keep the last ``months`` blocks of thirty days; product and client must be set."""
    return df.where(F.col(date_col) >= days_cutoff(df, months, date_col)).dropna(
        subset=["product", "id_client"]
    )


# --- duplicates and union ---------------------------------------------------


def dedupe_keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), output: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the first by ``order``, then by the remaining columns.

    An aggregation rather than a ranking window, so the copies of one key are reduced
    where they are read and never meet in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    out = df.groupBy(*keys).agg(first).select(*keys, "_first.*")
    return out.select(*(output or df.columns))


def union_by_name(*parts: DataFrame) -> DataFrame:
    """Stack tables by column name; a column missing in one of them is null there."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def incremental_sync(
    existing: DataFrame,
    new: DataFrame,
    months: int,
    line_order: Sequence[str] = (),
) -> DataFrame:
    """History plus new lines, one row per (date, client, product), last months only.

    Existing rows win over new ones, then the lower ``line_order``.
    """
    both = union_by_name(existing.withColumn("_source", F.lit(0)), new.withColumn("_source", F.lit(1)))
    one = dedupe_keep_first(both, ("date_sale", "id_client", "product"), ("_source", *line_order))
    return trim_window(one, months).select(*SALES_COLUMNS)
