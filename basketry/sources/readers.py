"""Readers. Schemas are stated, so no file is scanned to guess types."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.functions.text import strip
from basketry.operators.clean import filter_positive_ticket
from basketry.schemas import CONTACT_COLUMNS, LANDED_TICKETS


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; a missing path is an error."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def or_none(read, *args, **kwargs) -> DataFrame | None:
    """Result of a reader, or ``None`` when its path does not exist."""
    try:
        return read(*args, **kwargs)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _csv_with(spark: SparkSession, path: str, required: tuple[str, ...]) -> DataFrame:
    """All columns of a CSV with header as text; ``required`` ones must be there."""
    df = spark.read.option("header", True).csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise KeyError(f"{path} lacks the columns {missing}")
    return df


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Product and description, one row per stripped product code.

    Of several descriptions the lowest is kept: rows of a distributed file have no
    first one.
    """
    df = _csv_with(spark, path, ("codigo_unico", "description"))
    return df.groupBy(strip("codigo_unico").alias("product")).agg(
        F.min("description").alias("description")
    )


def load_catalog_wide(spark: SparkSession, path: str) -> DataFrame | None:
    """Every catalogue column, one row per stripped product; ``None`` without the file.

    One row per product, so joining it cannot multiply ticket lines.
    """
    df = or_none(_csv_with, spark, path, ("codigo_unico",))
    if df is None:
        return None
    rest = [c for c in df.columns if c != "codigo_unico"]
    first = F.min(F.struct(*rest)).alias("_first")
    return df.groupBy(strip("codigo_unico").alias("product")).agg(first).select("product", "_first.*")


def load_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Calendar features with a plain date and a text client."""
    df = spark.read.parquet(path)
    return df.withColumns({"date": F.to_date("date"), "client": F.col("client").cast("string")})


def scan_raw_months(spark: SparkSession, path: str) -> DataFrame:
    """All landed months; columns some months lack are null there.

    The schema is stated, so that no file's footer is opened to find it.
    """
    return spark.read.schema(LANDED_TICKETS).parquet(path)


def scan_vip(spark: SparkSession, parquet_path: str, csv_path: str) -> DataFrame:
    """VIP lines from Parquet, else from the older CSV form; positive tickets only."""
    df = or_none(spark.read.parquet, parquet_path)
    if df is None:
        df = or_none(spark.read.schema(schemas.VIP_LINES).option("header", True).csv, csv_path)
    if df is None:
        raise FileNotFoundError(f"neither {parquet_path} nor {csv_path} exists")
    typed = df.withColumns(
        {"date_sale": F.to_date("date_sale"), "user_id": strip(F.col("user_id").cast("string"))}
    )
    return filter_positive_ticket(typed)


def load_contacts(records: DataFrame, id_name: str = "client") -> DataFrame:
    """Contact records under canonical names, one row per stripped id."""
    renamed = records.withColumnsRenamed({"document": id_name, "cellphone": "phone"})
    present = [c for c in (*CONTACT_COLUMNS, "telephone") if c in renamed.columns]
    first = F.min(F.struct(*present)).alias("_first")
    key = strip(F.col(id_name).cast("string")).alias(id_name)
    return renamed.groupBy(key).agg(first).select(id_name, "_first.*")


def load_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Predictions with a text client; the column must exist."""
    df = _csv_with(spark, path, ("client",))
    typed = {"prob": F.col("prob").cast("double")} if "prob" in df.columns else {}
    return df.withColumns(typed) if typed else df


def load_recs_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """A recommendation table, or ``None`` when it was never written."""
    df = or_none(spark.read.parquet, path)
    return None if df is None else df.withColumn("client", F.col("client").cast("string"))
