"""Segment features and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.numeric import log_amount, min_max
from basketry.operators.order_stats import few_group_percentiles, percentiles_by_key
from basketry.schemas import CONTACT_COLUMNS
from basketry.session import materialise

VIP_FEATURES = (
    "ticket_promedio",
    "valor_tipico",
    "gasto_total_vida",
    "volatilidad_gasto",
    "frecuencia_total",
    "dias_sin_comprar",
)

# Names shown for the five profiles.
SEGMENT_LABELS = {
    "ballena": "Ballena (mini-mercado)",
    "cotidiano": "Cotidiano (familia)",
    "mensual": "Mensual",
    "hormiga": "Hormiga (frecuente, bajo monto)",
    "esporadico": "Esporádico",
}

# Group number, name and description of the four VIP segments.
VIP_SEGMENTS = {
    "reposicion": (1, "Reposición", "Compras frecuentes, ticket bajo (~$50k). ~220 visitas/año."),
    "intermedio": (2, "Mercado Intermedio", "Frecuencia media (~21 visitas/año), riesgo de pérdida."),
    "masa_critica": (3, "Masa Crítica", "Mayor volumen de clientes (73%), foco de crecimiento."),
    "ballenas": (4, "Ballenas", "Ticket alto (~$390k). Minisupermercados o negocios."),
}

LOG_FEATURES = ("ticket_median", "monetary_total")


# --- VIP features ---------------------------------------------------------------


def distinct_tickets(lines: DataFrame) -> DataFrame:
    """One row per ticket: its total repeats on every line."""
    return lines.select("tiket_id", "user_id", "tiket_price", "date_sale").distinct()


def vip_features(lines: DataFrame) -> DataFrame:
    """Six features per client over distinct tickets; missing values are zero.

    The number of tickets of one client is not bounded, so the median takes the route
    that splits hot keys. Tickets are stored: the latest day, the sums and the median all
    read them, and ``lines`` is read once.
    """
    tickets = materialise(distinct_tickets(lines), "tickets")
    last_day = tickets.agg(F.max("date_sale")).scalar()
    base = tickets.groupBy("user_id").agg(
        F.avg("tiket_price").alias("ticket_promedio"),
        F.sum("tiket_price").alias("gasto_total_vida"),
        F.stddev_samp("tiket_price").alias("volatilidad_gasto"),
        F.count("tiket_id").alias("frecuencia_total"),
        F.datediff(last_day, F.max("date_sale")).alias("dias_sin_comprar"),
    )
    typical = percentiles_by_key(tickets, "tiket_price", {"valor_tipico": 0.5}, ["user_id"])
    out = base.join(typical, "user_id", "left")
    return out.select("user_id", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in VIP_FEATURES])


def main_point_of_sale(lines: DataFrame) -> DataFrame:
    """The store a client's lines name most often; ties by store."""
    counts = lines.dropna(subset=["id_point_sale"]).groupBy("user_id", "id_point_sale").agg(
        F.count(F.lit(1)).alias("_n")
    )
    best = F.min(F.struct((-F.col("_n")).alias("_n"), F.col("id_point_sale")))
    return counts.groupBy("user_id").agg(best["id_point_sale"].alias("id_point_sale"))


def join_segments(df: DataFrame, segments: DataFrame, key: str, columns=("cluster_id",)) -> DataFrame:
    """Rows of segmented clients with their segment."""
    return df.join(segments.select(key, *columns), key)


def export_vip(
    segments: DataFrame, stores: DataFrame, contacts: DataFrame | None = None
) -> DataFrame:
    """The table handed to sales: segment, main store and contact columns in fixed order."""
    out = segments.select("user_id", "cluster_id", "cluster_nombre", "cluster_descripcion")
    out = out.join(stores, "user_id", "left")
    if contacts is not None:
        present = [c for c in CONTACT_COLUMNS if c in contacts.columns]
        return out.join(contacts.select("user_id", *present), "user_id", "left")
    return out.withColumns({c: F.lit(None).cast("string") for c in CONTACT_COLUMNS})


# --- names ----------------------------------------------------------------------


def cluster_centroids(features: DataFrame, columns, cluster_col: str = "cluster") -> DataFrame:
    """Mean of every feature and number of clients per cluster."""
    return features.groupBy(cluster_col).agg(
        *[F.avg(c).alias(c) for c in columns], F.count(F.lit(1)).alias("clients")
    )


def _claim(table: DataFrame, name: str, order: list[Column], when: Column | None = None) -> DataFrame:
    """Give ``name`` to the first unnamed row by ``order``. The table has one row per cluster."""
    unnamed = F.col("segment").isNull()
    scope = W.partitionBy(unnamed)
    wins = unnamed & (F.row_number().over(scope.orderBy(*order)) == 1)
    if when is not None:
        wins = wins & when
    return table.withColumn("segment", F.when(wins, F.lit(name)).otherwise(F.col("segment")))


def name_profiles(features: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """Cluster to profile name, from the cluster means; one row per cluster.

    Lowest share of active months is sporadic; of the rest the highest ticket is the
    whale; of the rest the highest frequency against ticket, both scaled, is the ant;
    of what remains the least frequent is monthly and everything else everyday.
    """
    c = F.col(cluster_col)
    table = features.groupBy(cluster_col).agg(
        *[F.avg(f).alias(f) for f in ("tickets_per_month", "ticket_median", "months_active_ratio")]
    ).withColumn("segment", F.lit(None).cast("string"))
    table = _claim(table, "esporadico", [F.asc("months_active_ratio"), c.asc()])
    table = _claim(table, "ballena", [F.desc("ticket_median"), c.asc()])

    rest = W.partitionBy(F.col("segment").isNull())
    left = F.count(F.lit(1)).over(rest)

    def scaled(column: str) -> Column:
        return min_max(F.col(column), F.min(column).over(rest), F.max(column).over(rest))

    table = table.withColumn("_left", left).withColumn(
        "_ant", scaled("tickets_per_month") - scaled("ticket_median")
    )
    table = _claim(table, "hormiga", [F.desc("_ant"), c.asc()], F.col("_left") >= 2)
    table = table.withColumn("_left", left)
    table = _claim(table, "mensual", [F.asc("tickets_per_month"), c.asc()], F.col("_left") >= 2)
    return table.select(cluster_col, F.coalesce("segment", F.lit("cotidiano")).alias("segment"))


def label_segments_5(features: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """Add ``segment`` and ``segment_label`` to every client."""
    labels = F.create_map(*[F.lit(x) for pair in SEGMENT_LABELS.items() for x in pair])
    # One row per cluster on the broadcast side.
    out = features.join(F.broadcast(name_profiles(features, cluster_col)), cluster_col)
    return out.withColumn("segment_label", labels[F.col("segment")])


def segment_summary(labelled: DataFrame) -> DataFrame:
    """Clients and three means per segment, to one decimal."""
    return labelled.groupBy("segment").agg(
        F.count("cluster").alias("clientes"),
        F.round(F.avg("tickets_per_month"), 1).alias("tickets_mes"),
        F.round(F.avg("ticket_median"), 1).alias("ticket_mediano"),
        F.round(F.avg("months_active_ratio"), 1).alias("meses_activos"),
    )


def name_vip_clusters(features: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Cluster to VIP segment; one row per cluster.

    Highest mean ticket, then highest frequency, then most clients; the rest is the middle.
    """
    c = F.col(cluster_col)
    table = cluster_centroids(features, ("ticket_promedio", "frecuencia_total"), cluster_col)
    table = table.withColumn("segment", F.lit(None).cast("string"))
    table = _claim(table, "ballenas", [F.desc("ticket_promedio"), c.asc()])
    table = _claim(table, "reposicion", [F.desc("frecuencia_total"), c.asc()])
    table = _claim(table, "masa_critica", [F.desc("clients"), c.asc()])
    return table.select(cluster_col, F.coalesce("segment", F.lit("intermedio")).alias("segment"))


def label_segments_vip(features: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Add ``grupo``, ``cluster_nombre`` and ``cluster_descripcion`` to every client."""
    names = name_vip_clusters(features, cluster_col)
    for i, column in enumerate(("grupo", "cluster_nombre", "cluster_descripcion")):
        lookup = F.create_map(*[F.lit(x) for k, v in VIP_SEGMENTS.items() for x in (k, v[i])])
        names = names.withColumn(column, lookup[F.col("segment")])
    # One row per cluster on the broadcast side.
    return features.join(F.broadcast(names.drop("segment")), cluster_col)


# --- model matrix ---------------------------------------------------------------


def impute_and_log(features: DataFrame, columns, suffix: str = "") -> DataFrame:
    """Fill missing features with their median and take logs of the money columns."""
    numeric = features.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = numeric.unpivot([], list(columns), "_feature", "_value")
    medians = few_group_percentiles(long, "_value", {"_median": 0.5}, ["_feature"])
    # One row per feature name, folded into one struct.
    median = medians.agg(
        F.struct(*[F.max(F.when(F.col("_feature") == c, F.col("_median"))).alias(c) for c in columns])
    ).scalar()
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_median.{c}")) for c in columns}
    return (
        features.withColumn("_median", median)
        .withColumns({c + suffix: log_amount(v) if c in LOG_FEATURES else v for c, v in filled.items()})
        .drop("_median")
    )


def standardise(df: DataFrame, columns, with_suffix: str = "") -> DataFrame:
    """Centre and scale by the population deviation; a constant column becomes zero."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"dev_{c}") for c in columns],
        )
    ).scalar()

    def scaled(c: str) -> Column:
        deviation = F.col(f"_stats.dev_{c}")
        centred = F.col(c) - F.col(f"_stats.mean_{c}")
        return F.when(deviation > 0, centred / deviation).otherwise(centred)

    return (
        df.withColumn("_stats", stats)
        .withColumns({c + with_suffix: scaled(c) for c in columns})
        .drop("_stats")
    )


def prepare_cluster_matrix(features: DataFrame, columns, suffix: str = "_z") -> DataFrame:
    """Add the imputed, logged and standardised form of every feature."""
    ready = impute_and_log(features, columns, suffix)
    return standardise(ready, [c + suffix for c in columns])
