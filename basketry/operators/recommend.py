"""The recommenders: global, per client, per segment, recent history, and their union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.dates import calendar_cutoff, days_cutoff
from basketry.operators.clean import exclude_products, normalise_tx
from basketry.operators.item_item import item_cosine, recommend_items, user_item_counts
from basketry.operators.order_stats import few_group_percentiles
from basketry.params import RecommendParams
from basketry.session import materialise


def filter_calendar_months(df: DataFrame, months: int, date_col: str = "date") -> DataFrame:
    """Rows of the last ``months`` calendar months before the latest date."""
    return df.where(F.col(date_col) >= calendar_cutoff(df, months, date_col))


# --- product popularity -------------------------------------------------------


def product_totals(tx: DataFrame) -> DataFrame:
    """Rows and latest date per product: what the popularity rules need of the lines."""
    return tx.groupBy("product").agg(F.count(F.lit(1)).alias("_rows"), F.max("date").alias("_last"))


def frequent_products(
    totals: DataFrame, catalog: DataFrame, params: RecommendParams = RecommendParams()
) -> DataFrame:
    """Catalogue products whose description is among the most frequent ones.

    A description counts when its rows reach the quantile over all descriptions. The
    catalogue meets one row per product, however hot a product is.
    """
    named = exclude_products(totals.join(catalog, "product"), params.excluded)
    freq = named.groupBy("description").agg(F.sum("_rows").alias("freq"))
    limit = few_group_percentiles(freq, "freq", {"_q": params.top_quantile}).scalar()
    top = freq.where(F.col("freq") >= limit).select("description")
    return catalog.join(top, "description", "left_semi").select("product").distinct()


def product_freq_p90(
    tx: DataFrame, catalog: DataFrame, params: RecommendParams = RecommendParams()
) -> DataFrame:
    """All product ids whose description is among the most frequent ones."""
    return frequent_products(product_totals(tx), catalog, params)


def product_freq_p90_by_id(tx: DataFrame, quantile: float = 0.90) -> DataFrame:
    """Products whose own row count reaches the quantile of all products' counts."""
    freq = tx.groupBy("product").agg(F.count(F.lit(1)).alias("freq"))
    limit = few_group_percentiles(freq, "freq", {"_q": quantile}).scalar()
    return freq.where(F.col("freq") >= limit)


def topn_per_client(tx: DataFrame, n: int) -> DataFrame:
    """The ``n`` most bought products per client; ties by product."""
    order = W.partitionBy("client").orderBy(F.desc("cnt"), F.asc("product"))
    counts = user_item_counts(tx).withColumn("rank", F.row_number().over(order))
    return counts.where(F.col("rank") <= n)


def join_top_pairs(tx: DataFrame, top: DataFrame) -> DataFrame:
    """Distinct rows whose (client, product) is among the top pairs."""
    return tx.join(top.select("client", "product"), ["client", "product"], "left_semi").distinct()


def map_names(df: DataFrame, catalog: DataFrame, product_col: str, name_col: str) -> DataFrame:
    """Add the product's description, or its id where the catalogue has none."""
    names = catalog.select(F.col("product").alias(product_col), F.col("description").alias("_catalog_name"))
    named = df.join(names, product_col, "left")
    return named.withColumn(name_col, F.coalesce("_catalog_name", product_col)).drop("_catalog_name")


def ordered_list(rank: str, value: str) -> Column:
    """Aggregate of a few ranked values into an array in rank order."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(rank), F.col(value).alias("_value"))))
    return F.transform(pairs, lambda p: p["_value"])


# --- recommenders -------------------------------------------------------------


def global_counts(
    product_day: DataFrame, catalog: DataFrame, params: RecommendParams = RecommendParams()
) -> DataFrame:
    """Client-product counts of the frequent products in the last months."""
    tx = normalise_tx(product_day)
    totals = product_totals(tx)
    ids = frequent_products(totals, catalog, params)
    # Stored: two later steps read it, and it is a tenth of the catalogue at most.
    frequent = materialise(totals.join(ids, "product", "left_semi").select("product", "_last"), "products")
    cutoff = calendar_cutoff(frequent, params.months, "_last")
    recent = tx.where(F.col("date") >= cutoff)
    return user_item_counts(recent.join(frequent, "product", "left_semi"))


def recs_global(
    product_day: DataFrame, catalog: DataFrame, params: RecommendParams = RecommendParams()
) -> DataFrame:
    """Item-to-item recommendations over the most frequent products."""
    counts = materialise(global_counts(product_day, catalog, params), "user-item")
    return recommend_items(counts, item_cosine(counts), params.n_recs, params.score_decimals)


def client_top_counts(product_day: DataFrame, params: RecommendParams = RecommendParams()) -> DataFrame:
    """Counts of each client's top products in the last months.

    Products are chosen by all their rows and counted by their distinct ones, both
    from one aggregation.
    """
    tx = filter_calendar_months(normalise_tx(product_day), params.months)
    pairs = tx.groupBy("client", "product").agg(
        F.count(F.lit(1)).alias("_rows"), F.countDistinct(F.struct(*tx.columns)).alias("cnt")
    )
    order = W.partitionBy("client").orderBy(F.desc("_rows"), F.asc("product"))
    ranked = pairs.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= params.products_per_client).select("client", "product", "cnt")


def recs_by_client(
    product_day: DataFrame, catalog: DataFrame, params: RecommendParams = RecommendParams()
) -> DataFrame:
    """Item-to-item recommendations from each client's top products, as a list of names.

    A client keeps at most ``products_per_client`` products, which bounds its pairs.
    """
    counts = materialise(client_top_counts(product_day, params), "user-item")
    recs = recommend_items(counts, item_cosine(counts), params.n_recs, params.score_decimals)
    named = map_names(recs, catalog, "recommended_product", "_name")
    lists = named.groupBy("client").agg(
        ordered_list("recommendation_rank", "_name").alias("recommended_products")
    )
    empty = F.array().cast("array<string>")
    return (
        counts.select("client")
        .distinct()
        .join(lists, "client", "left")
        .select("client", F.coalesce("recommended_products", empty).alias("recommended_products"))
    )


def topn_per_cluster(
    sales: DataFrame, assignments: DataFrame, catalog: DataFrame, excluded: Sequence[str]
) -> DataFrame:
    """Most sold descriptions per cluster; each cluster's own average variety sets how many.

    Sales are first counted per client and product, so the joins see one row per pair.
    """
    pairs = sales.groupBy("id_client", "product").agg(F.count(F.lit(1)).alias("_rows"))
    in_cluster = pairs.join(assignments.select("id_client", "cluster"), "id_client")
    sold = in_cluster.groupBy("cluster", "product").agg(F.sum("_rows").alias("_rows"))
    named = exclude_products(sold.join(catalog, "product", "left"), excluded)
    freq = named.groupBy("cluster", "description").agg(F.sum("_rows").alias("freq"))
    size = assignments.groupBy("cluster").agg(
        F.greatest(F.lit(1), F.bround(F.avg("product_distinct"))).cast("int").alias("top_n")
    )
    order = W.partitionBy("cluster").orderBy(F.desc("freq"), F.asc("description"))
    # One row per cluster on the broadcast side.
    return (
        freq.withColumn("rank", F.row_number().over(order))
        .join(F.broadcast(size), "cluster")
        .where(F.col("rank") <= F.col("top_n"))
        .select("cluster", "description", "freq", "rank")
    )


def recs_by_cluster(
    sales: DataFrame,
    assignments: DataFrame,
    catalog: DataFrame,
    excluded: Sequence[str] = RecommendParams().excluded,
) -> DataFrame:
    """Every client gets the popular products of its cluster."""
    lists = (
        topn_per_cluster(sales, assignments, catalog, excluded)
        .groupBy("cluster")
        .agg(ordered_list("rank", "description").alias("recommended_products"))
    )
    empty = F.array().cast("array<string>")
    # One row per cluster on the broadcast side.
    return assignments.join(F.broadcast(lists), "cluster", "left").select(
        F.col("id_client").alias("client"),
        F.col("cluster").alias("purchase_pattern_cluster"),
        "segment",
        "segment_label",
        F.coalesce("recommended_products", empty).alias("recommended_products"),
    )


def sales_with_descriptions(
    sales: DataFrame, catalog: DataFrame, excluded: Sequence[str]
) -> DataFrame:
    """Sales of known, not excluded products with their description."""
    return exclude_products(sales.join(catalog, "product"), excluded).withColumn(
        "client", F.col("id_client")
    )


def recent_product_stats(
    sales: DataFrame, clients: DataFrame, months: int, since: Column | None = None
) -> DataFrame:
    """Per client and description: median rows per day (cut to a whole number), days bought.

    ``sales`` carries ``client``, ``date_sale`` and ``description``. A group has at most
    one row per day of the window, which ``since`` may state.
    """
    recent = sales.where(F.col("date_sale") >= (days_cutoff(sales, months, "date_sale") if since is None else since))
    per_day = (
        recent.join(clients.select("client").distinct(), "client", "left_semi")
        .groupBy("client", "date_sale", "description")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    return per_day.groupBy("client", "description").agg(
        F.median("_rows").cast("int").alias("avg_sale_period"),
        F.count(F.lit(1)).alias("dias_compro"),
    )


def top_fraction_per_client(stats: DataFrame, fraction: float) -> DataFrame:
    """The first ``ceil(n x fraction)`` products of each client by days bought.

    A client has at most one row per catalogue description here.
    """
    client = W.partitionBy("client")
    order = client.orderBy(F.desc("dias_compro"), F.asc("description"))
    return (
        stats.withColumn("_rank", F.row_number().over(order))
        .withColumn("_size", F.count(F.lit(1)).over(client))
        .where(F.col("_rank") <= F.ceil(F.col("_size") * F.lit(fraction)))
        .drop("_rank", "_size")
    )


def recs_recent_history(
    sales: DataFrame,
    catalog: DataFrame,
    clients: DataFrame,
    params: RecommendParams = RecommendParams(),
) -> DataFrame:
    """What each client bought most often in the last days.

    The latest day of a wanted product is found from one row per product, so only sales of
    the last days are read a second time and meet the catalogue.
    """
    last = sales.groupBy("product").agg(F.max("date_sale").alias("date_sale"))
    since = days_cutoff(exclude_products(last.join(catalog, "product"), params.excluded), params.history_months, "date_sale")
    named = sales_with_descriptions(sales.where(F.col("date_sale") >= since), catalog, params.excluded)
    stats = recent_product_stats(named, clients, params.history_months, since)
    return top_fraction_per_client(stats, params.top_fraction).select(
        "client", F.col("description").alias("recommended_products"), "avg_sale_period"
    )


# --- joining recommendations to predictions -----------------------------------


def merge_recommendations(
    predictions: DataFrame, recs: DataFrame | None, list_name: str
) -> DataFrame:
    """Left join of list-form or long-form recommendations; ``None`` leaves the input as is."""
    if recs is None:
        return predictions
    if "recommended_products" in recs.columns:
        columns = ["recommended_products"]
    else:
        long_form = ("recommended_product", "recommendation_score", "recommendation_rank")
        columns = [c for c in long_form if c in recs.columns]
    merged = predictions.join(recs.select("client", *columns), "client", "left")
    return merged.withColumnRenamed("recommended_products", list_name)


def join_product_detail(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add the description of ``recommended_product``."""
    detail = catalog.select(F.col("product").alias("recommended_product"), "description")
    return df.join(detail, "recommended_product", "left")


def combine_recs(
    predictions: DataFrame,
    item_recs: DataFrame | None,
    catalog: DataFrame | None = None,
    cluster_recs: DataFrame | None = None,
) -> DataFrame:
    """Predictions with item-to-item and optional cluster recommendations, sorted."""
    out = merge_recommendations(predictions, item_recs, "item_item_recommended_products")
    out = merge_recommendations(out, cluster_recs, "cluster_recommended_products")
    if catalog is not None and "recommended_product" in out.columns:
        out = join_product_detail(out, catalog)
    order = [c for c in (*predictions.columns, "recommendation_rank") if c in out.columns]
    return out.orderBy(*[F.asc_nulls_last(c) for c in order])


def join_contacts_inner(predictions: DataFrame, contacts: DataFrame) -> DataFrame:
    """Predictions with contact data; clients nobody can reach are dropped."""
    wanted = [c for c in ("name", "email", "phone", "telephone") if c in contacts.columns]
    return predictions.select("date", "client", "prob").join(
        contacts.select("client", *wanted), "client"
    )


def campaign(
    scored: DataFrame,
    contacts: DataFrame,
    history_recs: DataFrame,
    dates: Sequence,
    threshold: float,
) -> DataFrame:
    """Likely buyers on the given dates with contacts and products, sorted for the call list."""
    chosen = filter_prob(filter_dates(scored, dates), threshold)
    out = join_contacts_inner(chosen, contacts).join(history_recs, "client", "left")
    return out.orderBy(F.asc("date"), F.desc("prob"))


def filter_dates(df: DataFrame, dates: Sequence, date_col: str = "date") -> DataFrame:
    return df.where(F.col(date_col).isin([F.lit(d).cast("date") for d in dates]))


def filter_prob(df: DataFrame, threshold: float, prob_col: str = "prob") -> DataFrame:
    """Rows at or above the threshold; zero is a valid threshold."""
    return df.where(F.col(prob_col) >= threshold)
