"""Item-to-item similarity in long form and the recommendations drawn from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.operators.skew import ROWS_PER_SALT, replicate, spread
from basketry.session import materialise

# Products of one client that one task pairs with the client's other products.
PRODUCTS_PER_SALT = 256


def user_item_counts(df: DataFrame) -> DataFrame:
    """Rows per client and product."""
    return df.groupBy("client", "product").agg(F.count(F.lit(1)).alias("cnt"))


def matrix_density(counts: DataFrame) -> DataFrame:
    """Users, items, filled cells and their share of the whole matrix."""
    sizes = counts.agg(
        F.countDistinct("client").alias("users"),
        F.countDistinct("product").alias("items"),
        F.count(F.lit(1)).alias("nnz"),
    )
    cells = F.col("users").cast("double") * F.col("items")
    return sizes.withColumn("density", F.try_divide(F.col("nnz"), cells))


def item_pair_dots(counts: DataFrame) -> DataFrame:
    """Sum over clients of the product of two items' counts, for ``product_i < product_j``.

    Pairs exist only where one client bought both. A client with many products is
    split into salts so that no task pairs more than ``PRODUCTS_PER_SALT`` of them
    with the rest, and pairs are summed in the task that forms them.
    """
    products = F.count(F.lit(1)).over(W.partitionBy("client"))
    salted = counts.withColumn(
        "_salts", F.ceil(products / F.lit(PRODUCTS_PER_SALT)).cast("int")
    )
    left = salted.select(
        "client",
        F.pmod(F.xxhash64("product"), F.col("_salts")).cast("int").alias("_salt"),
        F.col("product").alias("product_i"),
        F.col("cnt").alias("_cnt_i"),
    )
    right = salted.select(
        "client",
        F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"),
        F.col("product").alias("product_j"),
        F.col("cnt").alias("_cnt_j"),
    )
    return (
        left.join(right, ["client", "_salt"])
        .where(F.col("product_i") < F.col("product_j"))
        .groupBy("product_i", "product_j")
        .agg(F.sum(F.col("_cnt_i") * F.col("_cnt_j")).alias("dot"))
    )


def item_cosine(counts: DataFrame) -> DataFrame:
    """Cosine of item columns, both directions, without the diagonal.

    Dot products and squared norms are whole numbers, so the result does not depend
    on the order of the sums.
    """
    norms = counts.groupBy("product").agg(
        F.sqrt(F.sum(F.col("cnt") * F.col("cnt")).cast("double")).alias("_norm")
    )
    sim = (
        item_pair_dots(counts)
        .join(norms.withColumnsRenamed({"product": "product_i", "_norm": "_norm_i"}), "product_i")
        .join(norms.withColumnsRenamed({"product": "product_j", "_norm": "_norm_j"}), "product_j")
        .withColumn("sim", F.col("dot") / (F.col("_norm_i") * F.col("_norm_j")))
    )
    i, j = F.col("product_i"), F.col("product_j")
    both = F.array(
        F.struct(i.alias("product_i"), j.alias("product_j")),
        F.struct(j.alias("product_i"), i.alias("product_j")),
    )
    return sim.select(F.explode(both).alias("_p"), "sim").select("_p.*", "sim")


def similarities_by_block(counts: DataFrame, sim: DataFrame, blocks: int, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """``sim`` once for every block of clients (column ``_block``) that bought ``product_i``.

    A product goes to as many blocks as it has buyers, and at most to all of them, so the copies
    grow with the similarities and not with clients x catalogue. A product whose copies could
    pass ``rows_per_salt`` is salted; its neighbours are at most what its buyers bought beside it.
    """
    beside = F.count(F.lit(1)).over(W.partitionBy("client")) - 1
    wanted = counts.select(F.col("product").alias("product_i"), _block(blocks), beside.alias("_beside"))
    places = wanted.groupBy("product_i").agg(F.collect_set("_block").alias("_blocks"), F.sum("_beside").alias("_beside"))
    copies = F.col("_beside") * F.size("_blocks")
    hot = places.where(copies > rows_per_salt).select(
        "product_i", F.least(F.ceil(copies / rows_per_salt), F.col("_beside")).cast("int").alias("_salts")
    )
    salted = spread(sim, hot, "product_i", ["product_j"])
    homes = replicate(places.drop("_beside"), hot, "product_i")
    return salted.join(homes, ["product_i", "_salt"]).select(*sim.columns, F.explode("_blocks").alias("_block"))


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("client"), F.lit(blocks)).cast("int").alias("_block")


def _block_scores(counts: DataFrame, sim: DataFrame, blocks: int | None) -> DataFrame:
    spark = counts.sparkSession
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mine = counts.withColumn("_block", _block(blocks)).repartitionById(blocks, "_block")
    # Stored, so that nothing but the dealing by block is left to do when the blocks meet.
    sims = materialise(similarities_by_block(counts, sim, blocks), "similarities").repartitionById(blocks, "_block")
    gains = mine.withColumnRenamed("product", "product_i").join(sims, ["_block", "product_i"])
    scores = gains.groupBy("_block", "client", F.col("product_j").alias("product")).agg(
        F.sum(F.col("sim") * F.col("cnt")).alias("score")
    )
    bought = mine.select("_block", "client", "product")
    return scores.where("score > 0").join(bought, ["_block", "client", "product"], "left_anti")


def score_items(counts: DataFrame, sim: DataFrame, blocks: int | None = None) -> DataFrame:
    """Score of every product a client has not bought: sum of similarity x count.

    Clients are dealt into blocks, one per partition, and each block gets the similarities
    of what its clients bought, so the rows made for a client are summed, rid of what was
    bought and ranked in the task that made them. What is shuffled are the counts and these
    copies of the similarities, not client x bought x similar. A block holds whole
    clients, of at most one row per product, so no product or client is a hot key.
    Without :data:`IN_PLACE` set Spark deals the joined rows again, with the same result.
    """
    return _block_scores(counts, sim, blocks).drop("_block")


# Lets a join on (block, product) stay where rows were dealt by block alone.
IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def recommend_items(
    counts: DataFrame, sim: DataFrame, n: int, score_decimals: int = 6, blocks: int | None = None
) -> DataFrame:
    """The ``n`` best products per client, ranked by rounded score, then product.

    Scores are rounded before ranking: sums of fractions differ in the last digits
    with the order of the rows, and near-ties would change places between runs.
    """
    scores = _block_scores(counts, sim, blocks).withColumn("score", F.round("score", score_decimals))
    ranked = rank_first(scores, n, ("_block", "client"))
    return ranked.drop("_block").withColumnsRenamed(
        {"product": "recommended_product", "score": "recommendation_score"}
    )


def rank_first(scores: DataFrame, n: int | None = None, within: Sequence[str] = ("client",)) -> DataFrame:
    """Rank per client by score, ties by product. With ``n`` each task keeps only its
    own best ``n`` per client before the exchange."""
    order = W.partitionBy(*within).orderBy(F.desc("score"), F.asc("product"))
    ranked = scores.withColumn("recommendation_rank", F.row_number().over(order))
    return ranked if n is None else ranked.where(F.col("recommendation_rank") <= n)
