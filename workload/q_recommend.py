"""Checked queries: catalogue and contact joins, similarity and the recommenders."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry import materialise, work_dir
from basketry.operators import item_item, recommend
from basketry.operators.recommend import filter_calendar_months, filter_prob
from basketry.params import RecommendParams
from basketry.plans import jobs
from basketry.sources import writers
from workload.fixtures import FX_EXCLUDED
from workload.oracle_views import oracle
from workload.registry import joined, query, rnd, rounded

PARAMS = RecommendParams(excluded=FX_EXCLUDED)


def recent_tx(fx):
    return filter_calendar_months(fx.tx, PARAMS.months)


def client_counts(fx):
    return materialise(recommend.client_top_counts(fx.product_day, PARAMS), "user-item")


def likely(fx):
    return filter_prob(fx.scored, 0.5).select("date", "client", "prob")


# --- joins ----------------------------------------------------------------------------


@query(
    "join_catalog_inner",
    oracle("SELECT src_order, src_line, product, description FROM valid JOIN fx_catalog USING (product)"),
)
def _catalog_inner(fx):
    out = recommend.sales_with_descriptions(fx.valid, fx.catalog, ())
    return out.select("src_order", "src_line", "product", "description")


@query(
    "join_catalog_left",
    oracle("""SELECT v.src_order, v.src_line, v.product, c.description
              FROM valid v LEFT JOIN (SELECT * FROM fx_catalog WHERE description <> 'small ring') c USING (product)"""),
)
def _catalog_left(fx):
    part = fx.catalog.where(F.col("description") != "small ring")
    return fx.valid.join(part, "product", "left").select("src_order", "src_line", "product", "description")


@query(
    "join_contacts_inner",
    oracle("SELECT date, client, prob, name FROM scored JOIN fx_contacts USING (client) WHERE prob >= 0.5"),
)
def _contacts_inner(fx):
    return recommend.join_contacts_inner(likely(fx), fx.contacts)


@query(
    "join_recs_left",
    oracle("""SELECT s.date, s.client, s.prob, r.recommended_products, r.avg_sale_period
              FROM scored s LEFT JOIN history_recs r USING (client) WHERE s.prob >= 0.5"""),
)
def _recs_left(fx):
    clients = fx.valid.select(F.col("id_client").alias("client"))
    recs = recommend.recs_recent_history(fx.valid, fx.catalog, clients, PARAMS)
    return likely(fx).join(recs, "client", "left")


@query(
    "merge_recommendations",
    oracle("""SELECT s.date, s.client, s.prob, r.recommended_product, r.recommendation_score, r.recommendation_rank
              FROM scored s LEFT JOIN c_counts_recs r USING (client) WHERE s.prob >= 0.5"""),
)
def _merge(fx):
    counts = client_counts(fx)
    recs = item_item.recommend_items(counts, item_item.item_cosine(counts), 5)
    return recommend.merge_recommendations(likely(fx), recs, "item_item_recommended_products")


@query(
    "join_product_detail",
    oracle("""SELECT client, product AS recommended_product, cnt, description FROM c_top
              LEFT JOIN fx_catalog USING (product)"""),
)
def _detail(fx):
    top = recommend.topn_per_client(recent_tx(fx), 5)
    named = top.select("client", F.col("product").alias("recommended_product"), "cnt")
    return recommend.join_product_detail(named, fx.catalog)


@query(
    "map_names",
    oracle("""SELECT client, product, CASE WHEN description = 'small ring' THEN product ELSE description END AS name
              FROM c_top JOIN fx_catalog USING (product)"""),
)
def _map_names(fx):
    part = fx.catalog.where(F.col("description") != "small ring")
    top = recommend.topn_per_client(recent_tx(fx), 5).select("client", "product")
    return recommend.map_names(top, part, "product", "name")


# --- similarity -------------------------------------------------------------------------


@query("user_item_counts", oracle("SELECT client, product, count(*) AS cnt FROM tx GROUP BY 1, 2"))
def _counts(fx):
    return item_item.user_item_counts(fx.tx)


@query(
    "matrix_density",
    oracle(f"""SELECT count(DISTINCT client) AS users, count(DISTINCT product) AS items, count(*) AS nnz,
                 {rnd('count(*) / (count(DISTINCT client) * count(DISTINCT product))', 8)} AS density
               FROM (SELECT client, product FROM tx GROUP BY 1, 2)"""),
)
def _density(fx):
    return rounded(item_item.matrix_density(item_item.user_item_counts(fx.tx)), 8)


@query(
    "item_pair_join",
    oracle("""SELECT a.product AS product_i, b.product AS product_j, cast(sum(a.cnt * b.cnt) AS BIGINT) AS dot
              FROM g_counts a JOIN g_counts b ON a.client = b.client AND a.product < b.product GROUP BY 1, 2"""),
)
def _pairs(fx):
    counts = materialise(recommend.global_counts(fx.product_day, fx.catalog, PARAMS), "user-item")
    return item_item.item_pair_dots(counts)


@query("item_cosine", oracle(f"SELECT product_i, product_j, {rnd('sim', 6)} AS sim FROM c_counts_sim"))
def _cosine(fx):
    return rounded(item_item.item_cosine(client_counts(fx)), 6)


@query("recommend_items", oracle("SELECT client, recommended_product, recommendation_score, recommendation_rank FROM c_counts_recs"))
def _recommend(fx):
    counts = client_counts(fx)
    return item_item.recommend_items(counts, item_item.item_cosine(counts), 5)


@query(
    "rank_first",
    oracle("""SELECT client, product, cast(cnt AS DOUBLE) AS score, cast(row_number() OVER
                (PARTITION BY client ORDER BY cnt DESC, product) AS INTEGER) AS recommendation_rank
              FROM (SELECT client, product, count(*) AS cnt FROM tx GROUP BY 1, 2)"""),
)
def _rank(fx):
    counts = item_item.user_item_counts(fx.tx).select("client", "product", F.col("cnt").cast("double").alias("score"))
    return item_item.rank_first(counts)


# --- popularity ---------------------------------------------------------------------------


@query("product_freq_p90", oracle("SELECT DISTINCT product FROM top_ids"))
def _p90(fx):
    return recommend.product_freq_p90(fx.tx, fx.catalog, PARAMS)


@query(
    "product_freq_p90_by_id",
    oracle("""SELECT product, freq FROM (SELECT product, count(*) AS freq FROM tx GROUP BY 1)
              WHERE freq >= (SELECT quantile_cont(f, 0.9) FROM (SELECT count(*) AS f FROM tx GROUP BY product))"""),
)
def _p90_id(fx):
    return recommend.product_freq_p90_by_id(fx.tx)


@query(
    "recent_product_stats",
    oracle("SELECT client, description, avg_sale_period, dias_compro FROM history_stats"),
)
def _stats(fx):
    named = recommend.sales_with_descriptions(fx.valid, fx.catalog, FX_EXCLUDED)
    return recommend.recent_product_stats(named, named.select("client"), 1)


@query(
    "top_fraction_per_client",
    oracle("""SELECT client, product AS description, cnt AS dias_compro FROM (
                SELECT *, row_number() OVER (PARTITION BY client ORDER BY cnt DESC, product) AS r,
                  count(*) OVER (PARTITION BY client) AS n
                FROM (SELECT client, product, count(*) AS cnt FROM tx GROUP BY 1, 2))
              WHERE r <= ceil(n * 0.75)"""),
)
def _fraction(fx):
    stats = item_item.user_item_counts(fx.tx).withColumnsRenamed({"product": "description", "cnt": "dias_compro"})
    return recommend.top_fraction_per_client(stats, 0.75)


# --- recommenders -------------------------------------------------------------------------


GLOBAL = "SELECT client, recommended_product, recommendation_score, recommendation_rank FROM g_counts_recs"


@query("recs_global", oracle(GLOBAL))
def _global(fx):
    return recommend.recs_global(fx.product_day, fx.catalog, PARAMS)


BY_CLIENT = """SELECT c.client, array_to_string(coalesce(r.recommended_products, []), ' | ') AS recommended_products
FROM (SELECT DISTINCT client FROM c_counts) c LEFT JOIN (
  SELECT client, list(coalesce(description, recommended_product) ORDER BY recommendation_rank) AS recommended_products
  FROM c_counts_recs LEFT JOIN fx_catalog ON product = recommended_product GROUP BY 1) r ON r.client = c.client"""


@query("recs_by_client", oracle(BY_CLIENT))
def _by_client(fx):
    return joined(recommend.recs_by_client(fx.product_day, fx.catalog, PARAMS))


@query(
    "recs_recent_history",
    oracle("SELECT client, recommended_products, avg_sale_period FROM history_recs"),
)
def _history(fx):
    clients = fx.valid.select(F.col("id_client").alias("client"))
    return recommend.recs_recent_history(fx.valid, fx.catalog, clients, PARAMS)


CAMPAIGN_DATES = ["2024-01-20", "2024-01-31"]


@query(
    "predict_campaign",
    oracle("""SELECT s.date, s.client, s.prob, c.name, r.recommended_products, r.avg_sale_period
              FROM scored s JOIN fx_contacts c USING (client) LEFT JOIN history_recs r USING (client)
              WHERE s.prob >= 0.5 AND s.date IN (DATE '2024-01-20', DATE '2024-01-31')"""),
)
def _campaign(fx):
    """With a fixed score; ``predict_campaign_model`` uses a fitted one."""
    chosen = likely(fx).select("client")
    recs = recommend.recs_recent_history(fx.valid, fx.catalog, chosen, PARAMS)
    return recommend.campaign(fx.scored, fx.contacts, recs, CAMPAIGN_DATES, 0.5)


COMBINED = """SELECT s.date, s.client, s.prob, r.recommended_product, r.recommendation_score,
                r.recommendation_rank, d.description,
                array_to_string(k.cluster_recommended_products, ' | ') AS cluster_recommended_products
              FROM scored s LEFT JOIN c_counts_recs r USING (client)
              LEFT JOIN fx_catalog d ON d.product = r.recommended_product
              LEFT JOIN (SELECT client, list(product ORDER BY rank) AS cluster_recommended_products
                         FROM c_top GROUP BY 1) k USING (client)
              WHERE s.prob >= 0.5"""


@query("combine_recs", oracle(COMBINED))
def _combine(fx):
    counts = client_counts(fx)
    recs = item_item.recommend_items(counts, item_item.item_cosine(counts), 5)
    lists = recommend.topn_per_client(recent_tx(fx), 5).groupBy("client").agg(
        recommend.ordered_list("rank", "product").alias("recommended_products")
    )
    return joined(recommend.combine_recs(likely(fx), recs, fx.catalog, lists))


@query(
    "job_combine",
    oracle(f"""SELECT strftime(date, '%Y-%m-%d') AS date, client, printf('%.4f', {rnd('prob')}) AS prob, recommended_product,
                 printf('%.4f', recommendation_score) AS recommendation_score, recommendation_rank::VARCHAR AS recommendation_rank,
                 description FROM ({COMBINED})"""),
)
def _job_combine(fx):
    """A predictions file and stored recommendations; the clusters' table is missing and skipped."""
    base = work_dir(fx.spark, "combine")
    writers.sink_csv(rounded(likely(fx)), f"{base}/predictions")
    counts = client_counts(fx)
    recs = item_item.recommend_items(counts, item_item.item_cosine(counts), 5)
    writers.sink_parquet(recs, f"{base}/recs")
    jobs.job_combine(fx.spark, f"{base}/predictions", f"{base}/recs", f"{base}/out", fx.catalog, f"{base}/none")
    return fx.spark.read.option("header", True).csv(f"{base}/out")


@query("job_recs_global", oracle(GLOBAL))
def _job_global(fx):
    base = work_dir(fx.spark, "recs-global")
    writers.sink_parquet(fx.product_day, f"{base}/product_day")
    jobs.job_recs_global(fx.spark, f"{base}/product_day", fx.catalog, f"{base}/recs", PARAMS)
    return fx.spark.read.parquet(f"{base}/recs")


@query("job_recs_by_client", oracle(BY_CLIENT))
def _job_by_client(fx):
    base = work_dir(fx.spark, "recs")
    writers.sink_parquet(fx.product_day, f"{base}/product_day")
    jobs.job_recs_by_client(fx.spark, f"{base}/product_day", fx.catalog, f"{base}/recs", PARAMS)
    return joined(fx.spark.read.parquet(f"{base}/recs"))


