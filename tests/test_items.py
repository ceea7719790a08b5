"""Similarity and recommendations against brute force, with one client holding a third."""

import math
import random
from collections import Counter, defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.operators import item_item, recommend, skew
from basketry.operators.item_item import IN_PLACE
from basketry.params import RecommendParams
from basketry.session import materialise, settings


def purchases():
    """One client and one product each take about a third of the rows."""
    rng = random.Random(5)
    out = [("hot", f"p{rng.randrange(40):02d}") for _ in range(300)]
    out += [(f"c{rng.randrange(60):02d}", "p00") for _ in range(300)]
    out += [(f"c{rng.randrange(60):02d}", f"p{rng.randrange(40):02d}") for _ in range(300)]
    return out


@pytest.fixture()
def counts(spark):
    return item_item.user_item_counts(spark.createDataFrame(purchases(), "client string, product string"))


def brute_similarity():
    cells = Counter(purchases())
    columns = defaultdict(dict)
    for (c, p), n in cells.items():
        columns[p][c] = n
    norm = {p: math.sqrt(sum(n * n for n in col.values())) for p, col in columns.items()}
    sim = {}
    for a in columns:
        for b in columns:
            dot = sum(n * columns[b].get(c, 0) for c, n in columns[a].items())
            if a != b and dot:
                sim[a, b] = dot / (norm[a] * norm[b])
    return cells, sim


@pytest.mark.parametrize("per_salt", [4, 256])
def test_cosine_is_whole_however_finely_a_client_is_split(counts, monkeypatch, per_salt):
    monkeypatch.setattr(item_item, "PRODUCTS_PER_SALT", per_salt)
    got = {(r["product_i"], r["product_j"]): r["sim"] for r in item_item.item_cosine(counts).collect()}
    _, want = brute_similarity()
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    assert all(0 < v <= 1 + 1e-12 and got[b, a] == v for (a, b), v in got.items())


def test_salting_spreads_the_hot_client(counts, monkeypatch):
    monkeypatch.setattr(item_item, "PRODUCTS_PER_SALT", 4)
    plan = item_item.item_pair_dots(counts)._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("blocks,in_place", [(None, {}), (1, IN_PLACE), (7, {}), (7, IN_PLACE)])
def test_recommendations(spark, counts, blocks, in_place):
    cells, sim = brute_similarity()
    bought = defaultdict(dict)
    for (c, p), n in cells.items():
        bought[c][p] = n
    products = {p for _, p in cells}
    want = set()
    for c, mine in bought.items():
        scores = {
            j: round(sum(n * sim.get((i, j), 0) for i, n in mine.items()), 6) for j in products - set(mine)
        }
        best = sorted((-s, j) for j, s in scores.items() if s > 0)[:5]
        want |= {(c, j, -s, r + 1) for r, (s, j) in enumerate(best)}
    with settings(spark, in_place):
        recs = item_item.recommend_items(counts, item_item.item_cosine(counts), 5, blocks=blocks)
        got = set(rows(recs, "client", "recommended_product", "recommendation_score", "recommendation_rank"))
    assert {(c, j, r) for c, j, _, r in got} == {(c, j, r) for c, j, _, r in want}
    assert not {(c, j) for c, j, *_ in got} & set(cells)


def test_no_exchange_after_the_blocks_meet(spark, counts):
    """Join, sum, anti join and rank run where clients and similarities were dealt."""
    sim = materialise(item_item.item_cosine(counts), "sim")
    stored = materialise(counts, "counts")
    with settings(spark, IN_PLACE | {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        recs = item_item.recommend_items(stored, sim, 5, blocks=3)
        plan = recs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange shufflepartitionidpassthrough") in (2, 3)
    assert "hashpartitioning" not in plan and "Window" in plan and "LeftAnti" in plan


@pytest.mark.parametrize("per_salt", [3, 1_000_000])
def test_similarities_go_only_where_their_product_was_bought(spark, counts, per_salt):
    """Two buyers need two copies however many blocks there are; salts change nothing."""
    pairs = [(f"k{i}", f"{i}{x}") for i in range(50) for x in "ab"]
    few = item_item.user_item_counts(spark.createDataFrame(pairs, "client string, product string"))
    sim = item_item.item_cosine(few)
    assert item_item.similarities_by_block(few, sim, 500, per_salt).count() == sim.count() == 100
    sim, block = item_item.item_cosine(counts), F.pmod(F.xxhash64("client"), F.lit(7)).cast("int")
    homes = counts.select(F.col("product").alias("product_i"), block.alias("_block")).distinct()
    got = item_item.similarities_by_block(counts, sim, 7, per_salt).select("product_i", "product_j", "sim", "_block")
    assert rows(got) == rows(sim.join(homes, "product_i"), "product_i", "product_j", "sim", "_block")


def test_scoring_deals_as_many_similarities_as_its_clients_need(spark):
    """Fifty clients of two products each: 100 rows, not 100 for each of 500 blocks."""
    pairs = [(f"k{i}", f"{i}{x}") for i in range(50) for x in "ab"]
    few = item_item.user_item_counts(spark.createDataFrame(pairs, "client string, product string"))
    plan = item_item.score_items(few, item_item.item_cosine(few), 500)._jdf.queryExecution().optimizedPlan()
    assert "sequence(0, 499" not in plan.toString() and "explode" not in plan.toString()


def test_settings_come_back(spark):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, None)
    with pytest.raises(ValueError), settings(spark, IN_PLACE):
        assert spark.conf.get(key) == "false"
        raise ValueError
    assert spark.conf.get(key, None) == before


def test_one_item_gives_no_similarity(spark):
    counts = item_item.user_item_counts(spark.createDataFrame([("a", "x"), ("b", "x")], "client string, product string"))
    assert item_item.item_cosine(counts).count() == 0


def test_salted_join_loses_nothing(spark):
    big = spark.createDataFrame([("h", i) for i in range(500)] + [("k", 1)], "key string, x int")
    small = spark.createDataFrame([("h", "a"), ("h", "b"), ("k", "c"), ("z", "d")], "key string, y string")
    hot = skew.hot_keys(big, "key", 50)
    assert rows(hot) == [("h", 10)]
    joined = skew.spread(big, hot, "key", ["x"]).join(skew.replicate(small, hot, "key"), ["key", "_salt"])
    assert joined.count() == big.join(small, "key").count()


def test_client_without_recommendations_keeps_an_empty_list(spark, day):
    data = [(day("2024-01-01"), "a", "x", 1.0, 1.0)]
    tx = spark.createDataFrame(data, "date_sale date, id_client string, product string, quantity double, amount_paid double")
    catalog = spark.createDataFrame([("x", "X")], "product string, description string")
    assert rows(recommend.recs_by_client(tx, catalog)) == [("a", [])]


def test_names_fall_back_to_ids(spark):
    df = spark.createDataFrame([("x",), ("y",)], "product string")
    catalog = spark.createDataFrame([("x", "X")], "product string, description string")
    assert rows(recommend.map_names(df, catalog, "product", "name")) == [("x", "X"), ("y", "y")]


def test_fraction_rounds_up_and_median_is_cut(spark, day):
    d = [(day("2024-01-01"), "a", p) for p in "xxyz"] + [(day("2024-01-02"), "a", "x")]
    sales = spark.createDataFrame(d, "date_sale date, client string, description string")
    stats = recommend.recent_product_stats(sales, sales.select("client"), 1)
    assert rows(stats) == [("a", "x", 1, 2), ("a", "y", 1, 1), ("a", "z", 1, 1)]
    assert {r["description"] for r in recommend.top_fraction_per_client(stats, 0.5).collect()} == {"x", "y"}


def test_cluster_size_rounds_half_to_even(spark, day):
    sales = spark.createDataFrame([("a", p) for p in "xyz"], "id_client string, product string")
    catalog = spark.createDataFrame([(p, p.upper()) for p in "xyz"], "product string, description string")
    who = spark.createDataFrame(
        [("a", 0, 2, "s", "S"), ("b", 0, 3, "s", "S")],
        "id_client string, cluster int, product_distinct int, segment string, segment_label string",
    )
    lists = {r["client"]: r["recommended_products"] for r in recommend.recs_by_cluster(sales, who, catalog).collect()}
    assert lists == {"a": ["X", "Y"], "b": ["X", "Y"]}


def test_zero_threshold_keeps_everything(spark):
    df = spark.createDataFrame([(0.0,), (0.4,)], "prob double")
    assert recommend.filter_prob(df, 0.0).count() == 2


def test_calendar_months_are_clamped(spark, day):
    df = spark.createDataFrame([(day(d),) for d in ("2024-05-31", "2024-02-29", "2024-02-28")], "date date")
    assert recommend.filter_calendar_months(df, 3).count() == 2


def test_missing_recommendations_are_skipped(spark):
    p = spark.createDataFrame([("a", 0.5)], "client string, prob double")
    assert recommend.merge_recommendations(p, None, "x") is p
    long = spark.createDataFrame([("a", "x", 1.0)], "client string, recommended_product string, other double")
    assert recommend.merge_recommendations(p, long, "x").columns == ["client", "prob", "recommended_product"]
    assert recommend.combine_recs(p, None).columns == ["client", "prob"]


def test_top_lists_are_cut_before_the_exchange(spark):
    tx = spark.createDataFrame(purchases(), "client string, product string")
    plan = recommend.topn_per_client(tx, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert RecommendParams().products_per_client == 5 and F is not None
