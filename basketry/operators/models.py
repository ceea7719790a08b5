"""Purchase model, its calibration and explanation, and K-Means segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.operators import clustering
from basketry.operators.boosting import fit_trees
from basketry.operators.isotonic import fit_isotonic
from basketry.operators.linear import LogisticModel, fit_logistic, fit_sigmoid
from basketry.operators.segmentation import (
    VIP_FEATURES,
    label_segments_5,
    label_segments_vip,
    prepare_cluster_matrix,
    standardise,
)
from basketry.params import ModelParams, SegmentParams, VipParams
from basketry.session import materialise


# --- training -------------------------------------------------------------------


def train_logistic(df: DataFrame, params: ModelParams = ModelParams()) -> PipelineModel:
    """Logistic model by Newton steps; see :mod:`basketry.operators.linear`."""
    return PipelineModel(stages=[fit_logistic(df, params)])


def train_gbt(
    df: DataFrame, params: ModelParams = ModelParams(), keys: Sequence[str] = ("client", "date")
) -> PipelineModel:
    """Boosted trees on binned features with balanced classes; see :mod:`basketry.operators.boosting`."""
    return PipelineModel(stages=[fit_trees(df, params, keys)])


def train(df: DataFrame, params: ModelParams = ModelParams()) -> PipelineModel:
    if params.model_type == "gradient_boosting":
        return train_gbt(df, params)
    if params.model_type == "logistic_regression":
        return train_logistic(df, params)
    raise ValueError(f"unknown model type {params.model_type}")


# --- calibration ----------------------------------------------------------------


def calibrate_sigmoid(base: PipelineModel, df: DataFrame, label: str) -> PipelineModel:
    """Platt scaling of a fitted model that stays as it is."""
    return PipelineModel(stages=[*base.stages, fit_sigmoid(base.transform(df), label)])


def calibrate_isotonic(base: PipelineModel, df: DataFrame, label: str) -> PipelineModel:
    """Isotonic calibration of the base probability; see :mod:`basketry.operators.isotonic`."""
    return PipelineModel(stages=[*base.stages, fit_isotonic(base.transform(df), label)])


def score(model: Transformer, df: DataFrame, output: str = "prob") -> DataFrame:
    """Add the probability of a purchase, calibrated if the model is."""
    out = model.transform(df)
    if "calibrated_prob" in out.columns:
        prob = F.col("calibrated_prob")
    else:
        prob = vector_to_array("probability")[1]
    return out.select(*[F.col(c) for c in df.columns], prob.alias(output))


# --- explanation ----------------------------------------------------------------


def coef_importance(model: PipelineModel, params: ModelParams = ModelParams(), top_n: int = 15) -> DataFrame:
    """Absolute coefficients of the logistic model, largest first."""
    logistic = next(s for s in model.stages if isinstance(s, LogisticModel))
    rows = [(f, abs(c)) for f, c in logistic.coefficients.items()]
    table = SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), F.asc("feature")).limit(top_n)


def _sample(df: DataFrame, rows: int | None, seed: int, keys: Sequence[str]) -> DataFrame:
    """A repeatable random sample: the rows with the lowest hash of their key; all without a number."""
    hashed = df.withColumn("_h", F.xxhash64(F.lit(seed), *keys))
    return hashed if rows is None else hashed.orderBy("_h", *keys).limit(rows)


def permutation_importance(
    model: Transformer,
    df: DataFrame,
    params: ModelParams = ModelParams(),
    keys: Sequence[str] = ("client", "date"),
    buckets: int | None = None,
) -> DataFrame:
    """Loss of accuracy when one feature is shuffled, averaged over the repeats.

    Works on every row, or on a sample of ``permutation_rows``. Rows lie in random order, by a
    hash of their keys, in ``buckets`` random buckets (as many as shuffle partitions if not
    given). The repeat ``j`` gives each row the value of the ``j``-th row after it, the first
    following the last, so one window of as many rows as repeats carries all shuffled values
    beside a row. Only these rows are shuffled between tasks; the changed copies are made, scored
    and counted where they lie. Counts are whole, so a feature without influence gets exactly 0.
    """
    features, repeats = list(params.features), params.permutation_repeats
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = _sample(df.select(*keys, *features, params.target), params.permutation_rows, params.seed, keys)
    order = F.md5(F.concat_ws("|", F.lit(str(params.seed)), *[F.col(k).cast("string") for k in keys]))
    dealt = sample.drop("_h").withColumn("_order", order).withColumn(
        "_bucket", F.pmod(F.conv(F.substring("_order", 1, 8), 16, 10).cast("long"), F.lit(buckets))
    )
    whole = W.partitionBy("_bucket")
    rows = whole.orderBy("_order", *keys)
    own = F.struct(*features)
    placed = dealt.withColumn("_place", F.row_number().over(rows)).withColumn(
        "_after", F.collect_list(own).over(rows.rowsBetween(1, repeats))
    )
    firsts = F.collect_list(F.when(F.col("_place") <= repeats, F.struct("_place", own.alias("_own"))))
    ringed = placed.withColumn("_size", F.count(F.lit(1)).over(whole)).withColumn(
        "_ring", F.concat("_after", F.transform(F.sort_array(firsts.over(whole)), lambda x: x["_own"]))
    )
    copies = ringed.withColumn("_repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats)))).withColumn(
        "_theirs", F.element_at("_ring", ((F.col("_repeat") - 1) % F.col("_size") + 1).cast("int"))
    )
    # The copy without a shuffled feature is the row itself, for the accuracy to compare with.
    changed = copies.withColumn("_feature", F.explode(F.array(F.lit(""), *[F.lit(f) for f in features]))).withColumns(
        {f: F.when(F.col("_feature") == f, F.col(f"_theirs.{f}")).otherwise(F.col(f)) for f in features}
    )
    hit = (F.col("prediction") == F.col(params.target)).cast("long")
    scored = model.transform(changed.select("_feature", params.target, *features))
    hits = scored.groupBy("_feature").agg(F.sum(hit).alias("_hits"), F.count(F.lit(1)).alias("_rows"))
    # One row per feature.
    base = F.max(F.when(F.col("_feature") == "", F.col("_hits"))).over(W.partitionBy(F.lit(0)))
    loss = (base - F.col("_hits")) / F.col("_rows")
    return hits.select(F.col("_feature").alias("feature"), loss.alias("importance")).where("feature != ''")


def linear_shap(
    df: DataFrame,
    coefficients: dict[str, float],
    rows: int | None = None,
    keys: Sequence[str] = ("client", "date"),
    seed: int = 42,
) -> DataFrame:
    """Mean absolute contribution of each feature of a linear model.

    In a linear model a feature contributes its coefficient times the distance from
    the mean. ``rows`` limits the sample; without it every row counts.
    """
    if rows is not None:
        df = _sample(df, rows, seed, keys)
    names = list(coefficients)
    mean = df.agg(F.struct(*[F.avg(c).alias(c) for c in names])).scalar()
    parts = [
        F.avg(F.abs(F.lit(w) * (F.col(c) - F.col(f"_mean.{c}")))).alias(c)
        for c, w in coefficients.items()
    ]
    return df.withColumn("_mean", mean).agg(*parts).unpivot([], names, "feature", "mean_abs_shap")


# --- K-Means --------------------------------------------------------------------


def elbow_scan(
    matrix: DataFrame,
    columns: Sequence[str],
    ks: Sequence[int],
    seed: int = 42,
    max_iter: int = 300,
    tol: float = 1e-4,
    starts: Sequence[Sequence[Sequence[float]]] | None = None,
) -> DataFrame:
    """Inertia and silhouette per number of clusters, over all rows.

    All numbers of clusters are fitted together; ``starts`` may state their first centres.
    """
    stored = clustering.points(matrix, columns)
    first = starts or clustering.starts(stored, len(columns), [(k, seed) for k in ks])
    fits = clustering.lloyd(stored, first, max_iter, tol)
    rows = [(k, f.cost, s) for k, f, s in zip(ks, fits, clustering.silhouettes(stored, fits))]
    return matrix.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def best_k(scan: DataFrame) -> int:
    """Number of clusters with the best silhouette, the smallest of several."""
    return scan.orderBy(F.desc("silhouette"), F.asc("k")).first()["k"]


def choose_k(matrix: DataFrame, columns: Sequence[str], params: SegmentParams) -> int:
    """Number of clusters with the best silhouette; never more than the clients allow."""
    k_max = min(params.k_max, matrix.count() - 1)
    if params.k_min >= k_max:
        return params.k_min
    return best_k(elbow_scan(matrix, columns, range(params.k_min, k_max + 1), params.seed, params.max_iter, params.tol))


def _clustered(matrix: DataFrame, columns: Sequence[str], settings: Sequence[tuple[int, int]], params, name: str) -> DataFrame:
    """``matrix`` with the cluster of the cheapest of the fits."""
    stored = clustering.points(matrix, columns)
    first = getattr(params, "starts", None) or clustering.starts(stored, len(columns), settings)
    fits = clustering.lloyd(stored, first, params.max_iter, params.tol)
    best = min(fits, key=lambda f: f.cost)
    return matrix.withColumn(name, clustering.nearest(columns, best.centers))


def kmeans_segments(features: DataFrame, params: SegmentParams = SegmentParams()) -> DataFrame:
    """Cluster clients on their scaled features and name the clusters.

    The features are stored first: scaling reads them several times, and the rounds
    read what follows.
    """
    columns = [c + "_z" for c in params.features]
    matrix = prepare_cluster_matrix(materialise(features, "segment-features"), params.features)
    given = params.n_clusters is not None and params.n_clusters > 0
    k = params.n_clusters if given else choose_k(matrix, columns, params)
    return label_segments_5(_clustered(matrix, columns, [(k, params.seed)], params, "cluster").drop(*columns))


def kmeans_vip(features: DataFrame, params: VipParams = VipParams()) -> DataFrame:
    """Cluster VIP clients, best of several seeds by cost, and name the clusters."""
    columns = [c + "_z" for c in VIP_FEATURES]
    matrix = standardise(materialise(features, "vip-features"), VIP_FEATURES, "_z")
    settings = [(params.n_clusters, params.seed + i) for i in range(params.restarts)]
    return label_segments_vip(_clustered(matrix, columns, settings, params, "cluster_id").drop(*columns))
