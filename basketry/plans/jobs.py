"""The jobs of the purchase pipeline.

``*_plan`` functions compose operators into one lazy plan; ``job_*`` functions read
their inputs, run a plan and write its result. A table that several later steps read
is written once and read back, which also cuts its lineage.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas
from basketry.functions.dates import days_cutoff
from basketry.functions.text import parse_literal_list, strip
from basketry.operators import behaviour, models
from basketry.operators.calendar import calendar_features
from basketry.operators.clean import (
    clean_new_sales,
    explode_details,
    explode_details_strict,
    filter_positive_ticket,
    filter_vip_weeks,
    iso_week_key,
    normalise_sales,
    rename_vip,
    semi_join,
    validate_client_ids,
)
from basketry.operators.item_item import IN_PLACE
from basketry.operators.metrics import (
    backtest_average,
    backtest_daily,
    binary_metrics,
    calibration_curve,
    calibration_split,
    classification_report,
    known_clients,
    pr_at,
    pr_curve,
    train_end,
)
from basketry.operators.patterns import (
    agg_client_product_day,
    agg_daily_client,
    client_regularity,
    filter_patterns,
    filter_recent_clients,
    segmentation_features,
)
from basketry.operators.recommend import (
    campaign,
    combine_recs,
    filter_prob,
    recs_by_client,
    recs_by_cluster,
    recs_global,
    recs_recent_history,
)
from basketry.operators.segmentation import export_vip, join_segments, main_point_of_sale, vip_features
from basketry.params import (
    CalendarParams,
    DeclineParams,
    ModelParams,
    PatternParams,
    RecommendParams,
    SegmentParams,
    VipParams,
    WindowParams,
)
from basketry.session import materialise, settings
from basketry.sources.landing import land
from basketry.sources.months import SALES_KEY, STORED, last_day, merge_months
from basketry.sources.readers import (
    empty_table,
    load_calendar,
    load_contacts,
    load_predictions_csv,
    load_recs_optional,
    or_none,
    scan_parquet,
)
from basketry.sources.writers import sink_csv, sink_metrics, sink_parquet

# --- load, preprocess, featurize --------------------------------------------------


def job_land(
    spark: SparkSession,
    tickets_path: str,
    landed_path: str,
    ledger_path: str,
    today: date,
    batch: str | None = None,
    force: Sequence[str] = (),
) -> list[str]:
    """Land the months of received tickets that are not landed yet; gives their names."""
    tickets = scan_parquet(spark, tickets_path, schemas.RAW_TICKETS)
    return land(spark, tickets, landed_path, ledger_path, today, batch or today.isoformat(), force)


def job_load(
    spark: SparkSession,
    raw_path: str,
    sales_path: str,
    state_path: str,
    today: date,
    batch: str | None = None,
) -> bool:
    """Bring the sales, stored by month, up to date with nested raw tickets.

    Only tickets since the last stored day are read, and only the months of new lines are
    rewritten. ``False`` when the sales are up to date, or nothing new has come: then no file
    changes. Read the result by :func:`basketry.sources.months.read_months`, which keeps to the
    last months.
    """
    raw = scan_parquet(spark, raw_path, schemas.RAW_TICKETS)
    stored = or_none(spark.read.schema(STORED).parquet, sales_path)
    last = None if stored is None else last_day(stored)
    if last is not None:
        if last >= today:
            return False
        raw = raw.where(F.col("date_sale") >= F.lit(last))
    new = clean_new_sales(raw)
    if last is not None:
        # What is stored already, as the last day is read again, is not new.
        held = stored.where(F.col("month") == f"{last:%Y-%m}").where(F.col("date_sale") == F.lit(last))
        new = new.join(held, list(SALES_KEY), "left_anti")
    return bool(merge_months(new, batch or f"load-{today.isoformat()}", sales_path, state_path))


def regular_clients(
    sales: DataFrame, params: PatternParams = PatternParams(), window: WindowParams = WindowParams()
) -> DataFrame:
    """Sales of valid, recent clients who buy regularly.

    The lines are read twice: to measure every valid client, and to keep the lines of
    those that qualify.
    """
    valid = validate_client_ids(sales)
    return semi_join(valid, regular_ids(valid, params, window), "id_client")


def regular_ids(
    valid: DataFrame, params: PatternParams = PatternParams(), window: WindowParams = WindowParams()
) -> DataFrame:
    """Patterns of recent clients within the limits.

    The table of one row per client is stored, so that its latest purchase, which is
    the latest date of the lines, costs no second pass over them.
    """
    found = materialise(client_regularity(valid), "regularity")
    cutoff = days_cutoff(found, window.recent_months, "last_purchase")
    recent = found.where(F.col("last_purchase") >= cutoff).drop("last_purchase")
    return filter_patterns(recent, params)


def job_preprocess(
    spark: SparkSession,
    sales_path: str,
    product_day_path: str,
    daily_path: str,
    params: PatternParams = PatternParams(),
    window: WindowParams = WindowParams(),
) -> None:
    sales = scan_parquet(spark, sales_path, schemas.SALES)
    sink_parquet(agg_client_product_day(regular_clients(sales, params, window)), product_day_path)
    sink_parquet(agg_daily_client(scan_parquet(spark, product_day_path)), daily_path)


def job_featurize(
    spark: SparkSession, daily_path: str, calendar_path: str, params: CalendarParams = CalendarParams()
) -> None:
    """Write the calendar; training, evaluation, backtest and campaign all read it."""
    sink_parquet(calendar_features(scan_parquet(spark, daily_path), params), calendar_path)


# --- model ------------------------------------------------------------------------


def job_train(
    spark: SparkSession, calendar_path: str, model_path: str, params: ModelParams = ModelParams()
) -> PipelineModel:
    calendar = load_calendar(spark, calendar_path)
    past = calendar.where(F.col("date") <= train_end(calendar, params.split_days))
    model = models.train(past, params)
    model.write().overwrite().save(model_path)
    return model


def calibrate(base: PipelineModel, df: DataFrame, params: ModelParams) -> PipelineModel:
    if params.calibration == "isotonic":
        return models.calibrate_isotonic(base, df, params.target)
    return models.calibrate_sigmoid(base, df, params.target)


def job_evaluate(
    spark: SparkSession,
    calendar_path: str,
    model_path: str,
    calibrated_path: str,
    report_path: str,
    params: ModelParams = ModelParams(),
) -> PipelineModel:
    """Calibrate on the first half of the validation days, judge both models on the second."""
    calendar = load_calendar(spark, calendar_path)
    # Only the validation days are read; the split repeats the condition.
    recent = F.col("date") > train_end(calendar, params.split_days)
    halves = calibration_split(calendar, params.split_days).where(recent)
    base = PipelineModel.load(model_path)
    calibrated = calibrate(base, halves.where(F.col("split") == "calibration"), params)
    calibrated.write().overwrite().save(calibrated_path)

    test = halves.where(F.col("split") == "test")
    both = models.score(calibrated, models.score(base, test, "base_prob"), "cal_prob")
    scored_path = f"{report_path}/scored"
    sink_parquet(both.select("client", "date", params.target, "base_prob", "cal_prob"), scored_path)
    scored = scan_parquet(spark, scored_path)

    target, at = params.target, params.threshold
    judged = {}
    # The base model is reported by its own decision, which is always at one half.
    for model, prob, cut in (("base", "base_prob", 0.5), ("cal", "cal_prob", at)):
        one = binary_metrics(scored, target, prob, at)
        judged[model] = one.select(F.struct(*one.columns)).scalar()
        sink_metrics(classification_report(scored, target, prob, cut), f"{report_path}/report_{model}")
        sink_metrics(calibration_curve(scored, target, prob, params.bins), f"{report_path}/bins_{model}")
    names = {"roc_auc": "roc_auc", "brier": "brier", "precision": f"precision@{at}", "recall": f"recall@{at}", "f05": f"f0.5@{at}"}
    both = spark.range(1).select(*[m.alias(f"_{k}") for k, m in judged.items()])
    metrics = both.select(
        *[F.col(f"_{k}.{c}").alias(f"{k}_{shown}") for k in judged for c, shown in names.items()]
    )
    sink_metrics(metrics, f"{report_path}/metrics")
    curve_path = f"{report_path}/pr_curve"
    sink_parquet(pr_curve(scored, target, "cal_prob"), curve_path)
    sink_metrics(pr_at(scan_parquet(spark, curve_path)), f"{report_path}/pr_points")
    if params.model_type == "logistic_regression":
        importance = models.coef_importance(base, params)
        logistic = base.stages[0]
        shap = models.linear_shap(
            logistic.scaled(test, "client", "date"), logistic.coefficients, params.shap_rows, seed=params.seed
        )
        sink_metrics(shap, f"{report_path}/shap")
    else:
        importance = models.permutation_importance(base, test, params)
    sink_metrics(importance, f"{report_path}/importance")
    return calibrated


def actual_buyers(raw: DataFrame) -> DataFrame:
    """Date and client of every raw ticket line."""
    lines = explode_details(raw)
    return normalise_sales(lines).select(F.col("date_sale").alias("date"), F.col("id_client").alias("client"))


def job_backtest(
    spark: SparkSession,
    calendar_path: str,
    calibrated_path: str,
    raw_path: str,
    output_path: str,
    start: date,
    end: date,
    params: ModelParams = ModelParams(),
) -> DataFrame:
    """Predicted against actual buyers per day; returns the mean scores."""
    first, last = F.lit(start), F.lit(end)
    calendar = load_calendar(spark, calendar_path)
    raw = scan_parquet(spark, raw_path, schemas.RAW_TICKETS)
    actual = known_clients(actual_buyers(raw.where(F.col("date_sale").between(first, last))), calendar)
    days = calendar.where(F.col("date").between(first, last))
    likely = filter_prob(models.score(PipelineModel.load(calibrated_path), days), params.threshold)
    daily = backtest_daily(actual, likely, first, last)
    # Stored once, so that the mean scores do not score the days again.
    daily = materialise(daily, "backtest")
    sink_csv(daily, output_path, [F.col("fecha")])
    return backtest_average(daily)


# --- VIP and segments ---------------------------------------------------------------


def vip_plan(
    raw: DataFrame, catalog: DataFrame | None, params: VipParams = VipParams()
) -> DataFrame:
    """Raw months to the lines of clients active in enough weeks.

    The ticket lines may still be the text of a list, as older exports have them.
    """
    if isinstance(raw.schema["invoice_details"].dataType, T.StringType):
        raw = raw.withColumn("invoice_details", parse_literal_list("invoice_details"))
    lines = normalise_sales(explode_details_strict(raw)).drop("id_client")
    if catalog is not None:
        lines = lines.join(catalog, "product", "left")
    vip = rename_vip(lines.withColumn("identification_doct", strip("identification_doct")))
    return filter_vip_weeks(iso_week_key(vip), params.min_weeks)


def job_vip(
    spark: SparkSession, raw: DataFrame, catalog: DataFrame | None, output_path: str,
    params: VipParams = VipParams(),
) -> None:
    sink_parquet(vip_plan(raw, catalog, params), output_path)


def job_segment_vip(
    spark: SparkSession,
    vip: DataFrame,
    contacts: DataFrame | None,
    output_path: str,
    params: VipParams = VipParams(),
) -> None:
    lines = filter_positive_ticket(validate_client_ids(vip, "user_id"))
    segments = models.kmeans_vip(vip_features(lines), params)
    sink_parquet(export_vip(segments, main_point_of_sale(lines), contacts), output_path)


def job_segment_recs(
    spark: SparkSession,
    sales: DataFrame,
    catalog: DataFrame,
    assignments_path: str,
    recs_path: str,
    params: SegmentParams = SegmentParams(),
    excluded: Sequence[str] = RecommendParams().excluded,
) -> None:
    """Segment recently active clients and recommend each segment's popular products.

    Without any such client an empty table of the right shape is written.
    """
    lines = filter_recent_clients(normalise_sales(validate_client_ids(sales)), params.recent_months)
    # Stored once: the check for rows, the features and the recommendations all read it.
    recent = materialise(lines, "recent")
    if recent.isEmpty():
        sink_parquet(empty_table(spark, schemas.CLUSTER_RECS), recs_path)
        return
    sink_parquet(models.kmeans_segments(segmentation_features(recent), params), assignments_path)
    assignments = scan_parquet(spark, assignments_path)
    sink_parquet(recs_by_cluster(recent, assignments, catalog, excluded), recs_path)


def job_behaviour(
    spark: SparkSession,
    lines: DataFrame,
    segments: DataFrame,
    year: int,
    output_path: str,
    params: DeclineParams = DeclineParams(),
) -> None:
    """All tables of behaviour over time, per segment (``user_id``, ``cluster_id``).

    What several tables read is stored once: the tickets and lines of the segments, and the
    declined clients of the year.
    """
    def table(name: str, df: DataFrame) -> DataFrame:
        sink_parquet(df, f"{output_path}/{name}")
        return scan_parquet(spark, f"{output_path}/{name}")

    members = segments.select("user_id", "cluster_id")
    named = materialise(join_segments(lines, members, "user_id", ("cluster_id",)), "segment-lines")
    tickets = materialise(named.select("tiket_id", "user_id", "tiket_price", "date_sale", "cluster_id").distinct(), "segment-tickets")
    table("monthly_evolution", behaviour.monthly_evolution(tickets))
    table("day_of_month", behaviour.day_of_month_spend(tickets))
    core = table("product_penetration", behaviour.product_penetration(named))
    table("core_products", behaviour.core_products(core))
    this_year = tickets.where(F.year("date_sale") == year)
    declined = table("declined", behaviour.declining_clients(this_year, params))
    table("decline_trend", behaviour.decline_trend(this_year, declined))
    table("decline_summary", behaviour.decline_summary(members, declined))
    table("product_cutback", behaviour.product_cutback(named.where(F.year("date_sale") == year), declined, params))


# --- recommendations and campaign -------------------------------------------------


def job_recs_global(
    spark: SparkSession, product_day_path: str, catalog: DataFrame, output_path: str,
    params: RecommendParams = RecommendParams(),
) -> None:
    with settings(spark, IN_PLACE):
        sink_parquet(recs_global(scan_parquet(spark, product_day_path), catalog, params), output_path)


def job_recs_by_client(
    spark: SparkSession, product_day_path: str, catalog: DataFrame, output_path: str,
    params: RecommendParams = RecommendParams(),
) -> None:
    with settings(spark, IN_PLACE):
        sink_parquet(recs_by_client(scan_parquet(spark, product_day_path), catalog, params), output_path)


def job_predict(
    spark: SparkSession,
    calendar_path: str,
    calibrated_path: str,
    sales: DataFrame,
    catalog: DataFrame,
    contacts: DataFrame,
    dates: Sequence[date],
    output_path: str,
    threshold: float | None = None,
    params: ModelParams = ModelParams(),
    recs: RecommendParams = RecommendParams(),
) -> None:
    """Score the given dates and write the call list with contacts and products."""
    threshold = params.threshold if threshold is None else threshold
    calendar = load_calendar(spark, calendar_path)
    days = calendar.where(F.col("date").isin([F.lit(d) for d in dates]))
    # Stored once: the histories of likely clients and the campaign both read it.
    scored = materialise(models.score(PipelineModel.load(calibrated_path), days), "scored-days")
    sales = sales.withColumn("product", strip(F.col("product").cast("string")))
    history = recs_recent_history(sales, catalog, filter_prob(scored, threshold).select("client"), recs)
    # One call per client, however many contact records there are.
    out = campaign(scored, load_contacts(contacts), history, dates, threshold)
    sink_csv(out, output_path, [F.asc("date"), F.desc("prob")])


def job_combine(
    spark: SparkSession,
    predictions_path: str,
    item_recs_path: str,
    output_path: str,
    catalog: DataFrame | None = None,
    cluster_recs_path: str | None = None,
) -> None:
    """Join stored recommendations to a predictions file; a missing table is skipped."""
    predictions = load_predictions_csv(spark, predictions_path)
    clusters = load_recs_optional(spark, cluster_recs_path) if cluster_recs_path else None
    out = combine_recs(predictions, load_recs_optional(spark, item_recs_path), catalog, clusters)
    sink_csv(out, output_path)


__all__ = [name for name in dir() if name.startswith("job_") or name.endswith("_plan")]
