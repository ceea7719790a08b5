"""Classification metrics, curves and the daily backtest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.numeric import f_beta, ratio
from basketry.operators.order_stats import running_totals


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0))


def _cells(label: Column, predicted: Column) -> dict[str, Column]:
    return {
        "tp": _count((label == 1) & (predicted == 1)),
        "fp": _count((label == 0) & (predicted == 1)),
        "fn": _count((label == 1) & (predicted == 0)),
        "tn": _count((label == 0) & (predicted == 0)),
    }


def confusion_counts(df: DataFrame, label: str, prob: str, threshold: float) -> DataFrame:
    """One row with true and false positives and negatives."""
    predicted = (F.col(prob) >= threshold).cast("int")
    cells = _cells(F.col(label), predicted)
    return df.agg(*[c.alias(n) for n, c in cells.items()])


def _by_score(df: DataFrame, label: str, prob: str) -> DataFrame:
    y = F.col(label).cast("long")
    return df.groupBy(F.col(prob).alias("score")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")
    )


def roc_auc(df: DataFrame, label: str, prob: str) -> DataFrame:
    """Exact area under the ROC curve, ties counted half."""
    ordered = running_totals(_by_score(df, label, prob), F.col("score"), ["neg"])
    wins = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ordered.agg(F.try_divide(F.sum(wins), pairs).alias("roc_auc"))


def binary_metrics(df: DataFrame, label: str, prob: str, threshold: float) -> DataFrame:
    """One row: ROC AUC, Brier score, precision, recall and F0.5 at the threshold."""
    predicted = (F.col(prob) >= threshold).cast("int")
    cells = _cells(F.col(label), predicted)
    counts = df.agg(
        F.avg(F.pow(F.col(prob) - F.col(label), 2)).alias("brier"),
        *[c.alias(n) for n, c in cells.items()],
    )
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.select(
        roc_auc(df, label, prob).scalar().alias("roc_auc"),
        "brier",
        precision.alias("precision"),
        recall.alias("recall"),
        f_beta(precision, recall).alias("f05"),
    )


def classification_report(df: DataFrame, label: str, prob: str, threshold: float) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and two averages.

    The accuracy row carries the accuracy in all three score columns.
    """
    counts = confusion_counts(df, label, prob, threshold)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def scores(hit: Column, wrong: Column, missed: Column) -> tuple[Column, ...]:
        precision, recall = ratio(hit, hit + wrong), ratio(hit, hit + missed)
        return precision, recall, f_beta(precision, recall, 1.0), hit + missed

    negative, positive = scores(tn, fn, fp), scores(tp, fp, fn)
    total = negative[3] + positive[3]
    accuracy = ratio(tp + tn, total)
    macro = [(n + p) / 2 for n, p in zip(negative[:3], positive[:3])]
    weighted = [
        ratio(n * negative[3] + p * positive[3], total) for n, p in zip(negative[:3], positive[:3])
    ]
    rows = [
        ("0", *negative),
        ("1", *positive),
        ("accuracy", accuracy, accuracy, accuracy, total),
        ("macro avg", *macro, total),
        ("weighted avg", *weighted, total),
    ]
    names = ("class", "precision", "recall", "f1_score", "support")
    structs = [
        F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(n) for n, v in zip(names, row)])
        for row in rows
    ]
    return counts.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def calibration_curve(df: DataFrame, label: str, prob: str, bins: int = 10) -> DataFrame:
    """Mean predicted and observed rate per equal-width bin; empty bins are absent.

    A score on an edge belongs to the lower bin.
    """
    bin_no = F.greatest(F.lit(0), F.ceil(F.col(prob) * bins) - 1).cast("int")
    return df.groupBy(bin_no.alias("bin")).agg(
        F.avg(prob).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"),
        F.count(F.lit(1)).alias("rows"),
    )


def pr_curve(df: DataFrame, label: str, prob: str) -> DataFrame:
    """Precision and recall when everything at or above each distinct score is predicted."""
    ordered = running_totals(_by_score(df, label, prob), -F.col("score"), ["pos", "neg"])
    hits = F.col("pos_before") + F.col("pos")
    predicted = hits + F.col("neg_before") + F.col("neg")
    positives = df.agg(F.sum(F.col(label).cast("long"))).scalar()
    return ordered.select(
        F.col("score").alias("threshold"),
        ratio(hits, predicted).alias("precision"),
        ratio(hits, positives).alias("recall"),
    )


def pr_at(curve: DataFrame, thresholds: Sequence[float] = (0.3, 0.4, 0.5, 0.6)) -> DataFrame:
    """The curve read at the first score not below each wanted threshold."""
    first = [
        F.min(
            F.when(F.col("threshold") >= t, F.struct("threshold", "precision", "recall"))
        ).alias(f"_{i}")
        for i, t in enumerate(thresholds)
    ]
    rows = [
        F.struct(
            F.lit(float(t)).alias("wanted"),
            *[F.col(f"_{i}")[c].alias(c) for c in ("threshold", "precision", "recall")],
        )
        for i, t in enumerate(thresholds)
    ]
    found = curve.agg(*first).select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")
    return found.where(F.col("threshold").isNotNull())


# --- backtest -----------------------------------------------------------------


def known_clients(actual: DataFrame, calendar: DataFrame) -> DataFrame:
    """Actual sales of clients the calendar knows."""
    return actual.join(calendar.select("client").distinct(), "client", "left_semi")


def full_outer_indicator(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Each (date, client) once, flagged TP, FP or FN."""
    bought = actual.select("date", "client").distinct().withColumn("_bought", F.lit(1))
    chosen = predicted.select("date", "client").distinct().withColumn("_chosen", F.lit(1))
    both = bought.join(chosen, ["date", "client"], "full_outer")
    outcome = (
        F.when(F.col("_bought").isNull(), "FP").when(F.col("_chosen").isNull(), "FN").otherwise("TP")
    )
    return both.select("date", "client", outcome.alias("outcome"))


def backtest_daily(
    actual: DataFrame, predicted: DataFrame, start: Column, end: Column
) -> DataFrame:
    """Hits, misses and scores per day from ``start`` to ``end``; idle days give zeros.

    ``start`` and ``end`` are date literals or scalar subqueries.
    """
    spark = actual.sparkSession
    outcome = full_outer_indicator(actual, predicted)
    per_day = (
        outcome.where(F.col("date").between(start, end))
        .groupBy("date")
        .agg(*[_count(F.col("outcome") == o).alias(o) for o in ("TP", "FP", "FN")])
    )
    days = spark.range(1).select(F.explode(F.sequence(start, end)).alias("date"))
    tp, fp, fn = (F.coalesce(F.col(c), F.lit(0)) for c in ("TP", "FP", "FN"))
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return days.join(per_day, "date", "left").select(
        F.col("date").alias("fecha"),
        tp.alias("TP"),
        fp.alias("FP"),
        fn.alias("FN"),
        (tp + fn).alias("Clientes_Compraron"),
        (tp + fp).alias("Clientes_Predichos"),
        precision.alias("Precision"),
        recall.alias("Recall"),
        f_beta(precision, recall).alias("F0.5-score"),
    )


def backtest_average(daily: DataFrame) -> DataFrame:
    """Plain mean of the daily scores."""
    return daily.agg(*[F.avg(f"`{c}`").alias(c) for c in ("Precision", "Recall", "F0.5-score")])


# --- splits and weights ---------------------------------------------------------


def _last_purchase(split_days: int) -> Column:
    """Latest day with a purchase; the end of the table minus the split if there is none."""
    bought = F.max(F.when(F.col("purchased") == 1, F.col("date")))
    return F.coalesce(bought, F.date_sub(F.max("date"), split_days))


def last_purchase_day(df: DataFrame, split_days: int) -> Column:
    return df.agg(_last_purchase(split_days)).scalar()


def train_end(df: DataFrame, split_days: int) -> Column:
    """Last training day, as a bare subquery so that a filter on it reaches the scan."""
    return df.agg(F.date_sub(_last_purchase(split_days), split_days)).scalar()


def temporal_split(df: DataFrame, split_days: int) -> DataFrame:
    """Add ``split``: train, valid, or null for the future days."""
    last = last_purchase_day(df, split_days)
    day = F.col("date")
    part = F.when(day <= F.date_sub(last, split_days), "train").when(day <= last, "valid")
    return df.withColumn("split", part)


def calibration_split(df: DataFrame, split_days: int) -> DataFrame:
    """Add ``split``: calibration and test halves of the validation days, else null."""
    last = last_purchase_day(df, split_days)
    day = F.col("date")
    middle = F.date_sub(last, split_days - split_days // 2)
    part = (
        F.when(day <= F.date_sub(last, split_days), None)
        .when(day <= middle, "calibration")
        .when(day <= last, "test")
    )
    return df.withColumn("split", part)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows and balanced weight per class: rows / (classes x rows of the class)."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.agg(F.struct(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    weight = totals["n"].cast("double") / (totals["k"] * F.col("rows"))
    return counts.select("label", "rows", weight.alias("weight"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per class."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("share", F.col("rows") / total)
