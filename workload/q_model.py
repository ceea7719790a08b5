"""Checked queries: splits, metrics, backtest and the purchase model."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from basketry import work_dir
from basketry.operators import metrics, models, recommend
from basketry.operators.linear import LogisticModel
from basketry.params import MODEL_FEATURES, ModelParams
from basketry.plans import jobs
from basketry.sources import writers
from workload.fixtures import FX_EXCLUDED, FX_SPLIT_DAYS
from workload.oracle_models import metrics_sql
from workload.oracle_views import oracle
from workload.registry import query, rnd, rounded

# Thirty days of events leave ten for validation.
FX_MODEL = ModelParams(split_days=FX_SPLIT_DAYS)
# Jobs that fit trees on the way to something else.
FX_FEW_TREES = ModelParams(split_days=FX_SPLIT_DAYS, trees=20)
FX_FIRST_TREE = ModelParams(split_days=FX_SPLIT_DAYS, trees=1, depth=3, early_stopping_rows=1 << 40)
# The threshold lies inside the range of calibrated scores, so that some days have hits and misses.
FX_LOGISTIC = ModelParams(split_days=FX_SPLIT_DAYS, model_type="logistic_regression", threshold=0.36)

AT = "0.5"


# --- splits and weights -----------------------------------------------------------------


@query("temporal_split", oracle("SELECT client, date, purchased, split FROM split"))
def _split(fx):
    return metrics.temporal_split(fx.calendar, FX_SPLIT_DAYS).select("client", "date", "purchased", "split")


@query(
    "calibration_split",
    oracle(f"""SELECT client, date, purchased, CASE WHEN date <= last - {FX_SPLIT_DAYS} THEN NULL
                 WHEN date <= last - {FX_SPLIT_DAYS - FX_SPLIT_DAYS // 2} THEN 'calibration'
                 WHEN date <= last THEN 'test' END AS split
               FROM calendar CROSS JOIN last_hist"""),
)
def _calibration_split(fx):
    return metrics.calibration_split(fx.calendar, FX_SPLIT_DAYS).select("client", "date", "purchased", "split")


@query(
    "class_weights",
    oracle(f"""SELECT purchased AS label, count(*) AS rows,
                 {rnd('(SELECT count(*) FROM calendar) / (2 * count(*))', 6)} AS weight FROM calendar GROUP BY 1"""),
)
def _weights(fx):
    return rounded(metrics.class_weights(fx.calendar, "purchased"), 6)


@query(
    "class_distribution",
    oracle(f"""SELECT purchased AS label, count(*) AS rows,
                 {rnd('count(*) / (SELECT count(*) FROM calendar)', 6)} AS share FROM calendar GROUP BY 1"""),
)
def _distribution(fx):
    return rounded(metrics.class_distribution(fx.calendar, "purchased"), 6)


# --- metrics ------------------------------------------------------------------------------

CELLS = f"""SELECT count(*) FILTER (purchased = 1 AND prob >= {AT}) AS tp,
  count(*) FILTER (purchased = 0 AND prob >= {AT}) AS fp, count(*) FILTER (purchased = 1 AND prob < {AT}) AS fn,
  count(*) FILTER (purchased = 0 AND prob < {AT}) AS tn FROM scored"""


@query("confusion_counts", oracle(CELLS))
def _confusion(fx):
    return metrics.confusion_counts(fx.scored, "purchased", "prob", 0.5)


@query(
    "binary_metrics",
    oracle(f"""SELECT {rnd('auc', 6)} AS roc_auc, {rnd('brier', 6)} AS brier, {rnd('tp / (tp + fp)', 6)} AS "precision",
                 {rnd('tp / (tp + fn)', 6)} AS recall, {rnd('1.25 * tp / (1.25 * tp + 0.25 * fn + fp)', 6)} AS f05
               FROM ({CELLS})
               CROSS JOIN (SELECT avg((prob - purchased) * (prob - purchased)) AS brier FROM scored)
               CROSS JOIN (
                 SELECT (sum(CASE WHEN purchased = 1 THEN mid END) - any_value(p) * (any_value(p) + 1) / 2)
                        / (any_value(p) * (count(*) - any_value(p))) AS auc
                 FROM (SELECT purchased, sum(purchased) OVER () AS p,
                         rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2 AS mid FROM scored))"""),
)
def _binary(fx):
    return rounded(metrics.binary_metrics(fx.scored, "purchased", "prob", 0.5), 6)


def _class_rows() -> str:
    f1 = "2.0 * {h} / (2 * {h} + {w} + {m})"
    n = dict(h="tn", w="fn", m="fp")
    p = dict(h="tp", w="fp", m="fn")
    score = lambda d: [f"1.0 * {d['h']} / ({d['h']} + {d['w']})", f"1.0 * {d['h']} / ({d['h']} + {d['m']})", f1.format(**d)]
    a, b, acc = score(n), score(p), "1.0 * (tp + tn) / (tp + tn + fp + fn)"
    total = "(tp + tn + fp + fn)"
    rows = [
        ("0", a, "tn + fp"),
        ("1", b, "tp + fn"),
        ("accuracy", [acc] * 3, total),
        ("macro avg", [f"(({x}) + ({y})) / 2" for x, y in zip(a, b)], total),
        ("weighted avg", [f"(({x}) * (tn + fp) + ({y}) * (tp + fn)) / {total}" for x, y in zip(a, b)], total),
    ]
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS class, {rnd(s[0], 6)} AS "precision", {rnd(s[1], 6)} AS recall, {rnd(s[2], 6)} AS f1_score,
              cast({support} AS BIGINT) AS support FROM ({CELLS})"""
        for name, s, support in rows
    )


@query("classification_report", oracle(_class_rows()))
def _report(fx):
    return rounded(metrics.classification_report(fx.scored, "purchased", "prob", 0.5), 6)


@query(
    "calibration_curve",
    oracle(f"""SELECT cast(greatest(0, ceil(prob * 10) - 1) AS INTEGER) AS bin, {rnd('avg(prob)', 6)} AS mean_predicted,
                 {rnd('avg(purchased)', 6)} AS observed_rate, count(*) AS rows FROM scored GROUP BY 1"""),
)
def _calibration_curve(fx):
    return rounded(metrics.calibration_curve(fx.scored, "purchased", "prob"), 6)


CURVE = f"""SELECT s.prob AS threshold, {rnd('sum(t.p) / sum(t.n)', 6)} AS "precision",
  {rnd('sum(t.p) / (SELECT sum(purchased) FROM scored)', 6)} AS recall
FROM (SELECT DISTINCT prob FROM scored) s
JOIN (SELECT prob, sum(purchased) AS p, count(*) AS n FROM scored GROUP BY 1) t ON t.prob >= s.prob GROUP BY 1"""


@query("pr_curve", oracle(CURVE))
def _pr(fx):
    return metrics.pr_curve(fx.scored, "purchased", "prob").select(
        "threshold", *[F.round(F.col(c) + 0.033e-6, 6).alias(c) for c in ("precision", "recall")]
    )


@query(
    "pr_at",
    oracle(f"""SELECT w.wanted, min(c.threshold) AS threshold, min_by(c."precision", c.threshold) AS "precision",
                 min_by(c.recall, c.threshold) AS recall
               FROM (SELECT cast(unnest([0.3, 0.4, 0.5, 0.6]) AS DOUBLE) AS wanted) w
               JOIN ({CURVE}) c ON c.threshold >= w.wanted GROUP BY 1"""),
)
def _pr_at(fx):
    points = metrics.pr_at(metrics.pr_curve(fx.scored, "purchased", "prob"))
    return points.select(
        "wanted", "threshold", *[F.round(F.col(c) + 0.033e-6, 6).alias(c) for c in ("precision", "recall")]
    )


# --- backtest -----------------------------------------------------------------------------

DAYS = """SELECT cast(d AS DATE) AS day FROM (SELECT unnest(generate_series(DATE '2024-01-24', DATE '2024-02-02', INTERVAL 1 DAY)) AS d)"""
OUTCOME = f"""SELECT coalesce(a.date, p.date) AS date, coalesce(a.client, p.client) AS client,
  CASE WHEN a.client IS NULL THEN 'FP' WHEN p.client IS NULL THEN 'FN' ELSE 'TP' END AS outcome
FROM (SELECT DISTINCT date, client FROM fx_daily) a
FULL JOIN (SELECT DISTINCT date, client FROM scored WHERE prob >= {AT}) p ON a.date = p.date AND a.client = p.client"""
DAILY = f"""SELECT day AS fecha, count(*) FILTER (outcome = 'TP') AS TP, count(*) FILTER (outcome = 'FP') AS FP,
  count(*) FILTER (outcome = 'FN') AS FN FROM ({DAYS}) LEFT JOIN ({OUTCOME}) o ON o.date = day GROUP BY 1"""
SCORES = f"""SELECT *, coalesce(TP / nullif(TP + FP, 0), 0) AS pr, coalesce(TP / nullif(TP + FN, 0), 0) AS re,
  coalesce(1.25 * TP / nullif(1.25 * TP + 0.25 * FN + FP, 0), 0) AS fb FROM ({DAILY})"""


def backtest(fx):
    start, end = F.lit("2024-01-24").cast("date"), F.lit("2024-02-02").cast("date")
    return metrics.backtest_daily(fx.daily, recommend.filter_prob(fx.scored, 0.5), start, end)


@query("full_outer_indicator", oracle(OUTCOME))
def _indicator(fx):
    return metrics.full_outer_indicator(fx.daily, recommend.filter_prob(fx.scored, 0.5))


@query(
    "backtest_daily",
    oracle(f"""SELECT fecha, TP, FP, FN, TP + FN AS "Clientes_Compraron", TP + FP AS "Clientes_Predichos",
                 {rnd('pr', 6)} AS "Precision", {rnd('re', 6)} AS "Recall", {rnd('fb', 6)} AS "F0.5-score" FROM ({SCORES})"""),
)
def _backtest(fx):
    return rounded(backtest(fx), 6)


@query(
    "backtest_average",
    oracle(f"""SELECT {rnd('avg(pr)', 6)} AS "Precision", {rnd('avg(re)', 6)} AS "Recall", {rnd('avg(fb)', 6)} AS "F0.5-score"
               FROM ({SCORES})"""),
)
def _average(fx):
    return rounded(metrics.backtest_average(backtest(fx)), 6)


# --- model --------------------------------------------------------------------------------


def parts(fx, params):
    split = metrics.temporal_split(fx.stored_calendar, params.split_days)
    return split.where(F.col("split") == "train"), split.where(F.col("split") == "valid")


def halves(fx, params):
    split = metrics.calibration_split(fx.stored_calendar, params.split_days)
    return split.where(F.col("split") == "calibration"), split.where(F.col("split") == "test")


def _metrics_row(source: str, prob: str, at: float, names: dict[str, str], digits: int = 4) -> str:
    shown = ", ".join(f'{rnd(c, digits)} AS "{n}"' for c, n in names.items())
    return f"SELECT {shown} FROM ({metrics_sql(source, prob, at)})"


FIVE = {"auc": "roc_auc", "brier": "brier", "pr": "precision", "re": "recall", "fb": "f05"}


@query("train_logistic", oracle(_metrics_row("(SELECT * FROM based WHERE split = 'valid')", "base_prob", 0.5, FIVE)))
def _logistic(fx):
    train, valid = parts(fx, FX_LOGISTIC)
    scored = models.score(models.train_logistic(train, FX_LOGISTIC), valid)
    return rounded(metrics.binary_metrics(scored, "purchased", "prob", 0.5))


@query("train_gbt")
def _gbt(fx):
    train, valid = parts(fx, FX_MODEL)
    scored = models.score(models.train_gbt(train, FX_MODEL), valid)
    return rounded(metrics.binary_metrics(scored, "purchased", "prob", 0.5))


def _first_tree_sql(p: ModelParams) -> str:
    """The first tree, level by level: bins, histograms, best splits, and rows sent to their nodes."""
    unit = float(1 << 28)
    values = "\nUNION ALL ".join(f"SELECT rid, {i} AS f, cast({c} AS DOUBLE) AS x FROM r" for i, c in enumerate(p.features))
    shares = ", ".join(repr(k / p.max_bins) for k in range(1, p.max_bins))
    l2 = p.l2
    part = lambda g, h: f"({g}) / {unit} * ({g}) / {unit} / (({h}) / {unit} + {l2})"
    levels = ["n0 AS (SELECT rid, 0 AS node FROM r)"]
    for d in range(p.depth):
        levels.append(f"""h{d} AS (
  SELECT n.node, b.f, b.bin, sum(r.g) AS g, sum(r.h) AS h, count(*) AS n
  FROM n{d} n JOIN r USING (rid) JOIN b USING (rid) GROUP BY ALL),
c{d} AS (
  SELECT *, sum(g) OVER up AS gl, sum(h) OVER up AS hl, sum(n) OVER up AS nl,
    sum(g) OVER al AS gt, sum(h) OVER al AS ht, sum(n) OVER al AS nt
  FROM h{d} WINDOW up AS (PARTITION BY node, f ORDER BY bin), al AS (PARTITION BY node, f)),
s{d} AS (
  SELECT node, f, bin, nt, gain FROM (
    SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, bin) AS k FROM (
      SELECT *, {part("gl", "hl")} + {part("gt - gl", "ht - hl")} - {part("gt", "ht")} AS gain FROM c{d}
      WHERE nl >= {p.min_leaf} AND nt - nl >= {p.min_leaf}))
  WHERE k = 1 AND gain > 0),
n{d + 1} AS (
  SELECT n.rid, cast(2 * n.node + CASE WHEN b.bin <= s.bin THEN 1 ELSE 2 END AS INTEGER) AS node
  FROM n{d} n JOIN s{d} s USING (node) JOIN b ON b.rid = n.rid AND b.f = s.f)""")
    splits = "\nUNION ALL ".join(f"SELECT * FROM s{d}" for d in range(p.depth))
    nodes = "\nUNION ALL ".join(f"SELECT * FROM n{d}" for d in range(p.depth + 1))
    names = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(p.features))
    base = oracle("SELECT 1 FROM split")
    return base[: base.rindex("\nSELECT 1")] + f""",
w AS (SELECT purchased AS y, count(*) AS n, (SELECT count(*) FROM split WHERE split = 'train') / (2 * count(*)) AS w
      FROM split WHERE split = 'train' GROUP BY 1),
m AS (SELECT 1 / (1 + exp(-ln(sum(n * w) FILTER (y = 1) / sum(n * w) FILTER (y = 0)))) AS p FROM w),
r AS (SELECT s.*, row_number() OVER () AS rid, cast(round_even(w * (p - y) * {unit}, 0) AS BIGINT) AS g,
             cast(round_even(w * p * (1 - p) * {unit}, 0) AS BIGINT) AS h
      FROM split s JOIN w ON w.y = s.purchased CROSS JOIN m WHERE split = 'train'),
v AS ({values}),
dv AS (SELECT f, x, lead(x) OVER (PARTITION BY f ORDER BY x) AS y, count(*) OVER (PARTITION BY f) AS d
       FROM (SELECT DISTINCT f, x FROM v)),
e AS (SELECT f, edge, row_number() OVER (PARTITION BY f ORDER BY edge) AS bin FROM (
        SELECT f, (x + y) / 2 AS edge FROM dv WHERE d <= {p.max_bins} AND y IS NOT NULL
        UNION SELECT f, unnest(quantile_cont(x, [{shares}])) FROM v
        WHERE f IN (SELECT f FROM dv WHERE d > {p.max_bins}) GROUP BY f)),
b AS MATERIALIZED (SELECT v.rid, v.f, coalesce(e.bin, 0) + 1 AS bin FROM v ASOF LEFT JOIN e ON v.f = e.f AND v.x > e.edge),
{",".join(levels)},
splits AS ({splits}),
sums AS (SELECT node, sum(g) AS g, sum(h) AS h, count(*) AS n FROM ({nodes}) JOIN r USING (rid) GROUP BY 1)
SELECT cast(node AS INTEGER) AS node, CASE s.f {names} END AS feature, {rnd("coalesce(e.edge, 0)", 6)} AS threshold,
  {rnd("coalesce(gain, 0)", 4)} AS gain, cast(n AS BIGINT) AS rows,
  {rnd(f"CASE WHEN s.f IS NULL THEN -{p.learning_rate} * (g / {unit}) / (h / {unit} + {l2}) ELSE 0 END", 6)} AS value
FROM sums LEFT JOIN splits s USING (node) LEFT JOIN e ON e.f = s.f AND e.bin = s.bin"""


@query("gbt_first_tree", _first_tree_sql(FX_FIRST_TREE))
def _first_tree(fx):
    """Bins, split search and leaf values of one tree over all training rows."""
    train, _ = parts(fx, FX_FIRST_TREE)
    nodes = models.train_gbt(train, FX_FIRST_TREE).stages[0].table(train)
    return nodes.select(
        "node", "feature", *[F.round(F.col(c) + 0.033 * 10**-d, d).alias(c) for c, d in (("threshold", 6), ("gain", 4))],
        "rows", F.round(F.col("value") + 0.033e-6, 6).alias("value"),
    )


def _calibrated(fx, method):
    train, _ = parts(fx, FX_LOGISTIC)
    calibration, test = halves(fx, FX_LOGISTIC)
    base = models.train_logistic(train, FX_LOGISTIC)
    return models.score(method(base, calibration, "purchased"), test)


@query(
    "calibrate_sigmoid",
    oracle(f"""SELECT cast(greatest(0, ceil(prob * 10) - 1) AS INTEGER) AS bin, {rnd('avg(prob)', 6)} AS mean_predicted,
                 {rnd('avg(purchased)', 6)} AS observed_rate, count(*) AS rows FROM calibrated WHERE half = 'test' GROUP BY 1"""),
)
def _sigmoid(fx):
    return rounded(metrics.calibration_curve(_calibrated(fx, models.calibrate_sigmoid), "purchased", "prob"), 6)


@query("calibrate_isotonic", oracle(f"SELECT client, date, purchased, {rnd('prob', 6)} AS prob FROM isotonic"))
def _isotonic(fx):
    scored = _calibrated(fx, models.calibrate_isotonic)
    return rounded(scored.select("client", "date", "purchased", "prob"), 6)


@query("score", oracle(f"SELECT client, date, purchased, {rnd('prob', 6)} AS prob FROM calibrated WHERE half = 'test'"))
def _score(fx):
    return rounded(_calibrated(fx, models.calibrate_sigmoid).select("client", "date", "purchased", "prob"), 6)


@query(
    "score_in_range",
    oracle(f"""SELECT client, date, purchased, true AS probability FROM calendar CROSS JOIN last_hist
               WHERE date > last - {FX_SPLIT_DAYS - FX_SPLIT_DAYS // 2} AND date <= last"""),
)
def _score_in_range(fx):
    return _score(fx).select("client", "date", "purchased", F.col("prob").between(0, 1).alias("probability"))


@query(
    "coef_importance",
    oracle("\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, {rnd(f'abs(b[{i}])', 5)} AS importance FROM logit" for i, f in enumerate(MODEL_FEATURES, 1)
    )),
)
def _coef(fx):
    """Coefficients of the fit, all of them, as there are fewer than fifteen."""
    found = models.coef_importance(models.train_logistic(parts(fx, FX_LOGISTIC)[0], FX_LOGISTIC), FX_LOGISTIC)
    return rounded(found, 5)


@query("permutation_importance")
def _permutation(fx):
    train, valid = parts(fx, FX_LOGISTIC)
    return models.permutation_importance(models.train_logistic(train, FX_LOGISTIC), valid, FX_LOGISTIC)


STATED_MODEL = {
    "features": list(MODEL_FEATURES), "scale": [1.0 + i for i in range(len(MODEL_FEATURES))],
    "coefficients": [0.0 if i % 4 == 3 else 0.3 * (-1) ** i for i in range(len(MODEL_FEATURES))], "intercept": -0.5,
}
STATED_REPEATS = 3


def _permutation_sql() -> str:
    def margin(changed: str | None) -> str:
        parts = zip(STATED_MODEL["features"], STATED_MODEL["scale"], STATED_MODEL["coefficients"])
        return " + ".join([str(STATED_MODEL["intercept"]), *[f"{w} * ({'q' if f == changed else 'o'}.{f} / {s})" for f, s, w in parts]])

    accuracy = lambda f: f"avg(CASE WHEN ({margin(f)} > 0) = (o.purchased = 1) THEN 1.0 ELSE 0.0 END)"
    means = ", ".join([f"{accuracy(None)} AS base", *[f"{accuracy(f)} AS a_{f}" for f in STATED_MODEL["features"]]])
    rows = "\nUNION ALL ".join(f"SELECT '{f}' AS feature, {rnd(f'base - a_{f}', 6)} AS importance FROM m" for f in STATED_MODEL["features"])
    base = oracle("SELECT * FROM split")
    return base[: base.rindex("\nSELECT * FROM split")] + f""",
o AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '{FX_LOGISTIC.seed}', client, cast(date AS VARCHAR)))) - 1 AS at,
             count(*) OVER () AS n FROM split WHERE split = 'valid'),
m AS (SELECT {means} FROM o CROSS JOIN (SELECT unnest(range(1, {STATED_REPEATS} + 1)) AS j) JOIN o q ON q.at = (o.at + j) % o.n)
{rows}"""


@query("permutation_importance_stated", _permutation_sql())
def _permutation_stated(fx):
    """Every shuffled value and every accuracy for a model of stated coefficients."""
    model = LogisticModel(spec=json.dumps(STATED_MODEL))
    params = replace(FX_LOGISTIC, permutation_repeats=STATED_REPEATS)
    return rounded(models.permutation_importance(model, parts(fx, FX_LOGISTIC)[1], params, buckets=1), 6)


WEIGHTS = {f: 0.1 * (i + 1) * (-1) ** i for i, f in enumerate(MODEL_FEATURES)}


@query(
    "linear_shap",
    oracle("\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {rnd(f'avg(abs({w!r} * ({c} - m) / s))', 6)} AS mean_abs_shap "
        f"FROM calendar CROSS JOIN (SELECT avg({c}) AS m, coalesce(nullif(stddev_samp({c}), 0), 1) AS s FROM calendar)"
        for c, w in WEIGHTS.items()
    )),
)
def _shap(fx):
    """All features on the scale of the model, fixed coefficients, every row."""
    calendar = fx.stored_calendar
    spread = calendar.agg(F.struct(*[F.stddev_samp(c).alias(c) for c in WEIGHTS])).scalar()
    scaled = calendar.withColumn("_s", spread).select(
        "client", "date", *[(F.col(c) / F.coalesce(F.nullif(F.col(f"_s.{c}"), F.lit(0.0)), F.lit(1.0))).alias(c) for c in WEIGHTS]
    )
    return rounded(models.linear_shap(scaled, WEIGHTS), 6)


@query(
    "predict_campaign_model",
    oracle("""SELECT strftime(s.date, '%Y-%m-%d') AS date, s.client, printf('%.4f', s.base_prob) AS prob, c.name,
                r.recommended_products, cast(r.avg_sale_period AS VARCHAR) AS avg_sale_period
              FROM based s JOIN fx_contacts c USING (client) LEFT JOIN history_recs r USING (client)
              WHERE s.base_prob >= 0.5 AND s.date IN (DATE '2024-01-30', DATE '2024-01-31')"""),
)
def _campaign(fx):
    base = work_dir(fx.spark, "campaign")
    writers.sink_parquet(fx.calendar, f"{base}/calendar")
    jobs.job_train(fx.spark, f"{base}/calendar", f"{base}/model", FX_LOGISTIC)
    jobs.job_predict(
        fx.spark, f"{base}/calendar", f"{base}/model", fx.valid, fx.catalog, fx.contacts,
        [date(2024, 1, 30), date(2024, 1, 31)], f"{base}/out", 0.5, FX_LOGISTIC,
        recommend.RecommendParams(excluded=FX_EXCLUDED),
    )
    return fx.spark.read.option("header", True).csv(f"{base}/out")


@query("job_train")
def _job_train(fx):
    base = work_dir(fx.spark, "train")
    writers.sink_parquet(fx.calendar, f"{base}/calendar")
    model = jobs.job_train(fx.spark, f"{base}/calendar", f"{base}/model", FX_FEW_TREES)
    return models.score(model, fx.stored_calendar).select("client", "date", "prob")


@query("job_train_logistic", oracle(f"SELECT client, date, {rnd('base_prob', 6)} AS prob FROM based"))
def _job_train_logistic(fx):
    """The stored logistic model scores every day of the calendar."""
    base = work_dir(fx.spark, "train")
    writers.sink_parquet(fx.calendar, f"{base}/calendar")
    jobs.job_train(fx.spark, f"{base}/calendar", f"{base}/model", FX_LOGISTIC)
    scored = models.score(PipelineModel.load(f"{base}/model"), fx.stored_calendar)
    return rounded(scored.select("client", "date", "prob"), 6)


@query("job_train_in_range", oracle("SELECT client, date, true AS probability FROM calendar"))
def _job_train_in_range(fx):
    return _job_train(fx).select("client", "date", F.col("prob").between(0, 1).alias("probability"))


def _evaluated(fx, params):
    base = work_dir(fx.spark, "evaluate")
    writers.sink_parquet(fx.calendar, f"{base}/calendar")
    jobs.job_train(fx.spark, f"{base}/calendar", f"{base}/model", params)
    jobs.job_evaluate(fx.spark, f"{base}/calendar", f"{base}/model", f"{base}/calibrated", f"{base}/report", params)
    return base


def _named(model: str) -> dict[str, str]:
    at = FX_LOGISTIC.threshold
    return dict(zip(FIVE, (f"{model}_{n}" for n in ("roc_auc", "brier", f"precision@{at}", f"recall@{at}", f"f0.5@{at}"))))


TEST = "(SELECT * FROM calibrated WHERE half = 'test')"
EVALUATED = " CROSS JOIN ".join(
    f"({_metrics_row(TEST, prob, FX_LOGISTIC.threshold, _named(model), 5)})" for model, prob in (("base", "base_prob"), ("cal", "prob"))
)


@query("job_evaluate", oracle(f"SELECT * FROM {EVALUATED}"))
def _job_evaluate(fx):
    return rounded(fx.spark.read.json(f"{_evaluated(fx, FX_LOGISTIC)}/report/metrics"), 5)


BACKTEST = (
    SCORES.replace("scored WHERE prob >= 0.5", f"calibrated WHERE prob >= {FX_LOGISTIC.threshold}")
    .replace("2024-02-02", "2024-01-30")
)


@query(
    "job_backtest",
    oracle(f"""SELECT strftime(fecha, '%Y-%m-%d') AS fecha, TP::VARCHAR AS TP, FP::VARCHAR AS FP, FN::VARCHAR AS FN,
                 (TP + FN)::VARCHAR AS "Clientes_Compraron", (TP + FP)::VARCHAR AS "Clientes_Predichos",
                 printf('%.4f', pr) AS "Precision", printf('%.4f', re) AS "Recall", printf('%.4f', fb) AS "F0.5-score"
               FROM ({BACKTEST})"""),
)
def _job_backtest(fx):
    """Raw tickets rebuilt from purchase events, scored by the calibrated model."""
    base = _evaluated(fx, FX_LOGISTIC)
    lines = F.array(F.struct(
        F.lit("1").alias("product"), F.col("value").alias("amount"),
        F.col("value").alias("invoice_value_with_discount_and_without_iva"), F.lit(0.0).alias("tax"),
    ))
    raw = fx.table("events").where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("ID"),
        F.to_date("ts").alias("date_sale"),
        (F.col("user_id") + 10000000).cast("string").alias("identification_doct"),
        F.col("value").alias("invoice_value_without_iva_and_discount"),
        F.lit("S1").alias("id_point_sale"),
        F.lit("N").alias("domicilio_status"),
        lines.alias("invoice_details"),
    )
    writers.sink_parquet(raw, f"{base}/raw")
    jobs.job_backtest(
        fx.spark, f"{base}/calendar", f"{base}/calibrated", f"{base}/raw", f"{base}/backtest",
        date(2024, 1, 24), date(2024, 1, 30), FX_LOGISTIC,
    )
    return fx.spark.read.option("header", True).csv(f"{base}/backtest")


@query(
    "job_backtest_buyers",
    oracle("""SELECT strftime(cast(d AS DATE), '%Y-%m-%d') AS fecha, cast(count(DISTINCT f.client) AS VARCHAR) AS "Clientes_Compraron"
              FROM (SELECT unnest(generate_series(DATE '2024-01-24', DATE '2024-01-30', INTERVAL 1 DAY)) AS d)
              LEFT JOIN fx_daily f ON f.date = cast(d AS DATE) GROUP BY 1"""),
)
def _job_backtest_buyers(fx):
    """How many clients bought does not depend on the model."""
    return _job_backtest(fx).select("fecha", "Clientes_Compraron")
