"""Views of fitted models for the oracles: Newton steps as recursive SQL."""

from __future__ import annotations

from basketry.params import MODEL_FEATURES
from workload.fixtures import FX_SPLIT_DAYS
from workload.oracle_views import SQL


def newton_sql(rows: str, size: int, ridge: list[float], rounds: int) -> str:
    """Coefficients ``b`` after Newton steps from zero over ``rows`` (x1, ..., t, w).

    Each round sums the normal equations and solves them by elimination, a pivot a level; the
    matrix is positive definite, so pivots need no search.
    """
    margin = " + ".join(f"b[{i}] * x{i}" for i in range(1, size + 1))
    lines = []
    for i in range(1, size + 1):
        cells = [
            f"sum(v * x{i} * x{j})" + (f" + {ridge[i - 1]}" if i == j and ridge[i - 1] else "") for j in range(1, size + 1)
        ]
        right = f"sum(r * x{i})" + (f" + {ridge[i - 1]} * any_value(b)[{i}]" if ridge[i - 1] else "")
        lines.append(f"[{', '.join([*cells, right])}]")
    body = f"""SELECT i, any_value(b) AS b, [{", ".join(lines)}] AS m0 FROM (
  SELECT *, w * p * (1 - p) AS v, w * (p - t) AS r FROM (
    SELECT s.i, s.b, d.*, 1 / (1 + exp(-({margin}))) AS p FROM steps s, ({rows}) d WHERE s.i < {rounds})) GROUP BY i"""
    for q in range(1, size + 1):
        m = f"m{q - 1}"
        body = f"""SELECT i, b, list_transform({m}, lambda r, n: CASE WHEN n = {q} THEN list_transform(r, lambda c: c / r[{q}])
  ELSE list_transform(r, lambda c, j: c - r[{q}] * {m}[{q}][j] / {m}[{q}][{q}]) END) AS m{q} FROM ({body})"""
    zeros = ", ".join(["0.0"] * size)
    return f"""
WITH RECURSIVE steps(i, b) AS (
  SELECT 0, [{zeros}]::DOUBLE[]
  UNION ALL
  SELECT i + 1, list_transform(b, lambda c, n: c - m{size}[n][{size + 1}]) FROM ({body}))
SELECT b FROM steps WHERE i = {rounds}"""


_N = len(MODEL_FEATURES)
_SCALED = ", ".join(f"{f} / s_{f} AS x{i}" for i, f in enumerate(MODEL_FEATURES, 1))
_MARGIN = " + ".join(f"b[{i}] * ({f} / s_{f})" for i, f in enumerate(MODEL_FEATURES, 1))

SQL |= {
    "train": "SELECT * FROM split WHERE split = 'train'",
    "scales": "SELECT " + ", ".join(f"coalesce(nullif(stddev_pop({f}), 0), 1) AS s_{f}" for f in MODEL_FEATURES) + " FROM train",
    "class_w": "SELECT purchased AS y, (SELECT count(*) FROM train) / (2 * count(*)) AS w FROM train GROUP BY 1",
    "logit": newton_sql(
        f"SELECT {_SCALED}, 1.0 AS x{_N + 1}, purchased AS t, w FROM train CROSS JOIN scales JOIN class_w ON y = purchased",
        _N + 1, [1.0] * _N + [0.0], 9,
    ),
    "based": f"""
SELECT client, date, purchased, split, half, margin, 1 / (1 + exp(-margin)) AS base_prob FROM (
  SELECT s.*, b[{_N + 1}] + {_MARGIN} AS margin,
    CASE WHEN date <= last - {FX_SPLIT_DAYS} THEN NULL WHEN date <= last - {FX_SPLIT_DAYS - FX_SPLIT_DAYS // 2} THEN 'calibration'
         WHEN date <= last THEN 'test' END AS half
  FROM split s CROSS JOIN last_hist CROSS JOIN scales CROSS JOIN logit)""",
    "platt_rows": """
SELECT margin AS x1, 1.0 AS x2, 1.0 AS w, CASE WHEN purchased = 1
         THEN (sum(purchased) OVER () + 1) / (sum(purchased) OVER () + 2)
         ELSE 1 / (sum(1 - purchased) OVER () + 2) END AS t
FROM based WHERE half = 'calibration'""",
    "platt": newton_sql("SELECT * FROM platt_rows", 2, [0.0, 0.0], 9),
    "calibrated": "SELECT *, 1 / (1 + exp(-(b[1] * margin + b[2]))) AS prob FROM based CROSS JOIN platt",
}


# The fit by its max-min formula over distinct scores, then straight lines between scores.
SQL |= {
    "rates": """
SELECT row_number() OVER (ORDER BY base_prob) AS k, base_prob AS score,
  sum(sum(purchased)) OVER (ORDER BY base_prob) AS s, sum(count(*)) OVER (ORDER BY base_prob) AS n,
  sum(purchased) AS own_s, count(*) AS own_n
FROM based WHERE half = 'calibration' GROUP BY base_prob""",
    "iso": """
SELECT k, any_value(score) AS score, max(least_mean) AS rate FROM (
  SELECT j AS k, score, min(mean) OVER (PARTITION BY i ORDER BY j DESC) AS least_mean FROM (
    SELECT a.k AS i, b.k AS j, b.score, (b.s - a.s + a.own_s) / (b.n - a.n + a.own_n) AS mean
    FROM rates a JOIN rates b ON a.k <= b.k))
GROUP BY k""",
    "isotonic": """
SELECT t.*, CASE WHEN a.rate IS NULL THEN b.rate WHEN b.rate IS NULL OR b.score = a.score THEN a.rate
    ELSE a.rate + (b.rate - a.rate) * (base_prob - a.score) / (b.score - a.score) END AS prob
FROM (SELECT * FROM based WHERE half = 'test') t
ASOF LEFT JOIN iso a ON t.base_prob >= a.score ASOF LEFT JOIN iso b ON t.base_prob <= b.score""",
}

def metrics_sql(source: str, prob: str, at: float) -> str:
    """Metrics of one score column as one row: auc, brier, pr, re, fb."""
    return f"""
SELECT (sum(CASE WHEN purchased = 1 THEN mid END) - any_value(p) * (any_value(p) + 1) / 2) / (any_value(p) * (count(*) - any_value(p))) AS auc,
  avg((q - purchased) * (q - purchased)) AS brier,
  coalesce(count(*) FILTER (purchased = 1 AND q >= {at}) / nullif(count(*) FILTER (q >= {at}), 0), 0) AS pr,
  count(*) FILTER (purchased = 1 AND q >= {at}) / any_value(p) AS re,
  1.25 * count(*) FILTER (purchased = 1 AND q >= {at}) / (0.25 * any_value(p) + count(*) FILTER (q >= {at})) AS fb
FROM (SELECT purchased, {prob} AS q, sum(purchased) OVER () AS p,
        rank() OVER (ORDER BY {prob}) + (count(*) OVER (PARTITION BY {prob}) - 1) / 2 AS mid FROM {source})"""


def lloyd_sql(rows: str, starts: list[list[float]], rounds: int) -> str:
    """Centres ``c`` after Lloyd steps over ``rows`` (id, x) from stated starts, as a list of lists.

    A cluster without rows keeps its centre.
    """
    size = len(starts[0])
    means = ", ".join(f"avg(x[{i}])" for i in range(1, size + 1))
    return f"""
WITH RECURSIVE steps(i, c) AS (
  SELECT 0, {starts!r}::DOUBLE[][]
  UNION ALL
  SELECT i + 1, list_transform(c, lambda e, n: coalesce(m[n], e)) FROM (
    SELECT i, any_value(c) AS c, map(list(k), list(centre)) AS m FROM (
      SELECT i, k, any_value(c) AS c, [{means}] AS centre FROM (
        SELECT i, c, x, list_position(d, list_min(d)) AS k FROM (
          SELECT s.i, s.c, z.x, {distances("s.c", "z.x")} AS d FROM steps s, ({rows}) z WHERE s.i < {rounds}))
      GROUP BY i, k)
    GROUP BY i))
SELECT c FROM steps WHERE i = {rounds}"""


def distances(centres: str, point: str) -> str:
    return f"list_transform({centres}, lambda e: list_sum(list_transform(e, lambda v, j: (v - {point}[j]) * (v - {point}[j]))))"


def placed_sql(rows: str, starts: list[list[float]], rounds: int) -> str:
    """Rows (id, x, c, d, k): centres, squared distances to them, and the nearest, from 1 on."""
    return f"""SELECT *, list_position(d, list_min(d)) AS k FROM (
  SELECT z.id, z.x, f.c, {distances("f.c", "z.x")} AS d FROM ({rows}) z CROSS JOIN ({lloyd_sql(rows, starts, rounds)}) f)"""


def silhouette_sql(placed: str) -> str:
    """Mean silhouette under squared distances, from the distances of all pairs."""
    return f"""SELECT avg(CASE WHEN own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM (
  SELECT id, max(n) FILTER (same) AS own, max(total / (n - 1)) FILTER (same AND n > 1) AS a, min(total / n) FILTER (NOT same) AS b FROM (
    SELECT p.id, p.k = q.k AS same, q.k, count(*) AS n, sum({" + ".join("(p.x[%d] - q.x[%d]) * (p.x[%d] - q.x[%d])" % (i, i, i, i) for i in range(1, 7))}) AS total
    FROM ({placed}) p CROSS JOIN ({placed}) q GROUP BY ALL)
  GROUP BY id)"""
