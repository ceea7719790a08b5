"""Named SQL views the oracles are built from, written for DuckDB."""

from __future__ import annotations

import re

from basketry.functions.text import GENERIC_IDS
from basketry.params import PAYDAYS
from workload.fixtures import CLIENT_ID, FX_EXCLUDED, FX_PATTERNS, FX_SPLIT_DAYS, FX_YEAR, TABLES, VIEWS

VALUE = "invoice_value_with_discount_and_without_iva"


def _texts(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _numbers(values) -> str:
    return ", ".join(str(v) for v in values)


EXCLUDED = _texts(FX_EXCLUDED)

SQL: dict[str, str] = {
    name: text.format(**{t: t for t in TABLES}) for name, text in VIEWS.items()
}

SQL |= {
    # --- sales -----------------------------------------------------------------
    "ids": f"""
SELECT *, trim(id_client) AS cid,
  CASE WHEN NOT regexp_full_match(trim(id_client), '[0-9]+') THEN 'not_digits'
       WHEN left(trim(id_client), 1) = '0' THEN 'leading_zero'
       WHEN length(trim(id_client)) NOT BETWEEN 6 AND 10 THEN 'bad_length'
       WHEN trim(id_client) IN ({_texts(GENERIC_IDS)}) THEN 'generic'
       WHEN replace(trim(id_client), left(trim(id_client), 1), '') = '' THEN 'repeated'
       ELSE 'valid' END AS reason
FROM fx_sales""",
    "valid": "SELECT * REPLACE (cid AS id_client) FROM ids WHERE reason = 'valid'",
    "recent": """
SELECT * FROM valid WHERE id_client IN (
  SELECT id_client FROM valid WHERE date_sale >= (SELECT max(date_sale) FROM valid) - 90)""",
    "gaps": """
SELECT id_client, date_sale,
  cast(date_sale - lag(date_sale) OVER (PARTITION BY id_client ORDER BY date_sale) AS INTEGER) AS days_between
FROM (SELECT DISTINCT id_client, date_sale FROM recent)""",
    "patterns": """
SELECT g.id_client, g.purchase_days, g.median_days_between, g.std_days_between, v.product_distinct
FROM (SELECT id_client, count(*) AS purchase_days, median(days_between) AS median_days_between,
             stddev_samp(days_between) AS std_days_between FROM gaps GROUP BY 1) g
JOIN (SELECT id_client, count(DISTINCT product) AS product_distinct FROM recent GROUP BY 1) v
  ON g.id_client = v.id_client""",
    "kept": f"""
SELECT * FROM patterns
WHERE purchase_days >= {FX_PATTERNS.min_purchase_days} AND median_days_between < {FX_PATTERNS.max_median_days}
  AND std_days_between <= {FX_PATTERNS.max_std_days} AND product_distinct >= {FX_PATTERNS.min_products}""",
    "product_day": f"""
SELECT date_sale, id_client, product, sum(amount) AS quantity, sum({VALUE}) AS amount_paid
FROM valid GROUP BY 1, 2, 3""",
    "tx": "SELECT id_client AS client, date_sale AS date, product, quantity, amount_paid FROM product_day",
    "daily_sales": f"""
SELECT id_client, date_sale, sum({VALUE}) AS amt, count(DISTINCT product) AS n FROM valid GROUP BY 1, 2""",
    "segment_features": """
SELECT d.id_client, count(*) / count(DISTINCT date_trunc('month', date_sale)) AS tickets_per_month,
  count(DISTINCT date_trunc('month', date_sale)) / any_value(m.total) AS months_active_ratio,
  median(amt) AS ticket_median, sum(amt) AS monetary_total, avg(n) AS products_per_visit,
  any_value(v.product_distinct) AS product_distinct
FROM daily_sales d
JOIN (SELECT id_client, count(DISTINCT product) AS product_distinct FROM valid GROUP BY 1) v USING (id_client)
CROSS JOIN (SELECT (year(max(date_sale)) - year(min(date_sale))) * 12
                   + month(max(date_sale)) - month(min(date_sale)) + 1 AS total FROM valid) m
GROUP BY 1""",
    # --- calendar ----------------------------------------------------------------
    "calendar": f"""
SELECT *, cast(isodow(date) - 1 AS INTEGER) AS dow, cast(day(date) AS INTEGER) AS dom,
  cast(month(date) AS INTEGER) AS month,
  cast(isodow(date) IN (6, 7) AS INTEGER) AS is_weekend,
  cast(day(date) IN ({_numbers(PAYDAYS)}) AS INTEGER) AS is_quincena
FROM (
  SELECT client, date, qty_tot, amount_tot, skus, purchased,
    cast(coalesce(date - max(CASE WHEN purchased = 1 THEN date END)
         OVER (PARTITION BY client ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 365) AS INTEGER) AS days_since_last,
    {", ".join(f"cast(coalesce(sum(purchased) OVER (PARTITION BY client ORDER BY date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cnt_{w}d" for w in (3, 7, 30))},
    {", ".join(f"coalesce(avg({c}) OVER (PARTITION BY client ORDER BY date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING), 0.0) AS avg_{n}_{w}d" for w in (7, 30) for n, c in (("amount", "amount_tot"), ("skus", "skus")))}
  FROM (
    SELECT c.client, cast(g.day AS DATE) AS date, coalesce(d.qty_tot, 0.0) AS qty_tot,
      coalesce(d.amount_tot, 0.0) AS amount_tot, cast(coalesce(d.skus, 0) AS BIGINT) AS skus,
      cast(coalesce(d.purchased, 0) AS INTEGER) AS purchased
    FROM (SELECT DISTINCT client FROM fx_daily) c
    CROSS JOIN (SELECT unnest(generate_series(min(date), max(date) + 5, INTERVAL 1 DAY)) AS day FROM fx_daily) g
    LEFT JOIN fx_daily d ON d.client = c.client AND d.date = cast(g.day AS DATE)))""",
    "scored": """
SELECT *, round(1 / (1 + exp(-(0.4 * cnt_7d - 0.3 * days_since_last))), 6) AS prob FROM calendar""",
    "last_hist": "SELECT max(date) AS last FROM calendar WHERE purchased = 1",
    "split": f"""
SELECT c.*, CASE WHEN date <= last - {FX_SPLIT_DAYS} THEN 'train' WHEN date <= last THEN 'valid' END AS split
FROM calendar c CROSS JOIN last_hist""",
    # --- VIP ---------------------------------------------------------------------
    "tickets": "SELECT DISTINCT tiket_id, user_id, tiket_price, date_sale FROM fx_vip_lines",
    "tickets_cl": "SELECT *, cast(cast(user_id AS BIGINT) % 4 AS INTEGER) AS cluster_id FROM tickets",
    "lines_cl": "SELECT *, cast(cast(user_id AS BIGINT) % 4 AS INTEGER) AS cluster_id FROM fx_vip_lines",
    "vip": """
SELECT user_id, avg(tiket_price) AS ticket_promedio, median(tiket_price) AS valor_tipico,
  sum(tiket_price) AS gasto_total_vida, coalesce(stddev_samp(tiket_price), 0) AS volatilidad_gasto,
  count(*) AS frecuencia_total,
  cast((SELECT max(date_sale) FROM tickets) - max(date_sale) AS INTEGER) AS dias_sin_comprar
FROM tickets GROUP BY 1""",
    "vip_cl": "SELECT *, cast(cast(user_id AS BIGINT) % 4 AS INTEGER) AS cluster_id FROM vip",
    "vip_names": """
SELECT cluster_id, CASE WHEN cluster_id = b THEN 'ballenas' WHEN cluster_id = r THEN 'reposicion'
  WHEN cluster_id = m THEN 'masa_critica' ELSE 'intermedio' END AS segment
FROM (
  SELECT c.cluster_id, b.b, r.r,
    (SELECT cluster_id FROM vip_cent WHERE cluster_id NOT IN (b.b, r.r) ORDER BY n DESC, cluster_id LIMIT 1) AS m
  FROM vip_cent c
  CROSS JOIN (SELECT cluster_id AS b FROM vip_cent ORDER BY tp DESC, cluster_id LIMIT 1) b
  CROSS JOIN (SELECT cluster_id AS r FROM vip_cent
              WHERE cluster_id <> (SELECT cluster_id FROM vip_cent ORDER BY tp DESC, cluster_id LIMIT 1)
              ORDER BY fr DESC, cluster_id LIMIT 1) r)""",
    "vip_cent": """
SELECT cluster_id, avg(ticket_promedio) AS tp, avg(frecuencia_total) AS fr, count(*) AS n FROM vip_cl GROUP BY 1""",
    "penetration": """
SELECT * FROM (
  SELECT cluster_id, product_name, tickets, cast(row_number() OVER
      (PARTITION BY cluster_id ORDER BY tickets DESC, product_name) AS INTEGER) AS rank,
    tickets / total * 100 AS penetration
  FROM (SELECT cluster_id, product_name, count(DISTINCT tiket_id) AS tickets FROM lines_cl GROUP BY 1, 2)
  JOIN (SELECT cluster_id, count(DISTINCT tiket_id) AS total FROM lines_cl GROUP BY 1) USING (cluster_id))
WHERE rank <= 15""",
    "tickets_year": f"SELECT * FROM tickets_cl WHERE year(date_sale) = {FX_YEAR}",
    "lines_year": f"SELECT * FROM lines_cl WHERE year(date_sale) = {FX_YEAR}",
    "cluster_medians": "SELECT cluster_id, median(tiket_price) AS mediana_global FROM tickets_year GROUP BY 1",
    "declined": """
SELECT cluster_id, user_id, promedio_P1, promedio_P2, mediana_global,
  promedio_P1 - promedio_P2 AS delta_caida
FROM (
  SELECT cluster_id, user_id, median(m) FILTER (mes BETWEEN 1 AND 7) AS promedio_P1,
    median(m) FILTER (mes BETWEEN 8 AND 12) AS promedio_P2
  FROM (SELECT cluster_id, user_id, month(date_sale) AS mes, avg(tiket_price) AS m
        FROM tickets_year GROUP BY 1, 2, 3)
  GROUP BY 1, 2)
JOIN cluster_medians USING (cluster_id)
WHERE promedio_P1 >= mediana_global AND promedio_P2 < mediana_global""",
    # --- raw tickets ---------------------------------------------------------------
    "raw_orders": f"""
SELECT o_orderkey AS ID, cast(o_orderdate AS DATE) AS date_sale, {CLIENT_ID} AS identification_doct,
  o_totalprice AS invoice_value_without_iva_and_discount,
  concat('S', o_custkey % 20) AS id_point_sale, o_orderstatus AS domicilio_status
FROM orders o""",
    "raw_lines": f"""
SELECT r.*, cast(l.l_partkey AS VARCHAR) AS product, l.l_quantity AS amount,
  l.l_extendedprice * (1 - l.l_discount) AS {VALUE}, l.l_tax AS tax
FROM raw_orders r LEFT JOIN lineitem l ON l.l_orderkey = r.ID""",
    # --- recommenders --------------------------------------------------------------
    "freq_desc": f"""
SELECT c.description, count(*) AS freq FROM tx JOIN fx_catalog c USING (product)
WHERE c.description NOT IN ({EXCLUDED}) GROUP BY 1""",
    "top_ids": """
SELECT product FROM fx_catalog WHERE description IN (
  SELECT description FROM freq_desc WHERE freq >= (SELECT quantile_cont(freq, 0.9) FROM freq_desc))""",
    "g_tx": "SELECT * FROM tx WHERE product IN (SELECT product FROM top_ids)",
    "g_counts": """
SELECT client, product, count(*) AS cnt FROM g_tx
WHERE date >= (SELECT max(date) FROM g_tx) - INTERVAL 3 MONTH GROUP BY 1, 2""",
    "c_tx": "SELECT * FROM tx WHERE date >= (SELECT max(date) FROM tx) - INTERVAL 3 MONTH",
    "c_top": """
SELECT client, product, cnt, cast(rank AS INTEGER) AS rank FROM (
  SELECT client, product, count(*) AS cnt,
    row_number() OVER (PARTITION BY client ORDER BY count(*) DESC, product) AS rank
  FROM c_tx GROUP BY 1, 2) WHERE rank <= 5""",
    "c_counts": """
SELECT client, product, count(*) AS cnt FROM (
  SELECT DISTINCT t.* FROM c_tx t JOIN c_top USING (client, product)) GROUP BY 1, 2""",
    "cluster_freq": f"""
SELECT cluster, c.description, count(*) AS freq
FROM valid s JOIN (SELECT id_client, cast(id_client AS BIGINT) % 5 AS cluster FROM segment_features) USING (id_client)
JOIN fx_catalog c USING (product) WHERE c.description NOT IN ({EXCLUDED}) GROUP BY 1, 2""",
    "cluster_top": """
SELECT cluster, description, freq, rank FROM (
  SELECT f.*, s.top_n, row_number() OVER (PARTITION BY cluster ORDER BY freq DESC, description) AS rank
  FROM cluster_freq f JOIN (
    SELECT cast(id_client AS BIGINT) % 5 AS cluster,
      greatest(1, cast(round_even(avg(product_distinct), 0) AS INTEGER)) AS top_n
    FROM segment_features GROUP BY 1) s USING (cluster))
WHERE rank <= top_n""",
    "profiles": """
SELECT *, cast(cast(id_client AS BIGINT) % 5 AS INTEGER) AS cluster FROM segment_features""",
    "history": f"""
SELECT s.id_client AS client, s.date_sale, c.description
FROM valid s JOIN fx_catalog c USING (product) WHERE c.description NOT IN ({EXCLUDED})""",
    "history_stats": """
SELECT client, description, cast(floor(median(q)) AS INTEGER) AS avg_sale_period, count(*) AS dias_compro
FROM (SELECT client, date_sale, description, count(*) AS q FROM history
      WHERE date_sale >= (SELECT max(date_sale) FROM history) - 30 GROUP BY 1, 2, 3)
GROUP BY 1, 2""",
    "history_recs": """
SELECT client, description AS recommended_products, avg_sale_period FROM (
  SELECT *, row_number() OVER (PARTITION BY client ORDER BY dias_compro DESC, description) AS r,
    count(*) OVER (PARTITION BY client) AS n FROM history_stats)
WHERE r <= ceil(n * 0.75)""",
}


def _similarity(counts: str) -> dict[str, str]:
    """Cosine and recommendation views over one counts view."""
    return {
        f"{counts}_sim": f"""
SELECT a.product AS product_i, b.product AS product_j,
  sum(a.cnt * b.cnt) / (any_value(na.n) * any_value(nb.n)) AS sim
FROM {counts} a JOIN {counts} b ON a.client = b.client AND a.product <> b.product
JOIN (SELECT product, sqrt(sum(cnt * cnt)) AS n FROM {counts} GROUP BY 1) na ON na.product = a.product
JOIN (SELECT product, sqrt(sum(cnt * cnt)) AS n FROM {counts} GROUP BY 1) nb ON nb.product = b.product
GROUP BY 1, 2""",
        f"{counts}_recs": f"""
SELECT client, product AS recommended_product, score AS recommendation_score,
  cast(r AS INTEGER) AS recommendation_rank
FROM (
  SELECT client, product, score, row_number() OVER (PARTITION BY client ORDER BY score DESC, product) AS r
  FROM (
    SELECT c.client, s.product_j AS product, round(sum(s.sim * c.cnt), 6) AS score
    FROM {counts} c JOIN {counts}_sim s ON s.product_i = c.product
    WHERE NOT EXISTS (SELECT 1 FROM {counts} b WHERE b.client = c.client AND b.product = s.product_j)
    GROUP BY 1, 2))
WHERE r <= 5""",
    }


SQL |= _similarity("g_counts") | _similarity("c_counts")


def oracle(body: str) -> str:
    """``body`` with every named view it needs, in order, as common table expressions."""
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in SQL:
            if name not in ordered and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need(SQL[name])
                if name not in ordered:
                    ordered.append(name)

    need(body)
    views = ",\n".join(f"{name} AS ({SQL[name].strip()})" for name in ordered)
    return f"WITH {views}\n{body.strip()}" if views else body.strip()
