"""Checked queries: segments, their names, and behaviour over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry import materialise, work_dir
from basketry.operators import behaviour, clustering, models, recommend, segmentation
from basketry.params import SegmentParams, VipParams
from basketry.schemas import CONTACT_COLUMNS
from basketry.plans import jobs
from basketry.sources.readers import load_contacts
from workload.fixtures import FX_EXCLUDED, FX_YEAR
from workload.oracle_models import placed_sql, silhouette_sql
from workload.oracle_views import SQL, oracle
from workload.registry import joined, query, rnd, rounded

VIP = segmentation.VIP_FEATURES


def _case(column: str, texts: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in texts.items()) + " END"


VIP_NAMES = _case("segment", {k: v[1] for k, v in segmentation.VIP_SEGMENTS.items()})
VIP_TEXTS = _case("segment", {k: v[2] for k, v in segmentation.VIP_SEGMENTS.items()})


# --- VIP features and export -------------------------------------------------------------


def _vip_sql(columns=VIP) -> str:
    return ", ".join(
        c if c in ("frecuencia_total", "dias_sin_comprar") else f"{rnd(c)} AS {c}" for c in columns
    )


@query("vip_features", oracle(f"SELECT user_id, {_vip_sql()} FROM vip"))
def _vip(fx):
    return rounded(fx.vip)


@query(
    "main_point_of_sale",
    oracle("""SELECT user_id, id_point_sale FROM (
                SELECT user_id, id_point_sale, row_number() OVER
                  (PARTITION BY user_id ORDER BY count(*) DESC, id_point_sale) AS r
                FROM fx_vip_lines GROUP BY 1, 2) WHERE r = 1"""),
)
def _store(fx):
    return segmentation.main_point_of_sale(fx.vip_lines)


@query(
    "join_segments",
    oracle("""SELECT t.tiket_id, t.user_id, t.date_sale, n.segment FROM tickets_cl t JOIN vip_names n USING (cluster_id)"""),
)
def _join_segments(fx):
    names = segmentation.name_vip_clusters(fx.with_cluster(fx.vip))
    users = fx.with_cluster(fx.vip).join(F.broadcast(names), "cluster_id")
    out = segmentation.join_segments(fx.tickets, users, "user_id", ("segment",))
    return out.select("tiket_id", "user_id", "date_sale", "segment")


@query(
    "join_contacts_left",
    oracle("SELECT v.user_id, v.cluster_id, c.name, c.country FROM vip_cl v LEFT JOIN fx_contacts c ON c.client = v.user_id"),
)
def _contacts_left(fx):
    contacts = load_contacts(fx.contacts.withColumnRenamed("client", "document"), "user_id")
    return fx.with_cluster(fx.vip).select("user_id", "cluster_id").join(contacts, "user_id", "left")


@query(
    "export_vip",
    oracle(f"""SELECT v.user_id, v.cluster_id, {VIP_NAMES} AS cluster_nombre,
                 {VIP_TEXTS} AS cluster_descripcion, s.id_point_sale, c.name, c.country
               FROM vip_cl v JOIN vip_names USING (cluster_id)
               LEFT JOIN (SELECT user_id, id_point_sale FROM (
                  SELECT user_id, id_point_sale, row_number() OVER
                    (PARTITION BY user_id ORDER BY count(*) DESC, id_point_sale) AS r
                  FROM fx_vip_lines GROUP BY 1, 2) WHERE r = 1) s USING (user_id)
               LEFT JOIN fx_contacts c ON c.client = v.user_id"""),
)
def _export(fx):
    contacts = load_contacts(fx.contacts.withColumnRenamed("client", "document"), "user_id")
    out = segmentation.export_vip(fx.vip_named, segmentation.main_point_of_sale(fx.vip_lines), contacts)
    return out


@query(
    "export_vip_no_contact",
    oracle(f"""SELECT v.user_id, v.cluster_id, {VIP_NAMES} AS cluster_nombre, {VIP_TEXTS} AS cluster_descripcion,
                 s.id_point_sale, {", ".join(f"NULL::VARCHAR AS {c}" for c in CONTACT_COLUMNS)}
               FROM vip_cl v JOIN vip_names USING (cluster_id) LEFT JOIN (SELECT user_id, id_point_sale FROM (
                  SELECT user_id, id_point_sale, row_number() OVER
                    (PARTITION BY user_id ORDER BY count(*) DESC, id_point_sale) AS r
                  FROM fx_vip_lines GROUP BY 1, 2) WHERE r = 1) s USING (user_id)"""),
)
def _export_plain(fx):
    return segmentation.export_vip(fx.vip_named, segmentation.main_point_of_sale(fx.vip_lines))


# --- names ---------------------------------------------------------------------------------


@query(
    "cluster_centroids",
    oracle(f"""SELECT cluster_id, {", ".join(f"{rnd(f'avg({c})')} AS {c}" for c in VIP)}, count(*) AS clients
               FROM vip_cl GROUP BY 1"""),
)
def _centroids(fx):
    return rounded(segmentation.cluster_centroids(fx.with_cluster(fx.vip), VIP, "cluster_id"))


@query(
    "label_segments_vip",
    oracle(f"""SELECT user_id, cluster_id, {VIP_NAMES} AS cluster_nombre,
                 cast(CASE segment WHEN 'reposicion' THEN 1 WHEN 'intermedio' THEN 2
                   WHEN 'masa_critica' THEN 3 ELSE 4 END AS INTEGER) AS grupo
               FROM vip_cl JOIN vip_names USING (cluster_id)"""),
)
def _label_vip(fx):
    return fx.vip_named.select("user_id", "cluster_id", "cluster_nombre", "grupo")


def _profiles_sql(k: int) -> str:
    """Profile names by repeated selection over the cluster means."""
    return f"""
WITH RECURSIVE none AS (SELECT 1), f AS (
  SELECT *, cast(cast(id_client AS BIGINT) % {k} AS INTEGER) AS cluster FROM segment_features),
m AS (SELECT cluster, avg(tickets_per_month) AS t, avg(ticket_median) AS a, avg(months_active_ratio) AS r
      FROM f GROUP BY 1),
e AS (SELECT cluster FROM m ORDER BY r, cluster LIMIT 1),
m1 AS (SELECT * FROM m WHERE cluster NOT IN (SELECT cluster FROM e)),
b AS (SELECT cluster FROM m1 ORDER BY a DESC, cluster LIMIT 1),
m2 AS (SELECT * FROM m1 WHERE cluster NOT IN (SELECT cluster FROM b)),
h AS (SELECT cluster FROM m2 CROSS JOIN (SELECT min(t) AS t0, max(t) AS t1, min(a) AS a0, max(a) AS a1 FROM m2)
      ORDER BY (t - t0) / (t1 - t0) - (a - a0) / (a1 - a0) DESC, cluster LIMIT 1),
m3 AS (SELECT * FROM m2 WHERE cluster NOT IN (SELECT cluster FROM h)),
n AS (SELECT cluster FROM m3 ORDER BY t, cluster LIMIT 1)
"""


def _profile_oracle(k: int, body: str, *more: str) -> str:
    views = _profiles_sql(k).strip().removeprefix("WITH RECURSIVE none AS (SELECT 1), ")
    base = oracle("SELECT 1 FROM segment_features" + "".join(f" JOIN {name} ON true" for name in more))
    return base[: base.rindex("\nSELECT 1")] + ",\n" + views + body


SEGMENT = """CASE WHEN cluster IN (SELECT cluster FROM e) THEN 'esporadico'
  WHEN cluster IN (SELECT cluster FROM b) THEN 'ballena' WHEN cluster IN (SELECT cluster FROM h) THEN 'hormiga'
  WHEN cluster IN (SELECT cluster FROM n) THEN 'mensual' ELSE 'cotidiano' END"""
LABEL = _case("segment", segmentation.SEGMENT_LABELS)
LABELLED = f"SELECT id_client, cluster, segment, {LABEL} AS segment_label FROM (SELECT *, {SEGMENT} AS segment FROM f)"


@query("label_segments_5", _profile_oracle(5, LABELLED))
def _label5(fx):
    return segmentation.label_segments_5(fx.profiled(5)).select("id_client", "cluster", "segment", "segment_label")


@query("label_segments_7", _profile_oracle(7, LABELLED))
def _label7(fx):
    """Seven clusters: those in the middle are everyday clients too."""
    return segmentation.label_segments_5(fx.profiled(7)).select("id_client", "cluster", "segment", "segment_label")


@query(
    "segment_summary",
    _profile_oracle(5, f"""SELECT segment, count(*) AS clientes, round(avg(tickets_per_month), 1) AS tickets_mes,
        round(avg(ticket_median), 1) AS ticket_mediano, round(avg(months_active_ratio), 1) AS meses_activos
        FROM (SELECT *, {SEGMENT} AS segment FROM f) GROUP BY 1"""),
)
def _summary(fx):
    return segmentation.segment_summary(segmentation.label_segments_5(fx.profiled(5)))


SCALED = ("tickets_per_month", "ticket_median", "months_active_ratio")


@query(
    "prepare_cluster_matrix",
    oracle(f"""SELECT id_client, {", ".join(f"{rnd(f'({c} - m_{c}) / s_{c}')} AS {c}_z" for c in SCALED)}
               FROM (SELECT id_client, tickets_per_month, ln(1 + greatest(ticket_median, 0)) AS ticket_median,
                       months_active_ratio FROM (
                       SELECT id_client, months_active_ratio,
                         coalesce(tickets_per_month, (SELECT median(t) FROM (SELECT CASE WHEN id_client LIKE '%7' THEN NULL
                            ELSE tickets_per_month END AS t FROM segment_features))) AS tickets_per_month, ticket_median
                       FROM (SELECT * REPLACE (CASE WHEN id_client LIKE '%7' THEN NULL ELSE tickets_per_month END AS tickets_per_month)
                             FROM segment_features)))
               CROSS JOIN (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED)} FROM (
                     SELECT coalesce(CASE WHEN id_client LIKE '%7' THEN NULL ELSE tickets_per_month END, (SELECT median(t) FROM (SELECT CASE WHEN id_client LIKE '%7' THEN NULL
                            ELSE tickets_per_month END AS t FROM segment_features))) AS tickets_per_month,
                       ln(1 + greatest(ticket_median, 0)) AS ticket_median, months_active_ratio FROM segment_features))"""),
)
def _matrix(fx):
    """Every id ending in 7 loses its frequency, so the median fill has work."""
    holes = fx.stored_features.withColumn(
        "tickets_per_month", F.when(~F.col("id_client").endswith("7"), F.col("tickets_per_month"))
    )
    out = segmentation.prepare_cluster_matrix(holes, SCALED)
    return rounded(out.select("id_client", *[c + "_z" for c in SCALED]))


# --- recommendations per cluster ---------------------------------------------------------------


def assignments(fx):
    return materialise(segmentation.label_segments_5(fx.profiled(5)), "assignments")


@query(
    "topn_per_cluster",
    oracle("""SELECT cast(cluster AS INTEGER) AS cluster, description, freq, cast(rank AS INTEGER) AS rank FROM cluster_top"""),
)
def _topn_cluster(fx):
    return recommend.topn_per_cluster(fx.valid, assignments(fx), fx.catalog, FX_EXCLUDED)


@query(
    "recs_by_cluster",
    _profile_oracle(5, f"""SELECT p.id_client AS client, p.cluster AS purchase_pattern_cluster, p.segment, p.segment_label,
                array_to_string(coalesce(r.recommended_products, []), ' | ') AS recommended_products
              FROM ({LABELLED}) p LEFT JOIN (
                SELECT cluster, list(description ORDER BY rank) AS recommended_products FROM cluster_top GROUP BY 1) r
                ON r.cluster = p.cluster""", "cluster_top"),
)
def _recs_cluster(fx):
    out = recommend.recs_by_cluster(fx.valid, assignments(fx), fx.catalog, FX_EXCLUDED)
    return joined(out)


# --- behaviour ------------------------------------------------------------------------------


@query(
    "monthly_evolution",
    oracle(f"""SELECT cluster_id, cast(date_trunc('month', date_sale) AS DATE) AS mes, count(*) AS total_tickets,
                 count(DISTINCT user_id) AS usuarios_unicos, {rnd('avg(tiket_price)')} AS valor_media,
                 {rnd('median(tiket_price)')} AS valor_mediana,
                 {rnd('count(*) / count(DISTINCT user_id)')} AS frecuencia_promedio
               FROM tickets_cl GROUP BY 1, 2"""),
)
def _evolution(fx):
    return rounded(behaviour.monthly_evolution(fx.tickets_cl))


@query(
    "product_penetration",
    oracle(f"SELECT cluster_id, product_name, tickets, rank, {rnd('penetration')} AS penetration FROM penetration"),
)
def _penetration(fx):
    return rounded(behaviour.product_penetration(fx.lines_cl))


@query(
    "core_products",
    oracle("""SELECT product_name FROM penetration GROUP BY 1
              HAVING count(DISTINCT cluster_id) = (SELECT count(DISTINCT cluster_id) FROM penetration)"""),
)
def _core(fx):
    return behaviour.core_products(behaviour.product_penetration(fx.lines_cl))


@query(
    "premium_products",
    oracle("""SELECT DISTINCT product_name FROM penetration JOIN vip_names USING (cluster_id)
              WHERE segment IN ('ballenas', 'intermedio') AND product_name NOT IN (
                SELECT product_name FROM penetration JOIN vip_names USING (cluster_id)
                WHERE segment NOT IN ('ballenas', 'intermedio'))"""),
)
def _premium(fx):
    names = segmentation.name_vip_clusters(fx.with_cluster(fx.vip))
    top = behaviour.product_penetration(fx.lines_cl).join(F.broadcast(names), "cluster_id")
    return behaviour.premium_products(top, ("ballenas", "intermedio"), "segment")


@query(
    "day_of_month_spend",
    oracle(f"""SELECT cluster_id, cast(day(date_sale) AS INTEGER) AS dia_mes, {rnd('avg(tiket_price)')} AS gasto_promedio,
                 count(*) AS tickets FROM tickets_cl GROUP BY 1, 2"""),
)
def _day_spend(fx):
    return rounded(behaviour.day_of_month_spend(fx.tickets_cl))


DECLINED = ("promedio_P1", "promedio_P2", "mediana_global", "delta_caida")


@query(
    "declining_clients",
    oracle(f"SELECT cluster_id, user_id, {', '.join(f'{rnd(c)} AS {c}' for c in DECLINED)} FROM declined"),
)
def _declining(fx):
    return rounded(behaviour.declining_clients(fx.tickets_cl, year=FX_YEAR))


def in_year(df):
    return df.where(F.year("date_sale") == FX_YEAR)


@query(
    "decline_trend",
    oracle(f"""SELECT c.cluster_id, cast(m.mes AS INTEGER) AS mes_num, {rnd('t.p')} AS ticket_promedio
               FROM (SELECT DISTINCT cluster_id FROM tickets_year) c
               CROSS JOIN (SELECT unnest(range(1, 13)) AS mes) m
               LEFT JOIN (SELECT cluster_id, month(date_sale) AS mes, avg(tiket_price) AS p FROM tickets_year
                          WHERE user_id IN (SELECT user_id FROM declined) GROUP BY 1, 2) t
                 ON t.cluster_id = c.cluster_id AND t.mes = m.mes"""),
)
def _trend(fx):
    tickets = in_year(fx.tickets_cl)
    return rounded(behaviour.decline_trend(tickets, behaviour.declining_clients(tickets)))


@query(
    "decline_summary",
    oracle(f"""SELECT cluster_id, count(*) AS clientes, count(d.user_id) AS caidos,
                 {rnd('count(d.user_id) * 100.0 / count(*)')} AS pct_caidos
               FROM vip_cl v LEFT JOIN (SELECT user_id FROM declined) d USING (user_id)
               GROUP BY ROLLUP (cluster_id)"""),
)
def _decline_summary(fx):
    declined = behaviour.declining_clients(fx.tickets_cl, year=FX_YEAR)
    return rounded(behaviour.decline_summary(fx.with_cluster(fx.vip), declined))


CUTBACK = f"""SELECT cluster_id, product_name, {rnd('p1')} AS avg_p1, {rnd('p2')} AS avg_p2, {rnd('p1 - p2')} AS caida,
                 cast(r AS INTEGER) AS rank FROM (
                 SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY round(p1 - p2, 9) DESC, product_name) AS r FROM (
                   SELECT cluster_id, product_name,
                     coalesce(sum(amount) FILTER (month(date_sale) <= 7), 0) / 7 / any_value(u) AS p1,
                     coalesce(sum(amount) FILTER (month(date_sale) > 7), 0) / 5 / any_value(u) AS p2
                   FROM lines_year JOIN (SELECT cluster_id, count(*) AS u FROM declined GROUP BY 1) USING (cluster_id)
                   WHERE user_id IN (SELECT user_id FROM declined) GROUP BY 1, 2))
               WHERE r <= 15"""


@query(
    "product_cutback",
    oracle(CUTBACK),
)
def _cutback(fx):
    declined = materialise(behaviour.declining_clients(fx.tickets_cl, year=FX_YEAR), "declined")
    return rounded(behaviour.product_cutback(in_year(fx.lines_cl), declined))


@query("job_behaviour", oracle(CUTBACK))
def _job_behaviour(fx):
    """The last table of the job, which needs all that it stores on the way."""
    base = work_dir(fx.spark, "behaviour")
    jobs.job_behaviour(fx.spark, fx.vip_lines, fx.with_cluster(fx.vip), FX_YEAR, base)
    return rounded(fx.spark.read.parquet(f"{base}/product_cutback"))


@query(
    "full_outer_fill0",
    oracle("""SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.product_name, b.product_name) AS product_name,
                coalesce(a.u, 0) AS units_p1, coalesce(b.u, 0) AS units_p2
              FROM (SELECT user_id, product_name, sum(amount) AS u FROM lines_year WHERE month(date_sale) <= 7 GROUP BY 1, 2) a
              FULL JOIN (SELECT user_id, product_name, sum(amount) AS u FROM lines_year WHERE month(date_sale) > 7 GROUP BY 1, 2) b
                ON a.user_id = b.user_id AND a.product_name = b.product_name"""),
)
def _outer_fill(fx):
    year = in_year(fx.lines_cl)
    keys = ["user_id", "product_name"]
    first, last = year.where(F.month("date_sale") <= 7), year.where(F.month("date_sale") > 7)
    units = [d.groupBy(*keys).agg(F.sum("amount").alias(n)) for d, n in ((first, "units_p1"), (last, "units_p2"))]
    return behaviour.full_outer_fill0(*units, keys)


STATS = {
    "mean": "avg({0})", "std": "stddev_samp({0})", "min": "min({0})", "max": "max({0})",
    "q25": "quantile_cont({0}, 0.25)", "q50": "quantile_cont({0}, 0.5)", "q75": "quantile_cont({0}, 0.75)",
}


@query(
    "describe_features",
    oracle("\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, count({c}) AS count, "
        + ", ".join(f"{rnd(s.format(c), 3)} AS {n}" for n, s in STATS.items()) + " FROM vip"
        for c in VIP
    )),
)
def _describe(fx):
    return rounded(behaviour.describe_features(fx.vip, VIP), 3)


@query(
    "histogram_p99",
    oracle("\nUNION ALL\n".join(
        f"""SELECT '{c}' AS feature, cast(b AS INTEGER) AS bin, {rnd('lo + b * (hi - lo) / 50', 3)} AS bin_start,
              (SELECT count(*) FROM vip WHERE least(49, floor((least({c}, hi) - lo) / (hi - lo) * 50)) = b) AS rows
            FROM (SELECT min({c}) AS lo, quantile_cont({c}, 0.99) AS hi FROM vip)
            CROSS JOIN (SELECT unnest(range(50)) AS b)"""
        for c in VIP
    )),
)
def _histogram(fx):
    return rounded(behaviour.histogram_p99(fx.vip, VIP), 3)


# --- K-Means -------------------------------------------------------------------------------


def _settled(clustered, matrix, key: str, columns, cluster: str):
    """Clients, clusters, and clients that are nearer to another cluster's mean than to
    their own, of which a converged fit has none but for the last move's tolerance."""
    points = clustered.select(key, cluster).join(matrix.select(key, *columns), key)
    means = points.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns])
    # One row per cluster.
    centres = means.agg(F.collect_list(F.struct(cluster, *columns))).scalar()

    def distance(x):
        return sum(((x[c] - F.col(c)) * (x[c] - F.col(c)) for c in columns), F.lit(0.0))

    nearest = F.array_min(F.transform(F.col("_centres"), distance))
    own = F.array_min(
        F.transform(F.filter(F.col("_centres"), lambda x: x[cluster] == F.col(cluster)), distance)
    )
    return points.withColumn("_centres", centres).agg(
        F.count(F.lit(1)).alias("clients"), F.count_distinct(cluster).alias("clusters"),
        F.count_if(own > nearest * (1 + 1e-9)).alias("misplaced"),
    )


@query("kmeans_segments", oracle("SELECT count(*) AS clients, cast(5 AS BIGINT) AS clusters, cast(0 AS BIGINT) AS misplaced FROM segment_features"))
def _kmeans(fx):
    params = SegmentParams(tol=0.0)
    stored = fx.stored_features
    matrix = segmentation.prepare_cluster_matrix(stored, params.features)
    columns = [c + "_z" for c in params.features]
    return _settled(models.kmeans_segments(stored, params), matrix, "id_client", columns, "cluster")


@query(
    "choose_k",
    oracle("SELECT count(*) AS clients, true AS best FROM segment_features"),
)
def _choose_k(fx):
    """The chosen number against a scan of all allowed ones."""
    params = SegmentParams(n_clusters=0)
    columns = [c + "_z" for c in params.features]
    matrix = materialise(segmentation.prepare_cluster_matrix(fx.stored_features, params.features), "matrix")
    chosen = models.choose_k(matrix, columns, params)
    scan = models.elbow_scan(matrix, columns, range(params.k_min, params.k_max + 1), params.seed)
    best = scan.agg(F.max_by("k", "silhouette")).scalar()
    return matrix.agg(F.count(F.lit(1)).alias("clients")).withColumn("best", best == F.lit(chosen))


@query(
    "elbow_scan",
    oracle("""SELECT cast(k AS INTEGER) AS k, (SELECT count(*) FROM vip) AS clients, true AS below_total
              FROM (SELECT unnest(range(2, 10)) AS k)"""),
)
def _elbow(fx):
    """Standardised features have a total cost of clients times features."""
    columns = [c + "_z" for c in VIP]
    matrix = materialise(segmentation.standardise(materialise(fx.vip, "features"), VIP, "_z"), "matrix")
    clients = matrix.agg(F.count(F.lit(1))).scalar()
    scan = models.elbow_scan(matrix, columns, range(2, 10))
    below = (F.col("inertia") < F.col("clients") * len(columns)) & F.col("silhouette").between(-1, 1)
    return scan.withColumn("clients", clients).select("k", "clients", below.alias("below_total"))


# First centres stated, so that both engines take the same steps; enough steps to stand still.
STATED = {k: [[j - 1.0] * 6 for j in range(k)] for k in (2, 3, 4)}
STEPS = 150
SCALED_VIP = f"""SELECT user_id AS id, [{", ".join(f"({c} - m_{c}) / s_{c}" for c in VIP)}] AS x
FROM vip CROSS JOIN (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in VIP)} FROM vip)"""
SCAN = "\nUNION ALL\n".join(
    f"""SELECT {k} AS k, (SELECT sum(list_min(d)) FROM ({placed_sql("SELECT * FROM scaled_vip", at, STEPS)})) AS inertia,
          silhouette FROM ({silhouette_sql(f"SELECT * FROM placed_{k}")})"""
    for k, at in STATED.items()
)


def _stated(body: str, more: str = "") -> str:
    """The fits from stated starts, and more views, in front of ``body``."""
    base = oracle(f"SELECT * FROM ({SCALED_VIP}) CROSS JOIN fx_vip_lines")
    head = base[: base.rindex("\nSELECT * FROM")]
    views = [f"scaled_vip AS MATERIALIZED ({SCALED_VIP})"]
    views += [f"placed_{k} AS MATERIALIZED ({placed_sql('SELECT * FROM scaled_vip', at, STEPS)})" for k, at in STATED.items()]
    return f"{head},\n" + ",\n".join([*views, more] if more else views) + f"\n{body}"


def _scaled_vip(fx):
    return materialise(segmentation.standardise(materialise(fx.vip, "features"), VIP, "_z"), "matrix")


def _stated_scan(fx):
    columns = [c + "_z" for c in VIP]
    return models.elbow_scan(_scaled_vip(fx), columns, list(STATED), tol=0.0, starts=list(STATED.values()))


@query("elbow_scan_stated", _stated(f"SELECT cast(k AS INTEGER) AS k, {rnd('inertia', 3)} AS inertia, {rnd('silhouette', 5)} AS silhouette FROM ({SCAN})"))
def _elbow_stated(fx):
    scan = _stated_scan(fx)
    return scan.select("k", F.round(F.col("inertia") + 0.033e-3, 3).alias("inertia"), F.round(F.col("silhouette") + 0.033e-5, 5).alias("silhouette"))


@query("choose_k_stated", _stated(f"SELECT cast(arg_max(k, silhouette) AS INTEGER) AS k FROM ({SCAN})"))
def _choose_stated(fx):
    return fx.spark.createDataFrame([(models.best_k(_stated_scan(fx)),)], "k int")


@query(
    "kmeans_lloyd",
    _stated(f"""SELECT cast(k - 1 AS INTEGER) AS cluster, count(*) AS clients,
                  {", ".join(f"{rnd(f'any_value(c)[k][{i}]')} AS {c}" for i, c in enumerate(VIP, 1))} FROM placed_4 GROUP BY k"""),
)
def _lloyd(fx):
    """Centres and sizes of the fit that starts from four stated centres."""
    columns = [c + "_z" for c in VIP]
    matrix = _scaled_vip(fx)
    fit = clustering.lloyd(clustering.points(matrix, columns), [STATED[4]], tol=0.0)[0]
    placed = matrix.withColumn("cluster", clustering.nearest(columns, fit.centers)).groupBy("cluster").agg(F.count(F.lit(1)).alias("clients"))
    names = ", ".join(f"{c} double" for c in VIP)
    centres = fx.spark.createDataFrame([(k, *map(float, c)) for k, c in enumerate(fit.centers)], f"cluster int, {names}")
    return rounded(placed.join(centres, "cluster"))


@query("kmeans_vip", oracle("SELECT count(*) AS clients, cast(4 AS BIGINT) AS clusters, cast(0 AS BIGINT) AS misplaced FROM vip"))
def _kmeans_vip(fx):
    stored = materialise(fx.vip, "features")
    matrix = segmentation.standardise(stored, VIP, "_z")
    columns = [c + "_z" for c in VIP]
    return _settled(models.kmeans_vip(stored, VipParams(tol=0.0)), matrix, "user_id", columns, "cluster_id")


# --- jobs ----------------------------------------------------------------------------------


@query(
    "job_vip",
    oracle("""SELECT tiket_id, user_id, periodo_unico, amount FROM (
                SELECT ID AS tiket_id, trim(identification_doct) AS user_id, amount,
                  concat(year(date_sale), '-', weekofyear(date_sale)) AS periodo_unico
                FROM raw_lines WHERE product IS NOT NULL)
              WHERE user_id IN (
                SELECT trim(identification_doct) FROM raw_lines WHERE product IS NOT NULL GROUP BY 1
                HAVING count(DISTINCT concat(year(date_sale), '-', weekofyear(date_sale))) >= 10)"""),
)
def _job_vip(fx):
    path = work_dir(fx.spark, "vip")
    wide = fx.table("part").select(
        F.col("p_partkey").cast("string").alias("product"), F.col("p_type").alias("category"), F.col("p_name").alias("name")
    )
    jobs.job_vip(fx.spark, fx.raw_tickets, wide, path, VipParams())
    return fx.spark.read.parquet(path).select("tiket_id", "user_id", "periodo_unico", "amount")


@query("job_segment_vip")
def _job_segment_vip(fx):
    """Cheaper tickets enter with a negative total and must not count."""
    path = work_dir(fx.spark, "vip-segments")
    price = F.when(F.col("tiket_price") > 50000, F.col("tiket_price")).otherwise(-F.col("tiket_price"))
    jobs.job_segment_vip(fx.spark, fx.vip_lines.withColumn("tiket_price", price), None, path)
    return fx.spark.read.parquet(path)


@query(
    "job_segment_vip_stores",
    oracle(f"""SELECT user_id, id_point_sale, {", ".join(f"NULL::VARCHAR AS {c}" for c in CONTACT_COLUMNS)} FROM (
                 SELECT user_id, id_point_sale, row_number() OVER
                   (PARTITION BY user_id ORDER BY count(*) DESC, id_point_sale) AS r
                 FROM fx_vip_lines WHERE tiket_price > 50000 GROUP BY 1, 2) WHERE r = 1"""),
)
def _job_segment_vip_stores(fx):
    return _job_segment_vip(fx).drop("cluster_id", "cluster_nombre", "cluster_descripcion")


FITTED = SQL["vip_names"].replace("vip_cent", "fit_cent")
FIT_CENT = SQL["vip_cent"].replace("vip_cl", "vip_fit")


@query(
    "job_segment_vip_stated",
    _stated(f"""SELECT user_id, f.cluster_id, {VIP_NAMES} AS cluster_nombre, {VIP_TEXTS} AS cluster_descripcion, id_point_sale
                FROM vip_fit f JOIN fit_names USING (cluster_id) JOIN (
                  SELECT user_id, id_point_sale, row_number() OVER
                    (PARTITION BY user_id ORDER BY count(*) DESC, id_point_sale) AS r
                  FROM fx_vip_lines GROUP BY 1, 2) s USING (user_id) WHERE r = 1""",
            f"""vip_fit AS (SELECT v.*, cast(p.k - 1 AS INTEGER) AS cluster_id FROM vip v JOIN placed_4 p ON p.id = v.user_id),
                fit_cent AS ({FIT_CENT}), fit_names AS ({FITTED})"""),
)
def _job_segment_vip_stated(fx):
    """Clusters, names and stores of the job whose fit starts from stated centres."""
    path = work_dir(fx.spark, "vip-segments")
    first = (tuple(map(tuple, STATED[4])),)
    jobs.job_segment_vip(fx.spark, fx.vip_lines, None, path, VipParams(starts=first, tol=0.0))
    return fx.spark.read.parquet(path).drop(*CONTACT_COLUMNS)


@query("job_segment_recs")
def _job_segment_recs(fx):
    base = work_dir(fx.spark, "segment-recs")
    jobs.job_segment_recs(fx.spark, fx.sales, fx.catalog, f"{base}/clusters", f"{base}/recs", excluded=FX_EXCLUDED)
    return joined(fx.spark.read.parquet(f"{base}/recs"))


@query(
    "job_segment_recs_clients",
    oracle("""SELECT DISTINCT id_client AS client FROM valid
              WHERE date_sale >= (SELECT max(date_sale) FROM valid) - 30"""),
)
def _job_segment_recs_clients(fx):
    """Every client of the last month gets a row."""
    return _job_segment_recs(fx).select("client")
