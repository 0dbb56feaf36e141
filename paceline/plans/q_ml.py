"""Queries over clustering, quality metrics, anomalies and change points."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.operators import changepoints, clustering, density, forest, metrics
from paceline.plans.q_laps import FEATURES_SQL, features, with_runs
from paceline.plans.registry import query, rounded
from paceline.plans.views import laps, staged, table, with_laps
from paceline.roles import Roles

ROLES = Roles()

_F2 = ["lap_delta", "age_normalized"]

#: Rounds that the SQL unrolls; the job stops by itself at the fixed point.
ROUNDS = 40


def _kmeans_sql(src: str, keys: str, feats: list[str], k: int, rounds: int, row: str) -> str:
    """Lloyd's iteration unrolled, for more rounds than any group needs; leaves the CTE ``km`` with label and distance."""
    dims = range(len(feats))
    kk = f"{keys}, " if keys else ""
    on = f"USING ({keys})" if keys else "ON true"
    out = [f"allp AS (SELECT {kk}{row}, {', '.join(f'CAST({f} AS DOUBLE) AS f{i}' for i, f in enumerate(feats))} FROM {src})",
           f"pts AS (SELECT * FROM allp WHERE {' AND '.join(f'f{i} IS NOT NULL' for i in dims)})",
           f"seeds AS (SELECT {kk}{', '.join(f'avg(f{i}) AS m{i}, stddev_pop(f{i}) AS s{i}' for i in dims)} FROM pts "
           + (f"GROUP BY {keys} " if keys else "") + f"HAVING count(*) >= {k})",
           f"c0 AS (SELECT {kk}j, {', '.join(f'm{i} + (j - {(k - 1) / 2}) * s{i} AS c{i}' for i in dims)} FROM seeds, range({k}) t(j))"]
    dist = " + ".join(f"power(f{i} - c{i}, 2)" for i in dims)
    for r in range(rounds + 1):
        part = f"{kk}{row}"
        out.append(f"a{r} AS MATERIALIZED (SELECT {kk}{row}, {', '.join(f'f{i}' for i in dims)}, j, d FROM (SELECT p.*, c.j, {dist} AS d, "
                   f"row_number() OVER (PARTITION BY {part} ORDER BY {dist}, c.j) AS rn FROM pts p JOIN c{r} c {on}) WHERE rn = 1)")
        if r < rounds:
            means = ", ".join(f"avg(f{i}) AS n{i}" for i in dims)
            out.append(f"c{r + 1} AS MATERIALIZED (SELECT {kk}j, {', '.join(f'coalesce(n{i}, c{i}) AS c{i}' for i in dims)} FROM c{r} "
                       f"LEFT JOIN (SELECT {kk}j, {means} FROM a{r} GROUP BY {kk}j) USING ({kk}j))")
    out.append(f"km AS (SELECT {kk}{row}, CAST(coalesce(j, -1) AS INTEGER) AS cluster_label, sqrt(d) AS cluster_centroid_distance, "
               f"{', '.join(f'p.f{i} AS f{i}' for i in dims)} FROM allp p LEFT JOIN (SELECT {kk}{row}, j, d FROM a{rounds}) USING ({kk}{row}))")
    return ", ".join(out)


KMEANS_SQL = FEATURES_SQL + ", " + _kmeans_sql("features", "entity", _F2, 3, ROUNDS, "seq")


def clustered(spark, sf_dir):
    """Clustered laps, kept as a table."""
    def build(s, d):
        return clustering.kmeans(features(s, d).select("entity", "seq", *_F2), ["entity"], _F2)
    return staged(spark, sf_dir, "clustered", build)


@query("kmeans", with_runs(KMEANS_SQL + """ SELECT entity, seq, cluster_label, round(cluster_centroid_distance, 6) AS cluster_centroid_distance,
 round(f0, 6) AS lap_delta, round(f1, 6) AS age_normalized FROM km"""))
def kmeans(spark, sf_dir):
    src = features(spark, sf_dir).select("entity", "seq", *_F2)
    return rounded(clustering.kmeans(src, ["entity"], _F2))


@query("kmeans_small_groups", with_laps("""
 , few AS (SELECT entity * 100 + seq // 2 AS g, seq, measure FROM laps), """ + _kmeans_sql("few", "g", ["measure"], 3, 12, "seq") + """
 SELECT g, seq, cluster_label, round(cluster_centroid_distance, 6) AS cluster_centroid_distance FROM km"""))
def kmeans_small_groups(spark, sf_dir):
    src = laps(spark, sf_dir).select((F.col("entity") * 100 + F.floor(F.col("seq") / 2)).alias("g"), "seq", "measure")
    return rounded(clustering.kmeans(src, ["g"], ["measure"]).drop("measure"))


_DIMS = 64
_EMB = [f"e{i}" for i in range(_DIMS)]
_EMB_SQL = "emb AS (SELECT vec_id, label, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(_DIMS)) + " FROM embeddings)"


def emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(_DIMS)])


@query("kmeans_global", f"WITH {_EMB_SQL}, " + _kmeans_sql("emb", "", _EMB, 3, ROUNDS, "vec_id")
       + " SELECT vec_id, cluster_label, round(cluster_centroid_distance, 6) AS cluster_centroid_distance FROM km")
def kmeans_global(spark, sf_dir):
    out = clustering.kmeans(emb(spark, sf_dir), [], _EMB)
    return rounded(out.select("vec_id", "cluster_label", "cluster_centroid_distance"))


@query("inertia", with_runs(KMEANS_SQL + " SELECT entity, round(sum(power(cluster_centroid_distance, 2)), 4) AS inertia FROM km GROUP BY entity"))
def inertia(spark, sf_dir):
    return rounded(clustering.inertia(clustered(spark, sf_dir), ["entity"]), digits=4)


SEMANTICS_SQL = KMEANS_SQL + """, cst AS (SELECT entity, cluster_label, count(f0) AS size, avg(f0) AS mean FROM km GROUP BY ALL),
 rk AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY size DESC, abs(mean), cluster_label) = 1 AS base,
   count(*) OVER (PARTITION BY entity) - 1 AS others FROM cst),
 b AS (SELECT entity, mean AS bm FROM rk WHERE base),
 o AS (SELECT entity, cluster_label, mean, row_number() OVER (PARTITION BY entity ORDER BY mean, cluster_label) AS lo,
   row_number() OVER (PARTITION BY entity ORDER BY mean DESC, cluster_label DESC) AS hi,
   min(mean) OVER (PARTITION BY entity) AS mn, max(mean) OVER (PARTITION BY entity) AS mx FROM rk WHERE NOT base),
 mp AS (SELECT rk.entity, rk.cluster_label, CASE WHEN rk.base THEN 1 WHEN others = 1 THEN CASE WHEN o.mean < bm THEN 0 ELSE 2 END
     WHEN o.lo = 1 THEN 0 WHEN o.hi = 1 THEN 2 END AS new,
   CASE WHEN others >= 2 THEN (SELECT any_value(o2.mn < bm AND o2.mx > bm) FROM o o2 WHERE o2.entity = rk.entity) ELSE true END AS clean
   FROM rk JOIN b USING (entity) LEFT JOIN o USING (entity, cluster_label)),
 sem AS (SELECT km.entity, km.seq, f0 AS lap_delta, f1 AS age_normalized, CAST(new AS INTEGER) AS cluster_label,
   CASE new WHEN 0 THEN 'push' WHEN 1 THEN 'base' WHEN 2 THEN 'degraded' END AS cluster_semantic, clean AS cluster_semantic_clean
   FROM km JOIN mp USING (entity, cluster_label))"""


def semantic(spark, sf_dir):
    return clustering.normalize_semantics(clustered(spark, sf_dir), ["entity"])


@query("cluster_semantics", with_runs(SEMANTICS_SQL + " SELECT entity, seq, cluster_label, cluster_semantic, cluster_semantic_clean FROM sem"))
def cluster_semantics(spark, sf_dir):
    return semantic(spark, sf_dir).select("entity", "seq", "cluster_label", "cluster_semantic", "cluster_semantic_clean")


@query("cluster_stats", with_runs(SEMANTICS_SQL + """ SELECT entity, cluster_label, count(*) AS size, min(cluster_semantic) AS cluster_semantic,
 round(avg(lap_delta), 6) AS lap_delta_mean, round(stddev_samp(lap_delta), 6) AS lap_delta_std,
 round_even(100 * count(*) / sum(count(*)) OVER (PARTITION BY entity), 2) AS cluster_size_pct FROM sem GROUP BY entity, cluster_label"""))
def cluster_stats(spark, sf_dir):
    return rounded(clustering.cluster_statistics(semantic(spark, sf_dir), ["entity"], ["lap_delta"]), "cluster_size_pct")


def _quality_sql(src: str, keys: str, feats: list[str], label: str, row: str) -> str:
    """Silhouette, Davies-Bouldin, Calinski-Harabasz from all pairs; leaves the CTE ``q``."""
    dims = range(len(feats))
    kk, on = (f"{keys}, ", f"USING ({keys})") if keys else ("", "ON true")
    grp = f"GROUP BY {keys}" if keys else ""
    sq = " + ".join(f"power(a.{f} - b.{f}, 2)" for f in feats)
    cd = " + ".join(f"power({f} - c{i}, 2)" for i, f in enumerate(feats))
    return f"""cl AS (SELECT * FROM {src} WHERE {label} <> -1),
 nz AS (SELECT {kk}count(*) FILTER ({label} = -1) AS n_noise FROM {src} {grp}),
 cen AS (SELECT {kk}{label} AS l, count(*) AS n, {', '.join(f'avg({f}) AS c{i}' for i, f in enumerate(feats))} FROM cl GROUP BY {kk}{label}),
 spr AS (SELECT {', '.join(f'cl.{x}' for x in [keys] if x) + ', ' if keys else ''}cen.l, avg(sqrt({cd})) AS s, sum({cd}) AS w FROM cl JOIN cen ON cl.{label} = cen.l {f'AND cl.{keys} = cen.{keys}' if keys else ''} GROUP BY ALL),
 ov AS (SELECT {kk}count(*) AS k, CAST(sum(n) AS BIGINT) AS nn, {', '.join(f'sum(n * c{i}) / sum(n) AS g{i}' for i in dims)} FROM cen {grp}),
 bw AS (SELECT {kk}sum(n * ({' + '.join(f'power(c{i} - g{i}, 2)' for i in dims)})) AS bt FROM cen JOIN ov {on} {grp}),
 wi AS (SELECT {kk}sum(w) AS wt FROM spr {grp}),
 pr AS (SELECT {f'a.{keys}, ' if keys else ''}a.l, max((sa.s + sb.s) / sqrt({' + '.join(f'power(a.c{i} - b.c{i}, 2)' for i in dims)})) AS r FROM cen a
   JOIN cen b ON a.l <> b.l {f'AND a.{keys} = b.{keys}' if keys else ''} JOIN spr sa ON sa.l = a.l {f'AND sa.{keys} = a.{keys}' if keys else ''}
   JOIN spr sb ON sb.l = b.l {f'AND sb.{keys} = b.{keys}' if keys else ''} GROUP BY ALL),
 db AS (SELECT {kk}avg(r) AS db FROM pr {grp}),
 pd AS (SELECT {f'a.{keys}, ' if keys else ''}a.{row}, a.{label} AS l, b.{label} AS o, sum(sqrt({sq})) AS d, count(*) AS c FROM cl a JOIN cl b
   ON {f'a.{keys} = b.{keys}' if keys else 'true'} GROUP BY ALL),
 ab AS (SELECT {kk}{row}, max(c) FILTER (o = l) AS n, max(CASE WHEN o = l AND c > 1 THEN d / (c - 1) END) AS a, min(CASE WHEN o <> l THEN d / c END) AS b FROM pd GROUP BY {kk}{row}),
 si AS (SELECT {kk}avg(CASE WHEN b IS NOT NULL THEN CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END END) AS si FROM ab {grp}),
 q AS (SELECT {kk}coalesce(k, 0) AS n_clusters, coalesce(nn, 0) AS n_samples, n_noise, CASE WHEN k >= 2 THEN round(si, 6) END AS silhouette_score,
   CASE WHEN k >= 2 THEN round(db, 6) END AS davies_bouldin_score, CASE WHEN k >= 2 THEN round(bt * (nn - k) / (wt * (k - 1)), 4) END AS calinski_harabasz_score,
   CASE WHEN coalesce(k, 0) < 2 THEN 'Insufficient clusters (' || coalesce(k, 0) || ') or samples (' || coalesce(nn, 0) || ')' END AS error
   FROM nz LEFT JOIN ov {on} LEFT JOIN bw {on} LEFT JOIN wi {on} LEFT JOIN db {on} LEFT JOIN si {on})"""


def _round_quality(df):
    return rounded(df.withColumn("calinski_harabasz_score", F.round("calinski_harabasz_score", 4)), "calinski_harabasz_score")


def _with_noise(df):
    return df.withColumn("cluster_label", F.when(F.col("seq") % 11 == 0, -1).otherwise(F.col("cluster_label")))


QUALITY_SQL = KMEANS_SQL + """, lab AS (SELECT entity, seq, f0, f1, CASE WHEN seq % 11 = 0 THEN -1 ELSE cluster_label END AS cluster_label FROM km), """ \
    + _quality_sql("lab", "entity", ["f0", "f1"], "cluster_label", "seq")


def quality(spark, sf_dir):
    return metrics.cluster_quality(_with_noise(clustered(spark, sf_dir)), ["entity"], "seq", _F2)


@query("cluster_quality", with_runs(QUALITY_SQL + " SELECT * FROM q"))
def cluster_quality(spark, sf_dir):
    return _round_quality(quality(spark, sf_dir))


@query("cluster_quality_global", f"WITH {_EMB_SQL}, " + _quality_sql("emb", "", _EMB, "label", "vec_id") + " SELECT * FROM q")
def cluster_quality_global(spark, sf_dir):
    return _round_quality(metrics.cluster_quality(emb(spark, sf_dir), [], "vec_id", _EMB, "label"))


@query("quality_summary", with_runs(QUALITY_SQL + """ SELECT round(avg(silhouette_score), 5) AS silhouette_mean, round(stddev_samp(silhouette_score), 5) AS silhouette_std,
 round(min(silhouette_score), 5) AS silhouette_min, round(max(silhouette_score), 5) AS silhouette_max, round(avg(davies_bouldin_score), 5) AS davies_bouldin_mean,
 round(stddev_samp(davies_bouldin_score), 5) AS davies_bouldin_std, round(avg(calinski_harabasz_score), 3) AS calinski_harabasz_mean, count(*) AS n_drivers_evaluated
 FROM q WHERE n_samples >= 4 AND n_clusters >= 2"""))
def quality_summary(spark, sf_dir):
    per = metrics.entity_quality(_with_noise(clustered(spark, sf_dir)), ["entity"], "seq", _F2)
    out = metrics.quality_summary(per)
    return rounded(out.withColumn("calinski_harabasz_mean", F.round("calinski_harabasz_mean", 3)), "calinski_harabasz_mean", digits=5)


@query("quality_verdict", with_runs(QUALITY_SQL + """ SELECT entity, coalesce(silhouette_score >= 0.25, false) AS silhouette_pass,
 coalesce(davies_bouldin_score <= 1.5, false) AS davies_bouldin_pass, CASE WHEN silhouette_score >= 0.25 AND davies_bouldin_score <= 1.5 THEN 'excellent'
 WHEN silhouette_score >= 0.25 OR davies_bouldin_score <= 1.5 THEN 'good' WHEN silhouette_score > 0 THEN 'fair' ELSE 'poor' END AS quality FROM q"""))
def quality_verdict(spark, sf_dir):
    return metrics.quality_verdict(quality(spark, sf_dir)).select("entity", "silhouette_pass", "davies_bouldin_pass", "quality")


# The models of every k, each by its own unrolled iteration.
_EACH_K_SQL = FEATURES_SQL + ", each AS (" + " UNION ALL ".join(
    f"SELECT entity, seq, f0, f1, cluster_label, cluster_centroid_distance AS d, {k} AS k FROM (WITH {_kmeans_sql('features', 'entity', _F2, k, ROUNDS, 'seq')} SELECT * FROM km WHERE cluster_label >= 0)"
    for k in (2, 3, 4, 5, 6)) + ")"


@query("choose_k", with_runs(_EACH_K_SQL + """, i AS (SELECT entity, k, sum(d * d) AS s, count(*) OVER (PARTITION BY entity) AS n FROM each GROUP BY entity, k),
 b AS (SELECT entity, k, n, abs(lead(s) OVER w - 2 * s + lag(s) OVER w) AS bend, row_number() OVER w AS rn FROM i WINDOW w AS (PARTITION BY entity ORDER BY k))
 SELECT entity, CASE WHEN n >= 3 THEN arg_max(k, bend) ELSE min(k) END AS k FROM b GROUP BY entity, n"""))
def choose_k(spark, sf_dir):
    return metrics.choose_k(features(spark, sf_dir).select("entity", "seq", *_F2), ["entity"], "seq", _F2, method="elbow")


def _squared_sql(src: str, by: str) -> str:
    """Mean over rows of the silhouette from all pairs of squared distances; leaves the CTE ``sq``."""
    on = " AND ".join(f"a.{c} = b.{c}" for c in by.split(", "))
    a_by = ", ".join(f"a.{c}" for c in by.split(", "))
    return f""", sp AS (SELECT {a_by}, a.seq, a.cluster_label AS l, b.cluster_label AS o, sum(power(a.f0 - b.f0, 2) + power(a.f1 - b.f1, 2)) AS d, count(*) AS c
   FROM {src} a JOIN {src} b ON {on} GROUP BY ALL),
 sa AS (SELECT {by}, seq, max(c) FILTER (o = l) AS n, max(CASE WHEN o = l AND c > 1 THEN d / (c - 1) END) AS a, min(CASE WHEN o <> l THEN d / c END) AS b FROM sp GROUP BY {by}, seq),
 sq AS (SELECT {by}, avg(CASE WHEN b IS NOT NULL THEN CASE WHEN n = 1 THEN 0 WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END END) AS score FROM sa GROUP BY {by})"""


@query("choose_k_silhouette", with_runs(_EACH_K_SQL + _squared_sql("each", "entity, k") + """
 SELECT entity, arg_max(k, round(score, 9) - k * 1e-12) AS k FROM sq WHERE score IS NOT NULL GROUP BY entity"""))
def choose_k_silhouette(spark, sf_dir):
    return metrics.choose_k(features(spark, sf_dir).select("entity", "seq", *_F2), ["entity"], "seq", _F2, method="silhouette_squared")


@query("silhouette_squared", with_runs(QUALITY_SQL + ", own AS (SELECT * FROM lab WHERE cluster_label <> -1)" + _squared_sql("own", "entity")
       + " SELECT entity, round(score, 6) AS silhouette_score FROM sq"))
def silhouette_squared(spark, sf_dir):
    src = _with_noise(clustered(spark, sf_dir)).where("cluster_label <> -1")
    return rounded(metrics.silhouette_squared(src, ["entity"], _F2))


@query("cluster_quality_squared", with_runs(QUALITY_SQL + ", own AS (SELECT * FROM lab WHERE cluster_label <> -1)" + _squared_sql("own", "entity")
       + " SELECT q.* REPLACE (CASE WHEN n_clusters >= 2 THEN round(score, 6) END AS silhouette_score) FROM q LEFT JOIN sq USING (entity)"))
def cluster_quality_squared(spark, sf_dir):
    """The quality of clusters at any size of a group: every score from sums per cluster."""
    return _round_quality(metrics.cluster_quality(_with_noise(clustered(spark, sf_dir)), ["entity"], "seq", _F2, squared=True))


# Anomalies and cliffs by rule, so that SQL can follow.
_RULE = ", an AS (SELECT entity, seq, measure, k > 90 AS is_anomaly, -0.4 - k / 1000.0 AS anomaly_score FROM laps)"


def rule(spark, sf_dir):
    return laps(spark, sf_dir).select("entity", "seq", "measure", (F.col("k") > 90).alias("is_anomaly"),
                                      (F.lit(-0.4) - F.col("k") / 1000.0).alias("anomaly_score"))


SUMMARY_SQL = _RULE + """, asum AS (SELECT entity, count(*) AS total_laps, count(*) FILTER (is_anomaly) AS anomalies_count,
 100 * count(*) FILTER (is_anomaly) / count(*) AS anomaly_rate, CAST(0 AS BIGINT) AS list_no,
 coalesce(string_agg(seq, ',' ORDER BY seq) FILTER (is_anomaly), '') AS anomaly_laps FROM an GROUP BY entity)"""


@query("anomaly_summary", with_laps(SUMMARY_SQL + " SELECT entity, total_laps, anomalies_count, round(anomaly_rate, 6) AS anomaly_rate, list_no, anomaly_laps FROM asum"))
def anomaly_summary(spark, sf_dir):
    out = metrics.anomaly_summary(rule(spark, sf_dir), ["entity"], "seq")
    return rounded(out.withColumn("anomaly_laps", F.array_join("anomaly_laps", ",")))


@query("anomaly_summary_global", with_laps(SUMMARY_SQL + """ SELECT count(*) AS total_laps, count(*) FILTER (is_anomaly) AS anomalies_count,
 round(100 * count(*) FILTER (is_anomaly) / count(*), 6) AS anomaly_rate FROM an"""))
def anomaly_summary_global(spark, sf_dir):
    return rounded(metrics.anomaly_summary(rule(spark, sf_dir), []))


@query("top_anomalous", with_laps(SUMMARY_SQL + " SELECT entity, anomalies_count FROM asum ORDER BY anomalies_count DESC, entity LIMIT 5"))
def top_anomalous(spark, sf_dir):
    s = metrics.anomaly_summary(rule(spark, sf_dir), ["entity"]).select("entity", "anomalies_count")
    return metrics.top_entities(s, ["entity"])


@query("anomaly_metrics", with_laps(_RULE + """ SELECT count(*) AS n_total, count(*) FILTER (is_anomaly) AS n_anomalies,
 round(100 * count(*) FILTER (is_anomaly) / count(*), 6) AS anomaly_rate, round(avg(anomaly_score), 6) AS score_mean, round(stddev_pop(anomaly_score), 6) AS score_std,
 round(min(anomaly_score), 6) AS score_min, round(max(anomaly_score), 6) AS score_max, round(avg(anomaly_score) FILTER (is_anomaly), 6) AS anomaly_score_mean,
 round(avg(anomaly_score) FILTER (NOT is_anomaly), 6) AS normal_score_mean FROM an"""))
def anomaly_metrics(spark, sf_dir):
    return rounded(metrics.anomaly_metrics(rule(spark, sf_dir)))


_CLIFFS = """, cf AS (SELECT entity, seq AS run, k > 60 AS has_cliff, k > 80 AS cliff_validated, CASE WHEN k > 60 THEN measure END AS cliff_delta_magnitude,
   CASE WHEN k > 60 THEN k END AS laps_before_cliff, CASE WHEN k > 70 THEN measure / 97 END AS pre_cliff_slope FROM laps)"""


def rule_cliffs(spark, sf_dir):
    k = F.col("k")
    return laps(spark, sf_dir).select("entity", F.col("seq").alias("run"), (k > 60).alias("has_cliff"), (k > 80).alias("cliff_validated"),
                                      F.when(k > 60, F.col("measure")).alias("cliff_delta_magnitude"), F.when(k > 60, k).alias("laps_before_cliff"),
                                      F.when(k > 70, F.col("measure") / 97).alias("pre_cliff_slope"))


@query("cliff_summary", with_laps(_CLIFFS + """ SELECT entity, count(*) AS total_stints, count(*) FILTER (has_cliff) AS stints_with_cliff,
 round_even(100.0 * count(*) FILTER (has_cliff) / count(*), 1) AS cliff_rate_pct, count(*) FILTER (cliff_validated) AS cliffs_validated,
 round_even(CASE WHEN count(*) FILTER (has_cliff) > 0 THEN 100.0 * count(*) FILTER (cliff_validated) / count(*) FILTER (has_cliff) ELSE 0 END, 1) AS validated_rate_pct,
 round_even(avg(cliff_delta_magnitude), 4) AS mean_cliff_magnitude, round_even(avg(laps_before_cliff), 1) AS mean_laps_before_cliff,
 round_even(avg(pre_cliff_slope), 4) AS mean_pre_cliff_slope FROM cf GROUP BY entity"""))
def cliff_summary(spark, sf_dir):
    return metrics.cliff_summary(rule_cliffs(spark, sf_dir), ["entity"])


@query("changepoint_metrics", with_laps(_CLIFFS + """ SELECT count(*) AS n_stints, count(*) FILTER (has_cliff) AS n_cliffs,
 round(100.0 * count(*) FILTER (has_cliff) / count(*), 6) AS cliff_rate, count(*) FILTER (cliff_validated) AS n_validated,
 round(100.0 * count(*) FILTER (cliff_validated) / count(*) FILTER (has_cliff), 6) AS validated_rate,
 round(avg(abs(cliff_delta_magnitude)), 6) AS mean_magnitude, round(avg(laps_before_cliff), 6) AS mean_laps_before FROM cf"""))
def changepoint_metrics(spark, sf_dir):
    return rounded(metrics.changepoint_metrics(rule_cliffs(spark, sf_dir)))


SCORES_SQL = _RULE + _CLIFFS + """, sil AS (SELECT entity, avg(k) / 100 - 0.4 AS s FROM laps GROUP BY entity HAVING avg(k) > 48),
 sc AS (SELECT entity, n, a, s, r FROM (SELECT entity, count(*) AS n, count(*) FILTER (is_anomaly) AS a FROM an GROUP BY entity) LEFT JOIN sil USING (entity)
   LEFT JOIN (SELECT entity, count(*) AS r FROM cf WHERE pre_cliff_slope > 2 GROUP BY entity) USING (entity)),
 scores AS (SELECT entity, round_even(CASE WHEN s IS NULL THEN 0.10 ELSE least(1, greatest(0, s)) * 0.40 END + least(1, n / 30.0) * 0.30
   + CASE WHEN a / n <= 0.15 THEN (1 - a / n / 0.15) * 0.20 ELSE 0 END + least(1, coalesce(r, 1) / 2.0) * 0.10, 3) AS quality_score FROM sc)"""


def scores(spark, sf_dir):
    sil = (laps(spark, sf_dir).groupBy("entity").agg((F.avg("k") / 100 - 0.4).alias("silhouette_score"), F.avg("k").alias("_k"))
           .where("_k > 48"))
    return metrics.quality_scores(rule(spark, sf_dir), ["entity"], sil, rule_cliffs(spark, sf_dir).where("pre_cliff_slope > 2"))


@query("quality_scores", with_laps(SCORES_SQL + " SELECT entity, quality_score FROM scores"))
def quality_scores(spark, sf_dir):
    return scores(spark, sf_dir)


@query("score_overview", with_laps(SCORES_SQL + " SELECT round(avg(quality_score), 6) AS mean_score, min(quality_score) AS min_score FROM scores"))
def score_overview(spark, sf_dir):
    return rounded(metrics.score_overview(scores(spark, sf_dir)))


@query("executive_summary", with_laps(""" SELECT count(*) AS total_laps, count(*) FILTER (measure = 0) AS zero_laps_removed, count(DISTINCT entity) AS n_drivers,
 count(*) FILTER (k > 95) AS structural_laps, count(*) FILTER (k > 90) AS anomalies, printf('%.2f%%', 100.0 * count(*) FILTER (k > 90) / count(*)) AS anomaly_rate FROM laps"""))
def executive_summary(spark, sf_dir):
    src = laps(spark, sf_dir).select("entity", "measure", (F.col("k") > 95).alias("is_structural"), (F.col("k") > 90).alias("is_anomaly"))
    return metrics.executive_summary(src, ["entity"], "measure")


# --- models without a relational form; the operators are tested against brute force ---

def cliff_input(spark, sf_dir):
    """Feature laps with rule anomalies, keyed by runs long enough to be searched."""
    return features(spark, sf_dir).select("entity", "seq", (F.floor((F.col("seq") - 1) / 20) + 1).cast("int").alias("run"),
                                          "measure", (F.col("measure") / 20).alias("lap_delta"), (F.col("measure") > 150).alias("is_anomaly"))


# The full search over all previous starts, value by value, then the cuts from the end backwards.
def _cuts_sql(penalties: str) -> str:
    return f""", src AS (SELECT entity, seq, CAST(floor((seq - 1) / 20) + 1 AS INTEGER) AS run, measure / 20 AS y, measure > 150 AS odd FROM features),
 pens AS (SELECT unnest([{penalties}]::DOUBLE[]) AS penalty),
 starts AS (SELECT entity, run, min(seq) AS s0, count(*) AS n_laps FROM src GROUP BY ALL),
 warm AS (SELECT entity, run, seq, y, odd FROM src JOIN starts USING (entity, run) WHERE seq >= s0 + 3),
 perrun AS (SELECT entity, run, count(*) FILTER (odd) AS n_odd, count(*) FILTER (NOT odd AND y IS NOT NULL) AS n_used FROM warm GROUP BY ALL),
 clean AS MATERIALIZED (SELECT entity, run, seq, y, row_number() OVER (PARTITION BY entity, run ORDER BY seq) - 1 AS idx FROM warm WHERE NOT odd AND y IS NOT NULL),
 st AS (SELECT entity, run, penalty, CAST(0 AS BIGINT) AS t, 0.0::DOUBLE AS p1, 0.0::DOUBLE AS p2, [0::BIGINT] AS ss, [0.0::DOUBLE] AS fs, [0.0::DOUBLE] AS aa,
   [0.0::DOUBLE] AS bb, CAST([] AS BIGINT[]) AS back FROM perrun, pens WHERE n_used >= 6
  UNION ALL SELECT entity, run, penalty, t, p1, p2, CASE WHEN low IS NULL THEN ss ELSE list_append(ss, t) END, CASE WHEN low IS NULL THEN fs ELSE list_append(fs, low + penalty) END,
   CASE WHEN low IS NULL THEN aa ELSE list_append(aa, p1) END, CASE WHEN low IS NULL THEN bb ELSE list_append(bb, p2) END,
   list_append(back, CASE WHEN low IS NULL THEN -1 ELSE ss[list_position(totals, low)] END) FROM (
    SELECT *, list_min(totals) AS low FROM (SELECT *, list_transform(range(1, len(list_filter(ss, lambda s: s <= t - 3)) + 1),
      lambda i: fs[i] + (p2 - bb[i]) - (p1 - aa[i]) * (p1 - aa[i]) / (t - ss[i])) AS totals FROM (
     SELECT st.* EXCLUDE (t, p1, p2), t + 1 AS t, p1 + y AS p1, p2 + y * y AS p2 FROM st JOIN clean c ON c.entity = st.entity AND c.run = st.run AND c.idx = st.t)))),
 ends AS (SELECT entity, run, penalty, arg_max(back, t) AS back, max(t) AS n FROM st GROUP BY ALL),
 tr AS (SELECT entity, run, penalty, back, back[n] AS cut FROM ends WHERE n > 0
  UNION ALL SELECT entity, run, penalty, back, back[cut] FROM tr WHERE cut > 0),
 cuts AS MATERIALIZED (SELECT entity, run, penalty, cut, seq AS lap FROM tr JOIN clean USING (entity, run) WHERE cut > 0 AND idx = cut),
 fst AS (SELECT entity, run, penalty, min(cut) AS c0, min(lap) AS cliff_lap, CAST(count(*) AS INTEGER) AS n_cp, string_agg(lap, ',' ORDER BY lap) AS all_laps FROM cuts GROUP BY ALL),
 lev AS (SELECT entity, run, penalty, avg(y) FILTER (idx < c0) AS pre, avg(y) FILTER (idx >= c0) AS post,
   regr_slope(y, idx) FILTER (idx < c0 AND idx >= c0 - 5) AS slope FROM clean JOIN fst USING (entity, run) GROUP BY ALL),
 cliffs AS (SELECT *, post - pre AS big, CASE WHEN c0 >= 2 THEN slope END AS pre_slope FROM fst JOIN lev USING (entity, run, penalty) WHERE post - pre >= 0.3),
 tab AS (SELECT s.entity, s.run, penalty, n_laps AS n_laps_in_stint, coalesce(n_odd, 0) AS n_anomalies_filtered, coalesce(n_used, 0) AS n_laps_analyzed,
   coalesce(n_cp, 0) AS n_changepoints, cliff_lap IS NOT NULL AS has_cliff, cliff_lap, coalesce(all_laps, '') AS all_cliff_laps, c0 AS laps_before_cliff,
   round(big, 6) AS cliff_delta_magnitude, round(pre, 6) AS regime_pre_cliff_mean, round(post, 6) AS regime_post_cliff_mean, round(pre_slope, 6) AS pre_cliff_slope,
   coalesce(pre_slope > 0.05, false) AS cliff_validated
   FROM starts s CROSS JOIN pens LEFT JOIN perrun USING (entity, run) LEFT JOIN cliffs USING (entity, run, penalty))"""


def _recursive(sql: str) -> str:
    return with_runs(FEATURES_SQL + sql).replace("WITH ", "WITH RECURSIVE ", 1)


@query("changepoint_runs", _recursive(_cuts_sql("3.0") + " SELECT * EXCLUDE (penalty) FROM tab"))
def changepoint_runs(spark, sf_dir):
    out = changepoints.detect_changepoints(cliff_input(spark, sf_dir), ROLES)[1]
    return rounded(out.withColumn("all_cliff_laps", F.array_join("all_cliff_laps", ",")))


@query("changepoint_rows", _recursive(_cuts_sql("3.0") + """, marks AS (SELECT entity, run, lap AS seq FROM cuts JOIN cliffs USING (entity, run, penalty))
 SELECT entity, seq, run, round(measure, 6) AS measure, round(measure / 20, 6) AS lap_delta, measure > 150 AS is_anomaly,
  CAST(count(mk) OVER (PARTITION BY entity, run ORDER BY seq) AS INTEGER) AS stint_regime, mk IS NOT NULL AS is_cliff_lap
 FROM (SELECT f.entity, f.seq, CAST(floor((f.seq - 1) / 20) + 1 AS INTEGER) AS run, measure, m.seq AS mk FROM features f
   LEFT JOIN marks m ON m.entity = f.entity AND m.seq = f.seq AND m.run = CAST(floor((f.seq - 1) / 20) + 1 AS INTEGER))"""))
def changepoint_rows(spark, sf_dir):
    return rounded(changepoints.detect_changepoints(cliff_input(spark, sf_dir), ROLES)[0])


@query("penalty_sweep", _recursive(_cuts_sql(", ".join(map(str, changepoints.PENALTY_SWEEP))) + """ SELECT penalty, count(*) AS n_stints, count(*) FILTER (has_cliff) AS n_cliffs,
 round(100.0 * count(*) FILTER (has_cliff) / count(*), 6) AS cliff_rate, count(*) FILTER (cliff_validated) AS n_validated,
 round(CASE WHEN count(*) FILTER (has_cliff) > 0 THEN 100.0 * count(*) FILTER (cliff_validated) / count(*) FILTER (has_cliff) ELSE 0 END, 6) AS validated_rate,
 round(coalesce(avg(abs(post - pre)) FILTER (has_cliff), 0), 6) AS mean_magnitude, round(coalesce(avg(laps_before_cliff) FILTER (has_cliff), 0), 6) AS mean_laps_before
 FROM tab LEFT JOIN (SELECT entity, run, penalty, pre, post FROM cliffs) USING (entity, run, penalty) GROUP BY penalty"""))
def penalty_sweep(spark, sf_dir):
    return rounded(changepoints.penalty_sweep(cliff_input(spark, sf_dir), ROLES))


_DENSE = ["lap_delta", "relative_pace"]


def _draw_sql(x: str, tree: str, seed: int) -> str:
    """``forest.draws`` in SQL."""
    p = forest.PRIME
    y = f"(({x}) * 48271 + ({tree} + 1) * 69621 + {seed}) % {p}"
    return f"list_transform([{y}], lambda y: ((y * y) % {p} * 48271 + {tree} + 1) % {p})[1]"


def _forest_sql(src: str, key: str, row_id: str, feats: list[str], seed: int = 42) -> str:
    """``fs`` (key, row id, anomaly_score, is_anomaly): trees grown level by level, then walked by every row."""
    n, p, f = len(feats), forest.PRIME, [f"f{i}" for i in range(len(feats))]
    cols = ", ".join(f)
    square = f"(d::BIGINT * d) % {p}"
    pick = " ".join(f"WHEN {i} THEN {{0}}f{i}" for i in range(n))
    wide = " OR ".join(f"hi{i} > lo{i}" for i in range(n))
    best = "list_position(u, list_max(u)) - 1"
    depth = lambda c: f"CASE WHEN {c} > 2 THEN 2 * (ln({c} - 1) + 0.5772156649015329) - 2 * ({c} - 1) / {c}::DOUBLE WHEN {c} = 2 THEN 1.0 ELSE 0.0 END"
    nodes = f"""SELECT *, CASE fd {" ".join(f"WHEN {i} THEN lo{i} + d / {p}::DOUBLE * (hi{i} - lo{i})" for i in range(n))} END AS cut
  FROM (SELECT * REPLACE (({square})::DOUBLE AS d), {best} AS fd FROM (SELECT *, {_draw_sql(f"v * {n + 1} + {n}", "t", seed + 1)} AS d,
   [{", ".join(f"CASE WHEN hi{i} > lo{i} THEN list_transform([{_draw_sql(f'v * {n + 1} + {i}', 't', seed + 1)}], lambda d: {square})[1] ELSE -1 END" for i in range(n))}] AS u FROM box))"""
    return f"""fbase AS (SELECT {key} AS g, {row_id} AS id, {", ".join(f"{c}::DOUBLE AS f{i}" for i, c in enumerate(feats))},
   ('0x' || substr(md5({row_id}::VARCHAR), 1, 8))::BIGINT AS x FROM {src} WHERE {" AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in feats)}),
 fsize AS (SELECT g, count(*) AS n FROM fbase GROUP BY g HAVING count(*) >= {forest.MIN_ROWS}),
 fvol AS (SELECT g, id, t, {square} AS h, {cols} FROM (SELECT *, {_draw_sql("x", "t", seed)} AS d FROM fbase JOIN fsize USING (g), range({forest.TREES}) r(t))
   WHERE ({square}) < {float(forest.VOLUNTEERS * forest.SAMPLE)} / n * {float(p)}),
 fm AS (SELECT g, least({forest.SAMPLE}, min(c)) AS m, ceil(log2(greatest(least({forest.SAMPLE}, min(c)), 2))) AS top FROM (SELECT g, t, count(*) AS c FROM fvol GROUP BY ALL) GROUP BY g),
 fpick AS (SELECT g, t, m, top, {cols} FROM (SELECT *, row_number() OVER (PARTITION BY g, t ORDER BY h, id) AS o FROM fvol) JOIN fm USING (g) WHERE o <= m),
 grown AS (SELECT 0 AS level, 1::BIGINT AS v, g, t, top, {cols} FROM fpick
  UNION ALL SELECT level + 1, 2 * v + (CASE fd {pick.format("")} END > cut)::INT, g, t, top, {cols}
  FROM (WITH box AS (SELECT *, count(*) OVER w AS c, {", ".join(f"min(f{i}) OVER w AS lo{i}, max(f{i}) OVER w AS hi{i}" for i in range(n))}
    FROM grown WHERE level < top WINDOW w AS (PARTITION BY g, t, v)) {nodes} WHERE c > 1 AND ({wide}))),
 box AS (SELECT level, v, g, t, any_value(top) AS top, count(*) AS c, {", ".join(f"min(f{i}) AS lo{i}, max(f{i}) AS hi{i}" for i in range(n))} FROM grown GROUP BY level, v, g, t),
 fnode AS MATERIALIZED (SELECT g, t, v, level, c, CASE WHEN c > 1 AND level < top AND ({wide}) THEN fd END AS fd, cut FROM ({nodes})),
 walk AS (SELECT 0 AS level, 1::BIGINT AS v, g, t, id, {cols} FROM fbase JOIN fsize USING (g), range({forest.TREES}) r(t)
  UNION ALL SELECT w.level + 1, 2 * w.v + (CASE fd {pick.format("w.")} END > cut)::INT, w.g, w.t, w.id, {", ".join("w." + c for c in f)}
  FROM walk w JOIN fnode k ON k.g = w.g AND k.t = w.t AND k.v = w.v WHERE fd IS NOT NULL),
 fend AS (SELECT w.g, w.id, sum((w.level::BIGINT * {forest.NANO} + round(({depth("coalesce(k.c, 0)")}) * {forest.NANO}))::BIGINT) AS total
   FROM walk w LEFT JOIN fnode k ON k.g = w.g AND k.t = w.t AND k.v = w.v WHERE fd IS NULL GROUP BY w.g, w.id),
 fscore AS (SELECT g, id, -power(2, -((total / {forest.TREES} / {forest.NANO}) / ({depth("m")}))) AS s FROM fend JOIN fm USING (g)),
 fs AS (SELECT g, id, s AS anomaly_score, s < q AS is_anomaly FROM fscore JOIN (SELECT g, quantile_cont(s, {forest.CONTAMINATION["default"]}) AS q FROM fscore GROUP BY g) USING (g))"""


@query("isolation_forest", with_runs(FEATURES_SQL + ", " + _forest_sql("features", "entity", "seq", _DENSE)).replace("WITH ", "WITH RECURSIVE ", 1) + """
 SELECT entity, seq, round(lap_delta, 6) AS lap_delta, round(relative_pace, 6) AS relative_pace, round(measure, 6) AS measure,
 coalesce(is_anomaly, false) AS is_anomaly, round(coalesce(anomaly_score, 0.0), 6) AS anomaly_score
 FROM features LEFT JOIN fs ON g = entity AND id = seq""")
def isolation_forest(spark, sf_dir):
    src = features(spark, sf_dir).select("entity", "seq", "lap_delta", "relative_pace", "measure")
    return rounded(forest.detect_anomalies(src, ["entity"], "seq", _DENSE))


@query("isolation_forest_global", f"WITH RECURSIVE {_EMB_SQL}, " + _forest_sql("emb", "0", "vec_id", _EMB) + f"""
 SELECT vec_id, label, {", ".join(f"round({c}, 6) AS {c}" for c in _EMB)}, coalesce(is_anomaly, false) AS is_anomaly,
 round(coalesce(anomaly_score, 0.0), 6) AS anomaly_score FROM emb LEFT JOIN fs ON id = vec_id""")
def isolation_forest_global(spark, sf_dir):
    return rounded(forest.detect_anomalies(emb(spark, sf_dir), [], "vec_id", _EMB))



# Core rows by counting neighbours, clusters by walking from core to core, borders to the lowest label.
DBSCAN_SQL = """, pt AS (SELECT entity, seq, lap_delta AS x, relative_pace AS y FROM features),
 nb AS (SELECT a.entity, a.seq, b.seq AS o FROM pt a JOIN pt b ON a.entity = b.entity AND sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) <= 5.0),
 core AS (SELECT entity, seq FROM nb GROUP BY ALL HAVING count(*) >= 3),
 ed AS (SELECT nb.entity, nb.seq, nb.o FROM nb JOIN core c ON c.entity = nb.entity AND c.seq = nb.seq JOIN core d ON d.entity = nb.entity AND d.seq = nb.o),
 reach AS (SELECT entity, seq, o FROM ed UNION SELECT r.entity, r.seq, e.o FROM reach r JOIN ed e ON e.entity = r.entity AND e.seq = r.o),
 comp AS (SELECT entity, seq, min(o) AS comp FROM reach GROUP BY ALL),
 allc AS (SELECT entity, seq, comp FROM comp UNION ALL SELECT nb.entity, nb.seq, min(comp) FROM nb JOIN comp c ON c.entity = nb.entity AND c.seq = nb.o
   WHERE NOT EXISTS (SELECT 1 FROM core k WHERE k.entity = nb.entity AND k.seq = nb.seq) GROUP BY ALL),
 num AS (SELECT entity, seq, dense_rank() OVER (PARTITION BY entity ORDER BY comp) - 1 AS label FROM allc)"""


@query("dbscan", with_runs(FEATURES_SQL + DBSCAN_SQL).replace("WITH ", "WITH RECURSIVE ", 1) + """
 SELECT entity, seq, CAST(coalesce(label, -1) AS INTEGER) AS cluster_label, label IS NULL AS is_noise FROM pt LEFT JOIN num USING (entity, seq)""")
def dbscan(spark, sf_dir):
    src = features(spark, sf_dir).select("entity", "seq", *_DENSE)
    return density.dbscan(src, ["entity"], "seq", _DENSE, eps=5.0).drop(*_DENSE)


_EPS_SQL = DBSCAN_SQL.replace("<= 5.0)", "<= (SELECT eps FROM ep WHERE ep.entity = a.entity))").replace(" nb AS (", """ kd AS (SELECT a.entity, a.seq, sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) AS d,
   row_number() OVER (PARTITION BY a.entity, a.seq ORDER BY sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2))) AS rn FROM pt a JOIN pt b ON a.entity = b.entity),
 ep AS (SELECT entity, quantile_cont(d, 0.9) AS eps FROM kd WHERE rn = 3 GROUP BY entity),
 nb AS (""", 1)


@query("dbscan_estimated_eps", with_runs(FEATURES_SQL + _EPS_SQL).replace("WITH ", "WITH RECURSIVE ", 1) + """
 SELECT entity, seq, round(x, 6) AS lap_delta, round(y, 6) AS relative_pace, CAST(coalesce(label, -1) AS INTEGER) AS cluster_label, label IS NULL AS is_noise
 FROM pt LEFT JOIN num USING (entity, seq)""")
def dbscan_estimated_eps(spark, sf_dir):
    src = features(spark, sf_dir).select("entity", "seq", *_DENSE)
    return rounded(density.dbscan(src, ["entity"], "seq", _DENSE, eps=None))


@query("hdbscan")
def hdbscan(spark, sf_dir):
    return density.hdbscan(features(spark, sf_dir).select("entity", "seq", *_DENSE), ["entity"], "seq", _DENSE)
