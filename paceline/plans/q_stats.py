"""Queries over the statistics operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.operators import stats
from paceline.operators.keyed import group_quantiles
from paceline.plans.registry import query, rounded
from paceline.plans.views import laps, table, with_laps

_LINE = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice"]
_GROUP = ["l_returnflag", "l_linestatus"]

# Moments written out, so that both engines use the same population formulas.
_MOMENTS = """
 m AS (SELECT {keys}, count({v}) AS n, avg({v}) AS mu, stddev_pop({v}) AS sd0, stddev_samp({v}) AS sd1,
         var_samp({v}) AS var1, min({v}) AS mn, max({v}) AS mx FROM {src} GROUP BY {keys}),
 s AS (SELECT {skeys}, avg(power(t.{v} - m.mu, 3)) AS m3, avg(power(t.{v} - m.mu, 4)) AS m4
       FROM {src} t JOIN m USING ({keys}) GROUP BY {skeys})"""


@query("enrich", "WITH " + _MOMENTS.format(keys="l_returnflag, l_linestatus", v="l_extendedprice", src="lineitem",
       skeys="l_returnflag, l_linestatus").strip() + """,
 r AS (SELECT l_returnflag, l_linestatus, regr_slope(l_extendedprice, l_quantity) AS sl,
         regr_r2(l_extendedprice, l_quantity) AS r2, regr_intercept(l_extendedprice, l_quantity) AS ic
       FROM lineitem GROUP BY ALL)
 SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity, l_extendedprice,
   round((l_extendedprice - mu) / nullif(sd0, 0), 6) AS z_score,
   coalesce(abs((l_extendedprice - mu) / nullif(sd0, 0)) > 3, false) AS is_outlier,
   round(sd1, 4) AS group_std, round(sl, 4) AS degradation_slope, round(r2, 6) AS degradation_r_squared,
   round(ic, 4) AS degradation_intercept, n AS group_nobs, round(mu, 4) AS group_mean,
   round(var1 / 1e6, 4) AS group_variance, round(m3 / power(sd0, 3), 6) AS group_skewness,
   round(m4 / power(sd0, 4) - 3, 6) AS group_kurtosis, mn AS group_min, mx AS group_max
 FROM lineitem JOIN m USING (l_returnflag, l_linestatus) JOIN s USING (l_returnflag, l_linestatus)
   JOIN r USING (l_returnflag, l_linestatus)""")
def enrich(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(*_LINE)
    out = stats.enrich(li, "l_extendedprice", _GROUP, x="l_quantity")
    four = ["group_std", "degradation_slope", "degradation_intercept", "group_mean"]
    for c in four:
        out = out.withColumn(c, F.round(c, 4))
    out = out.withColumn("group_variance", F.round(F.col("group_variance") / 1e6, 4))
    return rounded(out, *four, "group_variance", "l_quantity", "l_extendedprice", "group_min", "group_max")


@query("stat_features", with_laps("""
 SELECT entity, seq, category, measure,
   round((measure - avg(measure) OVER w) / nullif(stddev_pop(measure) OVER w, 0), 6) AS z_score,
   coalesce(abs((measure - avg(measure) OVER w) / nullif(stddev_pop(measure) OVER w, 0)) > 3, false) AS is_outlier,
   round(avg(measure) OVER w, 6) AS group_mean, round(stddev_samp(measure) OVER w, 6) AS group_std
 FROM laps WINDOW w AS (PARTITION BY entity, category)"""))
def stat_features(spark, sf_dir):
    src = laps(spark, sf_dir).select("entity", "seq", "category", "measure")
    return rounded(stats.statistical_features(src, "measure", ["entity", "category"]))


@query("stat_features_nullkey", with_laps("""
 SELECT entity, seq, g, measure,
   CASE WHEN g IS NOT NULL THEN round((measure - avg(measure) OVER w) / nullif(stddev_pop(measure) OVER w, 0), 6) END AS z_score,
   CASE WHEN g IS NOT NULL THEN coalesce(abs((measure - avg(measure) OVER w) / nullif(stddev_pop(measure) OVER w, 0)) > 3, false)
        ELSE false END AS is_outlier,
   CASE WHEN g IS NOT NULL THEN round(avg(measure) OVER w, 6) END AS group_mean,
   CASE WHEN g IS NOT NULL THEN round(stddev_samp(measure) OVER w, 6) END AS group_std
 FROM (SELECT *, nullif(category, 'view') AS g FROM laps) WINDOW w AS (PARTITION BY g)"""))
def stat_features_nullkey(spark, sf_dir):
    src = laps(spark, sf_dir).select("entity", "seq", F.nullif("category", F.lit("view")).alias("g"), "measure")
    return rounded(stats.statistical_features(src, "measure", ["g"]))


@query("stat_features_global", """
 SELECT event_id, value, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 6) AS z_score,
   abs((value - avg(value) OVER ()) / stddev_pop(value) OVER ()) > 3 AS is_outlier,
   round(avg(value) OVER (), 6) AS group_mean, round(stddev_samp(value) OVER (), 6) AS group_std FROM events""")
def stat_features_global(spark, sf_dir):
    return rounded(stats.statistical_features(table(spark, sf_dir, "events").select("event_id", "value"), "value"))


@query("degradation", with_laps("""
 , r AS (SELECT entity, category, count(*) AS n, regr_slope(measure, seq) AS sl, regr_r2(measure, seq) AS r2,
       regr_intercept(measure, seq) AS ic, min(measure) = max(measure) AS flat FROM laps GROUP BY ALL)
 SELECT entity, category, seq, measure,
   CASE WHEN n >= 2 THEN round(CASE WHEN flat THEN 0 ELSE sl END, 6) END AS degradation_slope,
   CASE WHEN n >= 2 THEN round(CASE WHEN flat THEN 1 ELSE r2 END, 6) END AS degradation_r_squared,
   CASE WHEN n >= 2 THEN round(ic, 6) END AS degradation_intercept
 FROM laps JOIN r USING (entity, category)"""))
def degradation(spark, sf_dir):
    src = laps(spark, sf_dir).select("entity", "category", "seq", "measure")
    return rounded(stats.degradation(src, "seq", "measure", ["entity", "category"]))


@query("trend_per_group", """
 SELECT l_suppkey, round(regr_slope(l_extendedprice, l_quantity), 4) AS degradation_slope,
   round(regr_r2(l_extendedprice, l_quantity), 6) AS degradation_r_squared,
   round(regr_intercept(l_extendedprice, l_quantity), 4) AS degradation_intercept
 FROM lineitem GROUP BY l_suppkey""")
def trend_per_group(spark, sf_dir):
    out = stats.group_trend(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", ["l_suppkey"])
    return out.select("l_suppkey", F.round("degradation_slope", 4).alias("degradation_slope"),
                      F.round("degradation_r_squared", 6).alias("degradation_r_squared"),
                      F.round("degradation_intercept", 4).alias("degradation_intercept"))


@query("describe", "WITH " + _MOMENTS.format(keys="l_suppkey", v="l_quantity", src="lineitem", skeys="l_suppkey").strip() + """
 SELECT l_suppkey, n AS nobs, round(mu, 6) AS mean, round(var1, 6) AS variance,
   round(m3 / power(sd0, 3), 6) AS skewness, round(m4 / power(sd0, 4) - 3, 6) AS kurtosis, mn AS min, mx AS max
 FROM m JOIN s USING (l_suppkey)""")
def describe(spark, sf_dir):
    return rounded(stats.describe(table(spark, sf_dir, "lineitem"), "l_quantity", ["l_suppkey"]))


@query("describe_global", """
 WITH m AS (SELECT avg(value) AS mu, stddev_pop(value) AS sd FROM events)
 SELECT count(*) AS nobs, round(avg(value), 6) AS mean, round(var_samp(value), 6) AS variance,
   round(avg(power(value - mu, 3)) / power(max(sd), 3), 6) AS skewness,
   round(avg(power(value - mu, 4)) / power(max(sd), 4) - 3, 6) AS kurtosis, min(value) AS min, max(value) AS max
 FROM events, m""")
def describe_global(spark, sf_dir):
    return rounded(stats.describe(table(spark, sf_dir, "events"), "value"))


@query("group_quantiles", """
 SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS q1,
   round(quantile_cont(l_extendedprice, 0.5), 4) AS q2, round(quantile_cont(l_extendedprice, 0.9), 4) AS q9
 FROM lineitem GROUP BY l_returnflag""")
def quantiles(spark, sf_dir):
    out = group_quantiles(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice",
                          {"q1": 0.25, "q2": 0.5, "q9": 0.9})
    return rounded(out, digits=4)
