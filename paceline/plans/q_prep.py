"""Queries over imputation, encoding and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.operators import prep
from paceline.plans.registry import query, rounded
from paceline.plans.views import laps, table, with_laps

# Holes by rule, so that SQL finds the same ones.
_HOLES = "SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS q, CASE WHEN l_linenumber <> 5 THEN l_discount END AS d FROM lineitem"


def holes(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("q"),
        F.when(F.col("l_linenumber") != 5, F.col("l_discount")).alias("d"))


def _impute_sql(fill: str) -> str:
    return f"""WITH h AS ({_HOLES}), f AS ({fill}) SELECT l_orderkey, l_partkey, round(coalesce(q, fq), 6) AS q, round(coalesce(d, fd), 6) AS d FROM h, f"""


@query("impute_mean", _impute_sql("SELECT avg(q) AS fq, avg(d) AS fd FROM h"))
def impute_mean(spark, sf_dir):
    return rounded(prep.impute(holes(spark, sf_dir), ["q", "d"]))


@query("impute_median", _impute_sql("SELECT median(q) AS fq, median(d) AS fd FROM h"))
def impute_median(spark, sf_dir):
    return rounded(prep.impute(holes(spark, sf_dir), ["q", "d"], "median"))


@query("impute_most_frequent", _impute_sql("""SELECT (SELECT q FROM h WHERE q IS NOT NULL GROUP BY q ORDER BY count(*) DESC, q LIMIT 1) AS fq,
  (SELECT d FROM h WHERE d IS NOT NULL GROUP BY d ORDER BY count(*) DESC, d LIMIT 1) AS fd"""))
def impute_most_frequent(spark, sf_dir):
    return rounded(prep.impute(holes(spark, sf_dir), ["q", "d"], "most_frequent"))


@query("knn_impute", with_laps(""", b AS (SELECT entity, seq, CASE WHEN k % 4 <> 0 THEN measure END AS m, CASE WHEN k % 7 <> 0 THEN CAST(k AS DOUBLE) END AS kk,
    CAST(age AS DOUBLE) AS a FROM laps),
  p AS (SELECT x.entity, x.seq, y.seq AS donor, y.m, y.kk, sqrt((coalesce(power(x.m - y.m, 2), 0) + coalesce(power(x.kk - y.kk, 2), 0) + power(x.a - y.a, 2))
     * 3 / (1 + CAST(x.m IS NOT NULL AND y.m IS NOT NULL AS INT) + CAST(x.kk IS NOT NULL AND y.kk IS NOT NULL AS INT))) AS dist
     FROM b x JOIN b y ON x.entity = y.entity AND x.seq <> y.seq WHERE x.m IS NULL OR x.kk IS NULL),
  fm AS (SELECT entity, seq, avg(m) AS f FROM (SELECT *, row_number() OVER (PARTITION BY entity, seq ORDER BY dist, donor) AS rn FROM p WHERE m IS NOT NULL) WHERE rn <= 5 GROUP BY ALL),
  fk AS (SELECT entity, seq, avg(kk) AS f FROM (SELECT *, row_number() OVER (PARTITION BY entity, seq ORDER BY dist, donor) AS rn FROM p WHERE kk IS NOT NULL) WHERE rn <= 5 GROUP BY ALL)
  SELECT b.entity, b.seq, round(coalesce(b.m, fm.f), 6) AS m, round(coalesce(b.kk, fk.f), 6) AS kk, b.a FROM b
  LEFT JOIN fm USING (entity, seq) LEFT JOIN fk USING (entity, seq)"""))
def knn_impute(spark, sf_dir):
    src = laps(spark, sf_dir).select("entity", "seq", F.when(F.col("k") % 4 != 0, F.col("measure")).alias("m"),
                                     F.when(F.col("k") % 7 != 0, F.col("k").cast("double")).alias("kk"),
                                     F.col("age").cast("double").alias("a"))
    return rounded(prep.knn_impute(src, "seq", ["m", "kk", "a"], keys=["entity"]), "a")


@query("one_hot", """SELECT p_partkey, CAST(p_size AS INTEGER) AS p_size, CAST(p_type = 'LARGE' AS INTEGER) AS p_type_LARGE,
  CAST(p_type = 'MEDIUM' AS INTEGER) AS p_type_MEDIUM, CAST(p_type = 'PROMO' AS INTEGER) AS p_type_PROMO,
  CAST(p_type = 'SMALL' AS INTEGER) AS p_type_SMALL, CAST(p_type = 'STANDARD' AS INTEGER) AS p_type_STANDARD FROM part""")
def one_hot(spark, sf_dir):
    return prep.one_hot(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type"), ["p_type"], drop_first=True)


@query("scale_standard", """SELECT l_orderkey, l_partkey, round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS l_quantity,
  round((l_tax - avg(l_tax) OVER ()) / stddev_pop(l_tax) OVER (), 6) AS l_tax FROM lineitem""")
def scale_standard(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_tax")
    return rounded(prep.scale(li, ["l_quantity", "l_tax"], "standard"))


@query("scale_robust", """WITH q AS (SELECT quantile_cont(l_quantity, [0.25, 0.5, 0.75]) AS a, quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS b FROM lineitem)
  SELECT l_orderkey, l_partkey, round((l_quantity - a[2]) / (a[3] - a[1]), 6) AS l_quantity,
  round((l_extendedprice - b[2]) / (b[3] - b[1]), 6) AS l_extendedprice FROM lineitem, q""")
def scale_robust(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    return rounded(prep.scale(li, ["l_quantity", "l_extendedprice"], "robust"))


@query("scale_auto", """WITH t AS (SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS name, c_acctbal, CAST(c_nationkey % 2 AS INTEGER) AS flag FROM customer),
  q AS (SELECT quantile_cont(id, [0.25, 0.5, 0.75]) AS a, quantile_cont(c_acctbal, [0.25, 0.5, 0.75]) AS b FROM t)
  SELECT name, flag, round((id - a[2]) / (a[3] - a[1]), 6) AS id, round((c_acctbal - b[2]) / (b[3] - b[1]), 6) AS c_acctbal FROM t, q""")
def scale_auto(spark, sf_dir):
    src = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").cast("string").alias("name"),
                                                  "c_acctbal", (F.col("c_nationkey") % 2).cast("int").alias("flag"))
    return rounded(prep.scale(src))


def _encoded_sql(where: str) -> str:
    hot = ", ".join(f"CAST(p_type = '{v}' AS INTEGER) AS p_type_{v}" for v in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"))
    return f"""SELECT p_partkey, round((p_size - a[2]) / (a[3] - a[1]), 6) AS p_size, {hot} FROM
  (SELECT p_partkey, p_type, CAST(p_size AS DOUBLE) AS p_size FROM part {where}),
  (SELECT quantile_cont(CAST(p_size AS DOUBLE), [0.25, 0.5, 0.75]) AS a FROM part {where})"""


def _encoded(spark, sf_dir):
    src = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.col("p_size").cast("double").alias("p_size"),
                                              (F.col("p_retailprice") > 1000).alias("slow"))
    return prep.encode_and_scale(src, ["p_type"], ["p_size"], "slow")


@query("encode_and_scale", _encoded_sql("WHERE NOT p_retailprice > 1000"))
def encode_and_scale(spark, sf_dir):
    return rounded(_encoded(spark, sf_dir)[1])


@query("encode_and_scale_all", _encoded_sql(""))
def encode_and_scale_all(spark, sf_dir):
    return rounded(_encoded(spark, sf_dir)[0])


@query("one_hot_long", """SELECT p_partkey, c AS "column", v AS value FROM (SELECT p_partkey, 'p_type' AS c, p_type AS v FROM part
  UNION ALL SELECT p_partkey, 'p_name', p_name FROM part) WHERE v IS NOT NULL
  AND v <> CASE c WHEN 'p_type' THEN (SELECT min(p_type) FROM part) ELSE (SELECT min(p_name) FROM part) END""")
def one_hot_long(spark, sf_dir):
    return prep.one_hot_long(table(spark, sf_dir, "part"), "p_partkey", ["p_type", "p_name"], drop_first=True)


@query("feature_pipeline", """WITH q AS (SELECT quantile_cont(CAST(p_size AS DOUBLE), [0.25, 0.5, 0.75]) AS a, quantile_cont(p_retailprice, [0.25, 0.5, 0.75]) AS b FROM part)
  SELECT p_partkey, round((p_size - a[2]) / (a[3] - a[1]), 6) AS p_size, round((p_retailprice - b[2]) / (b[3] - b[1]), 6) AS p_retailprice, """
       + ", ".join(f"CAST(p_type = '{v}' AS INTEGER) AS p_type_{v}" for v in ("LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")) + " FROM part, q")
def feature_pipeline(spark, sf_dir):
    src = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return rounded(prep.feature_pipeline(src, ["p_size", "p_retailprice"], ["p_type"]))
