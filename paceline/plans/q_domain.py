"""Queries over control, weather and result features, and lenient parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.functions.columns import clock_seconds, lenient_double
from paceline.operators import domain
from paceline.operators.ordered import dense_position, fill_gaps
from paceline.plans.registry import query, rounded
from paceline.plans.views import control, laps, table, with_control, with_laps

CONTROL_FEATURES_SQL = """
, txt AS (SELECT *, upper(coalesce(Message, '')) || upper(coalesce(Category, 'UNKNOWN')) AS t FROM control),
 flagged AS (SELECT *, t LIKE '%VIRTUAL SAFETY CAR%' OR t LIKE '%VSC DEPLOYED%' OR t LIKE '%SAFETY CAR (VSC)%' AS vsc FROM txt),
 cf AS (SELECT part, code, Lap, seq, Category, Message, Time_seconds, vsc AS is_virtual_safety_car,
   (t LIKE '%SAFETY CAR DEPLOYED%' OR t LIKE '%SC DEPLOYED%') AND NOT vsc AS is_full_safety_car,
   vsc OR t LIKE '%SAFETY CAR DEPLOYED%' OR t LIKE '%SC DEPLOYED%' AS is_safety_car, t LIKE '%FLAG%' AS is_flag,
   t LIKE '%PENALTY%' OR t LIKE '%PENALISED%' OR t LIKE '%DRIVE THROUGH%' OR t LIKE '%STOP AND GO%' AS is_penalty,
   t LIKE '%DRS%' AS is_drs,
   CASE Category WHEN 'SafetyCar' THEN 1 WHEN 'Flag' THEN 2 WHEN 'Drs' THEN 3 WHEN 'CarEvent' THEN 4 ELSE 0 END AS category_encoded,
   CASE WHEN t LIKE '%RED FLAG%' OR t LIKE '%SAFETY CAR DEPLOYED%' OR t LIKE '%RACE SUSPENDED%' THEN 2
        WHEN t LIKE '%YELLOW FLAG%' OR t LIKE '%VSC%' OR t LIKE '%PENALTY%' OR t LIKE '%INVESTIGATION%' THEN 1
        ELSE 0 END AS event_severity FROM flagged)
"""


def control_features(spark, sf_dir):
    return domain.control_features(control(laps(spark, sf_dir)))


@query("control_features", with_control(CONTROL_FEATURES_SQL + """ SELECT part, seq, is_virtual_safety_car, is_full_safety_car,
 is_safety_car, is_flag, is_penalty, is_drs, category_encoded, event_severity, Time_seconds AS time_seconds,
 coalesce(Category, 'UNKNOWN') AS category_text, coalesce(Message, '') AS message FROM cf"""))
def control_enriched(spark, sf_dir):
    return control_features(spark, sf_dir).select(
        "part", "seq", "is_virtual_safety_car", "is_full_safety_car", "is_safety_car", "is_flag", "is_penalty",
        "is_drs", "category_encoded", "event_severity", "time_seconds", "category_text", "message")


@query("severity_counts", """
 WITH t AS (SELECT upper(text) || 'UNKNOWN' AS t FROM documents)
 SELECT CASE WHEN t LIKE '%RED FLAG%' OR t LIKE '%SAFETY CAR DEPLOYED%' OR t LIKE '%RACE SUSPENDED%' THEN 2
        WHEN t LIKE '%YELLOW FLAG%' OR t LIKE '%VSC%' OR t LIKE '%PENALTY%' OR t LIKE '%INVESTIGATION%' THEN 1
        ELSE 0 END AS event_severity, t LIKE '%FLAG%' AS is_flag, count(*) AS n FROM t GROUP BY ALL""")
def severity_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("text").alias("Message"))
    return (domain.control_features(docs).groupBy("event_severity", "is_flag")
            .agg(F.count(F.lit(1)).alias("n")))


@query("lenient_cast", """
 SELECT p_partkey, try_cast(replace(p_brand, 'Brand#', CASE WHEN p_size > 25 THEN '' ELSE 'x' END) AS DOUBLE) AS n FROM part""")
def lenient_cast(spark, sf_dir):
    text = F.expr("replace(p_brand, 'Brand#', CASE WHEN p_size > 25 THEN '' ELSE 'x' END)")
    return table(spark, sf_dir, "part").select("p_partkey", lenient_double(text).alias("n"))


_WEATHER_SRC = """
 d AS (SELECT year(o_orderdate) AS yr, o_orderdate AS day, avg(o_totalprice) AS p, avg(o_custkey) AS q,
    count(*) AS n, bool_or(o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') AS rain FROM orders GROUP BY ALL),
 raw AS (SELECT yr, CAST(epoch(day) AS DOUBLE) AS Time_seconds,
    CASE WHEN n % 3 <> 0 THEN p / 7000 END AS AirTemp, CASE WHEN n % 5 <> 0 THEN q / 70 END AS TrackTemp, rain AS Rainfall FROM d),
 pos AS (SELECT *, row_number() OVER (PARTITION BY yr ORDER BY Time_seconds) AS pos FROM raw)"""


def _filled_sql(src: str, cols: list[str], keys: str) -> str:
    parts = []
    for c in cols:
        b = f"last_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY pos ROWS UNBOUNDED PRECEDING)"
        bv = f"last_value({c} IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY pos ROWS UNBOUNDED PRECEDING)"
        f = f"first_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        fv = f"first_value({c} IGNORE NULLS) OVER (PARTITION BY {keys} ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        parts.append(f"{b} AS {c}_bp, {bv} AS {c}_bv, {f} AS {c}_fp, {fv} AS {c}_fv")
    vals = [f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_bp IS NOT NULL AND {c}_fp IS NOT NULL "
            f"THEN {c}_bv + ({c}_fv - {c}_bv) * (pos - {c}_bp) / ({c}_fp - {c}_bp) ELSE coalesce({c}_bv, {c}_fv) END AS {c}"
            for c in cols]
    return f"SELECT * REPLACE ({', '.join(vals)}) FROM (SELECT *, {', '.join(parts)} FROM {src})"


def weather_like(spark, sf_dir):
    d = (table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("yr"), F.col("o_orderdate").alias("day"))
         .agg(F.avg("o_totalprice").alias("p"), F.avg("o_custkey").alias("q"), F.count(F.lit(1)).alias("n"),
              F.bool_or((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")).alias("Rainfall")))
    return d.select("yr", clock_seconds(F.col("day")).alias("Time_seconds"),
                    F.when(F.col("n") % 3 != 0, F.col("p") / 7000).alias("AirTemp"),
                    F.when(F.col("n") % 5 != 0, F.col("q") / 70).alias("TrackTemp"), "Rainfall")


WEATHER_SQL = _WEATHER_SRC + ", filled AS (" + _filled_sql("pos", ["AirTemp", "TrackTemp"], "yr") + """),
 tr AS (SELECT *, coalesce(TrackTemp - lag(TrackTemp) OVER w, 0) AS temp_trend,
    coalesce(CAST(Rainfall AS INT) - CAST(lag(Rainfall) OVER w AS INT), 0) > 0 AS onset FROM filled
    WINDOW w AS (PARTITION BY yr ORDER BY pos)),
 weather AS (SELECT yr, Time_seconds, Rainfall, AirTemp, TrackTemp,
  (AirTemp - avg(AirTemp) OVER p) / stddev_samp(AirTemp) OVER p AS air_temp_normalized,
  (TrackTemp - avg(TrackTemp) OVER p) / stddev_samp(TrackTemp) OVER p AS track_temp_normalized,
  TrackTemp - AirTemp AS temp_delta, CAST(Rainfall AS INT) AS rainfall_indicator, temp_trend,
  CASE WHEN temp_trend > 0.5 THEN 1 WHEN temp_trend < -0.5 THEN -1 ELSE 0 END AS temp_trend_direction,
  greatest(CAST(abs(temp_trend) > 2 * stddev_samp(temp_trend) OVER p AS INT), CAST(onset AS INT)) AS weather_change
  FROM tr WINDOW p AS (PARTITION BY yr))"""


@query("weather_features", "WITH " + WEATHER_SQL + """ SELECT yr, time_seconds AS t, Rainfall, round(AirTemp, 6) AS AirTemp,
 round(TrackTemp, 6) AS TrackTemp, round(air_temp_normalized, 6) AS air_temp_normalized,
 round(track_temp_normalized, 6) AS track_temp_normalized, round(temp_delta, 6) AS temp_delta, rainfall_indicator,
 round(temp_trend, 6) AS temp_trend, temp_trend_direction, weather_change FROM weather""")
def weather_features(spark, sf_dir):
    out = domain.weather_features(weather_like(spark, sf_dir), ["yr"])
    return rounded(out.withColumnRenamed("time_seconds", "t"), "t")


@query("gap_fill", with_laps(", g AS (SELECT entity, seq AS pos, CASE WHEN k % 3 <> 0 AND seq > 3 THEN measure END AS v FROM laps), f AS ("
       + _filled_sql("g", ["v"], "entity") + ") SELECT entity, pos, round(v, 6) AS v FROM f"))
def gap_fill(spark, sf_dir):
    g = laps(spark, sf_dir).select("entity", F.col("seq").alias("pos"),
                                   F.when((F.col("k") % 3 != 0) & (F.col("seq") > 3), F.col("measure")).alias("v"))
    return rounded(fill_gaps(g, ["entity"], "pos", ["v"]))


@query("dense_position", """SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_extendedprice,
 row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS pos FROM lineitem""")
def dense(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    return dense_position(li, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"],
                          F.year("l_shipdate").cast("long"))


_STATUS_SQL = """CASE WHEN o_orderstatus = 'F' THEN 'Finished' WHEN o_orderstatus = 'O' THEN '+1 Lap'
   WHEN o_orderkey % 5 = 0 THEN 'Collision damage' WHEN o_orderkey % 5 = 1 THEN 'Engine' WHEN o_orderkey % 5 = 2 THEN 'Power Unit'
   WHEN o_orderkey % 5 = 3 THEN 'Retired' END"""

RESULTS_SQL = f"""
 res AS (SELECT o_orderpriority AS part, o_orderkey, CASE WHEN o_custkey % 9 = 0 THEN 'NC' ELSE CAST(o_orderkey % 20 + 1 AS VARCHAR) END AS Position,
   CAST(o_custkey % 20 + 1 AS DOUBLE) AS GridPosition, CASE WHEN o_custkey % 7 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 26 AS VARCHAR) END AS Points,
   {_STATUS_SQL} AS Status FROM orders),
 rc AS (SELECT *, try_cast(Position AS DOUBLE) AS final_position, GridPosition AS grid_position,
   try_cast(Position AS DOUBLE) - GridPosition AS position_change,
   CAST(coalesce(try_cast(Position AS DOUBLE) < GridPosition, false) AS INT) AS position_gain, coalesce(Status, 'Unknown') AS status_text,
   CASE WHEN coalesce(Status, 'Unknown') LIKE '%Finished%' OR Status LIKE '%+%' THEN 1 ELSE 0 END AS finish_status,
   CASE WHEN upper(Status) LIKE '%COLLISION%' THEN 'collision' WHEN upper(Status) LIKE '%ENGINE%' THEN 'mechanical'
        WHEN upper(Status) LIKE '%POWER%' THEN 'electrical' WHEN upper(Status) LIKE '%FINISHED%' OR Status LIKE '%+%' THEN 'finished'
        ELSE 'other' END AS dnf_category, coalesce(try_cast(Points AS DOUBLE), 0) AS points_value FROM res),
 mx AS (SELECT *, max(points_value) OVER p AS mp, max(final_position) OVER p AS mxp FROM rc WINDOW p AS (PARTITION BY part)),
 sc AS (SELECT *, points_value / mp AS points_normalized,
    (mxp + 1 - coalesce(final_position, mxp + 1)) / mxp - 0.1 * coalesce(position_change, 0) + points_value / mp AS raw FROM mx),
 results AS (SELECT * EXCLUDE (mp, mxp, raw), (raw - min(raw) OVER p) / (max(raw) OVER p - min(raw) OVER p) AS performance_score
   FROM sc WINDOW p AS (PARTITION BY part))"""


def results_like(spark, sf_dir):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    status = (F.when(F.col("o_orderstatus") == "F", "Finished").when(F.col("o_orderstatus") == "O", "+1 Lap")
              .when(key % 5 == 0, "Collision damage").when(key % 5 == 1, "Engine").when(key % 5 == 2, "Power Unit")
              .when(key % 5 == 3, "Retired"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("part"), "o_orderkey",
        F.when(cust % 9 == 0, "NC").otherwise((key % 20 + 1).cast("string")).alias("Position"),
        (cust % 20 + 1).cast("double").alias("GridPosition"),
        F.when(cust % 7 == 0, "n/a").otherwise((key % 26).cast("string")).alias("Points"), status.alias("Status"))


@query("result_features", "WITH " + RESULTS_SQL + """ SELECT part, o_orderkey, Position, GridPosition, Points, Status, final_position,
 grid_position, position_change, position_gain, status_text, finish_status, dnf_category, points_value,
 round(points_normalized, 6) AS points_normalized, round(performance_score, 6) AS performance_score FROM results""")
def result_features(spark, sf_dir):
    return rounded(domain.result_features(results_like(spark, sf_dir), ["part"]))


@query("dnf_category", "WITH " + RESULTS_SQL + """ SELECT dnf_category, finish_status, count(*) AS n, CAST(sum(position_gain) AS BIGINT) AS gained
 FROM rc GROUP BY ALL""")
def dnf_category(spark, sf_dir):
    return (domain.result_columns(results_like(spark, sf_dir)).groupBy("dnf_category", "finish_status")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("position_gain").alias("gained")))
