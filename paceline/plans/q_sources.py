"""Queries over scans, sinks, normalisers, calendars, inventories, the run log and ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from paceline.functions.columns import clock_seconds
from paceline.operators import runlog
from paceline.operators.analysis import run_analysis
from paceline.plans.q_laps import named
from paceline.plans.registry import query, rounded
from paceline.plans.views import laps, table, with_laps
from paceline.roles import Roles
from paceline.session import shared_dir
from paceline.sources import calendar, tables
from paceline.streaming import ingest


def _path(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("normalize_laps", with_laps(""" SELECT code AS Driver, CAST(entity AS VARCHAR) AS DriverNumber, CAST(seq AS INTEGER) AS LapNumber, round(measure, 4) AS LapTime_seconds,
 CASE WHEN category = 'signup' THEN round(measure / 3, 4) END AS Sector1Time_seconds, category AS Compound FROM laps"""))
def normalize_laps(spark, sf_dir):
    whole = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.round("measure", 4).cast("decimal(18,6)"))
    third = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.round(F.col("measure") / 3, 4).cast("decimal(18,6)"))
    raw = laps(spark, sf_dir).select(
        F.col("code").alias("Driver"), F.col("entity").cast("string").alias("DriverNumber"), F.col("seq").cast("int").alias("LapNumber"),
        whole.alias("LapTime"), F.when(F.col("category") == "signup", third).alias("Sector1Time"), F.col("category").alias("Compound"), "k")
    return tables.normalize_laps(raw)


@query("normalize_telemetry", with_laps(""" SELECT entity, t AS Time_seconds, measure AS Speed, round(sum(measure / 3.6 * (t - coalesce(pt, 0))) OVER (PARTITION BY entity ORDER BY t, seq ROWS UNBOUNDED PRECEDING), 3) AS Distance
 FROM (SELECT *, lag(t) OVER (PARTITION BY entity ORDER BY t) AS pt FROM (SELECT entity, seq, measure, floor(epoch(ts)) - 1704067200 AS t FROM laps))"""))
def normalize_telemetry(spark, sf_dir):
    raw = laps(spark, sf_dir).select("entity", "seq", (F.floor(clock_seconds(F.col("ts"))) - 1_704_067_200).cast("double").alias("Time_seconds"),
                                     F.col("measure").alias("Speed"))
    return tables.normalize_telemetry(raw, ["entity"], ties=["seq"]).withColumn("Distance", F.round("Distance", 3))


@query("normalize_control", with_laps(" SELECT entity, seq, 'M' || k AS Message, round(measure, 2) AS Time_seconds FROM laps"))
def normalize_control(spark, sf_dir):
    raw = laps(spark, sf_dir).select("entity", "seq", F.concat(F.lit("M"), F.col("k")).alias("Message"),
                                     F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.round("measure", 2).cast("decimal(18,6)")).alias("Time"))
    return tables.normalize_control(raw).drop("Time")


@query("normalize_weather", "SELECT CAST(epoch(o_orderdate) AS DOUBLE) AS Time_seconds, o_totalprice AS AirTemp, o_orderstatus = 'P' AS Rainfall FROM orders")
def normalize_weather(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("Time"), F.col("o_totalprice").alias("AirTemp"),
                                                (F.col("o_orderstatus") == "P").alias("Rainfall"), "o_custkey")
    return tables.normalize_weather(raw)


@query("normalize_results", "SELECT CAST(c_custkey AS VARCHAR) AS DriverNumber, c_name AS FullName, c_mktsegment AS TeamName, c_acctbal AS Points FROM customer")
def normalize_results(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("DriverNumber"), F.col("c_name").alias("FullName"),
                                                  F.col("c_mktsegment").alias("TeamName"), F.col("c_acctbal").alias("Points"), "c_nationkey")
    return tables.normalize_results(raw)


@query("driver_codes", """SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, coalesce(CASE WHEN s_acctbal > 2000 THEN s_name END, CAST(l_suppkey AS VARCHAR)) AS Driver
 FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey""")
def driver_codes(spark, sf_dir):
    sup = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 2000).select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return tables.driver_codes(li, sup, [], "l_suppkey", "s_name")


_CAL_SQL = """WITH cal AS (SELECT year(o_orderdate) AS year, CAST(month(o_orderdate) AS INTEGER) AS RoundNumber, 'Race ' || month(o_orderdate) AS EventName, any_value('C' || month(o_orderdate)) AS Country,
 'L' || month(o_orderdate) AS Location, CASE WHEN month(o_orderdate) = 2 THEN 'Testing' ELSE 'conventional' END AS EventFormat, min(o_orderdate) AS EventDate, max(o_orderdate) AS Session5DateUtc FROM orders GROUP BY ALL)"""


def _calendar(spark, sf_dir):
    m = F.month("o_orderdate")
    return (table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), m.alias("RoundNumber"))
            .agg(F.min("o_orderdate").alias("EventDate"), F.max("o_orderdate").alias("Session5DateUtc"))
            .select("year", "RoundNumber", F.concat(F.lit("Race "), F.col("RoundNumber")).alias("EventName"),
                    F.concat(F.lit("C"), F.col("RoundNumber")).alias("Country"), F.concat(F.lit("L"), F.col("RoundNumber")).alias("Location"),
                    F.when(F.col("RoundNumber") == 2, "Testing").otherwise("conventional").alias("EventFormat"), "EventDate", "Session5DateUtc"))


@query("season_calendar", _CAL_SQL + " SELECT * FROM cal WHERE lower(EventFormat) <> 'testing'")
def season_calendar(spark, sf_dir):
    return calendar.season(_calendar(spark, sf_dir))


@query("event_info", _CAL_SQL + " SELECT year, RoundNumber AS round_number, EventName AS event_name, Location AS location, Country AS country FROM cal")
def event_info(spark, sf_dir):
    return tables.event_info(_calendar(spark, sf_dir))


@query("calendar_next", _CAL_SQL + """ SELECT RoundNumber AS round_number, EventName AS event_name, Country AS country, Location AS location, Session5DateUtc AS race_date, EventDate AS event_date
 FROM cal WHERE Session5DateUtc > TIMESTAMP '1998-06-15 00:00:00' ORDER BY Session5DateUtc, RoundNumber LIMIT 1""")
def calendar_next(spark, sf_dir):
    return calendar.next_race(_calendar(spark, sf_dir), "1998-06-15 00:00:00")


@query("calendar_next_per_season", _CAL_SQL + """ SELECT year, RoundNumber, EventName, Session5DateUtc FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY Session5DateUtc, RoundNumber) AS rn
 FROM cal WHERE Session5DateUtc > TIMESTAMP '1998-06-15 00:00:00') WHERE rn = 1""")
def calendar_next_per_season(spark, sf_dir):
    out = calendar.next_race_per_season(_calendar(spark, sf_dir), "1998-06-15 00:00:00")
    return out.select("year", "RoundNumber", "EventName", "Session5DateUtc")


@query("inventory", """WITH o AS (SELECT year(o_orderdate) AS year, month(o_orderdate) AS round, o_custkey FROM orders),
 d AS (SELECT year, round, o_custkey, row_number() OVER (PARTITION BY year, round ORDER BY o_custkey) AS rn FROM (SELECT DISTINCT * FROM o))
 SELECT year, round, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_entities, 3 AS n_columns,
  (SELECT string_agg(CAST(o_custkey AS VARCHAR), ', ' ORDER BY CAST(o_custkey AS VARCHAR)) FROM d WHERE d.year = o.year AND d.round = o.round AND rn <= 5) AS sample FROM o GROUP BY year, round""")
def inventory(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("round"), "o_custkey")
    return tables.inventory(o, ["year", "round"], "o_custkey")


_LANDED_SQL = """, landed AS (SELECT code AS Driver, CAST(seq AS INTEGER) AS LapNumber, CASE WHEN k % 9 <> 0 THEN measure END AS LapTime_seconds, category AS Compound,
 CAST(2023 + entity % 2 AS INTEGER) AS year, CAST(1 + seq % 4 AS INTEGER) AS round FROM laps)"""


def _landed(spark, sf_dir):
    """Laps as files of the feed: partitioned by race, NaN where a time is missing."""
    return laps(spark, sf_dir).select(
        F.col("code").alias("Driver"), F.col("seq").cast("int").alias("LapNumber"), F.when(F.col("k") % 9 != 0, F.col("measure")).otherwise(float("nan")).alias("LapTime_seconds"),
        F.col("category").alias("Compound"), (F.col("entity") % 2 + 2023).cast("int").alias("year"), (F.col("seq") % 4 + 1).cast("int").alias("round"))


@query("scan_filtered", with_laps(_LANDED_SQL + """ SELECT Driver, LapNumber, round(LapTime_seconds, 6) AS LapTime_seconds, Compound, year, round FROM landed
 WHERE LapTime_seconds > 60 AND year = 2024 AND Compound IN ('click', 'view')"""))
def scan_filtered(spark, sf_dir):
    root = _path(spark, "landed")
    tables.write_table(_landed(spark, sf_dir), f"{root}/laps")
    out = tables.read_table(spark, root, "laps", [("LapTime_seconds", ">", 60.0), ("year", "=", 2024), ("Compound", "in", ["click", "view"])])
    return rounded(out.select("Driver", "LapNumber", "LapTime_seconds", "Compound", "year", "round"))


@query("process_races", with_laps(_LANDED_SQL + """ SELECT 'laps' AS name, year, round, count(*) AS n_rows, count(LapTime_seconds) AS n_known, round(sum(LapTime_seconds), 4) AS total FROM landed
 WHERE (year, round) IN ((2023, 1), (2024, 3), (1996, 2)) GROUP BY ALL UNION ALL
 SELECT 'weather', CAST(year(o_orderdate) AS INTEGER), CAST(month(o_orderdate) AS INTEGER), count(*), count(o_totalprice), round(sum(o_totalprice), 4) FROM orders
 WHERE (year(o_orderdate), month(o_orderdate)) IN ((2023, 1), (2024, 3), (1996, 2)) GROUP BY ALL"""))
def process_races(spark, sf_dir):
    """Two tables of three races, normalised and written in one call, read back from their folders."""
    o = table(spark, sf_dir, "orders")
    weather = o.select((F.unix_timestamp("o_orderdate")).cast("double").alias("Time_seconds"), F.col("o_totalprice").alias("AirTemp"),
                       F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("round"))
    target = _path(spark, "processed")
    written = ingest.process_races({"laps": _landed(spark, sf_dir), "weather": weather}, [(2023, 1), (2024, 3), (1996, 2)], {"laps": tables.nan_to_null}, target)

    def totals(name, value):
        known = F.col(value)
        return (spark.read.schema(f"{value} double, year int, round int").parquet(written[name]).groupBy("year", "round")
                .agg(F.count(F.lit(1)).alias("n_rows"), F.count(known).alias("n_known"), F.round(F.sum(known), 4).alias("total"))
                .select(F.lit(name).alias("name"), "year", "round", "n_rows", "n_known", "total"))
    return totals("laps", "LapTime_seconds").unionByName(totals("weather", "AirTemp"))


@query("calendar_saved", _CAL_SQL + """ SELECT CAST(year AS INTEGER) AS year, RoundNumber, CASE WHEN year = 1996 THEN 'Moved ' || RoundNumber ELSE EventName END AS EventName, Country FROM cal
 WHERE year <> 1996 OR RoundNumber > 3""")
def calendar_saved(spark, sf_dir):
    """All seasons are saved, then one of them again: the others stay as they were."""
    path, cal = _path(spark, "calendar"), _calendar(spark, sf_dir)
    calendar.save(cal, path)
    calendar.save(cal.where("year = 1996 AND RoundNumber > 3").withColumn("EventName", F.concat(F.lit("Moved "), F.col("RoundNumber"))), path)
    return spark.read.schema("year int, RoundNumber int, EventName string, Country string").parquet(path)


@query("head_rows", with_laps(" SELECT entity, seq, measure FROM laps ORDER BY measure DESC, entity, seq LIMIT 5"))
def head_rows(spark, sf_dir):
    return tables.head(laps(spark, sf_dir).orderBy(F.col("measure").desc(), "entity", "seq"), ["entity", "seq", "measure"])


@query("file_inventory")
def file_inventory(spark, sf_dir):
    return tables.file_inventory(table(spark, sf_dir, "lineitem"))


@query("file_per_entity", """SELECT r_regionkey AS key, r_name AS name, 'region' AS Driver FROM region UNION ALL SELECT n_nationkey, n_name, 'nation' FROM nation""")
def file_per_entity(spark, sf_dir):
    parts = [tables.read_file_per_entity(spark, f"{sf_dir}/{n}.parquet").select(F.col(f"{n[0]}_{n}key").alias("key"), F.col(f"{n[0]}_name").alias("name"), "Driver")
             for n in ("region", "nation")]
    return parts[0].unionByName(parts[1])


@query("partitioned_roundtrip", "SELECT o_orderkey, o_totalprice, year(o_orderdate) AS year, month(o_orderdate) AS round FROM orders WHERE year(o_orderdate) = 1997 AND o_totalprice > 1000")
def partitioned_roundtrip(spark, sf_dir):
    path = _path(spark, "orders")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("round"))
    tables.write_table(o, path)
    schema = "o_orderkey bigint, o_totalprice double, year int, round int"
    return spark.read.schema(schema).parquet(path).where((F.col("year") == 1997) & (F.col("o_totalprice") > 1000))


@query("json_roundtrip", "SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_nationkey > 5 THEN c_mktsegment END AS c_mktsegment FROM customer")
def json_roundtrip(spark, sf_dir):
    path = _path(spark, "customer")
    c = table(spark, sf_dir, "customer")
    tables.write_json(c.select("c_custkey", "c_name", "c_acctbal", F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment")).alias("c_mktsegment")), path)
    return tables.read_json(spark, path, "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string")


@query("csv_artifact", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def csv_artifact(spark, sf_dir):
    path = tables.write_artifact(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"), "supplier.csv", _path(spark, "artifacts"))
    return spark.read.schema("s_suppkey bigint, s_name string, s_acctbal double").option("header", True).csv(path)


_LOG_SQL = """WITH m AS (SELECT CAST(user_id AS VARCHAR) AS run_id, count(*) AS n, avg(value) AS mean_value, CASE WHEN user_id % 3 <> 0 THEN max(value) END AS max_value FROM events GROUP BY user_id),
 log AS (SELECT run_id, 'n' AS name, CAST(n AS DOUBLE) AS value FROM m UNION ALL SELECT run_id, 'mean_value', mean_value FROM m UNION ALL SELECT run_id, 'max_value', max_value FROM m WHERE max_value IS NOT NULL)"""


def _log(spark, sf_dir):
    m = (table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"), F.max("value").alias("max_value"))
         .withColumn("max_value", F.when(F.col("user_id") % 3 != 0, F.col("max_value"))).withColumn("note", F.lit("text")))
    path = _path(spark, "runlog")
    runlog.append(runlog.run_metrics(m, "user_id", "pipeline", {"origin": "events"}), path)
    return spark.read.schema("run_id string, name string, value double, tags map<string,string>, kind string").parquet(path)


@query("run_log", _LOG_SQL + " SELECT run_id, 'pipeline' AS kind, name, round(value, 6) AS value FROM log")
def run_log(spark, sf_dir):
    return rounded(_log(spark, sf_dir).select("run_id", "kind", "name", "value"))


@query("run_compare", _LOG_SQL + """ SELECT run_id, round(max(value) FILTER (name = 'mean_value'), 6) AS mean_value, max(value) FILTER (name = 'max_value') AS max_value FROM log
 GROUP BY run_id ORDER BY run_id DESC LIMIT 10""")
def run_compare(spark, sf_dir):
    return rounded(runlog.compare_runs(_log(spark, sf_dir), ["mean_value", "max_value"]))


@query("best_run", _LOG_SQL + " SELECT run_id, round(value, 6) AS mean_value FROM log WHERE name = 'mean_value' ORDER BY value DESC, run_id DESC LIMIT 1")
def best_run(spark, sf_dir):
    return rounded(runlog.best_run(_log(spark, sf_dir), "mean_value"))


@query("stream_ingest", "SELECT event_id, user_id, event_type, value, year(ts) AS year, month(ts) AS round FROM events")
def stream_ingest(spark, sf_dir):
    """The event file is streamed in twice; the second run finds nothing new."""
    src, target, check = f"{sf_dir}/events*.parquet", _path(spark, "bronze"), _path(spark, "checkpoint")
    schema = table(spark, sf_dir, "events").schema

    def normalize(df):
        return df.select("event_id", "user_id", "event_type", "value", F.year("ts").alias("year"), F.month("ts").alias("round"))

    for _ in range(2):
        ingest.ingest(ingest.land_stream(spark, src, schema), target, check, ["event_id"], normalize=normalize).awaitTermination()
    return spark.read.schema("event_id bigint, user_id bigint, event_type string, value double, year int, round int").parquet(target)


@query("analysis_quality")
def analysis_quality(spark, sf_dir):
    src = named(spark, sf_dir).withColumnRenamed("rank", "Position")
    return run_analysis(src, Roles(rank="Position"))["quality_scores"]
