"""Queries over lap features, filters and pit laps."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.operators import laps as ops
from paceline.plans.registry import query, rounded
from paceline.plans.views import LAPS_SQL, laps, staged, with_laps
from paceline.roles import Roles

ROLES = Roles()

# Every 'view' lap loses its age, so that gaps have to be bridged.
GAPPY_SQL = """
gappy AS (SELECT entity, seq, category, measure, rank, CASE WHEN category <> 'view' THEN age END AS age FROM laps),
runs AS (SELECT *, CAST(1 + sum(CASE WHEN f < pf THEN 1 ELSE 0 END) OVER (PARTITION BY entity ORDER BY seq
            ROWS UNBOUNDED PRECEDING) AS INTEGER) AS run
         FROM (SELECT *, lag(f) OVER (PARTITION BY entity ORDER BY seq) AS pf
               FROM (SELECT *, last_value(age IGNORE NULLS) OVER (PARTITION BY entity ORDER BY seq
                     ROWS UNBOUNDED PRECEDING) AS f FROM gappy)))
"""


def gappy(spark, sf_dir):
    return laps(spark, sf_dir).select(
        "entity", "seq", "category", "measure", "rank",
        F.when(F.col("category") != "view", F.col("age")).alias("age"))


def runs(spark, sf_dir):
    """Laps with their run number, kept as a table for the operators that start from runs."""
    return staged(spark, sf_dir, "runs", lambda s, d: ops.detect_stints(gappy(s, d), ROLES))


def with_runs(sql: str) -> str:
    return f"WITH {LAPS_SQL}, {GAPPY_SQL} {sql}"


@query("stints", with_runs("SELECT entity, seq, category, measure, rank, age, run FROM runs"))
def stints(spark, sf_dir):
    return ops.detect_stints(gappy(spark, sf_dir), ROLES)


@query("drop_non_positive", "SELECT l_orderkey, l_partkey, l_discount FROM lineitem WHERE l_discount > 0")
def drop_non_positive(spark, sf_dir):
    from paceline.plans.views import table
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_discount")
    return ops.drop_non_positive(li, "l_discount")


@query("zero_count", """SELECT count(*) FILTER (l_discount = 0) AS zero_laps,
 count(*) FILTER (l_discount > 0) AS kept_laps FROM lineitem""")
def zero_count(spark, sf_dir):
    from paceline.plans.views import table
    return ops.zero_count(table(spark, sf_dir, "lineitem"), "l_discount")


@query("entity_filter", with_laps("SELECT entity, seq, measure FROM laps WHERE entity = 7"))
def entity_filter(spark, sf_dir):
    return ops.for_entity(laps(spark, sf_dir), ROLES, 7).select("entity", "seq", "measure")


@query("warmup_skip", with_runs("""SELECT entity, run, seq FROM (SELECT *, min(seq) OVER (PARTITION BY entity, run) AS s
 FROM runs) WHERE seq >= s + 3"""))
def warmup_skip(spark, sf_dir):
    return ops.warmup_skip(runs(spark, sf_dir).select("entity", "run", "seq"), ROLES, 3)


@query("relative_pace", with_laps("""
 , top AS (SELECT seq, median(measure) AS ref FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY measure) AS rn
     FROM laps) WHERE rn <= 3 GROUP BY seq)
 SELECT entity, seq, round(measure - ref, 6) AS relative_pace FROM laps JOIN top USING (seq)"""))
def relative_pace(spark, sf_dir):
    out = ops.relative_pace(laps(spark, sf_dir).select("entity", "seq", "measure"), ROLES)
    return rounded(out.drop("measure"))


@query("fuel_corrected", with_runs("""
 SELECT entity, seq, run, lap_position, round(measure - 0.065 * lap_position, 6) AS fuel_corrected FROM
 (SELECT *, row_number() OVER (PARTITION BY entity, run ORDER BY seq) - 1 AS lap_position FROM runs)"""))
def fuel_corrected(spark, sf_dir):
    src = runs(spark, sf_dir).select("entity", "seq", "run", "measure")
    return rounded(ops.fuel_corrected(src, ROLES).drop("measure"))


@query("run_delta", with_runs("""
 SELECT entity, seq, run, round(measure - median(measure) OVER (PARTITION BY entity, run), 6) AS lap_delta FROM runs"""))
def run_delta(spark, sf_dir):
    src = runs(spark, sf_dir).select("entity", "seq", "run", "measure")
    return rounded(ops.run_delta(src, ROLES, "measure").drop("measure"))


@query("entity_delta", with_laps("""
 SELECT entity, seq, round(measure - median(measure) OVER (PARTITION BY entity), 6) AS lap_delta FROM laps"""))
def entity_delta(spark, sf_dir):
    src = laps(spark, sf_dir).select("entity", "seq", "measure")
    return rounded(ops.entity_delta(src, ROLES).drop("measure"))


@query("age_normalized", with_runs("""
 SELECT entity, seq, run, round(CASE WHEN mx > 0 THEN age / mx ELSE 0 END, 6) AS age_normalized FROM
 (SELECT *, max(age) OVER (PARTITION BY entity, run) AS mx FROM runs)"""))
def age_normalized(spark, sf_dir):
    src = runs(spark, sf_dir).select("entity", "seq", "run", "age")
    return rounded(ops.age_normalized(src, ROLES).drop("age"))


_ORDINAL = """CASE upper(category) WHEN 'SOFT' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HARD' THEN 3 WHEN 'INTERMEDIATE' THEN 4
 WHEN 'WET' THEN 5 ELSE 2 END"""

FEATURES_SQL = f"""
, named AS (SELECT *, CASE category WHEN 'click' THEN 'SOFT' WHEN 'signup' THEN 'HARD' WHEN 'error' THEN 'WET'
     WHEN 'view' THEN NULL ELSE 'MEDIUM' END AS tyre FROM runs),
 corrected AS (SELECT *, measure - 0.065 * (row_number() OVER (PARTITION BY entity, run ORDER BY seq) - 1) AS fuel_corrected
     FROM named),
 top AS (SELECT seq, median(measure) AS ref FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY measure) AS rn
     FROM laps) WHERE rn <= 3 GROUP BY seq),
 features AS (SELECT entity, seq, tyre AS category, measure, rank, age, run,
   CAST(CASE tyre WHEN 'SOFT' THEN 1 WHEN 'HARD' THEN 3 WHEN 'WET' THEN 5 ELSE 2 END AS DOUBLE) AS compound_ordinal,
   fuel_corrected, CASE WHEN max(age) OVER w > 0 THEN age / max(age) OVER w ELSE 0 END AS age_normalized,
   fuel_corrected - median(fuel_corrected) OVER w AS lap_delta, measure - ref AS relative_pace
   FROM corrected JOIN top USING (seq) WINDOW w AS (PARTITION BY entity, run))"""


def named(spark, sf_dir):
    tyre = (F.when(F.col("category") == "click", "SOFT").when(F.col("category") == "signup", "HARD")
            .when(F.col("category") == "error", "WET").when(F.col("category") == "view", F.lit(None))
            .otherwise("MEDIUM"))
    return gappy(spark, sf_dir).withColumn("category", tyre)


def features(spark, sf_dir):
    """Laps with all features, kept as a table."""
    return staged(spark, sf_dir, "features", lambda s, d: ops.lap_features(named(s, d), ROLES))


@query("lap_features", with_runs(FEATURES_SQL + """ SELECT entity, seq, category, rank, age, run, compound_ordinal, measure,
 round(fuel_corrected, 6) AS fuel_corrected, round(age_normalized, 6) AS age_normalized,
 round(lap_delta, 6) AS lap_delta, round(relative_pace, 6) AS relative_pace FROM features"""))
def lap_features(spark, sf_dir):
    return rounded(ops.lap_features(named(spark, sf_dir), ROLES), "measure")


# Every fifth lap is missing from the table.
_GAPS_SQL = f"WITH {LAPS_SQL.replace('laps AS (', 'every_lap AS (')}, laps AS (SELECT * FROM every_lap WHERE seq % 5 <> 0), {GAPPY_SQL} "


@query("lap_features_gaps", _GAPS_SQL + FEATURES_SQL + """ SELECT entity, seq, category, rank, age, run, compound_ordinal, measure,
 round(fuel_corrected, 6) AS fuel_corrected, round(age_normalized, 6) AS age_normalized,
 round(lap_delta, 6) AS lap_delta, round(relative_pace, 6) AS relative_pace FROM features""")
def lap_features_gaps(spark, sf_dir):
    return rounded(ops.lap_features(named(spark, sf_dir).where("seq % 5 <> 0"), ROLES), "measure")


@query("fuel_corrected_gaps", _GAPS_SQL + """ SELECT entity, seq, run, p AS lap_position, round(measure - 0.065 * p, 6) AS fuel_corrected FROM
 (SELECT *, row_number() OVER (PARTITION BY entity, run ORDER BY seq) - 1 AS p FROM runs)""")
def fuel_corrected_gaps(spark, sf_dir):
    kept = ops.detect_stints(gappy(spark, sf_dir).where("seq % 5 <> 0"), ROLES)
    return rounded(ops.fuel_corrected(kept.select("entity", "seq", "run", "measure"), ROLES).drop("measure"))


@query("structural_filter", with_laps("""
 SELECT entity, seq, measure, measure > 1.5 * median(measure) OVER (PARTITION BY entity) AS is_structural FROM laps"""))
def structural_filter(spark, sf_dir):
    return ops.structural_filter(laps(spark, sf_dir).select("entity", "seq", "measure"), ROLES)


@query("structural_split_counts", with_laps("""
 SELECT CAST(count(*) FILTER (NOT s) AS BIGINT) AS clean, CAST(count(*) FILTER (s) AS BIGINT) AS removed FROM
 (SELECT measure > 1.5 * (SELECT median(measure) FROM laps) AS s FROM laps)"""))
def structural_split_counts(spark, sf_dir):
    flagged = ops.structural_filter(laps(spark, sf_dir).select("entity", "seq", "measure"), ROLES, grouped=False)
    return flagged.agg(F.count_if(~F.col("is_structural")).alias("clean"),
                       F.count_if("is_structural").alias("removed"))


PITS_SQL = """
, pits AS (SELECT entity, seq AS pit_lap FROM (SELECT *, lag(run) OVER w AS prun, lag(age) OVER w AS page FROM runs
   WINDOW w AS (PARTITION BY entity ORDER BY seq))
 WHERE run > prun AND NOT coalesce(age > page, false) AND NOT coalesce(age > 5, false) AND seq >= 8)"""


@query("pit_stops", with_runs(PITS_SQL + " SELECT entity, pit_lap FROM pits"))
def pit_stops(spark, sf_dir):
    return ops.pit_stops(runs(spark, sf_dir), ROLES)


@query("pit_laps_by_run", with_runs("""
 , r AS (SELECT entity, seq FROM (SELECT *, lag(run) OVER (PARTITION BY entity ORDER BY seq) AS p FROM runs) WHERE run > p)
 SELECT entity, seq FROM r UNION SELECT entity, seq - 1 FROM r WHERE seq > 1"""))
def pit_laps_by_run(spark, sf_dir):
    return ops.pit_laps(runs(spark, sf_dir), ROLES)


@query("pit_laps_by_time", with_laps("""SELECT DISTINCT entity, seq FROM laps WHERE
 (category = 'signup' AND k < 50) OR (category = 'error' AND k >= 50)"""))
def pit_laps_by_time(spark, sf_dir):
    timed = laps(spark, sf_dir).select(
        "entity", "seq", F.when((F.col("category") == "signup") & (F.col("k") < 50), F.col("measure")).alias("PitInTime_seconds"),
        F.when((F.col("category") == "error") & (F.col("k") >= 50), F.col("measure")).alias("PitOutTime_seconds"))
    return ops.pit_laps(timed, ROLES)


@query("label_sample", with_laps("""SELECT category, round(avg(measure), 6) AS mean, count(measure) AS count
 FROM laps GROUP BY category"""))
def label_sample(spark, sf_dir):
    return rounded(ops.label_sample(laps(spark, sf_dir), "category", "measure"))
