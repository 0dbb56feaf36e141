"""Queries over undercuts, overcuts and rank lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.operators import strategy as ops
from paceline.plans.q_laps import PITS_SQL, runs, with_runs
from paceline.plans.registry import query
from paceline.plans.views import laps, staged, with_laps
from paceline.roles import Roles

ROLES = Roles()

# Gain of the fast car over the slow one between two stops, 0 at least.
_GAIN = """CASE WHEN p2 - p1 - 1 >= 2 THEN greatest(0, ((SELECT avg(measure) FROM laps l WHERE l.entity = c.slow AND l.seq > p1 AND l.seq < p2)
  - (SELECT avg(measure) FROM laps l WHERE l.entity = c.fast AND l.seq > p1 AND l.seq < p2)) * (p2 - p1 - 1))
  ELSE greatest(0, ms.med - mf.med) END"""

UNDERCUT_SQL = PITS_SQL + """
, uc AS (SELECT p.entity AS fast, b.entity AS slow, p.pit_lap AS p1,
    (SELECT min(q.pit_lap) FROM pits q WHERE q.entity = b.entity AND q.pit_lap > p.pit_lap AND q.pit_lap <= p.pit_lap + 4) AS p2
   FROM pits p JOIN laps a ON a.entity = p.entity AND a.seq = p.pit_lap - 1
   JOIN laps b ON b.seq = a.seq AND b.rank BETWEEN a.rank - 6 AND a.rank - 1 AND b.entity <> a.entity WHERE a.rank > 1),
 med AS (SELECT entity, median(measure) AS med FROM laps GROUP BY entity),
 undercuts AS (SELECT fast AS driver, slow AS target_driver, p2 AS lap, gain FROM (SELECT c.*, """ + _GAIN + """ AS gain
   FROM (SELECT * FROM uc WHERE p2 IS NOT NULL) c JOIN laps fa ON fa.entity = c.fast AND fa.seq = c.p2 + 1
   JOIN laps sa ON sa.entity = c.slow AND sa.seq = c.p2 + 1 JOIN med mf ON mf.entity = c.fast JOIN med ms ON ms.entity = c.slow
   WHERE fa.rank < sa.rank) WHERE gain >= 0.3)"""

OVERCUT_SQL = PITS_SQL + """
, oc AS (SELECT b.entity AS fast, p.entity AS slow, p.pit_lap AS p1,
    (SELECT min(q.pit_lap) FROM pits q WHERE q.entity = b.entity AND q.pit_lap >= p.pit_lap) AS p2
   FROM pits p JOIN laps a ON a.entity = p.entity AND a.seq = p.pit_lap - 1
   JOIN laps b ON b.seq = a.seq AND b.rank BETWEEN a.rank + 1 AND a.rank + 6 AND b.entity <> a.entity),
 med AS (SELECT entity, median(measure) AS med FROM laps GROUP BY entity),
 overcuts AS (SELECT fast AS driver, slow AS target_driver, p2 AS lap, gain FROM (SELECT c.*, """ + _GAIN + """ AS gain
   FROM (SELECT * FROM oc WHERE p2 > p1 + 4) c JOIN laps fa ON fa.entity = c.fast AND fa.seq = c.p2 + 1
   JOIN laps sa ON sa.entity = c.slow AND sa.seq = c.p2 + 1 JOIN med mf ON mf.entity = c.fast JOIN med ms ON ms.entity = c.slow
   WHERE fa.rank < sa.rank) WHERE gain >= 0.3)"""


def base(spark, sf_dir):
    """The wide lap table both detectors start from, kept as a table."""
    return staged(spark, sf_dir, "strategy_base", lambda s, d: ops.strategy_base(runs(s, d), ROLES))


def undercuts(spark, sf_dir):
    return ops.detect_undercuts(runs(spark, sf_dir), ROLES, base=base(spark, sf_dir))


def overcuts(spark, sf_dir):
    return ops.detect_overcuts(runs(spark, sf_dir), ROLES, base=base(spark, sf_dir))


@query("undercuts", with_runs(UNDERCUT_SQL + " SELECT driver, target_driver, lap, round(gain, 3) AS time_gained_seconds FROM undercuts"))
def undercut_query(spark, sf_dir):
    return undercuts(spark, sf_dir)


@query("overcuts", with_runs(OVERCUT_SQL + " SELECT driver, target_driver, lap, round(gain, 3) AS time_saved_seconds FROM overcuts"))
def overcut_query(spark, sf_dir):
    return overcuts(spark, sf_dir)


@query("rank_lookup", with_laps(""" SELECT a.entity, a.seq, b.rank FROM (SELECT entity, seq + 1 AS seq FROM laps WHERE category = 'error') a
 LEFT JOIN laps b USING (entity, seq)"""))
def rank_lookup(spark, sf_dir):
    lp = laps(spark, sf_dir)
    asked = lp.where(F.col("category") == "error").select("entity", (F.col("seq") + 1).alias("seq"))
    return ops.rank_at(lp, ROLES, asked)


@query("cars_ahead", with_laps(""" SELECT a.entity, a.seq, a.rank, b.entity AS ahead FROM laps a JOIN laps b ON b.seq = a.seq
 AND b.rank BETWEEN a.rank - 6 AND a.rank - 1 WHERE a.category = 'purchase' AND a.rank > 1"""))
def cars_ahead(spark, sf_dir):
    lp = laps(spark, sf_dir)
    return ops.cars_ahead(lp, ROLES, lp.where(F.col("category") == "purchase").select("entity", "seq"))


@query("car_at_rank", with_laps(""" SELECT a.seq, a.rank, b.entity FROM (SELECT DISTINCT seq, rank + 1 AS rank FROM laps) a
 LEFT JOIN laps b USING (seq, rank)"""))
def car_at_rank(spark, sf_dir):
    lp = laps(spark, sf_dir)
    return ops.car_at_rank(lp, ROLES, lp.select("seq", (F.col("rank") + 1).alias("rank")).distinct())
