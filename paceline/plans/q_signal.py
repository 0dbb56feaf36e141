"""Queries over sensor-channel operators; each user's events are one signal."""

from __future__ import annotations

from pyspark.sql import functions as F

from paceline.functions.columns import clock_seconds
from paceline.operators import signal as ops
from paceline.plans.q_domain import _filled_sql
from paceline.plans.registry import query, rounded
from paceline.plans.views import laps, with_laps

LENGTH, POINTS = 2_592_000.0, 25  # thirty days in seconds
START = 1_704_067_200             # 2024-01-01T00:00:00Z


def samples(spark, sf_dir):
    """entity, x (seconds into the month), two channels, one with gaps and one NULL for some users."""
    return laps(spark, sf_dir).select(
        "entity", F.col("seq").alias("pos"), (F.floor(clock_seconds(F.col("ts"))) - START).cast("double").alias("x"),
        F.when(F.col("k") % 5 != 0, F.col("measure")).alias("Speed"),
        F.when(F.col("entity") % 10 != 3, F.col("k").cast("double")).alias("Throttle"))


SAMPLES_SQL = f"""
, samples AS (SELECT entity, seq AS pos, CAST(floor(epoch(ts)) - {START} AS DOUBLE) AS x,
   CASE WHEN k % 5 <> 0 THEN measure END AS Speed, CASE WHEN entity % 10 <> 3 THEN CAST(k AS DOUBLE) END AS Throttle FROM laps)"""


def _linear_sql(c: str) -> str:
    return f"""coalesce(CASE WHEN b{c}.x IS NOT NULL AND f{c}.x IS NOT NULL THEN CASE WHEN f{c}.x > b{c}.x
      THEN b{c}.v + (f{c}.v - b{c}.v) * (g.x - b{c}.x) / (f{c}.x - b{c}.x) ELSE b{c}.v END END, b{c}.v, f{c}.v, 0)"""


RESAMPLE_SQL = SAMPLES_SQL + f"""
, grid AS (SELECT entity, i AS grid, i * {LENGTH / (POINTS - 1)!r} AS x FROM (SELECT DISTINCT entity FROM samples), range({POINTS}) t(i)),
 sp AS (SELECT entity, x, min(Speed) AS v FROM samples WHERE Speed IS NOT NULL GROUP BY entity, x),
 th AS (SELECT entity, x, min(Throttle) AS v FROM samples WHERE Throttle IS NOT NULL GROUP BY entity, x),
 resampled AS (SELECT g.entity, g.grid, g.x, {_linear_sql('s')} AS Speed, {_linear_sql('t')} AS Throttle FROM grid g
  ASOF LEFT JOIN sp bs ON bs.entity = g.entity AND bs.x <= g.x ASOF LEFT JOIN sp fs ON fs.entity = g.entity AND fs.x >= g.x
  ASOF LEFT JOIN th bt ON bt.entity = g.entity AND bt.x <= g.x ASOF LEFT JOIN th ft ON ft.entity = g.entity AND ft.x >= g.x)"""


@query("resample_linear", with_laps(RESAMPLE_SQL + """ SELECT entity, CAST(grid AS INTEGER) AS grid, round(x, 4) AS x,
  round(Speed, 6) AS Speed, round(Throttle, 6) AS Throttle FROM resampled"""))
def resample_linear(spark, sf_dir):
    out = ops.resample_linear(samples(spark, sf_dir), ["entity"], "x", ["Speed", "Throttle"], LENGTH, POINTS)
    return rounded(out.withColumn("x", F.round("x", 4)), "x")


@query("resample_laps", with_laps(RESAMPLE_SQL + """ SELECT entity, CAST(grid AS INTEGER) AS grid, round(Speed, 6) AS Speed FROM resampled"""))
def resample_laps(spark, sf_dir):
    src = samples(spark, sf_dir).select("x", "Speed", F.col("entity").alias("lap"))
    out = ops.resample_laps(src, [], "lap", "x", ["Speed"], LENGTH, POINTS)
    return rounded(out.select(F.col("lap").alias("entity"), F.posexplode("Speed_sync").alias("grid", "Speed")))


@query("resample_cubic")
def resample_cubic(spark, sf_dir):
    return rounded(ops.resample_cubic(samples(spark, sf_dir), ["entity"], "x", ["Speed", "Throttle"], LENGTH, POINTS))


@query("signal_delta", with_laps(RESAMPLE_SQL + """ SELECT round(max(a.Speed - b.Speed), 6) AS max_delta,
  round(min(a.Speed - b.Speed), 6) AS min_delta, round(avg(a.Speed - b.Speed), 6) AS mean_delta, count(*) AS points
  FROM resampled a JOIN resampled b ON a.grid = b.grid AND a.entity = 1 AND b.entity = 2"""))
def signal_delta(spark, sf_dir):
    grid = ops.resample_linear(samples(spark, sf_dir), ["entity"], "x", ["Speed"], LENGTH, POINTS)
    return rounded(ops.signal_delta(grid, "entity", 1, 2, "Speed"))


@query("axis_length", with_laps(SAMPLES_SQL + " SELECT entity % 10 AS race, max(x) AS track_length FROM samples GROUP BY 1"))
def axis_length(spark, sf_dir):
    src = samples(spark, sf_dir).withColumn("race", F.col("entity") % 10)
    return ops.axis_length(src, ["race"], "x")


@query("distance", with_laps(SAMPLES_SQL + """ SELECT entity, pos, round(sum(measure / 3.6 * (x - coalesce(px, 0)))
   OVER (PARTITION BY entity ORDER BY pos ROWS UNBOUNDED PRECEDING), 3) AS Distance FROM (
   SELECT entity, seq AS pos, measure, epoch(ts) - 1704067200 AS x, lag(epoch(ts) - 1704067200) OVER (PARTITION BY entity ORDER BY seq) AS px
   FROM laps)"""))
def distance(spark, sf_dir):
    src = laps(spark, sf_dir).select("entity", F.col("seq").alias("pos"), F.col("measure").alias("Speed"),
                                     (clock_seconds(F.col("ts")) - START).alias("Time_seconds"))
    return ops.distance(src, ["entity"], lane_seconds=86_400.0).select("entity", "pos", F.round("Distance", 3).alias("Distance"))


_FILLED = SAMPLES_SQL + ", filled AS (" + _filled_sql("samples", ["Speed"], "entity") + ")"


@query("median_filter", with_laps(_FILLED + """ SELECT entity, pos, round(list_sort(list_concat(w, list_resize([0.0::DOUBLE], 5 - len(w), 0.0)))[3], 6) AS Speed
  FROM (SELECT entity, pos, list(Speed) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS w FROM filled)"""))
def median_filter(spark, sf_dir):
    src = samples(spark, sf_dir).select("entity", "pos", "Speed")
    return rounded(ops.median_filter(src, ["entity"], "pos", ["Speed"]))


@query("gradient", with_laps(""" SELECT entity, pos, round(CASE WHEN p IS NULL THEN n - v WHEN n IS NULL THEN v - p ELSE (n - p) / 2 END, 6) AS v_derivative
  FROM (SELECT entity, seq AS pos, measure AS v, lag(measure) OVER w AS p, lead(measure) OVER w AS n FROM laps WINDOW w AS (PARTITION BY entity ORDER BY seq))"""))
def gradient(spark, sf_dir):
    src = laps(spark, sf_dir).select("entity", F.col("seq").alias("pos"), F.col("measure").alias("v"))
    return rounded(ops.derivative(src, ["entity"], "pos", "v", smooth=False).drop("v"))


def _savgol_sql(deriv: int, k: int = 11, order: int = 3) -> str:
    """The smoothing as a weighted sum of window values; the weights are those of the operator."""
    w = ops._fit_weights(k, order, deriv, 1.0)
    h = k // 2

    def dot(row, shift):
        return " + ".join(f"({float(c)!r}) * l[{shift} + {i}]" for i, c in enumerate(row))
    parts = [f"WHEN pos = {i + 1} THEN {dot(w[i], '1')}" for i in range(h)]
    parts += [f"WHEN pos = n - {h} + {i + 1} THEN {dot(w[k - h + i], f'n - {k - 1}')}" for i in range(h)]
    return "CASE " + " ".join(parts) + f" ELSE {dot(w[h], f'pos - {h}')} END"


_LISTED = """, listed AS (SELECT s.entity, s.pos, l, len(l) AS n FROM {src} s JOIN (SELECT entity, list({c} ORDER BY pos) AS l FROM {src}
   GROUP BY entity) USING (entity) WHERE len(l) >= 11)"""


@query("savgol", with_laps(_FILLED + _LISTED.format(src="filled", c="Speed") + f" SELECT entity, pos, round({_savgol_sql(0)}, 6) AS Speed FROM listed"))
def savgol(spark, sf_dir):
    src = samples(spark, sf_dir).select("entity", "pos", "Speed")
    return rounded(ops.savgol(src, ["entity"], "pos", "Speed"))


@query("savgol_derivative", with_laps(_FILLED + _LISTED.format(src="filled", c="Speed")
       + f" SELECT entity, pos, round({_savgol_sql(1)}, 6) AS Speed_derivative FROM listed"))
def savgol_derivative(spark, sf_dir):
    from paceline.operators.ordered import fill_gaps
    src = fill_gaps(samples(spark, sf_dir).select("entity", "pos", "Speed"), ["entity"], "pos", ["Speed"])
    return rounded(ops.derivative(src, ["entity"], "pos", "Speed").drop("Speed"))


_MASK = """, g AS (SELECT entity, seq AS pos, measure AS raw, {flag} AS o FROM laps JOIN m USING (entity)),
  h AS (SELECT *, CASE WHEN NOT o THEN raw END AS v FROM g), f AS (""" + _filled_sql("h", ["v"], "entity") + """)
  SELECT entity, pos, o AS is_outlier, round(v, 6) AS v FROM f"""


@query("zscore_outliers", with_laps(", m AS (SELECT entity, avg(measure) AS mu, stddev_pop(measure) AS sd FROM laps GROUP BY entity)"
       + _MASK.format(flag="abs(measure - mu) / sd > 3")))
def zscore_outliers(spark, sf_dir):
    src = laps(spark, sf_dir).select("entity", F.col("seq").alias("pos"), F.col("measure").alias("v"))
    return rounded(ops.remove_outliers(src, ["entity"], "pos", "v", method="zscore"))


@query("mad_outliers", with_laps(""", md AS (SELECT entity, median(measure) AS med FROM laps GROUP BY entity),
  m AS (SELECT entity, any_value(med) AS med, median(abs(measure - med)) AS mad FROM laps JOIN md USING (entity) GROUP BY entity)"""
       + _MASK.format(flag="0.6745 * abs(measure - med) / mad > 3")))
def mad_outliers(spark, sf_dir):
    src = laps(spark, sf_dir).select("entity", F.col("seq").alias("pos"), F.col("measure").alias("v"))
    return rounded(ops.remove_outliers(src, ["entity"], "pos", "v"))


@query("channel_pipeline", with_laps(""", md AS (SELECT entity, median(measure) AS med FROM laps GROUP BY entity),
  m AS (SELECT entity, any_value(med) AS med, median(abs(measure - med)) AS mad FROM laps JOIN md USING (entity) GROUP BY entity),
  g AS (SELECT entity, seq AS pos, measure AS raw, 0.6745 * abs(measure - med) / mad > 3 AS o FROM laps JOIN m USING (entity)),
  h AS (SELECT *, CASE WHEN NOT o THEN raw END AS v FROM g), f AS (""" + _filled_sql("h", ["v"], "entity") + """),
  med5 AS (SELECT entity, pos, list_sort(list_concat(w, list_resize([0.0::DOUBLE], 5 - len(w), 0.0)))[3] AS v
   FROM (SELECT entity, pos, list(v) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS w FROM f))"""
       + _LISTED.format(src="med5", c="v") + f""" SELECT entity, pos, round(l[pos], 6) AS Speed, round({_savgol_sql(1)}, 6) AS Speed_derivative FROM listed"""))
def channel_pipeline(spark, sf_dir):
    src = laps(spark, sf_dir).select("entity", F.col("seq").alias("pos"), F.col("measure").alias("Speed"))
    return rounded(ops.channel_pipeline(src, ["entity"], "pos", ["Speed"], derivatives=True))


