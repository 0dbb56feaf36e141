"""Race-control messages, weather and results turned into features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paceline.functions.columns import has_any, lenient_double, lookup, seconds
from paceline.operators.keyed import attach_stats
from paceline.operators.ordered import LANE, dense_position, drop_halo, fill_gaps, with_halo
from paceline.operators.stats import clean_number
from paceline.session import stage

# The keywords of the message feed, matched on upper(message) followed by upper(category).
VIRTUAL_WORDS = ["VIRTUAL SAFETY CAR", "VSC DEPLOYED", "SAFETY CAR (VSC)"]
SAFETY_WORDS = ["SAFETY CAR DEPLOYED", "SC DEPLOYED"]
FLAG_WORDS = ["YELLOW FLAG", "RED FLAG", "GREEN FLAG", "BLUE FLAG", "FLAG"]
PENALTY_WORDS = ["PENALTY", "PENALISED", "TIME PENALTY", "DRIVE THROUGH", "STOP AND GO"]
CRITICAL_WORDS = ["RED FLAG", "SAFETY CAR DEPLOYED", "RACE SUSPENDED"]
WARNING_WORDS = ["YELLOW FLAG", "VSC", "PENALTY", "INVESTIGATION"]
CATEGORY_CODES = {"SafetyCar": 1, "Flag": 2, "Drs": 3, "CarEvent": 4, "Other": 0, "UNKNOWN": 0}

# Words of a finishing status, in order of precedence.
DNF_WORDS = {
    "collision": ["COLLISION", "ACCIDENT"],
    "mechanical": ["MECHANICAL", "ENGINE", "GEARBOX"],
    "electrical": ["ELECTRICAL", "POWER"],
    "finished": ["FINISHED", "+"],
}

GAP_COLUMNS = ["AirTemp", "TrackTemp", "Humidity", "Pressure", "WindSpeed"]


def _column(df: DataFrame, name: str, default: Column) -> Column:
    return F.coalesce(F.col(name), default) if name in df.columns else default


def time_in_seconds(df: DataFrame) -> Column:
    """Time_seconds where the table has it, else Time converted, else 0."""
    types = dict(df.dtypes)
    for name in ("Time_seconds", "Time"):
        if name in types:
            return seconds(name, types[name])
    return F.lit(0.0)


def control_features(df: DataFrame) -> DataFrame:
    """Keyword flags, category code and severity of every message. Stateless, so it also streams."""
    kept = [c for c in df.columns if c.lower() not in ("time_seconds", "message")]
    base = df.select(*kept, time_in_seconds(df).alias("time_seconds"),
                     _column(df, "Category", F.lit("UNKNOWN")).alias("category_text"),
                     _column(df, "Message", F.lit("")).alias("message"))
    text = F.col("_text")
    virtual = has_any(text, VIRTUAL_WORDS)
    full = has_any(text, SAFETY_WORDS) & ~virtual
    return (base.withColumn("_text", F.upper(F.concat("message", "category_text")))
            .select(*kept, "time_seconds", "category_text", "message",
                    virtual.alias("is_virtual_safety_car"), full.alias("is_full_safety_car"),
                    (full | virtual).alias("is_safety_car"),
                    has_any(text, FLAG_WORDS).alias("is_flag"),
                    has_any(text, PENALTY_WORDS).alias("is_penalty"),
                    has_any(text, ["DRS"]).alias("is_drs"),
                    lookup("category_text", CATEGORY_CODES, F.lit(0)).alias("category_encoded"),
                    F.when(has_any(text, CRITICAL_WORDS), 2).when(has_any(text, WARNING_WORDS), 1)
                    .otherwise(0).alias("event_severity")))


def weather_features(df: DataFrame, part: Sequence[str], lane_seconds: float = 86_400.0,
                     lane_rows: int | None = None) -> DataFrame:
    """Gap-filled and standardised weather with trend and abrupt-change flag.

    Order is time inside ``part``. Numbering runs in time lanes, the filled table is written once
    because two statistics and the rows themselves are taken from it.
    """
    part = list(part)
    cols = [c for c in GAP_COLUMNS if c in df.columns]
    base = df.withColumn("_time", time_in_seconds(df))
    for c in cols:
        base = base.withColumn(c, clean_number(c))
    lane = F.floor(F.col("_time") / lane_seconds).cast("long")
    pos = dense_position(base, part, ["_time"], lane, "_pos")
    rain = F.col("Rainfall").cast("int") if "Rainfall" in df.columns else None
    filled = stage(fill_gaps(pos, part, "_pos", cols, lane_rows), "weather")

    near = with_halo(filled, "_pos", 1, 0, lane_rows)
    w = W.partitionBy(*part, LANE).orderBy("_pos")
    trend = (F.coalesce(F.col("TrackTemp") - F.lag("TrackTemp").over(w), F.lit(0.0))
             if "TrackTemp" in cols else F.lit(0.0))
    onset = (F.coalesce((rain - F.lag(rain).over(w) > 0).cast("int"), F.lit(0))
             if rain is not None else F.lit(0))
    out = drop_halo(near.withColumn("temp_trend", trend).withColumn("_onset", onset))
    aggs = [F.stddev_samp("temp_trend").alias("_tsd")]
    for c in ("AirTemp", "TrackTemp"):
        if c in cols:
            aggs += [F.avg(c).alias(f"_{c}_m"), F.stddev_samp(c).alias(f"_{c}_s")]
    out = attach_stats(out, part, aggs)

    def standard(c: str) -> Column:
        if c not in cols:
            return F.lit(None).cast("double")
        return (F.when(F.col(f"_{c}_s") > 0, (F.col(c) - F.col(f"_{c}_m")) / F.col(f"_{c}_s"))
                .otherwise(F.lit(0.0)))

    t = F.col("temp_trend")
    jump = F.when(F.col("_tsd") > 0, (F.abs(t) > 2 * F.col("_tsd")).cast("int")).otherwise(0)
    delta = (F.col("TrackTemp") - F.col("AirTemp") if {"AirTemp", "TrackTemp"} <= set(cols) else F.lit(0.0))
    kept = [c for c in df.columns if c.lower() != "time_seconds"]
    return out.select(*kept, F.col("_time").alias("time_seconds"),
                      standard("AirTemp").alias("air_temp_normalized"),
                      standard("TrackTemp").alias("track_temp_normalized"),
                      delta.alias("temp_delta"),
                      (F.coalesce((rain > 0).cast("int"), F.lit(0)) if rain is not None else F.lit(0))
                      .alias("rainfall_indicator"),
                      t.alias("temp_trend"),
                      F.when(t > 0.5, 1).when(t < -0.5, -1).otherwise(0).alias("temp_trend_direction"),
                      F.greatest(jump, F.col("_onset")).alias("weather_change"))


def finish_flag(status: Column) -> Column:
    """1 when the status says finished (also when laps down), else 0."""
    return F.when(has_any(status, ["Finished", "+"]), 1).otherwise(0)


def dnf_category(status: Column) -> Column:
    up = F.upper(status)
    out = None
    for name, words in DNF_WORDS.items():
        out = F.when(has_any(up, words), name) if out is None else out.when(has_any(up, words), name)
    return out.otherwise("other")


def result_columns(df: DataFrame) -> DataFrame:
    """Row-wise part of the result features: numbers, position change, finish flag, DNF category."""
    def number(name: str) -> Column:
        return lenient_double(name) if name in df.columns else F.lit(None).cast("double")

    fin, grid = number("Position"), number("GridPosition")
    has_status = "Status" in df.columns
    status = F.coalesce(F.col("Status"), F.lit("Unknown")) if has_status else F.lit(None).cast("string")
    change = fin - grid
    return df.select(*df.columns, fin.alias("final_position"), grid.alias("grid_position"),
                     change.alias("position_change"),
                     F.coalesce((change < 0).cast("int"), F.lit(0)).alias("position_gain"),
                     status.alias("status_text"),
                     (finish_flag(status) if has_status else F.lit(1)).alias("finish_status"),
                     (dnf_category(status) if has_status else F.lit("finished")).alias("dnf_category"),
                     F.coalesce(number("Points"), F.lit(0.0)).alias("points_value"))


def result_features(df: DataFrame, part: Sequence[str]) -> DataFrame:
    """:func:`result_columns` plus normalised points and the performance score in [0, 1].

    Where all scores of a part are equal the min-max scaling has no value and the score is NULL.
    """
    rows = result_columns(df)
    keep = rows.columns
    out = attach_stats(rows, part, [F.max("points_value").alias("_mp"), F.max("final_position").alias("_mx")])
    share = F.when(F.col("_mp") > 0, F.col("points_value") / F.col("_mp")).otherwise(F.lit(0.0))
    place = F.when(F.col("_mx") > 0, (F.col("_mx") + 1 - F.coalesce("final_position", F.col("_mx") + 1))
                   / F.col("_mx")).otherwise(F.lit(0.0))
    raw = place - 0.1 * F.coalesce("position_change", F.lit(0.0)) + share
    out = out.select(*keep, share.alias("points_normalized"), raw.alias("_raw"))
    wide = attach_stats(out, part, [F.max("_raw").alias("_hi"), F.min("_raw").alias("_lo")])
    spread = F.col("_hi") - F.col("_lo")
    score = (F.when(F.col("_hi") > 0, (F.col("_raw") - F.col("_lo")) / F.when(spread > 0, spread))
             .otherwise(F.col("_raw")))
    return wide.select(*keep, "points_normalized", score.alias("performance_score"))
