"""Lap features: runs, pace, fuel correction, deltas, structural filter, pit laps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paceline.operators.keyed import attach_quantiles, group_quantiles, top_by
from paceline.operators.ordered import dense_position, LANE, count_drops, drop_halo, lane_of, with_halo
from paceline.roles import Roles
from paceline.session import stage

# Hardness order of the tyre compounds and the ordinal of an unknown one.
COMPOUND_ORDER = {"SOFT": 1, "MEDIUM": 2, "HARD": 3, "INTERMEDIATE": 4, "WET": 5}
UNKNOWN_COMPOUND = 2.0

FUEL_SECONDS_PER_LAP = 0.065
STRUCTURAL_FACTOR = 1.5


def for_entity(df: DataFrame, roles: Roles, entity) -> DataFrame:
    """Rows of one competitor; the filter is pushed into the scan."""
    return df.where(F.col(roles.entity) == F.lit(entity))


def drop_non_positive(df: DataFrame, measure: str) -> DataFrame:
    """Rows with a measure above zero; NULL goes too."""
    return df.where(F.col(measure) > 0)


def zero_count(df: DataFrame, measure: str) -> DataFrame:
    """How many rows :func:`drop_non_positive` reports as zero laps."""
    return df.agg(F.count_if(F.col(measure) == 0).alias("zero_laps"),
                  F.count_if(F.col(measure) > 0).alias("kept_laps"))


def warmup_skip(df: DataFrame, roles: Roles, laps: int = 3) -> DataFrame:
    """Drop the first ``laps`` lap numbers of every run."""
    start = df.groupBy(*roles.run_keys).agg(F.min(roles.seq).alias("_start"))
    return (df.join(start, roles.run_keys).where(F.col(roles.seq) >= F.col("_start") + laps)
            .select(*df.columns))


def detect_stints(df: DataFrame, roles: Roles, lane_rows: int | None = None) -> DataFrame:
    """Append the run number: 1 at the start, one more at every drop of the tyre age.

    A missing age repeats the latest known one, so it neither starts nor hides a run.
    """
    keep = [c for c in df.columns if c != roles.run]
    runs = count_drops(df.select(*keep), roles.keys, roles.seq, roles.age, "_run", lane_of(roles.seq, lane_rows))
    return runs.select(*keep, (F.col("_run") + 1).cast("int").alias(roles.run))


def compound_ordinal(category: str) -> Column:
    known = F.create_map(*[F.lit(x) for kv in COMPOUND_ORDER.items() for x in kv])
    return F.coalesce(known[F.col(category)], F.lit(UNKNOWN_COMPOUND)).cast("double")


def top3_reference(df: DataFrame, roles: Roles) -> DataFrame:
    """Per lap number: median of the three fastest, or of all when there are fewer than three."""
    fast = top_by(df.where(F.col(roles.measure).isNotNull()).select(*roles.seq_keys, roles.measure),
                  roles.seq_keys, [F.col(roles.measure).asc()], 3)
    # At most three rows per lap number are left, and fewer than three means they are all there are.
    return fast.groupBy(*roles.seq_keys).agg(F.expr(f"percentile(`{roles.measure}`, 0.5)").alias("_top3"))


def relative_pace(df: DataFrame, roles: Roles) -> DataFrame:
    """Append relative_pace: measure minus the lap's top-3 reference."""
    ref = top3_reference(df, roles)
    return (df.join(ref, roles.seq_keys, "left")
            .select(*df.columns, (F.col(roles.measure) - F.col("_top3")).alias("relative_pace")))


def fuel_corrected(df: DataFrame, roles: Roles, rate: float = FUEL_SECONDS_PER_LAP,
                   sign: float = -1.0) -> DataFrame:
    """Append lap_position (0-based among the rows of the run) and the fuel-corrected measure.

    Laps that are missing from the table do not count.
    """
    pos = F.col("_pos") - 1
    return (dense_position(df, roles.run_keys, [roles.seq], lane_of(roles.seq), "_pos")
            .select(*df.columns, pos.alias("lap_position"),
                    (F.col(roles.measure) + F.lit(sign * rate) * pos).alias("fuel_corrected")))


def run_delta(df: DataFrame, roles: Roles, value: str = "fuel_corrected") -> DataFrame:
    """Append lap_delta: value minus the median of its run."""
    return (attach_quantiles(df, roles.run_keys, value, {"_med": 0.5})
            .select(*df.columns, (F.col(value) - F.col("_med")).alias("lap_delta")))


def entity_delta(df: DataFrame, roles: Roles, value: str | None = None) -> DataFrame:
    """Append lap_delta: value minus the median of its entity (used when run features are absent)."""
    value = value or roles.measure
    return (attach_quantiles(df, roles.keys, value, {"_med": 0.5})
            .select(*df.columns, (F.col(value) - F.col("_med")).alias("lap_delta")))


def age_normalized(df: DataFrame, roles: Roles) -> DataFrame:
    """Append age_normalized: tyre age over its maximum in the run, 0 when that is not positive."""
    top = df.groupBy(*roles.run_keys).agg(F.max(roles.age).alias("_top"))
    return (df.join(top, roles.run_keys, "left")
            .select(*df.columns, F.when(F.col("_top") > 0, F.col(roles.age) / F.col("_top"))
                    .otherwise(F.lit(0.0)).alias("age_normalized")))


def lap_features(df: DataFrame, roles: Roles, fuel: bool = True, rate: float = FUEL_SECONDS_PER_LAP,
                 lane_rows: int | None = None) -> DataFrame:
    """All lap features: compound ordinal, run, pace, fuel correction, delta, normalised age.

    The position in a run counts its rows, so missing laps do not matter. Oldest tyre and median of a
    run are joined on the run. The run numbering feeds four branches, so it is written once.
    """
    out = stage(detect_stints(df, roles, lane_rows), "runs")
    out = out.withColumn("compound_ordinal", compound_ordinal(roles.category))
    per_run = out.groupBy(*roles.run_keys).agg(F.max(roles.age).alias("_top"))
    base = F.col(roles.measure)
    if fuel:
        out = dense_position(out, roles.run_keys, [roles.seq], lane_of(roles.seq, lane_rows), "_pos")
        base = base - F.lit(rate) * (F.col("_pos") - 1)
    out = (out.join(per_run, roles.run_keys)
           .withColumn("fuel_corrected", base)
           .withColumn("age_normalized", F.when(F.col("_top") > 0, F.col(roles.age) / F.col("_top"))
                       .otherwise(F.lit(0.0)))
           .drop("_pos", "_top"))
    out = run_delta(out, roles)
    return relative_pace(out if fuel else out.drop("fuel_corrected"), roles)


def structural_filter(df: DataFrame, roles: Roles, factor: float = STRUCTURAL_FACTOR,
                      grouped: bool = True) -> DataFrame:
    """Append is_structural: measure above ``factor`` times the median.

    Grouped by entity a missing measure counts as clean; over the whole table it does not.
    """
    keys = roles.keys if grouped else []
    slow = F.col(roles.measure) > F.lit(factor) * F.col("_med")
    flag = F.coalesce(slow, F.lit(not grouped))
    return (attach_quantiles(df, keys, roles.measure, {"_med": 0.5})
            .select(*df.columns, flag.alias("is_structural")))


def split_structural(df: DataFrame, roles: Roles, factor: float = STRUCTURAL_FACTOR):
    """(clean rows, structurally slow rows)."""
    flagged = structural_filter(df, roles, factor)
    return (flagged.where(~F.col("is_structural")).drop("is_structural"),
            flagged.where("is_structural").drop("is_structural"))


def pit_stops(df: DataFrame, roles: Roles, min_lap: int = 8, max_new_age: int = 5,
              lane_rows: int | None = None) -> DataFrame:
    """Real stops: the run number rises, the tyre is not older than before and nearly new.

    Comparisons with a missing age do not reject a stop. Without an age column only the run number
    and the lap limit count.
    """
    has_age = roles.age in df.columns
    cols = [*roles.row_keys, roles.run, *([roles.age] if has_age else [])]
    near = with_halo(df.select(*cols), roles.seq, 1, 0, lane_rows)
    w = W.partitionBy(*roles.keys, LANE).orderBy(roles.seq)
    ok = F.col(roles.run) > F.lag(roles.run).over(w)
    if has_age:
        ok = (ok & ~F.coalesce(F.col(roles.age) > F.lag(roles.age).over(w), F.lit(False))
              & ~F.coalesce(F.col(roles.age) > max_new_age, F.lit(False)))
    flagged = drop_halo(near.withColumn("_pit", ok))
    return (flagged.where(F.col("_pit") & (F.col(roles.seq) >= min_lap))
            .select(*roles.keys, F.col(roles.seq).alias("pit_lap")))


def pit_laps(df: DataFrame, roles: Roles, pit_in: str = "PitInTime_seconds",
             pit_out: str = "PitOutTime_seconds", lane_rows: int | None = None) -> DataFrame:
    """(keys, seq) of every in-lap and out-lap.

    From the pit times where the table has them, otherwise from a rise of the run number, which
    marks the lap itself and the one before.
    """
    times = [c for c in (pit_in, pit_out) if c in df.columns]
    if times:
        return df.where(F.coalesce(*[F.col(c) for c in times]).isNotNull()).select(*roles.row_keys).distinct()
    near = with_halo(df.select(*roles.row_keys, roles.run), roles.seq, 1, 0, lane_rows)
    w = W.partitionBy(*roles.keys, LANE).orderBy(roles.seq)
    rise = drop_halo(near.withColumn("_rise", F.col(roles.run) > F.lag(roles.run).over(w))).where("_rise")
    both = F.when(F.col(roles.seq) > 1, F.array(F.col(roles.seq), F.col(roles.seq) - 1)) \
        .otherwise(F.array(F.col(roles.seq)))
    return rise.select(*roles.keys, F.explode(both).alias(roles.seq)).distinct()


def entity_medians(df: DataFrame, roles: Roles, value: str | None = None) -> DataFrame:
    """One row per entity: median of the value."""
    return group_quantiles(df, roles.keys, value or roles.measure, {"median": 0.5})


def label_sample(df: DataFrame, label: str, value: str) -> DataFrame:
    """Mean and count of a value per label."""
    return df.groupBy(label).agg(F.avg(value).alias("mean"), F.count(value).alias("count"))
