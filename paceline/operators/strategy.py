"""Undercuts and overcuts.

The race is first turned into one wide lap table: rank, next stop and the one after, running sums
of lap times shifted to where they are needed. A pair of cars is then found by joining on
(part, lap, rank) for six exploded ranks, and everything after the stop by one lookup per car, so
no join ever compares all cars or all stops of a race.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paceline.operators.keyed import group_quantiles
from paceline.operators.laps import pit_stops
from paceline.operators.ordered import LANE, Scan, drop_halo, lane_of, nearest_known, prefix_scan, with_halo
from paceline.roles import Roles
from paceline.session import stage

WINDOW_LAPS = 4
MAX_RANK_GAP = 6
MIN_GAIN_SECONDS = 0.3


def rank_at(df: DataFrame, roles: Roles, asked: DataFrame) -> DataFrame:
    """Rank of the asked (part, entity, seq) rows; NULL when there is none."""
    return asked.join(df.select(*roles.row_keys, roles.rank), roles.row_keys, "left")


def cars_ahead(df: DataFrame, roles: Roles, asked: DataFrame, gap: int = MAX_RANK_GAP) -> DataFrame:
    """(asked row, ahead): cars one to ``gap`` ranks in front of the asked (part, entity, seq) row."""
    me = rank_at(df, roles, asked).where(F.col(roles.rank).isNotNull() & (F.col(roles.rank) > 1))
    slots = F.sequence(F.greatest(F.lit(1), F.col(roles.rank) - gap), F.col(roles.rank) - 1)
    want = me.withColumn("_slot", F.explode(slots))
    cars = df.select(*roles.seq_keys, F.col(roles.entity).alias("ahead"), F.col(roles.rank).alias("_slot"))
    return want.join(cars, [*roles.seq_keys, "_slot"]).drop("_slot")


def car_at_rank(df: DataFrame, roles: Roles, asked: DataFrame) -> DataFrame:
    """Entity holding the asked (part, seq, rank)."""
    cars = df.select(*roles.seq_keys, roles.rank, roles.entity)
    return asked.join(cars, [*roles.seq_keys, roles.rank], "left")


def strategy_base(df: DataFrame, roles: Roles, min_lap: int = 8, max_new_age: int = 5,
                  lane_rows: int | None = None) -> DataFrame:
    """The wide lap table, written once because undercuts and overcuts scan it several times.

    ``stop``/``stop2``: first and second stop after this lap. ``s_next``/``n_next``: sum and count of
    lap times up to the next lap. ``s_back``/``n_back``: up to two laps before.
    """
    keys, seq = roles.keys, roles.seq
    pits = pit_stops(df, roles, min_lap, max_new_age, lane_rows)
    pits = prefix_scan(pits, keys, ["pit_lap"], [Scan("_then", "prev", F.col("pit_lap"))],
                       lane_of("pit_lap", lane_rows), reverse=True)
    # Sums in decimals are exact, so a gain at the least that counts does not depend on the laps before.
    laps = df.select(*roles.row_keys, roles.rank, F.col(roles.measure).try_cast("decimal(18,6)").alias("_m"))
    laps = laps.join(pits.withColumnRenamed("pit_lap", seq).withColumn("_stop", F.col(seq)), roles.row_keys, "left")
    stop = F.when(F.col("_stop").isNotNull(), F.struct(F.col("_stop").alias("lap"), F.col("_then").alias("then")))
    laps = nearest_known(laps, keys, [seq], {"stop": stop}, lane_of(seq, lane_rows), strict=True)
    sums = prefix_scan(laps.drop("stop_b", "_stop", "_then"), keys, [seq],
                       [Scan("_s", "sum", F.col("_m")), Scan("_n", "count", F.col("_m"))], lane_of(seq, lane_rows))
    near = with_halo(sums, seq, 2, 1, lane_rows)
    w = W.partitionBy(*keys, LANE).orderBy(seq)
    wide = near
    for c in "sn":
        wide = (wide.withColumn(f"{c}_next", F.coalesce(F.lead(f"_{c}", 1).over(w), F.col(f"_{c}")))
                .withColumn(f"{c}_back", F.coalesce(F.lag(f"_{c}", 2).over(w), F.lit(0))))
    return stage(drop_halo(wide).select(*roles.row_keys, roles.rank, F.col("stop_f.lap").alias("stop"),
                                        F.col("stop_f.then").alias("stop2"), "s_next", "n_next", "s_back", "n_back"),
                 "strategy")


def _pairs(base: DataFrame, roles: Roles, ahead: bool) -> DataFrame:
    """Cars stopping on the next lap, each with the cars up to six ranks in front of or behind it."""
    r = F.col(roles.rank)
    slots = (F.sequence(F.greatest(F.lit(1).cast("long"), r - MAX_RANK_GAP), r - 1) if ahead
             else F.sequence(r + 1, r + MAX_RANK_GAP))
    stopping = base.where((F.col("stop") == F.col(roles.seq) + 1) & r.isNotNull())
    if ahead:
        stopping = stopping.where(r > 1)
    me = stopping.select(*roles.seq_keys, F.col(roles.entity).alias("me"), F.col("stop").alias("my_stop"),
                         F.col("s_next").alias("my_s0"), F.col("n_next").alias("my_n0"),
                         F.explode(slots).alias("_slot"))
    other = base.select(*roles.seq_keys, F.col(roles.entity).alias("other"), F.col(roles.rank).alias("_slot"),
                        F.col("stop").alias("o_stop"), F.col("stop2").alias("o_stop2"),
                        F.col("s_next").alias("o_s0"), F.col("n_next").alias("o_n0"))
    return me.join(other, [*roles.seq_keys, "_slot"]).where(F.col("me") != F.col("other")).drop("_slot", roles.seq)


def _settle(pairs: DataFrame, base: DataFrame, medians: DataFrame, roles: Roles, fast: str, slow: str) -> DataFrame:
    """Keep pairs where ``fast`` is in front after the second stop, with the time it gained."""
    part = list(roles.part)
    after = {}
    for who in ("me", "other"):
        after[who] = base.select(*part, F.col(roles.entity).alias(who), (F.col(roles.seq) - 1).alias("second"),
                                 F.col(roles.rank).alias(f"{who}_rank"), F.col("s_back").alias(f"{who}_s1"),
                                 F.col("n_back").alias(f"{who}_n1"))
    out = pairs.join(after["me"], [*part, "me", "second"]).join(after["other"], [*part, "other", "second"])
    out = out.where(F.col(f"{fast}_rank") < F.col(f"{slow}_rank"))
    for who in ("me", "other"):
        out = out.join(medians.select(*part, F.col(roles.entity).alias(who), F.col("median").alias(f"{who}_med")),
                       [*part, who], "left")

    def mean(who: str) -> Column:
        p = "my" if who == "me" else "o"
        n = F.col(f"{who}_n1") - F.col(f"{p}_n0")
        return (F.col(f"{who}_s1") - F.col(f"{p}_s0")).cast("double") / F.when(n > 0, n)

    between = F.col("second") - F.col("my_stop") - 1
    gain = F.when(between >= 2, (mean(slow) - mean(fast)) * between).otherwise(
        F.coalesce(F.col(f"{slow}_med") - F.col(f"{fast}_med"), F.lit(0.0)))
    # A gain without a value stays NULL (greatest would turn it into zero) and is dropped later.
    return out.withColumn("gain", F.when(gain.isNotNull(), F.greatest(gain, F.lit(0.0))))


def _inputs(df: DataFrame, roles: Roles, base: DataFrame | None):
    medians = group_quantiles(df, roles.keys, roles.measure, {"median": 0.5})
    return (base if base is not None else strategy_base(df, roles)), medians


def detect_undercuts(df: DataFrame, roles: Roles, min_gain: float = MIN_GAIN_SECONDS, window: int = WINDOW_LAPS,
                     base: DataFrame | None = None) -> DataFrame:
    """(part, driver, target_driver, lap, time_gained_seconds): stopped first, came out in front."""
    base, medians = _inputs(df, roles, base)
    pairs = _pairs(base, roles, ahead=True)
    # The rival's first stop strictly after mine; one on the same lap is skipped.
    second = F.when(F.col("o_stop") > F.col("my_stop"), F.col("o_stop")).otherwise(F.col("o_stop2"))
    pairs = pairs.withColumn("second", second).where(F.col("second") <= F.col("my_stop") + window)
    out = _settle(pairs, base, medians, roles, fast="me", slow="other").where(F.col("gain") >= min_gain)
    return out.select(*roles.part, F.col("me").alias("driver"), F.col("other").alias("target_driver"),
                      F.col("second").alias("lap"), F.bround("gain", 3).alias("time_gained_seconds"))


def detect_overcuts(df: DataFrame, roles: Roles, min_gain: float = MIN_GAIN_SECONDS, window: int = WINDOW_LAPS,
                    base: DataFrame | None = None) -> DataFrame:
    """(part, driver, target_driver, lap, time_saved_seconds): stayed out longer, came out in front."""
    base, medians = _inputs(df, roles, base)
    pairs = _pairs(base, roles, ahead=False)
    # No stop inside the window means the first stop from here is beyond it.
    pairs = pairs.withColumn("second", F.col("o_stop")).where(F.col("second") > F.col("my_stop") + window)
    out = _settle(pairs, base, medians, roles, fast="other", slow="me").where(F.col("gain") >= min_gain)
    return out.select(*roles.part, F.col("other").alias("driver"), F.col("me").alias("target_driver"),
                      F.col("second").alias("lap"), F.bround("gain", 3).alias("time_saved_seconds"))
