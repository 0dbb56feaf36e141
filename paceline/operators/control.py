"""Safety-car periods, penalties, retirements and the causes behind slow laps.

Every interval question is turned into an equi-join on (part, lap): short intervals are exploded to
laps, long ones are merged first, and "next event from here" is a backward scan over laps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.operators.keyed import attach_quantiles, attach_stats
from paceline.operators.ordered import Scan, lane_of, ordered_sums, prefix_scan
from paceline.roles import Roles
from paceline.session import stage

# Texts of the message feed.
DEPLOYED = "SAFETY CAR DEPLOYED"
WITHDRAWN = "SAFETY CAR IN THIS LAP"
CAUSE_PATTERN = "(?i)(INCIDENT|RETIRED|COLLISION|ACCIDENT|CRASH|SPIN|OFF TRACK|DEBRIS|CONTACT)"
NOT_A_CAUSE_PATTERN = "(?i)(SAFETY CAR|VIRTUAL|DRS|PIT LANE|TRACK CLEAR)"
SETTLED_PENALTY_PATTERN = "(?i)(SERVED|UNDER INVESTIGATION|NO FURTHER|NOTED)"
RETIREMENT_PATTERN = "(?i)(RETIRED|RETIREMENT|WITHDREW)"
CODE_PATTERN = r"\(([A-Z]{2,3})\)"
REASON_PATTERN = r" - (.+)$"
DEFAULT_REASON = "Infraction"

OPEN_INTERVAL_LAPS = 4
EVENT_TAIL_LAPS = 2
NARRATIVE_CAUSES = ["driver_error", "external_incident"]


def _msg() -> Column:
    return F.coalesce(F.col("Message"), F.lit(""))


def _deployments(control: DataFrame, part: Sequence[str], order: str, exclude_virtual: bool) -> DataFrame:
    """One row per deployment message with the first withdrawal at or after its lap (or NULL)."""
    text = _msg()
    is_deploy = F.contains(text, F.lit(DEPLOYED))
    if exclude_virtual:
        is_deploy = is_deploy & ~F.contains(text, F.lit("VIRTUAL"))
    marked = control.where(F.col("Lap").isNotNull()).select(
        *part, F.col("Lap").cast("long").alias("Lap"), F.col(order).alias("_ord"), is_deploy.alias("_d"),
        F.contains(text, F.lit(WITHDRAWN)).alias("_w")).where("_d OR _w")
    # One row per lap first, so that a lap crowded with messages costs one row in the scan.
    per_lap = marked.groupBy(*part, "Lap").agg(F.bool_or("_w").alias("_w"), F.count_if("_d").alias("_n"))
    ends = prefix_scan(per_lap, part, ["Lap"], [Scan("end_lap", "last", F.when(F.col("_w"), F.col("Lap")))],
                       lane_of("Lap"), reverse=True)
    return (marked.where("_d").join(ends.where("_n > 0").select(*part, "Lap", "end_lap"), [*part, "Lap"])
            .select(*part, "Lap", "_ord", "end_lap"))


def safety_car_intervals(control: DataFrame, part: Sequence[str], order: str = "seq",
                         exclude_virtual: bool = False) -> DataFrame:
    """(part, deploy_lap, end_lap) per deployment; without a withdrawal the end is four laps later."""
    d = _deployments(control, part, order, exclude_virtual)
    return d.select(*part, F.col("Lap").alias("deploy_lap"),
                    F.coalesce("end_lap", F.col("Lap") + OPEN_INTERVAL_LAPS).alias("end_lap"))


def safety_car_laps(control: DataFrame, part: Sequence[str], order: str = "seq",
                    exclude_virtual: bool = False) -> DataFrame:
    """Distinct (part, lap) from one lap before the deployment to one after the withdrawal.

    Deployments that share an end are nested, so only the earliest is kept before exploding; the
    output stays proportional to the laps covered however many deployments overlap.
    """
    spans = (safety_car_intervals(control, part, order, exclude_virtual)
             .groupBy(*part, "end_lap").agg(F.min("deploy_lap").alias("deploy_lap")))
    laps = F.sequence(F.greatest(F.lit(1).cast("long"), F.col("deploy_lap") - 1), F.col("end_lap") + 1)
    return spans.select(*part, F.explode(laps).alias("lap")).distinct()


def tail_laps(control: DataFrame, part: Sequence[str], flag: str, tail: int = EVENT_TAIL_LAPS) -> DataFrame:
    """Distinct (part, lap) in [event, event + tail] of the flagged messages."""
    hit = (control.where(F.coalesce(F.col(flag), F.lit(False)) & F.col("Lap").isNotNull())
           .select(*part, F.col("Lap").cast("long").alias("Lap")).distinct())
    return hit.select(*part, F.explode(F.sequence(F.col("Lap"), F.col("Lap") + tail)).alias("lap")).distinct()


def safety_car_cause(control: DataFrame, deployments: DataFrame, part: Sequence[str],
                     order: str = "seq") -> DataFrame:
    """(part, Lap, cause): earliest explaining message in the two laps before and the lap itself.

    The first candidate per lap is found before it is copied to the laps it may explain.
    """
    text = _msg()
    candidates = (control.where(text.rlike(CAUSE_PATTERN) & ~text.rlike(NOT_A_CAUSE_PATTERN) & F.col("Lap").isNotNull())
                  .groupBy(*part, F.col("Lap").cast("long").alias("_at"))
                  .agg(F.min_by(F.trim("Message"), F.col(order)).alias("_text"))
                  .select(*part, "_at", "_text", F.explode(F.sequence(F.col("_at"), F.col("_at") + 2)).alias("Lap")))
    asked = deployments.select(*part, "Lap").distinct()
    return (asked.join(candidates, [*part, "Lap"]).groupBy(*part, "Lap")
            .agg(F.min_by("_text", "_at").alias("cause")))


def safety_car_events(control: DataFrame, part: Sequence[str], order: str = "seq",
                      exclude_virtual: bool = False) -> DataFrame:
    """(part, lap, deployed_on_lap, duration_laps, cause) per deployment message."""
    d = _deployments(control, part, order, exclude_virtual)
    cause = safety_car_cause(control, d, part, order)
    span = F.coalesce("end_lap", F.col("Lap")) - F.col("Lap")
    return (d.join(cause, [*part, "Lap"], "left")
            .select(*part, F.col("Lap").alias("lap"), F.col("Lap").alias("deployed_on_lap"),
                    F.greatest(F.lit(1).cast("long"), span).alias("duration_laps"), "cause"))


def penalty_events(control: DataFrame, part: Sequence[str]) -> DataFrame:
    """(part, lap, driver, reason) of every penalty that names a driver code and is not settled."""
    text = _msg()
    code = F.nullif(F.regexp_extract(text, CODE_PATTERN, 1), F.lit(""))
    reason = F.nullif(F.regexp_extract(text, REASON_PATTERN, 1), F.lit(""))
    return (control.where(F.col("is_penalty") & ~text.rlike(SETTLED_PENALTY_PATTERN) & F.col("Lap").isNotNull())
            .select(*part, F.col("Lap").cast("long").alias("lap"), code.alias("driver"),
                    F.coalesce(F.initcap(reason), F.lit(DEFAULT_REASON)).alias("reason"))
            .where(F.col("driver").isNotNull()))


def retirement_laps(results: DataFrame, laps: DataFrame, part: Sequence[str], entity: str = "Driver",
                    seq: str = "LapNumber") -> DataFrame:
    """(part, driver, on_lap): the lap after the last completed one, unless that was the race's last."""
    last = laps.groupBy(*part, F.substring(F.col(entity), 1, 3).alias("driver")).agg(F.max(seq).alias("_last"))
    total = last.groupBy(*part).agg(F.max("_last").alias("_total")) if part else last.agg(F.max("_last").alias("_total"))
    out = (results.where(F.col("finish_status") != 1)
           .select(*part, F.substring("Abbreviation", 1, 3).alias("driver")).distinct()
           .join(last, [*part, "driver"]))
    out = out.join(total, list(part)) if part else out.join(F.broadcast(total))
    on = F.when(F.col("_last") < F.col("_total"), F.col("_last") + 1).otherwise(F.col("_last"))
    return out.select(*part, "driver", on.cast("long").alias("on_lap"))


def retirement_causes(retired: DataFrame, control: DataFrame, part: Sequence[str],
                      order: str = "seq") -> DataFrame:
    """Append the first message, one lap around, that holds the code or speaks of a retirement.

    "Holds the code" is an equi-join: only laps next to a retirement are looked at, and their
    messages are cut into all their three-letter pieces. Of these, pieces that are no code asked for
    in the lap leave at once, and places stand for messages until the first one is known. The
    retirements are written once, so that Spark knows how few they are and moves no message to them.
    """
    part = list(part)
    retired = stage(retired, "retired")
    near = F.sequence(F.col("on_lap") - 1, F.col("on_lap") + 1)
    asked = retired.select(*part, "driver", "on_lap", F.explode(near).alias("_lap"))
    msgs = (control.where(F.col("Lap").isNotNull() & F.col("Message").isNotNull())
            .select(*part, F.col("Lap").cast("long").alias("_lap"), F.col(order).alias("_ord"), "Message")
            .join(asked.select(*part, "_lap").distinct(), [*part, "_lap"], "left_semi"))
    speaks = F.col("Message").rlike(RETIREMENT_PATTERN)
    generic = msgs.where(speaks).groupBy(*part, "_lap").agg(F.min("_ord").alias("_ord"))
    pieces = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("Message") - 2),
                                          lambda i: F.substring(F.col("Message"), i, F.lit(3))))
    coded = (msgs.where(F.length("Message") >= 3).select(*part, "_lap", "_ord", F.explode(pieces).alias("driver"))
             .join(asked.select(*part, "_lap", "driver").distinct(), [*part, "_lap", "driver"])
             .groupBy(*part, "_lap", "driver").agg(F.min("_ord").alias("_ord")))
    hits = (asked.join(generic, [*part, "_lap"]).select(*part, "driver", "on_lap", "_lap", "_ord")
            .unionByName(asked.join(coded, [*part, "_lap", "driver"]).select(*part, "driver", "on_lap", "_lap", "_ord")))
    best = hits.groupBy(*part, "driver", "on_lap").agg(F.min(F.struct("_ord", "_lap")).alias("_h"))
    best = stage(best.select(*part, "driver", "on_lap", "_h._lap", "_h._ord"), "firsts")
    said = speaks | F.contains("Message", F.col("driver"))
    texts = (msgs.join(best, [*part, "_lap", "_ord"]).where(said)
             .groupBy(*part, "driver", "on_lap").agg(F.min(F.trim("Message")).alias("cause")))
    return retired.join(texts, [*part, "driver", "on_lap"], "left")


def retirement_events(results: DataFrame, laps: DataFrame, control: DataFrame | None, part: Sequence[str],
                      existing: DataFrame | None = None, entity: str = "Driver", seq: str = "LapNumber",
                      order: str = "seq") -> DataFrame:
    """(part, lap, driver, cause) for every non-finisher that ``existing`` does not list yet."""
    part = list(part)
    out = retirement_laps(results, laps, part, entity, seq)
    if existing is not None:
        out = out.join(existing.select(*part, "driver"), [*part, "driver"], "left_anti")
    if control is not None:
        out = retirement_causes(out, control, part, order)
    else:
        out = out.withColumn("cause", F.lit(None).cast("string"))
    return out.select(*part, F.col("on_lap").alias("lap"), "driver", "cause")


def anomaly_z(laps: DataFrame, roles: Roles, delta: str | None = "lap_delta") -> DataFrame:
    """Append z_score per entity: of the delta, a missing delta counting as zero, or with ``delta=None``
    of the measure, a missing measure counting as the median of its entity.
    """
    if delta is None:
        laps = attach_quantiles(laps, roles.keys, roles.measure, {"_med": 0.5})
        out = anomaly_z(laps.withColumn("_known", F.coalesce(F.col(roles.measure), F.col("_med"))), roles, "_known")
        return out.drop("_known", "_med")
    v = F.coalesce(F.col(delta), F.lit(0.0))
    # The sign decides on the cause, also of a lap at the very mean: the mean is that of the laps in their order.
    sums = ordered_sums(laps, roles.keys, roles.seq, v, "_t")
    out = attach_stats(laps, roles.keys, [F.count(F.lit(1)).alias("_n"), F.stddev_pop(v).alias("_s")]).join(sums, roles.keys, "left")
    return out.select(*laps.columns, ((v - F.col("_t") / F.col("_n")) / F.when(F.col("_s") > 0, F.col("_s"))).alias("z_score"))


def _flag(df: DataFrame, hits: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    marked = hits.select(*keys).distinct().withColumn(name, F.lit(True))
    return df.join(marked, list(keys), "left").withColumn(name, F.coalesce(name, F.lit(False)))


def classify_anomalies(laps: DataFrame, control: DataFrame | None, roles: Roles, pits: DataFrame | None = None,
                       order: str = "seq") -> DataFrame:
    """Append anomaly_cause and is_driver_error to rows with is_anomaly and z_score.

    In and out laps outrank everything, then laps faster than usual, safety car, virtual safety
    car, flags; what is left is the driver's. Without any control messages only the speed counts.
    """
    z, anom = F.col("z_score"), F.col("is_anomaly")
    if control is None:
        cause = F.when(z < 0, "restart_fast").otherwise("driver_error")
        return laps.withColumn("anomaly_cause", cause).withColumn("is_driver_error", cause == "driver_error")
    part, seq = list(roles.part), roles.seq
    lap_keys = [*part, seq]
    out = laps
    if pits is not None:
        out = _flag(out, pits, [*roles.keys, seq], "_pit")
    else:
        out = out.withColumn("_pit", F.lit(False))
    out = _flag(out, safety_car_laps(control, part, order).withColumnRenamed("lap", seq), lap_keys, "_sc")
    out = _flag(out, tail_laps(control, part, "is_virtual_safety_car").withColumnRenamed("lap", seq), lap_keys, "_vsc")
    out = _flag(out, tail_laps(control, part, "is_flag").withColumnRenamed("lap", seq), lap_keys, "_flag")
    cause = (F.when(F.col("_pit") & anom, "pit_lap").when(z < 0, "restart_fast")
             .when(F.col("_sc") & anom, "safety_car").when(F.col("_vsc") & anom, "virtual_safety_car")
             .when(F.col("_flag") & anom, "yellow_flag").otherwise("driver_error"))
    return out.select(*laps.columns, cause.alias("anomaly_cause"), (cause == "driver_error").alias("is_driver_error"))


def clear_external_errors(laps: DataFrame, control: DataFrame, roles: Roles, order: str = "seq") -> DataFrame:
    """Set is_driver_error to false on anomalies near any safety-car, virtual or flag message."""
    part = list(roles.part)
    external = control.withColumn("_ext", F.col("is_safety_car") | F.col("is_virtual_safety_car") | F.col("is_flag"))
    hit = safety_car_laps(control, part, order).unionByName(tail_laps(external, part, "_ext")).distinct()
    out = _flag(laps, hit.withColumnRenamed("lap", roles.seq), [*part, roles.seq], "_hit")
    return out.withColumn("is_driver_error", F.col("is_driver_error") & ~(F.col("_hit") & F.col("is_anomaly"))).drop("_hit")


def narrative_anomalies(laps: DataFrame, roles: Roles, accurate: str = "IsAccurate") -> DataFrame:
    """Anomalies worth telling: not the first lap, accurate unless past lap five, cause of interest.

    Tables without anomaly_cause fall back to is_driver_error with the pit and speed filters.
    """
    seq = F.col(roles.seq)
    keep = F.col("is_anomaly") & (seq > 1)
    if accurate in laps.columns:
        keep = keep & (F.col(accurate) | (seq > 5))
    if "anomaly_cause" in laps.columns:
        keep = keep & F.col("anomaly_cause").isin(NARRATIVE_CAUSES)
        kind = F.col("anomaly_cause")
    else:
        for c in ("PitInTime_seconds", "PitOutTime_seconds"):
            if c in laps.columns:
                keep = keep & F.col(c).isNull()
        if "z_score" in laps.columns:
            keep = keep & (F.col("z_score") >= 0)
        kind = F.when(F.col("is_driver_error"), "driver_error").otherwise("external_incident")
    return laps.where(keep).select(*roles.part, kind.alias("type"), seq.cast("long").alias("lap"),
                                   F.substring(F.col(roles.entity).cast("string"), 1, 3).alias("driver"))


def event_rate(control: DataFrame | None, laps: DataFrame, part: Sequence[str], seq: str = "LapNumber",
               low: float = 0.02, high: float = 0.12, margin: float = 0.02, default: float = 0.05) -> DataFrame:
    """(part, contamination): distinct safety-car plus flag laps over the race's laps, plus a margin, clamped."""
    part = list(part)
    total = laps.groupBy(*part).agg(F.max(seq).alias("_total"))
    if control is None:
        return total.select(*part, F.lit(default).alias("contamination"))
    # Distinct laps are found before they are counted, so a busy race is spread by lap.
    per_lap = (control.where(F.col("Lap").isNotNull()).groupBy(*part, "Lap")
               .agg(F.max(F.coalesce(F.col("is_safety_car"), F.lit(False)).cast("int")).alias("_sc"),
                    F.max(F.coalesce(F.col("is_flag"), F.lit(False)).cast("int")).alias("_fl")))
    n = per_lap.groupBy(*part).agg(F.sum(F.col("_sc") + F.col("_fl")).alias("_n"))
    out = total.join(n, part, "left") if part else total.join(F.broadcast(n))
    rate = F.col("_n") / F.col("_total") + margin
    return out.select(*part, F.when(F.col("_n").isNull(), F.lit(default))
                      .otherwise(F.least(F.lit(high), F.greatest(F.lit(low), rate))).alias("contamination"))
