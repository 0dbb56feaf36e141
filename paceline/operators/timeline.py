"""One validated table of everything that happened in a race, and its JSON form."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.operators import contracts
from paceline.operators.control import narrative_anomalies, penalty_events, retirement_events, safety_car_events
from paceline.roles import Roles

_TYPES = {"driver": "string", "winner": "string", "loser": "string", "lap_time_drop_seconds": "double",
          "cliff_validated": "boolean", "positions_lost": "int", "time_gained_seconds": "double",
          "time_saved_seconds": "double", "deployed_on_lap": "bigint", "duration_laps": "bigint", "cause": "string",
          "reason": "string"}


def positions_lost(cliffs: DataFrame, laps: DataFrame, roles: Roles, window: int = 3) -> DataFrame:
    """Append positions_lost: median rank after minus before the cliff, where positive.

    At most ``window`` laps on either side are looked up, each by an equi-join.
    """
    keys = roles.keys
    steps = F.array(*[F.lit(s) for s in range(-window, window + 1) if s])
    asked = cliffs.select(*keys, "cliff_lap", F.explode(steps).alias("_step")).distinct()
    asked = asked.withColumn(roles.seq, F.col("cliff_lap") + F.col("_step"))
    seen = asked.join(laps.select(*roles.row_keys, F.col(roles.rank).cast("double").alias("_rank")), roles.row_keys)
    med = seen.groupBy(*keys, "cliff_lap").agg(
        F.percentile(F.when(F.col("_step") < 0, F.col("_rank")), 0.5).alias("_b"),
        F.percentile(F.when(F.col("_step") > 0, F.col("_rank")), 0.5).alias("_a"))
    lost = F.bround(F.col("_a") - F.col("_b")).cast("int")
    med = med.select(*keys, "cliff_lap", F.when(lost > 0, lost).alias("positions_lost"))
    return cliffs.join(med, [*keys, "cliff_lap"], "left")


def _events(df: DataFrame, part: Sequence[str], kind: Column, lap: str, **fields: Column) -> DataFrame:
    given = {n: c.cast(_TYPES[n]) for n, c in fields.items()}
    return df.select(*part, kind.alias("type"), F.col(lap).cast("bigint").alias("lap"),
                     *[given.get(n, F.lit(None).cast(t)).alias(n) for n, t in _TYPES.items()])


def build_timeline(roles: Roles, *, anomalies: DataFrame | None = None, cliffs: DataFrame | None = None,
                   undercuts: DataFrame | None = None, overcuts: DataFrame | None = None,
                   control: DataFrame | None = None, results: DataFrame | None = None,
                   laps: DataFrame | None = None, order: str = "seq") -> DataFrame:
    """All events of all races as one table; sources that are absent are skipped. Not yet validated."""
    part = list(roles.part)
    short = F.substring(F.col(roles.entity).cast("string"), 1, 3)
    parts = []
    if anomalies is not None:
        a = narrative_anomalies(anomalies, roles)
        parts.append(_events(a, part, F.col("type"), "lap", driver=F.col("driver")))
    if cliffs is not None:
        c = cliffs.where(F.col("has_cliff") & (F.col("cliff_delta_magnitude") > 0))
        c = positions_lost(c, laps, roles) if laps is not None and roles.rank in laps.columns else \
            c.withColumn("positions_lost", F.lit(None).cast("int"))
        parts.append(_events(c, part, F.lit("tire_dropoff"), "cliff_lap", driver=short,
                             lap_time_drop_seconds=F.col("cliff_delta_magnitude"),
                             cliff_validated=F.col("cliff_validated"), positions_lost=F.col("positions_lost")))
    for moves, kind, field in ((undercuts, "undercut", "time_gained_seconds"), (overcuts, "overcut", "time_saved_seconds")):
        if moves is not None:
            parts.append(_events(moves, part, F.lit(kind), "lap", winner=F.substring(F.col("driver").cast("string"), 1, 3),
                                 loser=F.substring(F.col("target_driver").cast("string"), 1, 3), **{field: F.col(field)}))
    if control is not None:
        s = safety_car_events(control, part, order)
        parts.append(_events(s, part, F.lit("safety_car"), "lap", deployed_on_lap=F.col("deployed_on_lap"),
                             duration_laps=F.col("duration_laps"), cause=F.col("cause")))
        if "is_penalty" in control.columns:
            p = penalty_events(control, part)
            parts.append(_events(p, part, F.lit("penalty"), "lap", driver=F.col("driver"), reason=F.col("reason")))
    if results is not None and laps is not None:
        r = retirement_events(results, laps, control, part, None, roles.entity, roles.seq, order)
        parts.append(_events(r, part, F.lit("retirement"), "lap", driver=F.col("driver"), cause=F.col("cause")))
    return reduce(DataFrame.unionByName, parts)


def type_rank() -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in contracts.EVENT_TYPES]), F.col("type"))


def validated(events: DataFrame) -> DataFrame:
    """The timeline, or a failed job when any event breaks a rule."""
    return contracts.enforce(events, contracts.event_rules())


def in_order(events: DataFrame, part: Sequence[str]) -> DataFrame:
    """Chronological order for the sink: lap, kind, driver."""
    who = F.coalesce("driver", "winner", F.lit(""))
    return events.orderBy(*part, "lap", type_rank(), who, F.coalesce("loser", F.lit("")))


def event_counts(events: DataFrame, part: Sequence[str] = ()) -> DataFrame:
    return events.groupBy(*part, "type").agg(F.count(F.lit(1)).alias("n"))


def to_json_rows(events: DataFrame, part: Sequence[str]) -> DataFrame:
    """(part, lap, type, event): one JSON object per event, absent fields left out."""
    fields = ["lap", "type", *_TYPES]
    return events.select(*part, "lap", "type", F.to_json(F.struct(*fields)).alias("event"))
