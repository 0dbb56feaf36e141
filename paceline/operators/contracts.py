"""Rules that rows must meet before they leave the pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds of timeline events, the words of the weather summary and the least
# lengths of the report sections.
EVENT_TYPES = ["driver_error", "external_incident", "tire_dropoff", "undercut", "overcut", "safety_car",
               "penalty", "retirement"]
CONDITIONS = ["dry", "wet", "mixed"]
SECTION_LENGTHS = {"titulo": 10, "lead": 50, "narrativa": 150, "destaques": 50, "conclusao": 20}

# Which fields each kind of event must have, and which it may have besides.
REQUIRED = {
    "driver_error": ["driver"], "external_incident": ["driver"],
    "tire_dropoff": ["driver", "lap_time_drop_seconds", "cliff_validated"],
    "undercut": ["winner", "loser", "time_gained_seconds"], "overcut": ["winner", "loser", "time_saved_seconds"],
    "safety_car": ["deployed_on_lap", "duration_laps"], "penalty": ["driver", "reason"], "retirement": ["driver"],
}
OPTIONAL = {"tire_dropoff": ["positions_lost"], "safety_car": ["cause"], "retirement": ["cause"]}
EVENT_FIELDS = ["driver", "winner", "loser", "lap_time_drop_seconds", "cliff_validated", "positions_lost",
                "time_gained_seconds", "time_saved_seconds", "deployed_on_lap", "duration_laps", "cause", "reason"]


def _when_type(kinds: list[str], rule: Column) -> Column:
    return ~F.col("type").isin(kinds) | rule


def event_rules() -> dict[str, Column]:
    rules = {"lap": F.col("lap") > 0, "type": F.col("type").isin(EVENT_TYPES)}
    for c in ("driver", "winner", "loser"):
        rules[f"{c}_length"] = F.col(c).isNull() | (F.length(c) == 3)
    rules["lap_time_drop_seconds"] = F.col("lap_time_drop_seconds").isNull() | (F.col("lap_time_drop_seconds") > 0)
    rules["deployed_on_lap"] = F.col("deployed_on_lap").isNull() | (F.col("deployed_on_lap") > 0)
    rules["duration_laps"] = F.col("duration_laps").isNull() | (F.col("duration_laps") >= 1)
    for field in EVENT_FIELDS:
        needs = [k for k, f in REQUIRED.items() if field in f]
        may = needs + [k for k, f in OPTIONAL.items() if field in f]
        if needs:
            rules[f"missing_{field}"] = _when_type(needs, F.col(field).isNotNull())
        rules[f"extra_{field}"] = F.col("type").isin(may) | F.col(field).isNull()
    return rules


def summary_rules() -> dict[str, Column]:
    podium = F.col("podium")
    return {
        "total_laps": F.col("total_laps") > 0, "winner": F.length("winner") == 3,
        "fastest_lap_driver": F.length("fastest_lap_driver") == 3, "fastest_lap_time": F.col("fastest_lap_time") > 0,
        "podium_size": F.size(podium).between(1, 3),
        "podium_position": F.forall(podium, lambda p: p["position"].between(1, 3)),
        "podium_driver": F.forall(podium, lambda p: F.length(p["driver"]) == 3),
        "dnf_driver": F.forall("dnfs", lambda d: F.length(d["driver"]) == 3),
        "safety_car_count": F.col("safety_car_count") >= 0, "condition": F.col("weather.condition").isin(CONDITIONS),
    }


def profile_rules() -> dict[str, Column]:
    rules = {f"{c}": F.col(c).between(0, 1) for c in ("push_pct", "base_pct", "degraded_pct")}
    return {"driver": F.length("driver") == 3, "points": F.col("points") >= 0, **rules,
            "compounds": F.size("compounds_used") >= 1,
            "compound_laps": F.forall("compounds_used", lambda c: c["laps"] > 0),
            "cliff_count": F.col("cliff_count") >= 0, "anomaly_count": F.col("anomaly_count") >= 0}


def report_rules() -> dict[str, Column]:
    return {c: F.length(c) >= n for c, n in SECTION_LENGTHS.items()}


def check(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Append violations: names of the rules a row breaks; an unknown outcome is a violation."""
    broken = [F.when(F.coalesce(rule, F.lit(False)), F.lit(None).cast("string")).otherwise(F.lit(name))
              for name, rule in rules.items()]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def split(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their violations)."""
    checked = check(df, rules)
    return checked.where(F.size("violations") == 0).drop("violations"), checked.where(F.size("violations") > 0)


def enforce(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows unchanged; the first violating row fails the job."""
    checked = check(df, rules)
    message = F.concat(F.lit("contract violated: "), F.array_join("violations", ", "))
    return checked.where(F.when(F.size("violations") == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))) \
        .drop("violations")
