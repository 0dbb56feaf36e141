"""Nested documents for a report: race summary, entity profiles, agenda, context."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.functions.columns import lookup
from paceline.operators.control import DEPLOYED
from paceline.operators.keyed import bounded_lists, top_by
from paceline.operators.ordered import dense_position
from paceline.roles import Roles

# Names behind the driver codes, and the report's words for penalties and tyres.
DRIVER_NAMES = {
    "NOR": "Lando Norris", "VER": "Max Verstappen", "RUS": "George Russell", "HAM": "Lewis Hamilton",
    "LEC": "Charles Leclerc", "SAI": "Carlos Sainz", "PIA": "Oscar Piastri", "ALO": "Fernando Alonso",
    "STR": "Lance Stroll", "GAS": "Pierre Gasly", "ANT": "Andrea Kimi Antonelli", "TSU": "Yuki Tsunoda",
    "ALB": "Alexander Albon", "HUL": "Nico Hülkenberg", "OCO": "Esteban Ocon", "BEA": "Oliver Bearman",
    "LAW": "Liam Lawson", "BOR": "Gabriel Bortoleto", "DOO": "Jack Doohan", "HAD": "Isack Hadjar",
}
PENALTY_REASONS = {
    "Unsafe Release": "saída insegura do boxe", "Track Limits": "ultrapassagem dos limites de pista",
    "Speeding In Pit Lane": "excesso de velocidade no boxe", "Speeding in the Pit Lane": "excesso de velocidade no boxe",
    "Causing A Collision": "causar colisão", "Causing a Collision": "causar colisão", "Collision": "colisão",
    "Ignoring Blue Flags": "ignorar bandeiras azuis", "Crossing The White Line": "cruzar a linha branca",
    "Crossing the White Line": "cruzar a linha branca",
    "Driving Unnecessarily Slowly": "conduzir desnecessariamente devagar", "Blocking": "bloqueio em pista",
}
COMPOUND_NAMES = {"SOFT": "pneus macios", "MEDIUM": "pneus médios", "HARD": "pneus duros",
                  "INTERMEDIATE": "pneus intermediários", "WET": "pneus de chuva"}

OVERCUT_MAX_SECONDS = 20.0
LIMITED_DATA_SCORE = 0.5
INCIDENT_PATTERN = "(?i)(INCIDENT|COLLISION|CONTACT|ACCIDENT|CRASH)"

#: Items per agenda list; a race with more has several lists, in order.
AGENDA_ITEMS = 10_000


def full_name(code: str | Column, names: Mapping[str, str] = DRIVER_NAMES) -> Column:
    """'Name (CODE)', or the code alone when it is unknown."""
    c = F.col(code) if isinstance(code, str) else code
    known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.upper(c)]
    return F.coalesce(F.concat(known, F.lit(" ("), c, F.lit(")")), c)


def with_dimension(df: DataFrame, dim: DataFrame, code: str, name: str, out: str) -> DataFrame:
    """Translate a code by a dimension table of any size; unknown codes stay as they are."""
    d = dim.select(F.col(code).alias(code), F.col(name).alias("_name"))
    return df.join(d, code, "left").withColumn(out, F.coalesce("_name", code)).drop("_name")


def _per(df: DataFrame, part: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*part).agg(*aggs)


def weather_summary(weather: DataFrame, part: Sequence[str]) -> DataFrame:
    """(part, weather): condition dry, mixed or wet, mean temperatures, any rain."""
    rain = F.coalesce(F.bool_or("Rainfall"), F.lit(False))
    wet = F.avg(F.col("Rainfall").cast("int")) > 0.5
    condition = F.when(rain & wet, "wet").when(rain, "mixed").otherwise("dry")
    return _per(weather, part, F.struct(
        condition.alias("condition"), F.bround(F.avg("AirTemp"), 1).alias("air_temp_avg_c"),
        F.bround(F.avg("TrackTemp"), 1).alias("track_temp_avg_c"), rain.alias("had_rainfall")).alias("weather"))


def race_summary(results: DataFrame, laps: DataFrame, control: DataFrame, weather: DataFrame, roles: Roles,
                 gap: str | None = None) -> DataFrame:
    """One row per race (and list of non-finishers): winner, laps, fastest lap, podium, DNFs, weather.

    ``gap`` names a column with the gap text; without it lapped cars show laps, and the gap of others
    is not known. ``list_no`` is 0 unless the list of
    non-finishers is so long that it is split.
    """
    part = list(roles.part)
    code = F.substring("Abbreviation", 1, 3)
    pos = F.col("final_position")
    text = F.when(pos == 1, "0.000").when(F.trim("Status") == "Lapped", F.format_string("+%d lap(s)", (pos - 1).cast("int")))
    entry = F.struct(pos.cast("int").alias("position"), code.alias("driver"), F.col("TeamName").alias("team"),
                     (F.col(gap) if gap else text).alias("gap_to_leader"))
    # Three places at most are kept per race before anything is collected.
    top3 = top_by(results.where(pos.isin(1, 2, 3)), part, [pos.asc(), F.col("Abbreviation").asc()], 3)
    podium = top3.groupBy(*part).agg(F.sort_array(F.collect_list(entry)).alias("podium"))
    winner = _per(results.where(pos == 1), part, F.min(code).alias("winner"))
    valid = F.col(roles.measure) > 0
    per_lap = _per(laps, part, F.max(roles.seq).cast("int").alias("total_laps"),
                   F.min(F.when(valid, F.struct(F.col(roles.measure).alias("t"), F.col(roles.entity).alias("d"),
                                                F.col(roles.seq).alias("s")))).alias("_fast"))
    last = laps.groupBy(*part, F.substring(F.col(roles.entity), 1, 3).alias("_d")).agg(F.max(roles.seq).cast("int").alias("_last"))
    out = results.where(F.col("finish_status") != 1).select(*part, code.alias("_d")).join(last, [*part, "_d"], "left")
    dnfs = bounded_lists(out, part, ["_d"], F.struct(F.col("_d").alias("driver"), F.col("_last").alias("on_lap")), "dnfs")
    cars = _per(control, part, F.count_if(F.contains(F.coalesce("Message", F.lit("")), F.lit(DEPLOYED)))
                .cast("int").alias("safety_car_count"))
    doc = per_lap
    for t in (winner, podium, dnfs, cars, weather_summary(weather, part)):
        doc = doc.join(t, part, "left")
    none = F.struct(F.lit("dry").alias("condition"), F.lit(0.0).alias("air_temp_avg_c"),
                    F.lit(0.0).alias("track_temp_avg_c"), F.lit(False).alias("had_rainfall"))
    won = F.coalesce("winner", F.lit("UNK"))
    return doc.select(
        *part, F.coalesce("list_no", F.lit(0)).cast("long").alias("list_no"), "total_laps", won.alias("winner"),
        F.coalesce(F.substring(F.col("_fast.d"), 1, 3), won).alias("fastest_lap_driver"),
        F.coalesce(F.bround("_fast.t", 3), F.lit(0.0)).alias("fastest_lap_time"),
        F.coalesce("podium", F.array().cast(podium.schema["podium"].dataType)).alias("podium"),
        F.coalesce("dnfs", F.array().cast(dnfs.schema["dnfs"].dataType)).alias("dnfs"),
        F.coalesce("safety_car_count", F.lit(0)).alias("safety_car_count"), F.coalesce("weather", none).alias("weather"))


def cluster_shares(clustered: DataFrame, keys: Sequence[str], semantic: str = "cluster_semantic") -> DataFrame:
    """(keys, push, base, degraded): share of labelled rows per meaning, absent ones 0."""
    lab = F.col(semantic)
    n = F.count(lab)
    return clustered.groupBy(*keys).agg(*[
        F.coalesce(F.count_if(lab == s) / F.when(n > 0, n), F.lit(0.0)).alias(f"{s}_pct") for s in ("push", "base", "degraded")])


def compound_usage(laps: DataFrame, keys: Sequence[str], category: str, seq: str) -> DataFrame:
    """(keys, compounds_used): laps per compound in name order; rows without compound are left out."""
    per = laps.where(F.col(category).isNotNull()).groupBy(*keys, category).agg(F.count(seq).cast("int").alias("laps"))
    return per.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(category).alias("compound"), "laps")))
                                  .alias("compounds_used"))


def entity_profiles(results: DataFrame, clustered: DataFrame, laps: DataFrame, anomalies: DataFrame, cliffs: DataFrame,
                    roles: Roles) -> DataFrame:
    """One profile per classified entity, joined from the per-entity summaries with defaults."""
    keys, ent = roles.keys, roles.entity
    base = results.select(*roles.part, F.substring("Abbreviation", 1, 3).alias(ent), F.col("TeamName").alias("team"),
                          F.col("final_position").cast("int").alias("final_position"),
                          F.col("grid_position").cast("int").alias("grid_position"),
                          F.coalesce(F.col("points").cast("double"), F.lit(0.0)).alias("points"))
    out = (base.join(cluster_shares(clustered, keys), keys, "left")
           .join(compound_usage(laps, keys, roles.category, roles.seq), keys, "left")
           .join(anomalies.select(*keys, "anomalies_count"), keys, "left")
           .join(cliffs.select(*keys, "stints_with_cliff"), keys, "left"))
    unknown = F.array(F.struct(F.lit("UNKNOWN").alias("compound"), F.lit(1).alias("laps")))
    n = F.coalesce("stints_with_cliff", F.lit(0)).cast("int")
    return out.select(
        *roles.part, F.col(ent).alias("driver"), "team", "final_position", "grid_position",
        F.coalesce(F.col("grid_position") - F.col("final_position"), F.lit(0)).alias("positions_gained"), "points",
        *[F.bround(F.coalesce(c, F.lit(0.0)), 3).alias(c) for c in ("push_pct", "base_pct", "degraded_pct")],
        F.coalesce("compounds_used", unknown).alias("compounds_used"), (n > 0).alias("had_tire_cliff"),
        n.alias("cliff_count"), F.coalesce("anomalies_count", F.lit(0)).cast("int").alias("anomaly_count"))


def compounds_text(used: str) -> Column:
    names = F.create_map(*[F.lit(x) for kv in COMPOUND_NAMES.items() for x in kv])

    def one(c: Column) -> Column:
        raw = F.upper(c["compound"])
        return F.concat(F.coalesce(names[raw], F.lower(raw)), F.lit(" ("), c["laps"].cast("string"), F.lit(" voltas)"))

    return F.when(F.size(used) > 0, F.array_join(F.transform(used, one), " → ")).otherwise("desconhecido")


def drivers_section(profiles: DataFrame, scores: DataFrame | None, part: Sequence[str]) -> DataFrame:
    """(part, driver code, driver): compact struct per profile; marks cliffs and thin data."""
    keys = [*part, "driver"]
    p = profiles.join(scores.select(*keys, "quality_score"), keys, "left") if scores is not None else \
        profiles.withColumn("quality_score", F.lit(None).cast("double"))
    entry = F.struct(full_name("driver").alias("driver"), "team", F.col("grid_position").alias("grid"),
                     F.col("final_position").alias("finish"), F.col("positions_gained").alias("delta"),
                     compounds_text("compounds_used").alias("compounds"),
                     F.when(F.col("had_tire_cliff"), F.lit(True)).alias("queda_abrupta_pneu"),
                     F.when(F.col("quality_score") < LIMITED_DATA_SCORE, F.lit(True)).alias("dados_limitados"))
    return p.select(*part, F.col("driver").alias("code"), entry.alias("driver"))


def race_section(summary: DataFrame, part: Sequence[str]) -> DataFrame:
    """(part, list_no, race): the race as a compact struct with formatted texts."""
    w = F.col("weather")
    text = F.concat(w["condition"], F.when(w["had_rainfall"], ", chuva").otherwise(", sem chuva"), F.lit(", ar "),
                    w["air_temp_avg_c"].cast("string"), F.lit("°C, pista "), w["track_temp_avg_c"].cast("string"), F.lit("°C"))
    podium = F.transform("podium", lambda e: F.struct(e["position"].alias("pos"), full_name(e["driver"]).alias("driver"),
                                                      e["team"].alias("team"), e["gap_to_leader"].alias("gap")))
    fastest = F.concat(full_name("fastest_lap_driver"), F.lit(" — "), F.col("fastest_lap_time").cast("string"), F.lit("s"))
    return summary.select(*part, "list_no", F.struct(
        full_name("winner").alias("winner"), podium.alias("podium"), "total_laps",
        F.col("safety_car_count").alias("safety_cars"), fastest.alias("fastest_lap"), text.alias("weather")).alias("race"))


def format_event() -> Column:
    """The event as JSON in the report's words, by kind."""
    t = F.col("type")
    lap = F.col("lap")

    def doc(kind: str, *fields: Column) -> Column:
        return F.to_json(F.struct(lap.alias("lap"), F.lit(kind).alias("type"), *fields))

    pilot = full_name("driver").alias("piloto")
    moves = [full_name("winner").alias("vencedor"), full_name("loser").alias("perdedor")]
    cause = F.when(F.col("cause") != "", F.col("cause")).alias("causa")
    return (F.when(t == "driver_error", doc("erro_piloto", pilot, cause))
            .when(t == "retirement", doc("abandono", pilot, cause))
            .when(t == "tire_dropoff", doc("queda_de_pneu", pilot, F.coalesce("cliff_validated", F.lit(False)).alias("confirmado"),
                                           F.when(F.col("positions_lost") != 0, F.col("positions_lost")).alias("posicoes_perdidas")))
            .when(t == "undercut", doc("undercut", *moves, F.bround("time_gained_seconds", 2).alias("ganho_s")))
            .when(t == "overcut", doc("overcut", *moves, F.bround("time_saved_seconds", 2).alias("vantagem_s")))
            .when(t == "safety_car", doc("safety_car", F.col("duration_laps").alias("duracao_voltas"), cause))
            .when(t == "penalty", doc("penalidade", pilot, lookup("reason", PENALTY_REASONS).alias("motivo"))))


def narrative_events(events: DataFrame, control: DataFrame | None, part: Sequence[str], list_rows: int = 10_000) -> DataFrame:
    """(part, lap, event): report events with external incidents thinned out.

    Incidents under or next to a safety car are dropped. Several on one lap become one event when a
    message of that lap confirms it, or when there are no messages at all; otherwise each stands alone.
    """
    part = list(part)
    keys = [*part, "lap"]
    ext = events.where(F.col("type") == "external_incident")
    start = F.coalesce("deployed_on_lap", "lap")
    # Safety cars that end together are nested, so the earliest start covers the others.
    spans = (events.where(F.col("type") == "safety_car")
             .groupBy(*part, (start + F.coalesce("duration_laps", F.lit(1))).alias("_end")).agg(F.min(start).alias("_start")))
    covered = spans.select(*part, F.explode(F.sequence(F.greatest(F.lit(1).cast("long"), F.col("_start") - 1),
                                                       F.col("_end"))).alias("lap")).distinct()
    ext = ext.join(covered, keys, "left_anti")
    per_lap = ext.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if control is not None:
        ok = (control.where(F.coalesce("Message", F.lit("")).rlike(INCIDENT_PATTERN) & F.col("Lap").isNotNull())
              .select(*part, F.col("Lap").cast("long").alias("lap")).distinct().withColumn("_ok", F.lit(True)))
        per_lap = per_lap.join(ok, keys, "left")
    else:
        per_lap = per_lap.withColumn("_ok", F.lit(True))
    ext = ext.join(per_lap, keys).withColumn("_merge", (F.col("_n") > 1) & F.coalesce("_ok", F.lit(False)))
    single = ext.where(~F.col("_merge")).select(*keys, F.to_json(F.struct(
        "lap", F.lit("incidente_externo").alias("type"), full_name("driver").alias("piloto"))).alias("event"))
    lists = bounded_lists(ext.where("_merge"), keys, ["driver"], full_name("driver"), "pilotos", list_rows)
    merged = lists.select(*keys, F.to_json(F.struct("lap", F.lit("incidente_multiplo").alias("type"), "pilotos")).alias("event"))
    rest = events.where(F.col("type") != "external_incident").select(*keys, format_event().alias("event"))
    return rest.unionByName(single).unionByName(merged)


def agenda_items(events: DataFrame, part: Sequence[str]) -> DataFrame:
    """(part, lap, kind, item): safety cars, penalties and retirements that must be told.

    A retirement counts as the cause of a safety car on its deployment lap, or one lap later when
    the deployment lap itself has none. Others inside a safety-car period are left out.
    """
    part = list(part)
    sc = events.where(F.col("type") == "safety_car")
    start = F.coalesce("deployed_on_lap", "lap")
    cars = sc.select(*part, F.col("lap"), F.lit(1).alias("kind"), F.format_string(
        "Safety Car volta %d (duração: %d voltas)", F.col("lap"), F.coalesce("duration_laps", F.lit(1))).alias("item"))
    pens = events.where(F.col("type") == "penalty").select(*part, "lap", F.lit(2).alias("kind"), F.concat(
        F.lit("Penalidade: "), full_name("driver"), F.lit(" volta "), F.col("lap").cast("string"), F.lit(" — "),
        lookup("reason", PENALTY_REASONS)).alias("item"))
    spans = sc.groupBy(*part, start.alias("_start")).agg(F.max(F.coalesce("duration_laps", F.lit(1))).alias("_dur"))
    retired = events.where(F.col("type") == "retirement").select(*part, "lap", full_name("driver").alias("_who"))
    with_ret = retired.select(*part, F.col("lap").alias("_start")).distinct().withColumn("_has", F.lit(True))
    lone = spans.join(with_ret, [*part, "_start"], "left")
    cause = (spans.select(*part, F.col("_start").alias("lap"))
             .unionByName(lone.where(F.col("_has").isNull()).select(*part, (F.col("_start") + 1).alias("lap")))
             .distinct().withColumn("_cause", F.lit(True)))
    nested = (spans.groupBy(*part, (F.col("_start") + F.col("_dur")).alias("_end")).agg(F.min("_start").alias("_start"))
              .where(F.col("_end") - F.col("_start") > 1))
    inside = (nested.select(*part, F.explode(F.sequence(F.col("_start") + 1, F.col("_end") - 1)).alias("lap"))
              .distinct().withColumn("_in", F.lit(True)))
    laps = (retired.select(*part, "lap").distinct().join(cause, [*part, "lap"], "left").join(inside, [*part, "lap"], "left")
            .where(F.col("_cause").isNotNull() | F.col("_in").isNull()))
    names = bounded_lists(retired.join(laps.select(*part, "lap"), [*part, "lap"], "left_semi"), [*part, "lap"], ["_who"],
                          F.col("_who"), "_names")
    outs = names.join(laps, [*part, "lap"]).select(*part, "lap", F.lit(3).alias("kind"), F.concat(
        F.lit("Abandono de "), F.array_join("_names", ", "), F.lit(" (volta "), F.col("lap").cast("string"), F.lit(")"),
        F.when(F.col("_cause"), " — causou o Safety Car").otherwise("")).alias("item"))
    return cars.unionByName(pens).unionByName(outs)


def best_moves(events: DataFrame, part: Sequence[str]) -> DataFrame:
    """(part, rank, item): the three largest undercuts and the two smallest overcuts.

    Overcuts of up to twenty seconds are preferred; larger ones count only where there is no other.
    """
    part = list(part)
    tie = [F.col("lap"), F.col("winner"), F.col("loser")]
    under = top_by(events.where(F.col("type") == "undercut"), part, [F.col("time_gained_seconds").desc(), *tie], 3)
    over = events.where(F.col("type") == "overcut")
    small = F.col("time_saved_seconds") <= OVERCUT_MAX_SECONDS
    # The two best of either class are enough to decide, so classes are ranked before they are compared.
    two = top_by(over.withColumn("_small", small), [*part, "_small"], [F.col("time_saved_seconds"), *tie], 2)
    real = two.where("_small").select(*part).distinct()
    chosen = two.where("_small").unionByName(two.where("NOT _small").join(real, part, "left_anti"))

    def text(kind: str, value: str) -> Column:
        return F.concat(F.lit(f"{kind}: "), full_name("winner"), F.lit(" sobre "), full_name("loser"), F.lit(" (volta "),
                        F.col("lap").cast("string"), F.lit(", +"), F.bround(value, 1).cast("string"), F.lit("s)"))

    return (under.select(*part, F.col("_rn").alias("rank"), text("Undercut", "time_gained_seconds").alias("item"))
            .unionByName(chosen.select(*part, (F.col("_rn") + 3).alias("rank"), text("Overcut", "time_saved_seconds").alias("item"))))


def highlights(summary: DataFrame, part: Sequence[str]) -> DataFrame:
    """(part, list_no, items): podium and non-finishers as texts."""
    podium = F.transform("podium", lambda p: F.concat(full_name(p["driver"]), F.lit(" — P"), p["position"].cast("string")))
    outs = F.transform("dnfs", lambda d: F.concat(full_name(d["driver"]), F.lit(" — abandono volta "),
                                                  F.coalesce(d["on_lap"].cast("string"), F.lit("None"))))
    return summary.select(*part, "list_no", F.when(F.col("list_no") == 0, F.concat(podium, outs)).otherwise(outs).alias("items"))


def must_cover(events: DataFrame, summary: DataFrame, part: Sequence[str]) -> DataFrame:
    """(part, list_no, must_cover): the agenda as three lists of texts.

    List 0 holds the first items of the race (all of them, ordinarily); more continue in lists 1, 2, ...
    """
    part = list(part)
    keys = [*part, "list_no"]

    def listed(df: DataFrame, no: Column, order: Sequence[str], name: str) -> DataFrame:
        item = F.struct(*order, "item")
        return (df.withColumn("list_no", no.cast("long")).groupBy(*keys)
                .agg(F.transform(F.sort_array(F.collect_list(item)), lambda s: s["item"]).alias(name)))

    numbered = dense_position(agenda_items(events, part), part, ["lap", "kind", "item"], F.col("lap"), "_no")
    dev = listed(numbered, F.floor((F.col("_no") - 1) / AGENDA_ITEMS), ["_no"], "desenvolvimento")
    tech = listed(best_moves(events, part), F.lit(0), ["rank"], "analise_tecnica")
    high = highlights(summary, part).withColumnRenamed("items", "destaques_individuais")
    out = high.join(dev, keys, "full").join(tech, keys, "full")
    none = F.array().cast("array<string>")
    return out.select(*keys, F.struct(*[F.coalesce(c, none).alias(c) for c in (
        "desenvolvimento", "analise_tecnica", "destaques_individuais")]).alias("must_cover"))


def context_json(summary: DataFrame, profiles: DataFrame, events: DataFrame, scores: DataFrame | None,
                 part: Sequence[str]) -> DataFrame:
    """(part, list_no, context): everything a report needs as one minified JSON document per race."""
    part = list(part)
    clash = [c for c in part if c in ("race", "drivers", "must_cover")]
    if clash:
        # The document has fields of these names, so the key columns step aside while it is built.
        new = {c: f"{c}_key" for c in clash}
        tables = [t if t is None else t.withColumnsRenamed(new) for t in (summary, profiles, events, scores)]
        return context_json(*tables, [new.get(c, c) for c in part]).withColumnsRenamed({v: k for k, v in new.items()})
    keys = [*part, "list_no"]
    drivers = bounded_lists(drivers_section(profiles, scores, part), part, ["code"], F.col("driver"), "drivers")
    out = (race_section(summary, part).join(drivers, keys, "full").join(must_cover(events, summary, part), keys, "full"))
    return out.select(*keys, F.to_json(F.struct("race", "drivers", "must_cover")).alias("context"))
