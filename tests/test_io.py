"""Sinks, sources, ingest, contracts and the analysis as a whole."""

import datetime

import pytest
from pyspark.sql import functions as F

from paceline.operators import contracts, runlog
from paceline.operators.analysis import run_analysis
from paceline.operators.control import classify_anomalies
from paceline.operators.domain import control_features, result_columns
from paceline.plans.views import laps
from paceline.roles import Roles
from paceline.sources import calendar, tables
from paceline.streaming import ingest


def test_partition_overwrite_keeps_other_races(spark, tmp_path):
    path = str(tmp_path / "t")
    d = spark.createDataFrame([(2024, 1, 1.0), (2024, 2, 2.0)], "year int, round int, v double")
    tables.write_table(d, path)
    tables.write_table(spark.createDataFrame([(2024, 2, 5.0)], "year int, round int, v double"), path)
    assert sorted((r.round, r.v) for r in spark.read.parquet(path).collect()) == [(1, 1.0), (2, 5.0)]


def test_artifacts(spark, tmp_path):
    d = spark.range(3)
    tables.write_artifact(d, "x.csv", str(tmp_path))
    tables.write_artifact(d, "x.parquet", str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "x.parquet")).count() == 3
    with pytest.raises(ValueError):
        tables.write_artifact(d, "x.xlsx", str(tmp_path))


def test_table_reader_turns_nan_into_null(spark, tmp_path):
    d = spark.createDataFrame([("VER", 1, float("nan"), 2024, 1)], "Driver string, LapNumber int, LapTime_seconds double, year int, round int")
    tables.write_table(d, str(tmp_path / "laps"))
    row = tables.read_table(spark, str(tmp_path), "laps").where("year = 2024").first()
    assert row.LapTime_seconds is None and row.Compound is None and row.Driver == "VER"


def test_calendar(spark, tmp_path):
    ts = datetime.datetime
    d = spark.createDataFrame([(1, "A", "X", "x", "testing", ts(2024, 1, 1), ts(2024, 1, 2), 2024),
                               (2, "B", "Y", "y", "sprint", ts(2024, 2, 1), ts(2024, 2, 2), 2024)],
                              "RoundNumber int, EventName string, Country string, Location string, EventFormat string, EventDate timestamp, Session5DateUtc timestamp, year int")
    assert [r.EventName for r in calendar.season(d).collect()] == ["B"]
    assert calendar.next_race(d, ts(2024, 1, 15)).first().event_name == "B"
    assert calendar.next_race(d, ts(2025, 1, 1)).count() == 0
    calendar.save(d, str(tmp_path / "cal"))
    assert spark.read.parquet(str(tmp_path / "cal")).count() == 2


def test_ingest_is_incremental_and_idempotent(spark, tmp_path):
    src, target, check = (str(tmp_path / n) for n in ("land", "bronze", "check"))
    one = spark.createDataFrame([(2024, 1, "A", 1), (2024, 1, "A", 1), (2024, 1, "B", 1)], "year int, round int, d string, lap int")
    two = spark.createDataFrame([(2024, 1, "B", 1), (2024, 2, "A", 1)], "year int, round int, d string, lap int")
    keys = ["year", "round", "d", "lap"]
    for batch in (one, two, None):
        if batch is not None:
            batch.write.mode("append").parquet(src)
        ingest.ingest(ingest.land_stream(spark, src, one.schema), target, check, keys).awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(target).select(*keys).collect()) == [
        (2024, 1, "A", 1), (2024, 1, "B", 1), (2024, 2, "A", 1)]


def test_ingest_reads_new_files_and_state_only(spark, tmp_path):
    src, target, check = (str(tmp_path / n) for n in ("land", "bronze", "check"))
    cols = "year int, round int, d string, lap int"
    rows = [(2024, r, d, lap) for r in (1, 2) for d in ("A", None) for lap in range(20)]
    spark.createDataFrame(rows * 2, cols).repartition(4).write.mode("append").parquet(src)
    keys = ["year", "round", "d", "lap"]
    ingest.ingest(ingest.land_stream(spark, src, cols), target, check, keys).awaitTermination()
    new = [*rows[:7], (2025, 1, "A", 1)]
    spark.createDataFrame(new, cols).coalesce(1).write.mode("append").parquet(src)
    q = ingest.ingest(ingest.land_stream(spark, src, cols), target, check, keys)
    q.awaitTermination()
    got = spark.read.parquet(target).select(*keys).collect()
    assert sorted(map(str, got)) == sorted(map(str, spark.createDataFrame([*rows, (2025, 1, "A", 1)], cols).collect()))
    # The one source is the landing folder, read once, and the keys of all runs are in the state.
    batches = [p for p in q.recentProgress if p.numInputRows]
    assert [len(p.sources) for p in batches] == [1] and batches[0].numInputRows == len(new)
    assert batches[0].stateOperators[0].numRowsTotal == len(rows) + 1


def test_ingest_replays_a_batch_that_was_not_committed(spark, tmp_path):
    """A failure between the files of a batch and its commit changes nothing after the restart."""
    src, target, check = (str(tmp_path / n) for n in ("land", "bronze", "check"))
    cols = "year int, round int, d string"
    spark.createDataFrame([(2024, 1, "A"), (2024, 1, "B")], cols).write.mode("append").parquet(src)
    ingest.ingest(ingest.land_stream(spark, src, cols), target, check, ["d"]).awaitTermination()
    spark.createDataFrame([(2024, 1, "B"), (2024, 2, "C")], cols).write.mode("append").parquet(src)
    ingest.ingest(ingest.land_stream(spark, src, cols), target, check, ["d"]).awaitTermination()
    last = sorted((tmp_path / "check" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))[-1]
    last.unlink()
    for crc in (tmp_path / "check" / "commits").glob(f".{last.name}.crc"):
        crc.unlink()
    ingest.ingest(ingest.land_stream(spark, src, cols), target, check, ["d"]).awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(target).select("year", "round", "d").collect()) == [
        (2024, 1, "A"), (2024, 1, "B"), (2024, 2, "C")]


def test_stateless_features_stream(spark, tmp_path):
    src = str(tmp_path / "rc")
    batch = spark.createDataFrame([("SAFETY CAR DEPLOYED", "SafetyCar", 3, 1.0)], "Message string, Category string, Lap int, Time_seconds double")
    batch.write.parquet(src)
    out, res = str(tmp_path / "out"), []
    s = control_features(spark.readStream.schema(batch.schema).parquet(src))
    s.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out).awaitTermination()
    res = spark.read.parquet(out).collect()
    assert len(res) == 1 and res[0].is_full_safety_car and res[0].event_severity == 2
    assert str(res[0].message) == control_features(batch).first().message


def test_process_races_reads_only_the_asked(spark, tmp_path):
    d = spark.createDataFrame([(2023, 1, 1.0), (2024, 1, 2.0), (2024, 3, 3.0)], "year int, round int, v double")
    paths = ingest.process_races({"laps": d}, [(2024, 3)], {}, str(tmp_path))
    assert [r.v for r in spark.read.parquet(paths["laps"]).collect()] == [3.0]


def test_contract_enforcement(spark):
    cols = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in (
        ("winner", "string"), ("loser", "string"), ("lap_time_drop_seconds", "double"), ("cliff_validated", "boolean"), ("positions_lost", "int"),
        ("time_gained_seconds", "double"), ("time_saved_seconds", "double"), ("deployed_on_lap", "bigint"), ("duration_laps", "bigint"),
        ("cause", "string"), ("reason", "string")))
    good = spark.sql(f"SELECT 'driver_error' AS type, 4L AS lap, 'VER' AS driver, {cols}")
    bad = spark.sql(f"SELECT 'undercut' AS type, 0L AS lap, 'VERSTAPPEN' AS driver, {cols}")
    assert contracts.enforce(good, contracts.event_rules()).count() == 1
    names = contracts.check(bad, contracts.event_rules()).first().violations
    assert {"lap", "driver_length", "missing_winner", "extra_driver"} <= set(names)
    ok, out = contracts.split(good.unionByName(bad), contracts.event_rules())
    assert ok.count() == 1 and out.count() == 1
    with pytest.raises(Exception, match="contract violated"):
        contracts.enforce(bad, contracts.event_rules()).collect()


def test_missing_inputs_have_defaults(spark):
    d = spark.createDataFrame([("x", 1)], "Abbreviation string, n int")
    r = result_columns(d).first()
    assert r.finish_status == 1 and r.dnf_category == "finished" and r.final_position is None and r.position_gain == 0
    z = spark.createDataFrame([("A", 1, True, -1.0), ("A", 2, True, 1.0)], "entity string, seq int, is_anomaly boolean, z_score double")
    assert [x.anomaly_cause for x in classify_anomalies(z, None, Roles()).orderBy("seq").collect()] == ["restart_fast", "driver_error"]


def test_run_log_rejects_unknown_kind(spark):
    with pytest.raises(ValueError):
        runlog.run_metrics(spark.range(1), "id", "other")


def test_analysis_tables(spark, sf_dir):
    src = laps(spark, sf_dir).where("entity < 6").select("entity", "seq", "measure", "age", "category", F.col("rank").alias("Position"))
    out = run_analysis(src, Roles(rank="Position"))
    assert {"laps_clustered", "laps_dense", "laps_anomalies", "tire_cliffs", "quality_scores", "executive_summary"} <= set(out)
    n = out["laps_processed"].count()
    assert out["laps_anomalies"].count() == n == out["laps_changepoints"].count()
    assert out["quality_scores"].where("quality_score BETWEEN 0 AND 1").count() == 6
    assert set(run_analysis(src, Roles(rank="Position"), kind="anomaly", entity=3)) == {
        "laps_processed", "laps_anomalies", "anomaly_metrics", "anomalies_summary"}
    with pytest.raises(ValueError):
        run_analysis(src, Roles(), kind="other")


def test_head_and_channels(spark):
    d = spark.createDataFrame([(1.0, 2.0)], "Speed double, other double")
    assert tables.channels(d) == ["Speed"] and tables.head(d, ["other"]).columns == ["other"]
