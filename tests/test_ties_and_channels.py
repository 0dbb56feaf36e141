"""Positions and times that repeat, and gains at the least that counts."""

from paceline.operators import signal, strategy
from paceline.roles import Roles
from paceline.sources import tables


def test_each_channel_takes_its_own_smallest_value_where_a_position_repeats(spark):
    rows = [("a", 0.0, 5.0, 9.0), ("a", 0.0, None, 7.0), ("a", 0.0, 4.0, 8.0), ("a", 10.0, 6.0, 1.0)]
    d = spark.createDataFrame(rows, "g string, x double, Speed double, Throttle double")
    first = signal.resample_linear(d, ["g"], "x", ["Speed", "Throttle"], 10.0, 2).where("grid = 0").first()
    assert (first.Speed, first.Throttle) == (4.0, 7.0)


def test_samples_of_one_time_follow_the_given_order(spark):
    rows = [(1, 3, 20.0, 1.0), (1, 2, 20.0, 72.0), (1, 1, 10.0, 36.0)]
    d = spark.createDataFrame(rows, "entity int, seq int, Time_seconds double, Speed double")
    for part in (d, d.orderBy("Speed"), d.orderBy("seq")):
        out = tables.normalize_telemetry(part.coalesce(1), ["entity"], ties=["seq"])
        assert {(r.Speed, round(r.Distance, 6)) for r in out.collect()} == {(36.0, 100.0), (72.0, 300.0), (1.0, 300.0)}


def test_sums_between_stops_do_not_depend_on_the_laps_before(spark):
    rows = [("a", n, 1, 0.1 if n < 40 else 0.3, n, 1, "S") for n in range(1, 60)]
    d = spark.createDataFrame(rows, "entity string, seq long, run int, measure double, age int, rank int, category string")
    got = {r.seq: float(r.s_next) for r in strategy.strategy_base(d, Roles()).collect()}
    assert got[38] == 3.9 and got[58] == 9.9
