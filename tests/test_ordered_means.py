"""The mean that decides on a cause is added up in the order of the laps."""

import random

from paceline.operators import control
from paceline.operators.ordered import ordered_sums
from paceline.roles import Roles
from pyspark.sql import functions as F


def _added(values):
    out = 0.0
    for v in values:
        out += v
    return out


def _tied():
    """Laps whose mean is one of them, and where the order of addition decides on the side it falls to."""
    rnd = random.Random(5)
    while True:
        cents = [rnd.randrange(1000, 50000) for _ in range(69)]
        mean = round(sum(cents) / 69)
        cents[0] += 69 * mean - sum(cents)
        values = [c / 100 for c in [*cents, mean]]
        there, back = values[-1] - _added(values) / 70, values[-1] - _added(values[::-1]) / 70
        if (there < 0) != (back < 0):
            return values, there


def test_a_lap_at_the_mean_does_not_depend_on_the_order_of_rows(spark):
    values, side = _tied()
    rows = [("p", "a", i, v, True) for i, v in enumerate(values, 1)]
    for some in (rows, rows[::-1]):
        d = spark.createDataFrame(some, "part string, entity string, seq long, measure double, is_anomaly boolean").coalesce(1)
        z = control.anomaly_z(d, Roles(part=("part",)), "measure")
        last = control.classify_anomalies(z, None, Roles(part=("part",))).where("seq = 70").first()
        assert (last.z_score < 0) == (side < 0)
        assert last.anomaly_cause == ("restart_fast" if side < 0 else "driver_error")


def test_ordered_sums_over_lanes(spark):
    d = spark.range(1, 1001).select((F.col("id") % 3).alias("g"), "id").repartition(7)
    got = {r.g: r.t for r in ordered_sums(d, ["g"], "id", F.col("id") / 10, "t", lane_rows=64).collect()}
    assert {g: round(t, 6) for g, t in got.items()} == {g: round(sum(i / 10 for i in range(1, 1001) if i % 3 == g), 6) for g in range(3)}
