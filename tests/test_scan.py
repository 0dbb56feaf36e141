"""Filters of a landed table reach the scan, whatever NaN and NULL it holds."""

from pyspark.sql import functions as F

from paceline.sources import tables


def test_filters_reach_the_scan(spark, tmp_path):
    rows = [("A", 1, 90.0, 2023, 1), ("A", 2, float("nan"), 2023, 1), ("A", 3, None, 2023, 2), ("B", 4, -1.0, 2024, 1), ("B", 5, 95.0, 2024, 1)]
    d = spark.createDataFrame(rows, "Driver string, LapNumber int, LapTime_seconds double, year int, round int")
    tables.write_table(d, f"{tmp_path}/laps")
    got = tables.read_table(spark, str(tmp_path), "laps", [("LapTime_seconds", ">", 0.0)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(LapTime_seconds,0.0)" in plan.split("PushedFilters")[1]
    assert sorted(r.LapNumber for r in got.collect()) == [1, 5]
    for filters in ([("LapTime_seconds", "<", 92.0)], [("LapTime_seconds", "!=", 90.0)], [("year", "in", [2024]), ("LapTime_seconds", ">=", 95.0)], [("LapTime_seconds", "<=", float("inf"))]):
        plain = tables.read_table(spark, str(tmp_path), "laps")
        for c, op, v in filters:
            plain = plain.where(F.col(c).isin(v) if op == "in" else F.expr(f"{c} {op} double('{v}')"))
        assert sorted(r.LapNumber for r in tables.read_table(spark, str(tmp_path), "laps", filters).collect()) == sorted(r.LapNumber for r in plain.collect())
    assert tables.read_table(spark, str(tmp_path), "laps").where("LapTime_seconds IS NULL").count() == 2
