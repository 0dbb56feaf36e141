"""Pieces of messages that are no code asked for never reach an aggregation, and messages do not travel with pieces."""

from paceline.operators import control


def test_messages_do_not_travel_with_their_pieces(spark, monkeypatch):
    plans = {}
    write = control.stage

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(control, "stage", spy)
    retired = spark.createDataFrame([(1, "ABC", 5), (1, "XYZ", 9), (1, "QQQ", 30)], "race int, driver string, on_lap long")
    msgs = spark.createDataFrame([(1, 4, 7, "CAR 3 (ABC) SLOW "), (1, 5, 3, "CAR 8 (ABD) RETIRED"), (1, 6, 3, "LAP OF ABC"),
                                  (1, 9, 8, "NOTHING"), (1, 10, 9, "XY"), (1, 10, 12, " BY XYZ"), (1, 20, 1, "QQQ")],
                                 "race int, Lap int, seq int, Message string")
    got = {r["driver"]: r["cause"] for r in control.retirement_causes(retired, msgs, ["race"]).collect()}
    # Of two messages with one place in the order the one of the earlier lap counts.
    assert got == {"ABC": "CAR 8 (ABD) RETIRED", "XYZ": "BY XYZ", "QQQ": None}
    assert not [line for line in plans["firsts"].splitlines() if "Aggregate" in line and "Message" in line]
