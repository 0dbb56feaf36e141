"""The numbering of laps: one lane for a user of ordinary size, minutes for a busy one, and the same laps."""

from paceline.plans import views


def test_lanes_follow_the_size_of_a_user(spark, sf_dir, monkeypatch):
    lanes, scan = [], views.prefix_scan

    def spied(df, keys, order, scans, lane):
        lanes.append(df.select(*keys, lane.alias("lane")).distinct().groupBy(*keys).count().agg({"count": "max"}).first()[0])
        return scan(df, keys, order, scans, lane)

    monkeypatch.setattr(views, "prefix_scan", spied)
    whole = views._build_laps(spark, sf_dir).collect()
    assert lanes[0] == 1
    monkeypatch.setattr(views, "BUSY", 0)
    minutes = views._build_laps(spark, sf_dir).collect()
    assert lanes[3] > 10
    assert sorted(map(str, whole)) == sorted(map(str, minutes)) and len(whole) > 500
