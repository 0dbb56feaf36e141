"""Lanes, halos and slices give what plain windows give, however small the pieces."""

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paceline.operators import laps, signal
from paceline.operators.keyed import attach_stats, bounded_lists, group_quantiles
from paceline.operators.ordered import Scan, count_drops, fill_gaps, lane_of, nearest_known, prefix_scan
from paceline.roles import Roles

ROLES = Roles()


@pytest.fixture(scope="module")
def df(spark):
    rng = np.random.default_rng(7)
    rows = []
    # One entity holds most of the rows.
    for ent, n in ((1, 400), (2, 37), (3, 1)):
        for s in range(1, n + 1):
            v = float(rng.normal())
            rows.append((ent, s, None if rng.random() < 0.3 else v, float(rng.integers(1, 9)) if rng.random() < 0.8 else None))
    return spark.createDataFrame(rows, "entity long, seq long, measure double, age double").cache()


@pytest.mark.parametrize("lane", [1, 7, 1000])
@pytest.mark.parametrize("reverse", [False, True])
def test_prefix_scan(df, lane, reverse):
    m = F.col("measure")
    scans = [Scan("s", "sum", m), Scan("c", "count", m), Scan("l", "last", m), Scan("p", "prev", m),
             Scan("hi", "max", m), Scan("lo", "min", m)]
    got = prefix_scan(df, ["entity"], ["seq"], scans, lane_of("seq", lane), reverse)
    order = W.partitionBy("entity").orderBy(F.col("seq").desc() if reverse else "seq")
    w = order.rowsBetween(W.unboundedPreceding, 0)
    want = df.select("entity", "seq", F.sum(m).over(w).alias("s"), F.count(m).over(w).alias("c"), F.last(m, True).over(w).alias("l"),
                     F.lag(m).over(order).alias("p"), F.max(m).over(w).alias("hi"), F.min(m).over(w).alias("lo"))
    cols = ["s", "c", "l", "p", "hi", "lo"]
    a = {(r.entity, r.seq): [r[c] for c in cols] for r in got.collect()}
    b = {(r.entity, r.seq): [r[c] for c in cols] for r in want.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k]) if None not in a[k] + b[k] else [x is None for x in a[k]] == [x is None for x in b[k]]


@pytest.mark.parametrize("lane", [1, 5, 1000])
def test_count_drops(df, lane):
    got = {(r.entity, r.seq): r.d for r in count_drops(df, ["entity"], "seq", "age", "d", lane_of("seq", lane)).collect()}
    for ent in (1, 2, 3):
        drops, last = 0, None
        for r in df.where(F.col("entity") == ent).orderBy("seq").collect():
            if r.age is not None:
                drops += last is not None and r.age < last
                last = r.age
            assert got[ent, r.seq] == drops


@pytest.mark.parametrize("lane", [1, 6, 1000])
def test_fill_gaps(df, lane):
    got = {(r.entity, r.seq): r.measure for r in fill_gaps(df, ["entity"], "seq", ["measure"], lane).collect()}
    for ent in (1, 2):
        rows = df.where(F.col("entity") == ent).orderBy("seq").collect()
        y = np.array([np.nan if r.measure is None else r.measure for r in rows])
        ok = ~np.isnan(y)
        want = np.interp(np.arange(len(y)), np.flatnonzero(ok), y[ok])
        assert [got[ent, r.seq] for r in rows] == pytest.approx(want.tolist())


@pytest.mark.parametrize("lane", [1, 4])
def test_nearest_known_strict(df, lane):
    out = nearest_known(df, ["entity"], ["seq"], {"m": F.col("measure")}, lane_of("seq", lane), strict=True)
    w = W.partitionBy("entity").orderBy("seq")
    want = df.select("entity", "seq", F.last("measure", True).over(w.rowsBetween(W.unboundedPreceding, -1)).alias("m_b"),
                     F.first("measure", True).over(w.rowsBetween(1, W.unboundedFollowing)).alias("m_f"))
    cols = ["entity", "seq", "m_b", "m_f"]
    assert sorted(map(str, out.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))


@pytest.mark.parametrize("slices", [1, 3, 1024])
def test_quantiles_are_exact(df, slices):
    got = {r.entity: r for r in group_quantiles(df, ["entity"], "measure", {"a": 0.0, "b": 0.37, "c": 1.0}, slices).collect()}
    for ent in (1, 2):
        y = [r.measure for r in df.where(F.col("entity") == ent).collect() if r.measure is not None]
        assert [got[ent].a, got[ent].b, got[ent].c] == pytest.approx(np.quantile(y, [0, 0.37, 1]).tolist())


def test_quantiles_constant_and_empty(spark):
    one = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, None)], "k int, v double")
    assert [tuple(r) for r in group_quantiles(one, ["k"], "v", {"m": 0.5}).collect()] == [(1, 5.0)]
    assert group_quantiles(one.where("k > 9"), [], "v", {"m": 0.5}).count() == 0


def test_null_key_gets_null(spark):
    d = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "k string, v double")
    out = {r.k: r.m for r in attach_stats(d, ["k"], [F.avg("v").alias("m")]).collect()}
    assert out == {None: None, "a": 2.0}


def test_quantiles_with_an_outlier(spark):
    """The slices follow the ranks, so a far outlier leaves no slice with much of a large group."""
    from paceline.operators import keyed
    d = spark.range(60_000).select(F.lit(1).alias("g"), F.when(F.col("id") == 0, 1e12).otherwise(F.xxhash64("id") / 2.0 ** 63).alias("v"))
    d = d.unionByName(spark.range(7).select(F.lit(2).alias("g"), F.col("id").cast("double").alias("v")))
    got = {r.g: (r.a, r.m, r.z) for r in keyed.group_quantiles(d, ["g"], "v", {"a": 0.25, "m": 0.5, "z": 1.0}).collect()}
    want = {r.g: tuple(r.q) for r in d.groupBy("g").agg(F.percentile("v", [0.25, 0.5, 1.0]).alias("q")).collect()}
    assert got[1] == pytest.approx(want[1]) and got[2] == pytest.approx(want[2])
    borders = keyed._borders(d.select("g", F.col("v").alias("_v")), ["g"], "_v", {"m": 0.5}).where("g = 1").first()._b
    inside = d.where((F.col("g") == 1) & F.col("v").between(borders[1], borders[2])).count()
    assert 0 < inside < 200


def test_bounded_lists_split_big_groups(df):
    out = bounded_lists(df, ["entity"], ["seq"], F.col("seq"), "laps", rows=50).collect()
    assert max(len(r.laps) for r in out) <= 150
    assert sorted(x for r in out if r.entity == 1 for x in r.laps) == list(range(1, 401))
    assert [r.list_no for r in out if r.entity == 2] == [0]


def test_same_answer_with_any_partitioning(spark, df):
    seen = set()
    for n in (1, 7, 64):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows = laps.detect_stints(df, ROLES, lane_rows=16).collect()
        seen.add(tuple(sorted(map(str, rows))))
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert len(seen) == 1


@pytest.mark.parametrize("lane", [8, 1000])
def test_frames_with_small_lanes(df, lane):
    keys = ["entity"]
    for f in (lambda n: signal.median_filter(df, keys, "seq", ["measure"], lane_rows=n),
              lambda n: signal.savgol(df, keys, "seq", "measure", lane_rows=n),
              lambda n: signal.gradient(df.fillna(0.0, ["measure"]), keys, "seq", "measure", lane_rows=n),
              lambda n: laps.pit_stops(laps.detect_stints(df, ROLES), ROLES, lane_rows=n)):
        got = sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in f(lane).collect())
        want = sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in f(None).collect())
        assert got == want
