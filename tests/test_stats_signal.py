"""Statistics and signal operators on small frames with known answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paceline.operators import prep, signal, stats, tiles
from paceline.operators.signal import _spline


def _df(spark, ys, key=1):
    return spark.createDataFrame([(key, i + 1, None if y is None else float(y)) for i, y in enumerate(ys)], "k int, pos long, v double")


def _values(df, col="v"):
    return [r[col] for r in df.orderBy("k", "pos").collect()]


def test_single_outlier_is_found(spark):
    rng = np.random.default_rng(1)
    rows = stats.statistical_features(_df(spark, [*rng.normal(90.5, 0.2, 14), 120.0]), "v").orderBy("pos").collect()
    assert rows[-1].is_outlier and not rows[0].is_outlier


def test_groups_keep_their_means(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), ("b", float("nan"))], "g string, v double")
    out = {(r.g, r.v): r for r in stats.statistical_features(d, "v", ["g"]).collect()}
    assert out["a", 1.0].group_mean == 2.0 and out["b", 10.0].group_mean == 10.0
    assert out["b", 10.0].z_score is None and not out["b", 10.0].is_outlier


def test_trend(spark):
    line = stats.degradation(_df(spark, [90 + 0.2 * i for i in range(10)]), "pos", "v", ["k"]).first()
    assert line.degradation_slope == pytest.approx(0.2) and line.degradation_r_squared == pytest.approx(1.0)
    flat = stats.degradation(_df(spark, [5.0] * 4), "pos", "v", ["k"]).first()
    assert flat.degradation_slope == 0.0 and flat.degradation_r_squared == 1.0
    assert stats.degradation(_df(spark, [5.0]), "pos", "v", ["k"]).first().degradation_slope is None


def test_describe_values_and_empty(spark):
    r = stats.describe(_df(spark, [1, 2, 3, 4, 5]), "v").first()
    assert (r.nobs, r.mean, r.min, r.max, r.variance) == (5, 3.0, 1.0, 5.0, 2.5)
    e = stats.describe(_df(spark, [1]).where("v > 5"), "v").first()
    assert e.nobs == 0 and e.mean is None and e.skewness is None


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError):
        stats.enrich(_df(spark, [1, 2]), "absent", ["k"])


def test_enrich_has_all_columns(spark):
    out = stats.enrich(_df(spark, range(10)), "v", ["k"], x="pos")
    assert {"z_score", "is_outlier", "degradation_slope", "group_nobs", "group_kurtosis"} <= set(out.columns)
    assert out.first().degradation_slope > 0


def test_median_filter_removes_a_spike(spark):
    assert _values(signal.median_filter(_df(spark, [1, 1, 50, 1, 1]), ["k"], "pos", ["v"], kernel=3)) == [1, 1, 1, 1, 1]
    assert _values(signal.median_filter(_df(spark, [4, 5, 6]), ["k"], "pos", ["v"], kernel=2)) == [4, 5, 5]


def test_gap_is_filled_before_filtering(spark):
    assert None not in _values(signal.median_filter(_df(spark, [1, None, 3, 4, 5]), ["k"], "pos", ["v"], kernel=3))


def test_savgol_keeps_cubics_and_lowers_noise(spark):
    x = np.arange(40)
    assert _values(signal.savgol(_df(spark, 0.01 * x ** 3 - x), ["k"], "pos", "v")) == pytest.approx((0.01 * x ** 3 - x).tolist(), abs=1e-6)
    noisy = np.sin(x / 6) + np.random.default_rng(3).normal(0, 0.3, 40)
    smooth = _values(signal.savgol(_df(spark, noisy), ["k"], "pos", "v"))
    assert np.var(np.diff(smooth)) < np.var(np.diff(noisy))


def test_savgol_on_short_signals(spark):
    assert _values(signal.savgol(_df(spark, [1, 2, 6, 4]), ["k"], "pos", "v")) == pytest.approx([0.5, 3.0, 4.0, 5.0])
    assert _values(signal.savgol(_df(spark, [1, 2]), ["k"], "pos", "v")) == [1, 2]


def test_derivatives(spark):
    assert _values(signal.derivative(_df(spark, range(8)), ["k"], "pos", "v", smooth=False), "v_derivative") == pytest.approx([1.0] * 8)
    x = np.arange(30)
    d = _values(signal.derivative(_df(spark, x ** 2), ["k"], "pos", "v"), "v_derivative")
    assert d == pytest.approx((2.0 * x).tolist(), abs=1e-6)
    assert _values(signal.derivative(_df(spark, [3]), ["k"], "pos", "v"), "v_derivative") == [None]
    assert _values(signal.derivative(_df(spark, [1, 3, 9]), ["k"], "pos", "v"), "v_derivative") == [2, 4, 6]


@pytest.mark.parametrize("method", ["median", "zscore"])
def test_outliers_are_replaced(spark, method):
    y = [float(10 + i % 3) for i in range(30)]
    y[12] = 500.0
    out = signal.remove_outliers(_df(spark, y), ["k"], "pos", "v", method=method).orderBy("pos").collect()
    assert [r.pos for r in out if r.is_outlier] == [13]
    assert out[12].v == pytest.approx((y[11] + y[13]) / 2)


def test_no_spread_means_no_outlier(spark):
    for method in ("median", "zscore"):
        assert not any(r.is_outlier for r in signal.remove_outliers(_df(spark, [2.0] * 6), ["k"], "pos", "v", method=method).collect())


def test_unknown_methods(spark):
    with pytest.raises(ValueError):
        signal.clean_signal(_df(spark, [1]), ["k"], "pos", "v", method="other")
    with pytest.raises(ValueError):
        signal.remove_outliers(_df(spark, [1]), ["k"], "pos", "v", method="other")
    with pytest.raises(ValueError):
        prep.scale(_df(spark, [1]), ["v"], "other")


def test_channel_pipeline(spark):
    y = [100.0 + i for i in range(40)]
    y[20] = 900.0
    d = _df(spark, y).withColumnRenamed("v", "Speed").withColumn("RPM", F.col("Speed"))
    out = signal.channel_pipeline(d, ["k"], "pos", ["Speed", "RPM"], derivatives=True)
    assert "Speed_derivative" in out.columns and "RPM_derivative" not in out.columns
    assert max(_values(out, "Speed")) < 200


def _samples(spark, x, y, key=1):
    return spark.createDataFrame([(key, float(a), None if b is None else float(b)) for a, b in zip(x, y)], "k int, x double, v double")


@pytest.mark.parametrize("lane_rows", [16, 4096])
def test_cubic_reproduces_cubics(spark, lane_rows):
    x = np.sort(np.random.default_rng(5).uniform(0, 100, 60))
    out = signal.resample_cubic(_samples(spark, x, 0.001 * x ** 3 - x), ["k"], "x", ["v"], 100.0, 21, lane_rows=lane_rows).orderBy("grid").collect()
    for r in out:
        at = min(max(r.x, x[0]), x[-1])
        assert r.v == pytest.approx(0.001 * at ** 3 - at, abs=1e-6)


def test_spline_stretches_agree_with_the_whole(spark):
    rng = np.random.default_rng(11)
    x = np.cumsum(rng.uniform(0.1, 5, 700))
    y = rng.normal(size=700)
    got = signal.resample_cubic(_samples(spark, x, y), ["k"], "x", ["v"], float(x[-1]), 300, lane_rows=100).orderBy("grid").collect()
    g = np.arange(300) * (x[-1] / 299)
    assert [r.v for r in got] == pytest.approx(_spline(x, y, np.clip(g, x[0], x[-1])).tolist(), abs=1e-8)


def test_resample_edges_gaps_and_errors(spark):
    d = _samples(spark, [10, 20, 20, 30], [1, 2, 9, None])
    lin = signal.resample_linear(d, ["k"], "x", ["v"], 40.0, 5).orderBy("grid").collect()
    assert [(r.x, r.v) for r in lin] == [(0, 1), (10, 1), (20, 2), (30, 2), (40, 2)]
    cub = signal.resample_cubic(d, ["k"], "x", ["v"], 40.0, 5).orderBy("grid").collect()
    assert [r.v for r in cub] == [r.v for r in lin]
    empty = signal.resample_linear(_samples(spark, [1, 2], [None, None]), ["k"], "x", ["v"], 10.0, 3)
    assert [r.v for r in empty.collect()] == [0, 0, 0]
    with pytest.raises(ValueError):
        signal.resample_linear(d, ["k"], "absent", ["v"], 40.0)
    with pytest.raises(ValueError):
        signal.resample_linear(d, ["k"], "x", ["absent"], 40.0)


def test_knn_impute_with_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(prep, "tile_pairs", lambda *a: tiles.tile_pairs(*a, tile_rows=9))
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 3))
    x[rng.random((60, 3)) < 0.2] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    d = spark.createDataFrame(rows, "id long, a double, b double, c double")
    got = {r.id: (r.a, r.b, r.c) for r in prep.knn_impute(d, "id", ["a", "b", "c"], k=4).collect()}
    for i in range(60):
        for j in range(3):
            if not np.isnan(x[i, j]):
                continue
            both = ~np.isnan(x) & ~np.isnan(x[i])
            n = both.sum(1)
            dist = np.sqrt(np.where(both, x - x[i], 0) ** 2 @ np.ones(3) * 3 / np.maximum(n, 1))
            ok = [m for m in np.argsort(dist, kind="stable") if m != i and n[m] and not np.isnan(x[m, j])][:4]
            # Without a donor the column mean is used.
            assert got[i][j] == pytest.approx(np.mean(x[ok, j]) if ok else np.nanmean(x[:, j]))


def test_one_hot_and_scaling_edges(spark):
    d = spark.createDataFrame([("b", 1.0, 1), ("a", 1.0, 0), (None, 1.0, 1)], "c string, v double, flag int")
    hot = prep.one_hot(d, ["c"])
    assert hot.columns == ["v", "flag", "c_a", "c_b"] and [r.c_a + r.c_b for r in hot.collect()].count(0) == 1
    assert prep.scalable_columns(d.withColumn("w", F.lit(3.0))) == ["w"]
    assert {r.v for r in prep.scale(d, ["v"], "robust").collect()} == {0.0}
    with pytest.raises(ValueError):
        prep.impute(d, ["v"], "other")
