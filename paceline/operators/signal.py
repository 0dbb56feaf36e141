"""Sensor channels: resampling, gap filling, smoothing, derivatives, outliers.

A channel is a column of a long table with a dense position per group. Bounded frames run in lanes
with a halo, so a group of any length is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.operators.keyed import attach_quantiles, attach_stats
from paceline.operators.ordered import (LANE, Scan, dense_position, drop_halo, fill_gaps, nearest_known,
                                        prefix_scan, with_halo)
from paceline.operators.stats import clean_number
from paceline.operators.tiles import map_packed, pack
from paceline.session import stage

GRID_POINTS = 5000
MEDIAN_KERNEL = 5
SAVGOL_KERNEL = 11
SAVGOL_ORDER = 3
OUTLIER_THRESHOLD = 3.0
DERIVED_CHANNELS = ("Speed", "Throttle", "Brake")

#: Knots per spline task, and knots borrowed from each neighbour. The influence of a knot on the
#: curve falls at least by half per knot, so 64 are below the precision of a double.
SPLINE_LANE = 4096
SPLINE_HALO = 64


def distance(df: DataFrame, keys: Sequence[str], time: str = "Time_seconds", speed: str = "Speed",
             lane_seconds: float = 600.0, ties: Sequence[str] = ()) -> DataFrame:
    """Append Distance: running sum of speed (km/h) / 3.6 times the time since the sample before.

    Samples of the same time follow each other in the order of the columns ``ties``.
    """
    lane, order = F.floor(F.col(time) / lane_seconds).cast("long"), [time, *ties]
    stepped = prefix_scan(df, keys, order, [Scan("_prev", "prev", F.col(time))], lane)
    step = F.col(speed) / 3.6 * (F.col(time) - F.coalesce("_prev", F.lit(0.0)))
    return prefix_scan(stepped, keys, order, [Scan("Distance", "sum", step)], lane).drop("_prev")


def axis_length(df: DataFrame, part: Sequence[str], x: str = "Distance", default: float = 5000.0) -> DataFrame:
    """(part, track_length): largest distance of any entity of the part."""
    return df.groupBy(*part).agg(F.coalesce(F.max(clean_number(x)), F.lit(default)).alias("track_length"))


def _check(df: DataFrame, x: str, channels: Sequence[str]) -> list[str]:
    if x not in df.columns:
        raise ValueError(f"position column {x!r} not found")
    found = [c for c in channels if c in df.columns]
    if not found:
        raise ValueError(f"none of the channels {list(channels)} found")
    return found


def _samples(df: DataFrame, keys: Sequence[str], x: str, channels: Sequence[str]) -> DataFrame:
    """One sample per position: the smallest known value of each channel, where a position repeats."""
    return (df.select(*keys, clean_number(x).alias("_x"), *[clean_number(c).alias(c) for c in channels]).where(F.col("_x").isNotNull())
            .groupBy(*keys, "_x").agg(*[F.min(c).alias(c) for c in channels]))


def _grid(points: int, length: float) -> Column:
    return F.col("grid") * F.lit(length / max(points - 1, 1))


def resample_linear(df: DataFrame, keys: Sequence[str], x: str, channels: Sequence[str], length: float,
                    points: int = GRID_POINTS, lanes: int = 16) -> DataFrame:
    """Channels on a uniform grid 0..length, linear between samples, held at the ends, 0 if all NULL.

    Samples and grid points are merged in order of x; the neighbours of a grid point are the latest
    sample before and the first after it.
    """
    channels = _check(df, x, channels)
    keys = list(keys)
    samples = _samples(df, keys, x, channels)
    grid = (df.select(*keys).distinct().withColumn("grid", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
            .withColumn("_x", _grid(points, length)))
    merged = (samples.withColumn("grid", F.lit(-1)).unionByName(grid, allowMissingColumns=True))
    known = {c: F.when((F.col("grid") < 0) & F.col(c).isNotNull(), F.struct(F.col("_x").alias("p"), F.col(c).alias("v")))
             for c in channels}
    lane = F.floor(F.col("_x") / F.lit(length / lanes)).cast("long")
    near = nearest_known(merged, keys, ["_x", "grid"], known, lane).where(F.col("grid") >= 0)
    outs = []
    for c in channels:
        b, f = F.col(f"{c}_b"), F.col(f"{c}_f")
        line = F.when(f["p"] > b["p"], b["v"] + (f["v"] - b["v"]) * (F.col("_x") - b["p"]) / (f["p"] - b["p"])) \
            .otherwise(b["v"])
        outs.append(F.coalesce(F.when(b.isNotNull() & f.isNotNull(), line), b["v"], f["v"], F.lit(0.0)).alias(c))
    return near.select(*keys, "grid", F.col("_x").alias(x), *outs)


def _spline(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Cubic through the knots with a continuous third derivative at the second and last but one knot."""
    n = len(x)
    h = np.diff(x)
    slope = np.diff(y) / h
    # Tridiagonal system for the second derivatives at the inner knots; the end conditions are
    # folded into its first and last row.
    low, diag, up = h[:-1].copy(), 2 * (h[:-1] + h[1:]), h[1:].copy()
    rhs = 6 * np.diff(slope)
    diag[0] += h[0] * (h[0] + h[1]) / h[1]
    up[0] -= h[0] ** 2 / h[1]
    diag[-1] += h[-1] * (h[-1] + h[-2]) / h[-2]
    low[-1] -= h[-1] ** 2 / h[-2]
    for i in range(1, n - 2):
        w = low[i] / diag[i - 1]
        diag[i] -= w * up[i - 1]
        rhs[i] -= w * rhs[i - 1]
    m = np.zeros(n)
    for i in range(n - 3, -1, -1):
        m[i + 1] = (rhs[i] - (up[i] * m[i + 2] if i < n - 3 else 0.0)) / diag[i]
    m[0] = m[1] + (m[1] - m[2]) * h[0] / h[1]
    m[-1] = m[-2] + (m[-2] - m[-3]) * h[-1] / h[-2]
    j = np.clip(np.searchsorted(x, at, side="right") - 1, 0, n - 2)
    a, b = x[j + 1] - at, at - x[j]
    return ((m[j] * a ** 3 + m[j + 1] * b ** 3) / (6 * h[j])
            + (y[j] / h[j] - m[j] * h[j] / 6) * a + (y[j + 1] / h[j] - m[j + 1] * h[j] / 6) * b)


def resample_cubic(df: DataFrame, keys: Sequence[str], x: str, channels: Sequence[str], length: float,
                   points: int = GRID_POINTS, lane_rows: int = SPLINE_LANE) -> DataFrame:
    """Channels on a uniform grid by cubic spline (linear below four samples), held at the ends.

    Every task solves one stretch of at most ``lane_rows`` knots plus the halo and evaluates the
    grid points of its own stretch.
    """
    channels = _check(df, x, channels)
    keys = list(keys)
    samples = _samples(df, keys, x, channels)
    long = samples.select(*keys, "_x", F.explode(F.array(*[
        F.struct(F.lit(c).alias("channel"), F.col(c).alias("y")) for c in channels])).alias("_c")
    ).select(*keys, "_x", "_c.*").where(F.col("y").isNotNull())
    ck = [*keys, "channel"]
    knots = dense_position(long, ck, ["_x"], F.floor(F.col("_x") / F.lit(length / 16)).cast("long"), "_pos")
    halo = with_halo(knots, "_pos", SPLINE_HALO, SPLINE_HALO, lane_rows)
    key_fields = [f for f in long.schema.fields if f.name in ck]
    schema = T.StructType([*key_fields, T.StructField("grid", T.IntegerType()), T.StructField("y", T.DoubleType())])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos")
        own, lane = pdf["_own_lane"].to_numpy(), pdf[LANE].iloc[0]
        kx, ky = pdf["_x"].to_numpy(), pdf["y"].to_numpy()
        if not (own == lane).any():
            return pd.DataFrame({f.name: [] for f in schema.fields})
        start = -np.inf if lane == 0 else kx[own == lane][0]
        end = kx[own > lane][0] if (own > lane).any() else np.inf
        g = np.arange(points) * (length / max(points - 1, 1))
        mine = np.flatnonzero((g >= start) & (g < end))
        at = np.clip(g[mine], kx[0], kx[-1])
        val = np.interp(at, kx, ky) if len(kx) < 4 else _spline(kx, ky, at)
        out = {k: [pdf[k].iloc[0]] * len(mine) for k in ck}
        return pd.DataFrame({**out, "grid": mine.astype("int32"), "y": val})

    solved = map_packed(pack(halo, [*ck, LANE], "h:"), [*ck, LANE], ["h:"], solve, schema)
    wide = solved.groupBy(*keys, "grid").agg(*[
        F.coalesce(F.max(F.when(F.col("channel") == c, F.col("y"))), F.lit(0.0)).alias(c) for c in channels])
    return wide.select(*keys, "grid", _grid(points, length).alias(x), *channels)


def resample_laps(df: DataFrame, keys: Sequence[str], lap: str, x: str, channels: Sequence[str], length: float,
                  points: int = GRID_POINTS, cubic: bool = False) -> DataFrame:
    """One row per (keys, lap) with an array of ``points`` values per channel."""
    resample = resample_cubic if cubic else resample_linear
    flat = resample(df, [*keys, lap], x, channels, length, points)

    def ordered(c: str) -> Column:
        return F.transform(F.sort_array(F.collect_list(F.struct("grid", F.col(c).alias("v")))), lambda s: s["v"])

    return flat.groupBy(*keys, lap).agg(*[ordered(c).alias(f"{c}_sync") for c in channels if c in flat.columns])


def signal_delta(grid: DataFrame, entity: str, a, b, channel: str, part: Sequence[str] = ()) -> DataFrame:
    """Largest, smallest and mean difference of a channel between two entities on the same grid."""
    pick = {n: grid.where(F.col(entity) == F.lit(e)).select(*part, "grid", F.col(channel).alias(n))
            for n, e in (("_a", a), ("_b", b))}
    diff = pick["_a"].join(pick["_b"], [*part, "grid"]).withColumn("d", F.col("_a") - F.col("_b"))
    return diff.groupBy(*part).agg(F.max("d").alias("max_delta"), F.min("d").alias("min_delta"),
                                   F.avg("d").alias("mean_delta"), F.count("d").alias("points"))


def _odd(kernel: int) -> int:
    return kernel + 1 if kernel % 2 == 0 else kernel


def median_filter(df: DataFrame, keys: Sequence[str], pos: str, columns: Sequence[str], kernel: int = MEDIAN_KERNEL,
                  lane_rows: int | None = None) -> DataFrame:
    """Median of the ``kernel`` rows around, with zeros beyond both ends. Gaps are filled before."""
    k = _odd(kernel)
    h = k // 2
    src = fill_gaps(df, keys, pos, columns, lane_rows)
    near = with_halo(src, pos, h, h, lane_rows)
    w = W.partitionBy(*keys, LANE).orderBy(pos).rowsBetween(-h, h)
    cols = {}
    for c in columns:
        seen = F.collect_list(c).over(w)
        padded = F.concat(seen, F.array_repeat(F.lit(0.0), F.lit(k) - F.size(seen)))
        cols[c] = F.when(F.col(c).isNotNull(), F.get(F.sort_array(padded), F.lit(h))).alias(c)
    keep = [*df.columns, LANE, "_own_lane"]
    return drop_halo(near.select(*[cols.get(c, F.col(c)) for c in keep]))


def _fit_weights(k: int, order: int, deriv: int, delta: float) -> np.ndarray:
    """Row i: weights of the k window values for the fitted value (or slope) at window place i."""
    place = np.arange(k, dtype=float)
    basis = np.vander(place, order + 1, increasing=True)
    fit = np.linalg.pinv(basis)
    if deriv == 0:
        at = basis
    else:
        at = np.zeros_like(basis)
        for p in range(1, order + 1):
            at[:, p] = p * place ** (p - 1)
    return at @ fit / (delta ** deriv)


def _dot(values: Column, weights: Sequence[float]) -> Column:
    products = F.zip_with(values, F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def _smooth(df: DataFrame, keys: Sequence[str], pos: str, column: str, out: str, k: int, order: int, deriv: int,
            delta: float, short: str, lane_rows: int | None) -> DataFrame:
    """Local polynomial value or slope. The half windows at both ends use the first and last full window."""
    h = k // 2
    counted = attach_stats(df, keys, [F.count(F.lit(1)).alias("_len")])
    near = with_halo(counted, pos, k - 1, k - 1, lane_rows)
    by = W.partitionBy(*keys, LANE).orderBy(pos)
    near = near.withColumn("_win", F.collect_list(column).over(by.rowsBetween(-(k - 1), k - 1)))
    n, p = F.col("_len"), F.col(pos)
    before = F.least(p - 1, F.lit(k - 1))
    weights = _fit_weights(k, order, deriv, delta)
    mid = _dot(F.slice("_win", (before - h + 1).cast("int"), F.lit(k)), weights[h])
    head, tail = F.slice("_win", F.lit(1), F.lit(k)), F.slice("_win", F.lit(-k), F.lit(k))
    value = F.when((p > h) & (p <= n - h), mid)
    for i in range(h):
        value = value.when(p == i + 1, _dot(head, weights[i])).when(p == n - h + i + 1, _dot(tail, weights[k - h + i]))
    if short == "line3":
        # Too short for the kernel: straight line through three rows, or the row itself below three.
        w3 = _fit_weights(3, 1, 0, 1.0)
        prev, nxt = F.lag(column).over(by), F.lead(column).over(by)
        tri = F.when(p == 1, _dot(F.slice("_win", 1, 3), w3[0])).when(p == n, _dot(F.slice("_win", -3, 3), w3[2])) \
            .otherwise((prev + F.col(column) + nxt) / 3)
        other = F.when(n >= 3, tri).otherwise(F.col(column))
    else:
        other = _gradient(column, p, n, by, delta)
    return drop_halo(near.withColumn(out, F.when(n >= k, value).otherwise(other)).drop("_win", "_len"))


def _kernel(kernel: int, order: int) -> int:
    k = _odd(kernel)
    return _odd(order + 2) if k <= order else k


def savgol(df: DataFrame, keys: Sequence[str], pos: str, column: str, kernel: int = SAVGOL_KERNEL,
           order: int = SAVGOL_ORDER, lane_rows: int | None = None) -> DataFrame:
    """Savitzky-Golay smoothing of a column (Savitzky and Golay 1964). Gaps are filled before."""
    src = fill_gaps(df, keys, pos, [column], lane_rows)
    out = _smooth(src, keys, pos, column, "_s", _kernel(kernel, order), order, 0, 1.0, "line3", lane_rows)
    return out.withColumn(column, F.col("_s")).drop("_s")


def clean_signal(df: DataFrame, keys: Sequence[str], pos: str, column: str, method: str = "median", **options) -> DataFrame:
    """Median filter or Savitzky-Golay smoothing by name."""
    if method == "median":
        return median_filter(df, keys, pos, [column], **options)
    if method == "savgol":
        return savgol(df, keys, pos, column, **options)
    raise ValueError(f"unknown method {method!r}, use 'median' or 'savgol'")


def _gradient(column: str, p: Column, n: Column, by, delta: float) -> Column:
    prev, nxt, own = F.lag(column).over(by), F.lead(column).over(by), F.col(column)
    return (F.when(n < 2, F.lit(None).cast("double")).when(p == 1, (nxt - own) / delta)
            .when(p == n, (own - prev) / delta).otherwise((nxt - prev) / (2 * delta)))


def gradient(df: DataFrame, keys: Sequence[str], pos: str, column: str, delta: float = 1.0,
             lane_rows: int | None = None, out: str | None = None) -> DataFrame:
    """Append the central difference, one-sided at the ends; NULL for a single row."""
    counted = attach_stats(df, keys, [F.count(F.lit(1)).alias("_len")])
    near = with_halo(counted, pos, 1, 1, lane_rows)
    by = W.partitionBy(*keys, LANE).orderBy(pos)
    name = out or f"{column}_derivative"
    return drop_halo(near.withColumn(name, _gradient(column, F.col(pos), F.col("_len"), by, delta)).drop("_len"))


def derivative(df: DataFrame, keys: Sequence[str], pos: str, column: str, delta: float = 1.0, smooth: bool = True,
               kernel: int = SAVGOL_KERNEL, order: int = SAVGOL_ORDER, lane_rows: int | None = None) -> DataFrame:
    """Append ``<column>_derivative``: smoothed slope, or the plain gradient when short or unsmoothed."""
    if not smooth:
        return gradient(df, keys, pos, column, delta, lane_rows)
    return _smooth(df, keys, pos, column, f"{column}_derivative", _kernel(kernel, order), order, 1, delta,
                   "gradient", lane_rows)


def _replace(df: DataFrame, keys: Sequence[str], pos: str, columns: Sequence[str], lane_rows: int | None) -> DataFrame:
    """Replace rows flagged in ``_o_<c>`` by linear interpolation over the others."""
    kept = df
    for c in columns:
        kept = kept.withColumn(f"_r_{c}", F.when(~F.col(f"_o_{c}"), F.col(c)))
    full = fill_gaps(kept, keys, pos, [f"_r_{c}" for c in columns], lane_rows)
    for c in columns:
        full = full.withColumn(c, F.when(F.col(f"_o_{c}"), F.coalesce(f"_r_{c}", c)).otherwise(F.col(c)))
    return full.drop(*[f"_r_{c}" for c in columns])


def zscore_outliers(df: DataFrame, keys: Sequence[str], pos: str, column: str, threshold: float = OUTLIER_THRESHOLD,
                    lane_rows: int | None = None) -> DataFrame:
    """Replace values more than ``threshold`` population deviations off; append is_outlier."""
    v = clean_number(column)
    out = attach_stats(df, keys, [F.avg(v).alias("_m"), F.stddev_pop(v).alias("_s")])
    flag = F.coalesce((F.col("_s") > 0) & (F.abs((v - F.col("_m")) / F.col("_s")) > threshold), F.lit(False))
    done = _replace(out.withColumn(f"_o_{column}", flag), keys, pos, [column], lane_rows)
    return done.select(*df.columns, F.col(f"_o_{column}").alias("is_outlier"))


def _flag_mad(df: DataFrame, keys: Sequence[str], column: str, threshold: float) -> DataFrame:
    with_med = attach_quantiles(df, keys, column, {f"_med_{column}": 0.5})
    off = F.abs(F.col(column) - F.col(f"_med_{column}"))
    # The deviations are read by several branches of the second quantile, so they are written once.
    with_med = stage(with_med.withColumn(f"_off_{column}", off), "deviations")
    with_mad = attach_quantiles(with_med, keys, f"_off_{column}", {f"_mad_{column}": 0.5})
    mad = F.col(f"_mad_{column}")
    flag = F.coalesce((mad > 0) & (0.6745 * F.col(f"_off_{column}") / mad > threshold), F.lit(False))
    return with_mad.select(*df.columns, flag.alias(f"_o_{column}"))


def mad_outliers(df: DataFrame, keys: Sequence[str], pos: str, column: str, threshold: float = OUTLIER_THRESHOLD,
                 lane_rows: int | None = None) -> DataFrame:
    """Replace values far off in units of the median absolute deviation; append is_outlier."""
    done = _replace(_flag_mad(df, keys, column, threshold), keys, pos, [column], lane_rows)
    return done.select(*df.columns, F.col(f"_o_{column}").alias("is_outlier"))


def remove_outliers(df: DataFrame, keys: Sequence[str], pos: str, column: str, method: str = "median", **options) -> DataFrame:
    """Outlier replacement by name: 'median' (MAD) or 'zscore'."""
    if method == "median":
        return mad_outliers(df, keys, pos, column, **options)
    if method == "zscore":
        return zscore_outliers(df, keys, pos, column, **options)
    raise ValueError(f"unknown method {method!r}, use 'median' or 'zscore'")


def channel_pipeline(df: DataFrame, keys: Sequence[str], pos: str, channels: Sequence[str], *, outliers: bool = True,
                     noise: bool = True, derivatives: bool = False, derived: Sequence[str] = DERIVED_CHANNELS,
                     lane_rows: int | None = None) -> DataFrame:
    """Outlier replacement, median filter and slope for every channel."""
    channels = [c for c in channels if c in df.columns]
    out = df
    if outliers:
        for c in channels:
            out = _flag_mad(out, keys, c, OUTLIER_THRESHOLD)
        out = stage(_replace(out, keys, pos, channels, lane_rows).select(*df.columns), "channels")
    if noise:
        out = median_filter(out, keys, pos, channels, lane_rows=lane_rows)
    if derivatives:
        for c in channels:
            if c in derived:
                out = derivative(out, keys, pos, c, lane_rows=lane_rows)
    return out
