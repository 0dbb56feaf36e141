"""Descriptive statistics, z-scores and trend fits per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.operators.keyed import attach_stats

OUTLIER_Z = 3.0


def clean_number(c: str | Column) -> Column:
    """NaN means missing, so it becomes NULL before any aggregate sees it."""
    col = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(col), col)


def _require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def description(value: Column, prefix: str = "") -> list[Column]:
    """count, mean, sample variance, population skewness, excess kurtosis, min and max."""
    return [
        F.count(value).alias(f"{prefix}nobs"),
        F.avg(value).alias(f"{prefix}mean"),
        F.var_samp(value).alias(f"{prefix}variance"),
        F.when(F.stddev_pop(value) > 0, F.skewness(value)).alias(f"{prefix}skewness"),
        F.when(F.stddev_pop(value) > 0, F.kurtosis(value)).alias(f"{prefix}kurtosis"),
        F.min(value).alias(f"{prefix}min"),
        F.max(value).alias(f"{prefix}max"),
    ]


def trend(y: Column, x: Column, prefix: str = "degradation_") -> list[Column]:
    """Least-squares line of y over x: slope, r squared, intercept; NULL below two points.

    A constant y has slope 0 and r squared 1 by definition here.
    """
    n = F.regr_count(y, x)
    flat = F.min(F.when(x.isNotNull(), y)) == F.max(F.when(x.isNotNull(), y))
    spread = F.regr_sxx(y, x) > 0
    ok = (n >= 2) & spread
    return [
        F.when(ok, F.when(flat, F.lit(0.0)).otherwise(F.regr_slope(y, x))).alias(f"{prefix}slope"),
        F.when(ok, F.when(flat, F.lit(1.0)).otherwise(F.regr_r2(y, x))).alias(f"{prefix}r_squared"),
        F.when(ok, F.regr_intercept(y, x)).alias(f"{prefix}intercept"),
    ]


def describe(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row of :func:`description` per group, or for the whole table."""
    _require(df, value, *keys)
    aggs = description(clean_number(value))
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def group_trend(df: DataFrame, x: str, y: str, keys: Sequence[str]) -> DataFrame:
    """One fitted line per group."""
    _require(df, x, y, *keys)
    aggs = trend(clean_number(y), clean_number(x))
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def _z_columns(value: Column) -> list[Column]:
    z = (value - F.col("_mean")) / F.when(F.col("_sd0") > 0, F.col("_sd0"))
    return [z.alias("z_score"),
            F.coalesce(F.abs(z) > OUTLIER_Z, F.lit(False)).alias("is_outlier")]


def _z_aggs(value: Column) -> list[Column]:
    return [F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_sd0"),
            F.stddev_samp(value).alias("group_std")]


def statistical_features(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Append z_score, is_outlier, group_mean, group_std."""
    _require(df, value, *keys)
    v = clean_number(value)
    out = attach_stats(df, keys, _z_aggs(v))
    return out.select(*df.columns, *_z_columns(v), F.col("_mean").alias("group_mean"), "group_std")


def degradation(df: DataFrame, x: str, y: str, keys: Sequence[str]) -> DataFrame:
    """Append the trend of the row's group."""
    _require(df, x, y, *keys)
    return attach_stats(df, keys, trend(clean_number(y), clean_number(x)))


def enrich(df: DataFrame, value: str, keys: Sequence[str], *, x: str | None = None) -> DataFrame:
    """z-score, trend and description of the row's group, from a single aggregation pass."""
    _require(df, value, *keys, *([x] if x else []))
    v = clean_number(value)
    aggs = _z_aggs(v) + (trend(v, clean_number(x)) if x else []) + description(v, "group_")
    out = attach_stats(df, keys, aggs)
    names = ["group_std", *(["degradation_slope", "degradation_r_squared", "degradation_intercept"]
                            if x else []),
             "group_nobs", "group_mean", "group_variance", "group_skewness", "group_kurtosis",
             "group_min", "group_max"]
    return out.select(*df.columns, *_z_columns(v), *names)
