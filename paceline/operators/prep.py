"""Preparing a feature table: imputation, one-hot columns, scaling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.operators.keyed import attach_stats, group_quantiles, top_by
from paceline.operators.nearest import Cells, neighbours
from paceline.operators.stats import clean_number
from paceline.operators.tiles import TILE_ROWS, plain, tile_pairs
from paceline.session import stage

_NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in _NUMERIC or t.startswith("decimal")]


def _attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(stats, list(keys), "left") if keys else df.join(F.broadcast(stats))


def _quantile_table(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                    probs: dict[str, float]) -> DataFrame:
    """One row per group (or one row) with ``<column>_<name>`` for every column and quantile.

    The columns are stacked and searched together, so their number does not add shuffles.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_val")) for c in columns])
    long = df.select(*keys, F.explode(cells).alias("_cell")).select(*keys, "_cell.*")
    q = group_quantiles(long, [*keys, "_col"], "_val", probs, few=not keys)
    wide = [F.max(F.when(F.col("_col") == c, F.col(n))).alias(f"{c}_{n}") for c in columns for n in probs]
    return q.groupBy(*keys).agg(*wide) if keys else q.agg(*wide)


def most_frequent(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """(keys, value): the most frequent value, the smallest of several."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_c"))
    best = F.max_by(column, F.struct(F.col("_c"), -F.col(column).cast("double"))).alias(f"{column}_fill")
    return counts.groupBy(*keys).agg(best) if keys else counts.agg(best)


def impute(df: DataFrame, columns: Sequence[str] | None = None, strategy: str = "mean",
           keys: Sequence[str] = ()) -> DataFrame:
    """Replace NULL and NaN by the column's mean, median or most frequent value."""
    columns = [c for c in (columns or numeric_columns(df)) if c in df.columns and c not in keys]
    if not columns:
        return df
    if strategy == "mean":
        out = attach_stats(df, keys, [F.avg(clean_number(c)).alias(f"{c}_fill") for c in columns])
    elif strategy == "median":
        clean = df.select(*keys, *[clean_number(c).alias(c) for c in columns])
        out = _attach(df, _quantile_table(clean, keys, columns, {"fill": 0.5}), keys)
    elif strategy == "most_frequent":
        out = df
        for c in columns:
            out = _attach(out, most_frequent(df.withColumn(c, clean_number(c)), keys, c), keys)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return out.select(*[F.coalesce(clean_number(c), F.col(f"{c}_fill")).alias(c) if c in columns else F.col(c)
                        for c in df.columns])


def _donors_by_tiles(base: DataFrame, keys: list[str], columns: list[str], k: int) -> DataFrame:
    """(keys, _id, _col, _d, _donor, _v): for each gap ``k`` donors or more of groups that are a few tiles; every pair is looked at."""
    gappy = F.lit(False)
    for c in columns:
        gappy = gappy | F.col(c).isNull()
    schema = T.StructType([*[base.schema[c] for c in [*keys, "_id"]], T.StructField("_col", T.StringType()), T.StructField("_d", T.DoubleType()),
                           T.StructField("_donor", base.schema["_id"].dataType), T.StructField("_v", T.DoubleType())])

    @plain
    def nearest(left: dict, right: dict) -> dict:
        gap, col, far, given, value = [], [], [], [], []
        a, b = (np.column_stack([t[c].astype(float) for c in columns]) for t in (left, right))
        donor, missing = right["_id"], np.isnan(b)
        for i in range(len(a)):
            both = ~missing & ~np.isnan(a[i])
            n = both.sum(1)
            sq = np.where(both, b - a[i], 0.0) ** 2
            with np.errstate(divide="ignore", invalid="ignore"):
                d = np.where(n > 0, np.sqrt(sq.sum(1) * len(columns) / n), np.inf)
            d[donor == left["_id"][i]] = np.inf
            for j in np.flatnonzero(np.isnan(a[i])):
                ok = np.flatnonzero(~missing[:, j] & np.isfinite(d))
                best = ok[np.lexsort((donor[ok], d[ok]))[:k]]
                gap.append(np.full(len(best), i))
                col.append(np.full(len(best), j))
                far.append(d[best])
                given.append(donor[best])
                value.append(b[best, j])
        if not gap:
            return {n: donor[:0] for n in schema.names}
        at = np.concatenate(gap)
        return {**{c: left[c][at] for c in [*keys, "_id"]}, "_col": np.array(columns, object)[np.concatenate(col)],
                "_d": np.concatenate(far), "_donor": np.concatenate(given), "_v": np.concatenate(value)}

    return tile_pairs(base.where(gappy), base, keys, "_id", nearest, schema)


def _donors_by_pivots(base: DataFrame, keys: list[str], columns: list[str], k: int) -> DataFrame:
    """The same for groups of any size, keyed: rows that know the same columns share a pattern, and between two
    patterns the distance is Euclidean over the columns they share, so a row only meets donors that can be near.
    """
    full = (1 << len(columns)) - 1
    known = [F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(columns)]
    base = stage(base.withColumn("_mask", reduce(Column.__add__, known)), "imputed")
    have = base.select(*keys, F.col("_mask").alias("_have")).distinct()
    lack = have.where(F.col("_have") != full).withColumnRenamed("_have", "_lack")
    both = F.col("_lack").bitwiseAND(F.col("_have"))
    # Patterns are few; a pair counts where the distance is defined and the donor has something to give.
    patterns = stage(lack.join(have, keys).where((both != 0) & (F.lit(full).bitwiseXOR(F.col("_lack")).bitwiseAND(F.col("_have")) != 0)), "patterns")
    shared = F.filter(F.array(*[F.when(both.bitwiseAND(F.lit(1 << i)) != 0, F.col(c)) for i, c in enumerate(columns)]), lambda v: v.isNotNull())
    block = [*keys, "_lack", "_have"]
    seekers = base.withColumnRenamed("_mask", "_lack").join(patterns, [*keys, "_lack"]).select(*block, "_id", shared.alias("_f"))
    donors = base.withColumnRenamed("_mask", "_have").join(patterns, [*keys, "_have"]).select(*block, "_id", shared.alias("_f"))
    near = neighbours(Cells(donors, block), k, seekers=seekers, pairs=tile_pairs)
    far = F.sqrt(F.col("s") * len(columns) / F.bit_count(both))
    given = near.select(*block, "_id", "other", far.alias("_d")).join(base.drop("_mask").withColumnRenamed("_id", "other"), [*keys, "other"])
    cells = F.array(*[F.when(F.col("_lack").bitwiseAND(F.lit(1 << i)) == 0, F.struct(F.lit(c).alias("c"), F.col(c).alias("v"))) for i, c in enumerate(columns)])
    return (given.select(*keys, "_id", "other", "_d", F.explode(cells).alias("x")).where("x.v IS NOT NULL")
            .select(*keys, "_id", F.col("x.c").alias("_col"), "_d", F.col("other").alias("_donor"), F.col("x.v").alias("_v")))


def knn_impute(df: DataFrame, row_id: str, columns: Sequence[str], k: int = 5, keys: Sequence[str] = (), block_rows: int = 4 * TILE_ROWS) -> DataFrame:
    """Replace a missing value by the mean of the ``k`` nearest rows that have it.

    Distance is Euclidean over the columns both rows have, scaled up for the missing ones; ties go to
    the smaller id. ``keys`` restrict donors to the same block. A column without donors takes the
    column mean. Blocks of up to ``block_rows`` rows are searched tile by tile, larger ones by pivots
    (``nearest``), where the pairs looked at grow about as the rows do; the result is the same.
    """
    columns, keys = list(columns), list(keys)
    gk = keys or ["_all"]
    base = df.select(*keys, F.col(row_id).alias("_id"), *[clean_number(c).alias(c) for c in columns])
    base = base if keys else base.withColumn("_all", F.lit(0))
    base = stage(attach_stats(base, gk, [F.count(F.lit(1)).alias("_n")]), "imputed")
    large = base.where(F.col("_n") > block_rows).drop("_n")
    near = _donors_by_tiles(base.where(F.col("_n") <= block_rows).drop("_n"), gk, columns, k)
    if not large.isEmpty():
        near = near.unionByName(_donors_by_pivots(large, gk, columns, k))
    best = top_by(near, [*gk, "_id", "_col"], [F.col("_d"), F.col("_donor")], k)
    fills = best.groupBy(*keys, "_id").agg(*[F.avg(F.when(F.col("_col") == c, F.col("_v"))).alias(f"{c}_knn") for c in columns])
    out = df.join(fills.withColumnRenamed("_id", row_id), [*keys, row_id], "left")
    out = attach_stats(out, keys, [F.avg(clean_number(c)).alias(f"{c}_mean") for c in columns])
    return out.select(*[F.coalesce(clean_number(c), F.col(f"{c}_knn"), F.col(f"{c}_mean")).alias(c)
                        if c in columns else F.col(c) for c in df.columns])


def categories(df: DataFrame, column: str) -> list:
    """Sorted distinct values of a label; each becomes a column, so they pass through the driver as column names do."""
    return sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())


def one_hot_long(df: DataFrame, row_id: str, columns: Sequence[str], drop_first: bool = False) -> DataFrame:
    """(row_id, column, value): the ones of :func:`one_hot` as rows, for labels with any number of values."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns if c in df.columns])
    long = df.select(row_id, F.explode(cells).alias("_cell")).select(row_id, "_cell.*").where(F.col("value").isNotNull())
    if drop_first:
        first = long.groupBy("column").agg(F.min("value").alias("value"))
        long = long.join(first, ["column", "value"], "left_anti").select(row_id, "column", "value")
    return long


def one_hot(df: DataFrame, columns: Sequence[str], drop_first: bool = False, values: dict[str, Sequence] | None = None) -> DataFrame:
    """Replace each column by 0/1 columns ``<column>_<value>`` in order of the values; NULL gives zeros.

    ``values`` names the categories; what is not among them gives zeros too. Without it the table is asked.
    """
    columns = [c for c in columns if c in df.columns]
    new: list[Column] = []
    for c in columns:
        for v in (values[c] if values and c in values else categories(df, c))[1 if drop_first else 0:]:
            new.append(F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}"))
    return df.select(*[c for c in df.columns if c not in columns], *new)


def scalable_columns(df: DataFrame) -> list[str]:
    """Numeric columns that are not plain 0/1 flags, from one pass over the table."""
    nums = numeric_columns(df)
    if not nums:
        return []
    row = df.agg(*[F.bool_and(clean_number(c).isin(0.0, 1.0) | clean_number(c).isNull()).alias(c) for c in nums]).first()
    return [c for c in nums if row[c] is False]


def scale(df: DataFrame, columns: Sequence[str] | None = None, kind: str = "robust",
          keys: Sequence[str] = ()) -> DataFrame:
    """Standard (population deviation) or robust (median and interquartile range) scaling.

    A column without spread is only centred.
    """
    columns = list(columns or scalable_columns(df))
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    if kind == "standard":
        out = attach_stats(df, keys, [a for c in columns for a in (
            F.avg(clean_number(c)).alias(f"{c}_mid"), F.stddev_pop(clean_number(c)).alias(f"{c}_wide"))])
    elif kind == "robust":
        clean = df.select(*keys, *[clean_number(c).alias(c) for c in columns])
        q = _quantile_table(clean, keys, columns, {"lo": 0.25, "mid": 0.5, "hi": 0.75})
        out = _attach(df, q, keys)
        for c in columns:
            out = out.withColumn(f"{c}_wide", F.col(f"{c}_hi") - F.col(f"{c}_lo"))
    else:
        raise ValueError(f"unknown scaler {kind!r}")
    done = {c: ((clean_number(c) - F.col(f"{c}_mid"))
                / F.when(F.col(f"{c}_wide") > 0, F.col(f"{c}_wide")).otherwise(F.lit(1.0))).alias(c) for c in columns}
    return out.select(*[done.get(c, F.col(c)) for c in df.columns])


def feature_pipeline(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], scaler: str = "robust",
                     values: dict[str, Sequence] | None = None) -> DataFrame:
    """Scaled numbers, then 0/1 columns of the labels without their first value.

    A NULL or (with ``values``) unknown label gives zeros. Other columns are kept in front.
    """
    scaled = scale(df, numeric, scaler)
    rest = [c for c in df.columns if c not in numeric and c not in categorical]
    return one_hot(scaled.select(*rest, *numeric, *categorical), categorical, drop_first=True, values=values)


def encode_and_scale(df: DataFrame, categorical: Sequence[str], columns: Sequence[str], structural: str,
                     kind: str = "robust") -> tuple[DataFrame, DataFrame]:
    """(all rows, rows that are not structural), each one-hot encoded and scaled on its own."""
    plain = one_hot(df.drop(structural), categorical)
    clean = one_hot(df.where(~F.col(structural)).drop(structural), categorical)
    return scale(plain, columns, kind), scale(clean, columns, kind)
