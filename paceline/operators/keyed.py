"""Group statistics joined back to rows, and exact quantiles, without gathering a group in one task.

A window over a group sends the whole group to one task. The helpers here aggregate first (Spark
combines on the map side, so a hot key costs one small row per map task) and join the result back;
the join is an ordinary equi-join that adaptive execution splits when a key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

_ALL = "_all"


def attach_stats(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Append per-group aggregates to every row.

    Rows with a NULL key get NULL statistics, because the join cannot match them. Without keys the
    aggregate is exactly one row and is broadcast; else adaptive execution broadcasts the aggregates
    where they turn out small.
    """
    keys = list(keys)
    if not keys:
        return df.join(F.broadcast(df.agg(*aggs)))
    stats = df.groupBy(*keys).agg(*aggs)
    return df.join(stats, keys, "left")


#: Rank error of the sketch, as a share of the group, and rows from which it is narrower than a whole group.
_SKETCH, _SKETCH_ROWS = 10_000, 20_000


def _borders(df: DataFrame, keys: list[str], value: str, probs: dict[str, float | str]) -> DataFrame:
    """(keys, _b, _n): rising borders that enclose the wanted ranks of each group closely, and its row count.

    They come from a mergeable sketch, so outliers do not move them. A rank given by a column, or in
    a small group, is enclosed by the minimum and maximum only.
    """
    fixed = sorted({float(p) for p in probs.values() if not isinstance(p, str)})
    margin = 3 / _SKETCH
    near = [min(max(p + d, 0.0), 1.0) for p in fixed for d in (-margin, margin)]
    near += [] if len(fixed) == len(set(probs.values())) else [i / 50 for i in range(1, 50)]
    aggs = [F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_n"),
            F.percentile_approx("_v", near, _SKETCH).alias("_q")]
    got = df.groupBy(*keys).agg(*aggs)
    inner = F.when(F.col("_n") >= _SKETCH_ROWS, F.col("_q")).otherwise(F.array().cast("array<double>"))
    return got.select(*keys, F.array_sort(F.array_distinct(F.concat(F.array("_lo", "_hi"), inner))).alias("_b"), "_n")


def group_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float | str],
                    slices: int = 1024, few: bool = False) -> DataFrame:
    """Exact linear-interpolated quantiles per group; one row per group with a non-NULL value.

    A probability is a number, or the name of a column that is constant inside a group.

    Equal values are counted first. The values of a group are cut at borders close around the wanted
    ranks, and between two borders into equal-width slices; slice counts locate the ranks, and only
    the slices that hold a wanted rank are ordered. The borders follow the ranks, not the range, so
    one far outlier does not put all other values into one slice. They decide who is sorted with
    whom, never the result.

    ``few`` says that there is a handful of groups only, as for a whole table. Then slices are counted
    straight from the rows, and equal values in the wanted slices only, so no task holds the distinct values.
    """
    keys = list(keys)
    if not keys:
        out = group_quantiles(df.withColumn(_ALL, F.lit(0)), [_ALL], value, probs, slices, True)
        return out.drop(_ALL)
    shares = {p: f"_p_{p}" for p in probs.values() if isinstance(p, str)}
    place = {name: (F.col(shares[p]) if p in shares else F.lit(p)) * (F.col("_n") - 1) for name, p in probs.items()}
    ranks = {name: (F.floor(h), F.ceil(h), h) for name, h in place.items()}
    present = F.col(value).isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    rows = df.where(present).select(*keys, F.col(value).cast("double").alias("_v"), *[F.col(p).alias(c) for p, c in shares.items()])
    counts = rows.withColumn("_c", F.lit(1)) if few else rows.groupBy(*keys, "_v").agg(
        F.count(F.lit(1)).alias("_c"), *[F.max(c).alias(c) for c in shares.values()])
    bounds = _borders(rows, keys, value, probs)
    bounds = F.broadcast(bounds) if few else bounds
    # Zone z lies between border z - 1 and border z; the last value of all belongs to the last zone.
    zone = F.least(F.size(F.filter("_b", lambda b: b <= F.col("_v"))), F.greatest(F.size("_b") - 1, F.lit(1)))
    left, right = F.get("_b", F.col("_zone") - 1), F.coalesce(F.get("_b", F.col("_zone")), F.get("_b", F.col("_zone") - 1))
    sliced = (counts.join(bounds, keys).withColumn("_zone", zone).withColumn("_left", left).withColumn("_width", right - left)
              .withColumn("_slice", F.col("_zone").cast("long") * slices + F.when(
                  F.col("_width") > 0, F.least(F.lit(slices - 1), F.floor((F.col("_v") - F.col("_left")) / F.col("_width") * slices).cast("int")))
                  .otherwise(F.lit(0))).drop("_b", "_zone", "_left", "_width"))
    over_slices = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    hist = (sliced.groupBy(*keys, "_slice").agg(F.sum("_c").alias("_sc"), F.first("_n").alias("_n"),
                                             *[F.max(c).alias(c) for c in shares.values()])
            .withColumn("_before", F.coalesce(F.sum("_sc").over(over_slices), F.lit(0))))
    wanted = F.lit(False)
    for lo, hi, _ in ranks.values():
        wanted = wanted | ((F.col("_before") <= hi) & (F.col("_before") + F.col("_sc") > lo))
    in_slice = (W.partitionBy(*keys, "_slice").orderBy("_v")
                .rowsBetween(W.unboundedPreceding, W.currentRow))
    hits = hist.where(wanted).drop("_sc")
    held = sliced.select(*keys, "_slice", "_v", "_c").join(F.broadcast(hits) if few else hits, [*keys, "_slice"])
    if few:
        held = held.groupBy(*[c for c in held.columns if c != "_c"]).agg(F.sum("_c").alias("_c"))
    kept = (held.withColumn("_upto", F.col("_before") + F.sum("_c").over(in_slice)))
    aggs = [F.first("_n").alias("_n"), *[F.first(c).alias(c) for c in shares.values()]]
    for name, (lo, hi, _) in ranks.items():
        aggs.append(F.min(F.when(F.col("_upto") > lo, F.col("_v"))).alias(f"_{name}_l"))
        aggs.append(F.min(F.when(F.col("_upto") > hi, F.col("_v"))).alias(f"_{name}_h"))
    out = kept.groupBy(*keys).agg(*aggs)
    cols = [F.col(k) for k in keys]
    for name, (lo, _, h) in ranks.items():
        frac = h - lo
        low, high = F.col(f"_{name}_l"), F.col(f"_{name}_h")
        cols.append((low + (high - low) * frac).alias(name))
    return out.select(*cols)


def attach_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                     probs: dict[str, float]) -> DataFrame:
    """:func:`group_quantiles` joined back to every row."""
    q = group_quantiles(df, keys, value, probs)
    if not keys:
        return df.join(F.broadcast(q))
    return df.join(q, list(keys), "left")


def top_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
           name: str = "_rn") -> DataFrame:
    """First ``n`` rows per group. For n up to 1000 Spark trims each group on the map side before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def bounded_lists(df: DataFrame, keys: Sequence[str], order: Sequence[str], item: Column, name: str,
                  rows: int = 10_000) -> DataFrame:
    """(keys, list_no, list): items of a group as sorted arrays of bounded length.

    A group of ordinary size has the single list 0. A bigger one is spread by hash over as many
    lists as it needs, so that no cell and no task grows with the group.
    """
    keys = list(keys)
    src = df.select(*keys, F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], item.alias("_item")).alias("_s"))
    n = F.ceil(F.count(F.lit(1)) / rows).cast("long").alias("_lists")
    src = attach_stats(src, keys, [n])
    return (src.groupBy(*keys, F.pmod(F.xxhash64("_s"), F.col("_lists")).alias("list_no"))
            .agg(F.transform(F.sort_array(F.collect_list("_s")), lambda s: s["_item"]).alias(name)))
