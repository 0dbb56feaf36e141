"""Seeded shuffles and global ranks that no single task has to hold.

Rows are dealt into buckets of an even quantity (a hash, a fraction), ranked inside each bucket, and
raised by the totals of the buckets before. Only one row per bucket meets in the scan of totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Rows that a bucket holds on average in a large table; a small one is dealt to up to ``BUCKETS``, for even tasks.
BUCKET_ROWS, BUCKETS = 20_000, 512


def draw(seed: int, *cols: Column) -> Column:
    """Hex digest that orders rows at random but alike in every run. NULL and text 'null' differ in no way that matters."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols]))


def share(digest: Column) -> Column:
    """Fraction in [0, 1) of a hex digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def buckets(rows: int) -> int:
    return max(-(-rows // BUCKET_ROWS), min(BUCKETS, -(-rows // 100)), 1)


def ranked(df: DataFrame, keys: list[str], fraction: str, order: list[str], n: int, rank: str,
           weight: str | None = None, before: str | None = None) -> DataFrame:
    """Append the 0-based ``rank`` within ``keys``, and the sum of ``weight`` on the rows ``before``.

    ``order`` starts with ``fraction`` or with something that grows with it; ``fraction`` lies in
    [0, 1) and is spread evenly, so its ``n`` buckets hold similar numbers of rows of a key.
    """
    one = F.lit(1).cast("long")
    src = df.withColumn("_bucket", F.floor(F.col(fraction) * n).cast("long"))
    inside = W.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    scan = W.partitionBy(*(keys or [F.lit(0)])).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = [F.sum(one).alias("_r")] + ([F.sum(weight).alias("_w")] if weight else [])
    totals = (src.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bucket").alias("_at")).agg(*sums))
    scan = W.partitionBy(*([f"_k_{k}" for k in keys] or [F.lit(0)])).orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(*[f"_k_{k}" for k in keys], "_at", F.coalesce(F.sum("_r").over(scan), F.lit(0)).alias("_r0"),
                           *([F.coalesce(F.sum("_w").over(scan), F.lit(0)).alias("_w0")] if weight else []))
    out = src.withColumn("_r1", F.coalesce(F.sum(one).over(inside), F.lit(0)))
    if weight:
        out = out.withColumn("_w1", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    match = F.col("_bucket") == F.col("_at")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    out = out.join(totals, match).withColumn(rank, F.col("_r0") + F.col("_r1"))
    if weight:
        out = out.withColumn(before, F.col("_w0") + F.col("_w1"))
    return out.select(*df.columns, rank, *([before] if weight else []))
