"""Ordered computations inside groups of any size.

Rows of a group are cut into *lanes*, consecutive stretches of the order. Windows run inside a lane
and the little that crosses a lane border is handled apart:

* :func:`prefix_scan` - running sums, counts, last-known values. Each lane is reduced to one row,
  the lane rows are scanned per group, and the result is added to the rows of the lane.
* :func:`with_halo` - bounded frames (``lag``, ``lead``, k rows around). The few rows next to a
  border are copied to the neighbouring lane.

So a group with a third of all rows is still worked on by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Rows of a group that one window partition holds at most when lanes come from a dense counter.
LANE_ROWS = 1 << 16

LANE = "_lane"


def lane_of(seq: str, rows: int | None = None) -> Column:
    """Lane number of a dense 1-based counter."""
    return F.floor((F.col(seq) - 1) / F.lit(rows or LANE_ROWS)).cast("long")


@dataclass(frozen=True)
class Scan:
    """One output of :func:`prefix_scan`.

    kind ``sum`` / ``count`` / ``max`` / ``min`` run over the rows so far including the current
    one, ``last`` is the latest non-NULL value including the current row, ``prev`` the value of
    the row before.
    """

    name: str
    kind: str
    value: Column


def prefix_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], scans: Sequence[Scan],
                lane: Column, reverse: bool = False) -> DataFrame:
    """Append running values per group. ``lane`` must not decrease along ``order``."""
    keys = list(keys)
    src = df.withColumn(LANE, lane)
    for s in scans:
        src = src.withColumn(f"_in_{s.name}", s.value)
    dirs = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    rows = W.partitionBy(*keys, LANE).orderBy(*dirs)
    upto = rows.rowsBetween(W.unboundedPreceding, W.currentRow)
    place = F.struct(*[F.col(c) for c in order])
    lane_dir = F.col(LANE).desc() if reverse else F.col(LANE).asc()
    over = W.partitionBy(*keys).orderBy(lane_dir) if keys else W.partitionBy(F.lit(0)).orderBy(lane_dir)
    before = over.rowsBetween(W.unboundedPreceding, -1)
    latest = F.min_by if reverse else F.max_by

    totals, carries, local, final = [], [], {}, {}
    for s in scans:
        v, t, c, loc = F.col(f"_in_{s.name}"), f"_t_{s.name}", F.col(f"_c_{s.name}"), F.col(f"_l_{s.name}")
        if s.kind in ("sum", "count"):
            agg = F.sum if s.kind == "sum" else F.count
            totals.append(agg(v).alias(t))
            carries.append(F.sum(t).over(before).alias(f"_c_{s.name}"))
            local[s.name] = agg(v).over(upto)
            final[s.name] = (F.when(loc.isNull() & c.isNull(), None)
                             .otherwise(F.coalesce(loc, F.lit(0)) + F.coalesce(c, F.lit(0))))
        elif s.kind in ("max", "min"):
            agg, pick = (F.max, F.greatest) if s.kind == "max" else (F.min, F.least)
            totals.append(agg(v).alias(t))
            carries.append(agg(t).over(before).alias(f"_c_{s.name}"))
            local[s.name] = agg(v).over(upto)
            final[s.name] = pick(loc, c)
        elif s.kind == "last":
            totals.append(latest(v, F.when(v.isNotNull(), place)).alias(t))
            carries.append(F.last(t, True).over(before).alias(f"_c_{s.name}"))
            local[s.name] = F.last(v, True).over(upto)
            final[s.name] = F.coalesce(loc, c)
        elif s.kind == "prev":
            totals.append(latest(v, place).alias(t))
            carries.append(F.lag(t).over(over).alias(f"_c_{s.name}"))
            local[s.name] = F.struct(F.lag(v).over(rows).alias("v"),
                                     (F.row_number().over(rows) == 1).alias("first"))
            final[s.name] = F.when(loc["first"], c).otherwise(loc["v"])
        else:
            raise ValueError(f"unknown scan kind {s.kind!r}")
    lanes = src.groupBy(*keys, LANE).agg(*totals).select(*keys, LANE, *carries)
    body = src
    for s in scans:
        body = body.withColumn(f"_l_{s.name}", local[s.name])
    joined = body.join(lanes, [*keys, LANE], "left")
    return joined.select(*[F.col(c) for c in df.columns if c not in final],
                         *[final[s.name].alias(s.name) for s in scans])


def ordered_sums(df: DataFrame, keys: Sequence[str], seq: str, value: Column, name: str,
                 lane_rows: int | None = None) -> DataFrame:
    """(keys, name): sum per group, added up along ``seq``, so its last digits do not depend on partitioning.

    A lane is added up in one row, and the sums of the lanes of a group in another.
    """
    def total(by: str, what: Column, of: str) -> Column:
        rows = F.sort_array(F.collect_list(F.struct(F.col(by), what.alias("_v"))))
        return F.aggregate(rows, F.lit(0.0), lambda acc, r: acc + r["_v"]).alias(of)

    keys = list(keys)
    lanes = df.groupBy(*keys, lane_of(seq, lane_rows).alias(LANE)).agg(total(seq, value.cast("double"), "_s"))
    return lanes.groupBy(*keys).agg(total(LANE, F.col("_s"), name))


def count_drops(df: DataFrame, keys: Sequence[str], seq: str, value: str, name: str,
                lane: Column) -> DataFrame:
    """Append how often ``value`` has dropped below its latest known value so far.

    One shuffle: drops are counted inside a lane; each lane then reports its count and its first
    and last known value, which decide the drops on the borders.
    """
    keys = list(keys)
    rows = W.partitionBy(*keys, LANE).orderBy(seq)
    upto = rows.rowsBetween(W.unboundedPreceding, W.currentRow)
    known = F.when(F.col(value).isNotNull(), F.col(seq))
    body = (df.withColumn(LANE, lane)
            .withColumn("_latest", F.last(value, True).over(rows.rowsBetween(W.unboundedPreceding, -1)))
            .withColumn("_drops", F.sum(F.when(F.col(value) < F.col("_latest"), 1).otherwise(0)).over(upto))
            .withColumn("_seen", F.first(value, True).over(upto).isNotNull()))
    over = W.partitionBy(*keys).orderBy(LANE)
    before = over.rowsBetween(W.unboundedPreceding, -1)
    lanes = (body.groupBy(*keys, LANE)
             .agg(F.max("_drops").alias("_n"), F.min_by(value, known).alias("_first"),
                  F.max_by(value, known).alias("_last"))
             .withColumn("_border", F.coalesce((F.col("_first") < F.last("_last", True).over(before)).cast("int"),
                                               F.lit(0)))
             .withColumn("_base", F.coalesce(F.sum(F.col("_n") + F.col("_border")).over(before), F.lit(0)))
             .select(*keys, LANE, "_border", "_base"))
    total = F.col("_base") + F.col("_drops") + F.when(F.col("_seen"), F.col("_border")).otherwise(0)
    return body.join(lanes, [*keys, LANE], "left").select(*df.columns, total.alias(name))


def with_halo(df: DataFrame, seq: str, before: int, after: int,
              lane_rows: int | None = None) -> DataFrame:
    """Copy rows next to a lane border so that frames of ``before``/``after`` rows are complete.

    ``seq`` is a dense 1-based counter. Window over ``(keys, _lane)`` ordered by ``seq``, then call
    :func:`drop_halo`.
    """
    n = F.lit(lane_rows or LANE_ROWS)
    pos = F.col(seq) - 1
    first = F.greatest(F.lit(0), F.floor((pos - after) / n)).cast("long")
    last = F.floor((pos + before) / n).cast("long")
    return (df.withColumn("_own_lane", F.floor(pos / n).cast("long"))
            .withColumn(LANE, F.explode(F.sequence(first, last))))


def drop_halo(df: DataFrame) -> DataFrame:
    """Keep each row once, in its own lane."""
    return df.where(F.col(LANE) == F.col("_own_lane")).drop(LANE, "_own_lane")


def dense_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], lane: Column,
                   name: str = "pos") -> DataFrame:
    """Number the rows of every group 1, 2, 3 ... along ``order``."""
    return prefix_scan(df, keys, order, [Scan(name, "count", F.lit(1))], lane)


def nearest_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], known: dict[str, Column],
                  lane: Column, strict: bool = False) -> DataFrame:
    """Append ``<name>_b`` and ``<name>_f``: latest non-NULL value up to the row, first from the row on.

    Both directions share one shuffle. ``strict`` leaves the row itself out.
    """
    keys = list(keys)
    gap = 1 if strict else 0
    src = df.withColumn(LANE, lane)
    for n, c in known.items():
        src = src.withColumn(f"_k_{n}", c)
    place = F.struct(*[F.col(c) for c in order])
    rows = W.partitionBy(*keys, LANE).orderBy(*order)
    back = rows.rowsBetween(W.unboundedPreceding, -gap)
    ahead = rows.rowsBetween(gap, W.unboundedFollowing)
    over = (W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))).orderBy(LANE)
    body, totals, carries = src, [], []
    for n in known:
        k = F.col(f"_k_{n}")
        body = (body.withColumn(f"_lb_{n}", F.last(k, True).over(back))
                .withColumn(f"_lf_{n}", F.first(k, True).over(ahead)))
        at = F.when(k.isNotNull(), place)
        totals += [F.max_by(k, at).alias(f"_tl_{n}"), F.min_by(k, at).alias(f"_tf_{n}")]
        carries += [F.last(f"_tl_{n}", True).over(over.rowsBetween(W.unboundedPreceding, -1)).alias(f"_cb_{n}"),
                    F.first(f"_tf_{n}", True).over(over.rowsBetween(1, W.unboundedFollowing)).alias(f"_cf_{n}")]
    lanes = src.groupBy(*keys, LANE).agg(*totals).select(*keys, LANE, *carries)
    outs = []
    for n in known:
        outs += [F.coalesce(f"_lb_{n}", f"_cb_{n}").alias(f"{n}_b"), F.coalesce(f"_lf_{n}", f"_cf_{n}").alias(f"{n}_f")]
    return body.join(lanes, [*keys, LANE], "left").select(*df.columns, *outs)


def fill_gaps(df: DataFrame, keys: Sequence[str], pos: str, columns: Sequence[str],
              lane_rows: int | None = None) -> DataFrame:
    """Linear interpolation by row position; the ends take the nearest value.

    A column without any value in the group stays NULL: its mean, the last resort of the weather
    job, does not exist either.
    """
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(c).cast("double").alias("v")))
             for c in columns}
    out = nearest_known(df, keys, [pos], known, lane_of(pos, lane_rows))
    cols = {}
    for c in columns:
        b, f = F.col(f"{c}_b"), F.col(f"{c}_f")
        line = b["v"] + (f["v"] - b["v"]) * (F.col(pos) - b["p"]) / (f["p"] - b["p"])
        cols[c] = (F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
                   .when(b.isNotNull() & f.isNotNull(), line)
                   .otherwise(F.coalesce(b["v"], f["v"]))).alias(c)
    return out.select(*[cols.get(c, F.col(c)) for c in df.columns])
