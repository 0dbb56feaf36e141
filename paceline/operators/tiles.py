"""Work on groups and on pairs of rows inside a group without emitting the pairs.

A group is cut into tiles by a hash of the row id. Every pair of tiles is one small unit of work
that sees two tables of bounded size and returns a reduced result (sums, nearest few, a spanning
forest). Big groups simply have more tiles. Tiles travel as packed arrays, many per Arrow batch, so
millions of small groups do not pay for a Python call each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.operators.keyed import attach_stats

TILE_ROWS = 1024
#: Unpacked rows that are held together, about.
UNPACKED = 1 << 16

Work = Callable[..., pd.DataFrame]


def pack(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """One row per key with an array per other column, all in the same order.

    Only for keys whose groups are bounded by construction (tiles, shares, lanes).
    """
    cols = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(F.collect_list(F.struct(*cols)).alias("_p"))
    return packed.select(*keys, *[F.col("_p").getField(c).alias(prefix + c) for c in cols])


def plain(work: Work) -> Work:
    """Mark ``work`` as one that takes and returns a dict of NumPy columns for each table, which spares small groups the cost of pandas."""
    work.plain = True
    return work


def _columns(pdf: pd.DataFrame, keys: list[str], cols: dict[str, list[str]]) -> list[tuple[dict[str, np.ndarray], np.ndarray]] | None:
    """For each prefix the columns of all packed rows together, and where each of them ends; None where the types of their arrays differ."""
    tables = []
    for prefix, own in cols.items():
        table, ends = {}, np.zeros(len(pdf), np.int64)
        for c in own:
            parts = [np.asarray(v) for v in pdf[c]]
            if len({v.dtype for v in parts}) > 1:
                return None
            flat, ends = np.concatenate(parts), np.cumsum([len(v) for v in parts])
            wide = {"i": np.int64, "f": np.float64}.get(flat.dtype.kind)
            table[c[len(prefix):]] = flat if wide is None else flat.astype(wide, copy=False)
        for k in keys:
            table[k] = np.repeat(pdf[k].to_numpy(), np.diff(ends, prepend=0))
        tables.append((table, ends))
    return tables


def map_packed(df: DataFrame, keys: Sequence[str], prefixes: Sequence[str], work: Work, schema: T.StructType) -> DataFrame:
    """Unpack every row into one table per prefix (with the keys as columns) and apply ``work``.

    The arrays of many rows are joined first and cut again, which costs a small group next to nothing.
    Tables are pandas ones, or dicts of columns where ``work`` is :func:`plain`.
    """
    keys, names = list(keys), schema.names
    cols = {p: [c for c in df.columns if c.startswith(p) and c not in keys] for p in prefixes}
    bare = getattr(work, "plain", False)

    def solve(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        tables = _columns(pdf, keys, cols)
        if tables is None:  # one row at a time, each with its own types
            for i in range(len(pdf)):
                yield from solve(pdf.iloc[i:i + 1])
            return
        whole = [t if bare else pd.DataFrame(t) for t, _ in tables]
        out = []
        for i in range(len(pdf)):
            own = []
            for t, (_, ends) in zip(whole, tables):
                a, b = ends[i - 1] if i else 0, ends[i]
                if bare:
                    own.append({c: v[a:b] for c, v in t.items()})
                else:
                    own.append(t.iloc[a:b].set_axis(pd.RangeIndex(b - a)))
            res = work(*own)
            if len(res[names[0]]):
                out.append({n: res[n] for n in names} if bare else res[names])
        if out and bare:
            yield pd.DataFrame({n: np.concatenate([r[n] for r in out]) for n in names})
        elif out:
            yield pd.concat(out, ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                rows = sum(pdf[own[0]].map(len).to_numpy() for own in cols.values())
                for _, share in pdf.groupby(np.cumsum(rows) // UNPACKED, sort=False):
                    yield from solve(share)

    return df.mapInPandas(run, schema)


def tile_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], row_id: str, work: Work, schema: T.StructType,
               tile_rows: int = TILE_ROWS) -> DataFrame:
    """Run ``work(left tile, right tile)`` for every pair of tiles of every group in both tables."""
    keys = list(keys)
    gk = keys or ["_all"]
    if not keys:
        left, right = left.withColumn("_all", F.lit(0)), right.withColumn("_all", F.lit(0))
    n = F.ceil(F.count(F.lit(1)) / tile_rows).cast("long")
    rn = right.groupBy(*gk).agg(n.alias("_rn"))

    def tile(df: DataFrame, name: str) -> DataFrame:
        counted = attach_stats(df, gk, [n.alias("_n")])
        return counted.withColumn(name, F.pmod(F.xxhash64(row_id), F.col("_n"))).drop("_n")

    # Left tiles are copied once per right tile and meet it by hash, so the pairs of one big group
    # are spread over as many partitions as it has tiles.
    a = (pack(tile(left, "_lt"), [*gk, "_lt"], "l:").join(rn, gk)
         .withColumn("_rt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rn") - 1))).drop("_rn", "_lt"))
    b = pack(tile(right, "_rt"), [*gk, "_rt"], "r:")
    pairs = a.join(b, [*gk, "_rt"]).drop("_rt")
    return map_packed(pairs, gk, ["l:", "r:"], work, schema)
