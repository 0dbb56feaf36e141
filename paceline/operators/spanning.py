"""Minimum spanning trees of groups of any size, under mutual reachability.

The weight of a pair is the largest of its distance and the core distances of both rows; equal
weights are ordered by ids, which makes the tree unique. A group that fits in a tile is solved in
place, many groups per batch. Larger ones grow by rounds (Boruvka): every component takes its
cheapest outgoing edge. The lists of nearest rows give most of these; only rows that could have a
nearer row of another component beyond their list look into other cells, and only where pivots,
core distances and the components held leave room for one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from paceline.operators.keyed import attach_stats
from paceline.operators.nearest import Cells, distances, matrix, neighbours
from paceline.operators.tiles import TILE_ROWS, map_packed, pack, plain, tile_pairs
from paceline.session import discard, stage

#: Neighbours listed per row at least; more of them spare later looks into other cells.
LISTED = 16


def core_distances(d: np.ndarray, k: int) -> np.ndarray:
    """Distance of each row to its ``k``-th nearest other row (the farthest, if there are fewer)."""
    return np.sort(d, axis=1)[:, min(k, len(d) - 1)]


def local_tree(x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(u, v, w) of one group, u < v, rows ordered by id."""
    n, d = len(x), distances(x, x)
    core = core_distances(d, k)
    w = np.maximum(np.maximum(d, core[:, None]), core[None])
    # The pair of each free row as one number, the smaller place first; of equal weights the smallest pair.
    at, free = np.arange(n), np.ones(n, bool)
    best, pair = w[0].copy(), at.copy()
    free[0] = False
    links, weight = np.zeros(max(n - 1, 0), np.int64), np.zeros(max(n - 1, 0))
    for step in range(n - 1):
        left = np.flatnonzero(free)
        weight[step] = least = best[left].min()
        even = left[best[left] == least]
        j = even[pair[even].argmin()]
        links[step] = pair[j]
        free[j] = False
        new = np.minimum(at, j) * n + np.maximum(at, j)
        nearer = free & ((w[j] < best) | ((w[j] == best) & (new < pair)))
        best, pair = np.where(nearer, w[j], best), np.where(nearer, new, pair)
    return ids[links // n], ids[links % n], weight


def _edge(w: Column, u: Column, v: Column) -> Column:
    return F.struct(w.alias("w"), F.least(u, v).alias("u"), F.greatest(u, v).alias("v"))


def spanning_trees(points: DataFrame, keys: Sequence[str], tile_rows: int = TILE_ROWS, cell_rows: int | None = None) -> DataFrame:
    """(keys, u, v, w), u < v: the minimum spanning tree of every group of ``points`` (keys, _id, _f, _k).

    ``_k`` is the number of neighbours that make a core distance, the same for all rows of a group.
    """
    keys = list(keys)
    counted = stage(attach_stats(points, keys, [F.count(F.lit(1)).alias("_n")]), "points")
    schema = T.StructType([*[counted.schema[k] for k in keys], *[T.StructField(c, T.LongType()) for c in ("u", "v")], T.StructField("w", T.DoubleType())])

    @plain
    def solve(own: dict) -> dict:
        order = np.argsort(own["_id"])
        u, v, w = local_tree(matrix(own["_f"][order]), own["_id"][order], int(own["_k"][0]))
        return {**{k: np.repeat(own[k][:1], len(u)) for k in keys}, "u": u, "v": v, "w": w}

    small = map_packed(pack(counted.where(F.col("_n") <= tile_rows).drop("_n"), keys, "b:"), keys, ["b:"], solve, schema)
    large = counted.where(F.col("_n") > tile_rows).drop("_n")
    if large.isEmpty():
        return stage(small, "tree")
    return stage(small, "tree").unionByName(_grown(large, keys, schema, cell_rows))


def _grown(points: DataFrame, keys: list[str], schema: T.StructType, cell_rows: int | None) -> DataFrame:
    from paceline.operators.density import connected_components

    most = points.agg(F.max("_k")).first()[0]
    cells = Cells(points, keys, cell_rows, ["_k"])
    listed = max(int(most), LISTED)
    near = stage(neighbours(cells, listed), "neighbours")
    ranked = near.withColumn("_at", F.row_number().over(W.partitionBy(*keys, "_id").orderBy("d", "other")))
    per = (ranked.join(cells.rows.select(*keys, "_id", "_k"), [*keys, "_id"]).groupBy(*keys, "_id")
           .agg(F.max(F.when(F.col("_at") <= F.col("_k"), F.col("d"))).alias("_core"),
                F.when(F.count(F.lit(1)) >= listed, F.max("d")).otherwise(F.lit(float("inf"))).alias("_reach")))
    nodes = stage(cells.rows.drop("_k").join(per, [*keys, "_id"]).withColumn("_comp", F.col("_id")), "nodes")
    core = nodes.select(*keys, F.col("_id").alias("other"), F.col("_core").alias("_oc"))
    pairs = stage(near.join(nodes.select(*keys, "_id", "_core"), [*keys, "_id"]).join(core, [*keys, "other"])
                  .select(*keys, _edge(F.greatest("d", "_core", "_oc"), F.col("_id"), F.col("other")).alias("e"),
                          F.col("_id").alias("a"), F.col("other").alias("b")), "pairs")
    discard(near)
    probed = T.StructType([*[nodes.schema[k] for k in keys], *[T.StructField(c, T.LongType()) for c in ("_comp", "_to", "u", "v")],
                           T.StructField("w", T.DoubleType())])

    def cheapest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        w = np.maximum(np.maximum(distances(matrix(left["_f"]), matrix(right["_f"])), left["_core"].to_numpy()[:, None]), right["_core"].to_numpy()[None])
        mine, theirs, own, ids = (t[c].to_numpy(np.int64) for t, c in ((left, "_comp"), (right, "_comp"), (left, "_id"), (right, "_id")))
        w[mine[:, None] == theirs[None]] = np.inf
        order = np.argsort(ids, kind="stable")  # of equal weights the smallest id
        at = order[w[:, order].argmin(1)]
        best = w[np.arange(len(left)), at]
        ok = np.isfinite(best)
        table = pd.DataFrame({"_comp": mine[ok], "_to": theirs[at][ok], "u": np.minimum(own, ids[at])[ok], "v": np.maximum(own, ids[at])[ok], "w": best[ok]})
        table = table.sort_values(["_comp", "w", "u", "v"]).drop_duplicates("_comp")
        return table.assign(**{k: left[k].iat[0] for k in keys})

    trees = []
    while True:
        foreign = pairs.where("a != b")
        outgoing = foreign.select(*keys, "e", F.explode(F.array(F.struct(F.col("a").alias("c"), F.col("b").alias("to")),
                                                                F.struct(F.col("b").alias("c"), F.col("a").alias("to")))).alias("x"))
        best = stage(outgoing.select(*keys, F.col("x.c").alias("_comp"), F.struct("e", "x.to").alias("s")).groupBy(*keys, "_comp").agg(F.min("s").alias("s")), "best")
        # Groups that are one component are done.
        open_groups = nodes.groupBy(*keys).agg(F.min("_comp").alias("_a"), F.max("_comp").alias("_b")).where("_a != _b").select(*keys)
        bound = best.select(*keys, "_comp", F.col("s.e.w").alias("_most"))
        seekers = (nodes.join(open_groups, keys, "left_semi").join(bound, [*keys, "_comp"], "left").withColumn("_most", F.coalesce("_most", F.lit(float("inf"))))
                   .where(F.greatest("_core", "_reach") <= F.col("_most")))

        def choose(left: dict, right: dict, bound: np.ndarray, d: np.ndarray, home: np.ndarray) -> np.ndarray:
            comp, core, most = left["_comp"][:, None], left["_core"][:, None], left["_most"]
            foreign = (right["lo"][None] != comp) | (right["hi"][None] != comp)
            # Without an edge so far, the nearest cell with another component tells how far one can be.
            far = np.where(foreign, np.maximum(np.maximum(d + right["r"], right["core"]), core), np.inf)
            most = np.where(np.isinf(most), far.min(1) * (1 + 1e-9), most)
            return foreign & (np.maximum(bound, core) <= most[:, None])

        held = cells.table(nodes, F.min("_comp").alias("lo"), F.max("_comp").alias("hi"), F.max("_core").alias("core"))
        there = cells.look_up(seekers, ["_f", "_core", "_comp", "_most"], held, choose).drop("_most")
        found = tile_pairs(there, nodes.drop("_d", "_reach"), [*keys, "_cell"], "_id", cheapest, probed)
        chosen = (best.unionByName(found.select(*keys, "_comp", F.struct(F.struct("w", "u", "v").alias("e"), F.col("_to").alias("to")).alias("s")))
                  .groupBy(*keys, "_comp").agg(F.min("s").alias("s")))
        chosen = stage(chosen.select(*keys, F.col("_comp").alias("a"), F.col("s.to").alias("b"), F.col("s.e.u").alias("u"), F.col("s.e.v").alias("v"),
                                     F.col("s.e.w").alias("w")), "chosen")
        discard(best)
        if chosen.isEmpty():
            discard(chosen)
            break
        trees.append(stage(chosen.select(*keys, "u", "v", "w").distinct(), "tree"))
        merged = stage(connected_components(chosen.select(*keys, F.col("a").alias("u"), F.col("b").alias("v")), keys), "merged")
        to = lambda c, new: merged.select(*keys, F.col("node").alias(c), F.col("component").alias(new))
        old_nodes, old_pairs = nodes, pairs
        nodes = stage(nodes.join(to("_comp", "_new"), [*keys, "_comp"], "left").withColumn("_comp", F.coalesce("_new", "_comp")).drop("_new"), "nodes")
        pairs = stage(foreign.join(to("a", "_a"), [*keys, "a"], "left").join(to("b", "_b"), [*keys, "b"], "left")
                      .select(*keys, "e", F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).where("a != b"), "pairs")
        for t in (old_nodes, old_pairs, chosen, merged):
            discard(t)
    out = trees[0]
    for t in trees[1:]:
        out = out.unionByName(t)
    return out.select(*schema.names)
