"""Most persistent clusters of a spanning tree of any size (Campello et al. 2013).

Edges join rows in the order of their weights. A tree with more edges than one task should hold is
halved at the median weight: the lower half falls into components, each a problem of its own, and
in the upper half a component is one vertex; halves that are still too large are halved again. A
problem is solved from the results of those below it (rows, and what they add to the persistence of
the cluster around them), and tells of each of its vertices which chosen cluster holds it. So no
task holds more than ``EDGES`` edges; a group has as many rounds as problems lie above one another.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from paceline.operators.density import connected_components
from paceline.operators.tiles import map_packed, pack, plain
from paceline.session import discard, stage

#: Edges of one problem at most, with as many vertices.
EDGES = 100_000
#: Sums of persistence that differ by less than this share count as equal.
TIE = 1e-9


def solve(u: list[int], v: list[int], w: list[float], rows: dict[int, tuple[float, float, float]], smallest: int) -> tuple[tuple[float, float, float], dict[int, int | None]]:
    """Join the vertices along edges in ascending order.

    ``rows[vertex]`` is (rows n, levels l, value of chosen clusters inside). A cluster that was born at
    level b and holds n rows has persistence l - n b. Returns the same three of the whole, and for each
    vertex the smallest vertex of the topmost chosen cluster that holds it, None if none does.
    """
    parent = {x: x for x in rows}
    state = dict(rows)
    members: dict[int, list] = {x: [x] for x in rows}  # nested lists of vertices, flattened at the end
    names = {x: x for x in rows}
    chosen: list[tuple[int, list]] = []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b, weight in zip(u, v, w):
        a, b = find(a), find(b)
        level = 1.0 / max(weight, 1e-12)
        large = [x for x in (a, b) if state[x][0] >= smallest]
        n = state[a][0] + state[b][0]
        if len(large) == 2:
            value = 0.0
            for x in large:
                rows_x, levels, inner = state[x]
                own = levels - rows_x * level
                if own >= inner - TIE * abs(inner):
                    chosen.append((names[x], members[x]))
                    own = max(own, inner)
                else:
                    own = inner
                value += own
            new = (n, n * level, value)
        elif large:
            rows_x, levels, inner = state[large[0]]
            new = (n, levels + (n - rows_x) * level, inner)
        else:
            new = (n, n * level, 0.0) if n >= smallest else (n, 0.0, 0.0)
        # The smaller list goes into the larger one's chain; lists that a chosen cluster keeps are never changed.
        parent[b] = a
        members[a] = [members[a], members[b]]
        names[a] = min(names[a], names[b])
        state[a] = new
    top: dict[int, int | None] = dict.fromkeys(rows)
    for name, held in chosen:  # the later, the higher
        todo = [held]
        while todo:
            x = todo.pop()
            if isinstance(x, list):
                todo.extend(x)
            else:
                top[x] = name
    root = find(next(iter(rows)))
    return state[root], top


def _halved(edges: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Add ``_sub``, the problem of each edge, and put components of lower problems in the place of rows."""
    edges = stage(edges.withColumn("_sub", F.lit("")), "tree")
    while True:
        sizes = edges.groupBy(*keys, "_sub").agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_rank", 0.5, 10_000).alias("_mid"))
        big = stage(sizes.where(F.col("_n") > most).drop("_n"), "big")
        if big.isEmpty():
            discard(big)
            return edges
        marked = stage(edges.join(big, [*keys, "_sub"], "left"), "marked")
        lower = marked.where("_rank <= _mid")
        comp = stage(connected_components(lower.select(*keys, "_sub", "u", "v"), [*keys, "_sub"]), "parts")
        to = lambda c, new: comp.select(*keys, "_sub", F.col("node").alias(c), F.col("component").alias(new))
        below = (lower.join(to("u", "_c"), [*keys, "_sub", "u"])
                 .select(*keys, "u", "v", "w", "_rank", F.concat("_sub", F.lit("/"), "_c").alias("_sub")))
        above = (marked.where("_rank > _mid").join(to("u", "_cu"), [*keys, "_sub", "u"], "left").join(to("v", "_cv"), [*keys, "_sub", "v"], "left")
                 .select(*keys, F.coalesce("_cu", "u").alias("u"), F.coalesce("_cv", "v").alias("v"), "w", "_rank", F.concat("_sub", F.lit("+")).alias("_sub")))
        rest = marked.where("_mid IS NULL").select(*keys, "u", "v", "w", "_rank", "_sub")
        old, edges = edges, stage(rest.unionByName(below).unionByName(above), "tree")
        for t in (old, big, marked, comp):
            discard(t)


def chosen_clusters(tree: DataFrame, groups: DataFrame, keys: Sequence[str], most: int | None = None) -> DataFrame:
    """(keys, _id, cluster): the smallest row id of the chosen cluster of each row that has one.

    ``tree`` has the keys and edges u, v, w; ``groups`` the keys and ``_least``, the rows of a cluster at least.
    """
    keys = list(keys)
    order = ["w", "u", "v"]
    ranked = tree.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_rank", F.monotonically_increasing_id())
    edges = _halved(stage(ranked, "ranked"), keys, most or EDGES)
    place = [*keys, "_sub"]
    # A vertex stands in problems of ascending weights: first as a row, then as what the problem before has joined.
    ends = edges.select(*place, "_rank", F.explode(F.array("u", "v")).alias("vertex")).groupBy(*place, "vertex").agg(F.min("_rank").alias("_rank"))
    from_rank = edges.groupBy(*place).agg(F.min("_rank").alias("_from"))
    along = W.partitionBy(*keys, "vertex").orderBy("_from")
    vertices = stage(ends.drop("_rank").join(from_rank, place).withColumns({"_below": F.lag("_sub").over(along), "_above": F.lead("_sub").over(along)}), "vertices")
    heads = vertices.groupBy(*place).agg(F.min_by(F.struct("vertex", "_above"), "vertex").alias("_head"))
    heads = stage(heads.select(*place, F.col("_head.vertex").alias("_root"), F.col("_head._above").alias("_above")), "heads")
    done = tops = None
    answers: list[DataFrame] = []
    group = F.sum(F.when(F.col("_below").isNotNull(), 1).otherwise(0))
    waiting = stage(vertices.groupBy(*place).agg(group.alias("_open")), "waiting")
    schema = T.StructType([*[edges.schema[k] for k in place], T.StructField("vertex", T.LongType()), T.StructField("top", T.LongType()),
                           *[T.StructField(c, T.DoubleType()) for c in ("n", "l", "x")]])

    @plain
    def run(e: dict, p: dict) -> dict:
        order = np.argsort(e["_rank"])
        rows = dict(zip(p["vertex"].tolist(), zip(p["n"].tolist(), p["l"].tolist(), p["x"].tolist())))
        whole, top = solve(*(e[c][order].tolist() for c in ("u", "v", "w")), rows, int(p["_least"][0]))
        out = {k: np.repeat(e[k][:1], len(top)) for k in place} | {c: np.full(len(top), x) for c, x in zip(("n", "l", "x"), whole)}
        return out | {"vertex": np.array(list(top), np.int64), "top": np.array(list(top.values()), object)}

    depth = 0
    while True:
        if depth == 0:
            ready = waiting.where("_open = 0").select(*place)
        else:
            # Problems whose lower ones are all solved, the last of them in the round before.
            solved = vertices.where("_below IS NOT NULL").join(done.select(*keys, F.col("_sub").alias("_below"), F.lit(True).alias("_ok")), [*keys, "_below"])
            ready = (solved.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")).join(waiting, place).where("_n = _open").select(*place)
                     .join(done.select(*place), place, "left_anti"))
        ready = stage(ready, "ready")
        if ready.isEmpty():
            discard(ready)
            break
        own = vertices.join(ready, place, "left_semi").select(*place, "vertex", "_below")
        if done is None:
            inner = own.select(*place, "vertex", F.lit(1.0).alias("n"), F.lit(0.0).alias("l"), F.lit(0.0).alias("x"))
        else:
            inner = (own.join(done.select(*keys, F.col("_sub").alias("_below"), "n", "l", "x"), [*keys, "_below"], "left")
                     .select(*place, "vertex", F.coalesce("n", F.lit(1.0)).alias("n"), F.coalesce("l", F.lit(0.0)).alias("l"), F.coalesce("x", F.lit(0.0)).alias("x")))
        left = pack(edges.join(ready, place, "left_semi").select(*place, "u", "v", "w", "_rank"), place, "e:")
        right = pack(inner.join(groups, keys), place, "p:")
        answer = stage(map_packed(left.join(right, place), place, ["e:", "p:"], run, schema), "solved")
        answers.append(answer)
        now = answer.groupBy(*place).agg(F.first("n").alias("n"), F.first("l").alias("l"), F.first("x").alias("x"))
        old, done = done, stage(now if done is None else done.unionByName(now), "sums")
        for t in (ready, old):
            if t is not None:
                discard(t)
        depth += 1
    if not answers:
        return tree.select(*keys, F.col("u").alias("_id"), F.lit(None).cast("long").alias("cluster")).limit(0)
    tops = answers[0]
    for a in answers[1:]:
        tops = tops.unionByName(a)
    tops = stage(tops.select(*place, "vertex", "top"), "tops")
    # From the top down: what holds a problem's own vertex in the problem above holds all of it.
    around = heads.where("_above IS NULL").select(*place, F.lit(None).cast("long").alias("_outer"))
    known = around = stage(around, "around")
    for _ in range(depth - 1):
        over = around.select(*keys, F.col("_sub").alias("_above"), "_outer")
        here = tops.select(*keys, F.col("_sub").alias("_above"), F.col("vertex").alias("_root"), "top")
        around = stage(heads.join(over, [*keys, "_above"]).join(here, [*keys, "_above", "_root"])
                       .select(*place, F.coalesce("_outer", "top").alias("_outer")), "around")
        known = known.unionByName(around)
    rows = vertices.where("_below IS NULL").select(*place, "vertex").join(tops, [*place, "vertex"]).join(known, place)
    out = stage(rows.select(*keys, F.col("vertex").alias("_id"), F.coalesce("_outer", "top").alias("cluster")).where("cluster IS NOT NULL"), "clusters")
    for t in (edges, vertices, heads, waiting, done, tops, *answers):
        discard(t)
    return out
