"""Approximate nearest neighbours on robustly pruned directed graphs, one per shard.

Distinct vectors are dealt to shards of bounded size by their hash. In each shard a graph is built
in batches: a greedy beam search from a few entry rows proposes the neighbours of a vector, and
pruning keeps the nearest of them and every other that is not much nearer to one already kept, so
the edges point in diverse directions. A query is searched in every shard by the same beam search,
and the nearest of all shards are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from paceline.session import stage

#: Distinct vectors of a shard on average, and queries that one task searches a shard with.
SHARD_ROWS, QUERY_ROWS = 4096, 4096
#: Edges of a vector, vectors kept by a search, and how much nearer a kept edge must be to make another needless.
DEGREE, BEAM, RELAX = 24, 64, 1.2
#: Entry rows taken far apart from each other, and as many at random.
ENTRIES = 16
SEED = 11
#: Numbers that differences are taken of at once.
_AT_ONCE = 1 << 21


def _apart(x: np.ndarray, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of ``q[i]`` to the vectors ``rows[i]``, from differences, so that no offset or outlier costs digits."""
    out = np.empty(rows.shape, x.dtype)
    step = max(1, _AT_ONCE // max(1, rows.shape[1] * x.shape[1]))
    for at in range(0, len(rows), step):
        apart = x[rows[at:at + step]] - q[at:at + step, None]
        out[at:at + step] = np.einsum("ijk,ijk->ij", apart, apart)
    return out


def beam_search(x: np.ndarray, graph: np.ndarray, entry: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, squared distances) of the ``beam`` nearest found from the rows ``entry`` on, nearest first, for all queries at once.

    Every step expands the nearest vector of each query that was not expanded yet, until all kept
    ones are. Missing entries are -1 and infinite. ``graph`` has -1 for absent edges.
    """
    n, count = len(x), len(queries)
    rows = np.full((count, beam), -1, np.int64)
    dist = np.full((count, beam), np.inf, x.dtype)
    done = np.ones((count, beam), bool)
    seen = np.zeros((count, n), bool)
    first = np.broadcast_to(entry, (count, len(entry)))
    away = _apart(x, first, queries)
    by = np.argsort(away, 1, kind="stable")[:, :beam]
    rows[:, :by.shape[1]], dist[:, :by.shape[1]] = np.take_along_axis(first, by, 1), np.take_along_axis(away, by, 1)
    done[:, :by.shape[1]], seen[:, entry] = False, True
    live = np.arange(count)
    while len(live):
        at = np.where(done[live], np.inf, dist[live]).argmin(1)
        open_ = ~done[live, at]
        live, at = live[open_], at[open_]
        if not len(live):
            break
        done[live, at] = True
        near = graph[rows[live, at]]
        new = (near >= 0) & ~seen[live[:, None], near]
        seen[live[:, None], np.where(near >= 0, near, entry[0])] = True
        far = np.where(new, _apart(x, np.maximum(near, 0), queries[live]), np.inf)
        all_rows, all_dist = np.hstack([rows[live], np.where(new, near, -1)]), np.hstack([dist[live], far])
        all_done = np.hstack([done[live], ~new])
        best = np.argsort(all_dist, 1, kind="stable")[:, :beam]
        rows[live], dist[live] = np.take_along_axis(all_rows, best, 1), np.take_along_axis(all_dist, best, 1)
        done[live] = np.take_along_axis(all_done, best, 1)
    return rows, dist


def prune(x: np.ndarray, own: np.ndarray, cand: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Robust pruning for many vectors at once: rows ``own`` choose up to ``degree`` of ``cand[i]`` (-1: none)."""
    cand = np.where(cand == own[:, None], -1, cand)
    order = np.sort(cand, 1)  # each candidate once
    order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
    cand = order
    dist = np.where(cand >= 0, _apart(x, np.maximum(cand, 0), x[own]), np.inf)
    by = np.argsort(dist, 1, kind="stable")
    cand, dist = np.take_along_axis(cand, by, 1), np.take_along_axis(dist, by, 1)
    alive = cand >= 0
    out = np.full((len(own), degree), -1, np.int64)
    rows = np.arange(len(own))
    for k in range(degree):
        pick = alive.argmax(1)
        has = alive[rows, pick]
        if not has.any():
            break
        star = cand[rows, pick]
        out[has, k] = star[has]
        between = _apart(x, np.maximum(cand, 0), x[np.maximum(star, 0)])
        alive &= (relax * relax * between > dist) & has[:, None]
        alive[rows, pick] = False
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX, batch: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entry rows) over distinct vectors: edges by beam search and robust pruning, with their reverse edges.

    Groups that lie far apart may end without edges between them, so there are several entry rows,
    and every row can be reached from one of them.
    """
    n = len(x)
    rng = np.random.default_rng(SEED)
    entry = _entries(x, rng)
    graph = np.full((n, degree), -1, np.int64)
    if n > 1:  # a random graph to start from, so that everything can be reached
        start = rng.integers(0, n, (n, min(degree, n - 1)))
        graph[:, :start.shape[1]] = np.where(start == np.arange(n)[:, None], -1, start)
    for alpha in (1.0, relax):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            own = order[at:at + batch]
            found, _ = beam_search(x, graph, entry, x[own], beam)
            graph[own] = prune(x, own, np.hstack([found, graph[own]]), degree, alpha)
            _add_reverse(x, graph, own, degree, alpha)
    return graph, _reaching(graph, entry)


def _entries(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The row in the middle, rows each as far as can be from those before, and rows at random."""
    picked = [int(((x - np.median(x, 0)) ** 2).sum(1).argmin())]
    away = np.full(len(x), np.inf)
    for _ in range(min(ENTRIES, len(x)) - 1):
        away = np.minimum(away, _apart(x, np.full((len(x), 1), picked[-1]), x)[:, 0])
        picked.append(int(away.argmax()))
    return np.unique(np.concatenate([picked, rng.integers(0, len(x), ENTRIES)]))


def _reaching(graph: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """``entry`` and further rows, until all rows can be reached."""
    reached = np.zeros(len(graph), bool)
    picked = [entry]
    while True:
        front = picked[-1]
        reached[front] = True
        while len(front):
            ends = np.unique(graph[front])
            front = ends[(ends >= 0) & ~reached[ends]]
            reached[front] = True
        if reached.all():
            return np.concatenate(picked)
        picked.append(np.array([reached.argmin()]))


def _add_reverse(x: np.ndarray, graph: np.ndarray, own: np.ndarray, degree: int, relax: float) -> None:
    """Give the targets of the edges of ``own`` edges back; targets with too many are pruned again."""
    ends = graph[own]
    target, back = ends.ravel(), np.repeat(own, graph.shape[1])
    target, back = target[target >= 0], back[target >= 0]
    if not len(target):
        return
    by = np.argsort(target, kind="stable")
    target, back = target[by], back[by]
    hit, first, times = np.unique(target, return_index=True, return_counts=True)
    width = times.max()
    extra = np.full((len(hit), width), -1, np.int64)
    extra[np.repeat(np.arange(len(hit)), times), np.arange(len(target)) - np.repeat(first, times)] = back
    graph[hit] = prune(x, hit, np.hstack([graph[hit], extra]), degree, relax)


_FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("kind", T.LongType()), T.StructField("score", T.DoubleType())])


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v): rows whose id is known and whose vector holds finite numbers only and is not zero; others take no part."""
    v = F.col(vector).cast("array<double>")
    ok = F.forall(v, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf"))) & F.exists(v, lambda a: a != 0.0)
    return vectors.where(F.col(id_col).isNotNull() & ok).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector: str = "embedding",
           shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, degree: int = DEGREE, beam: int = BEAM,
           relax: float = RELAX) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found of every query, nearest first, ties to the smaller id.

    ``score`` is the Euclidean distance in double precision. A query's own row is no candidate;
    other rows with an equal vector are. All vectors must have one length; rows with another length
    than most are compared with none. Equal vectors are indexed once, and the first ``k + 1`` ids of
    each stand for them, which is all that can appear in a result. Vectors that are NULL, zero, or
    hold NULL or non-finite numbers take no part. Rows that repeat id and vector count once. An
    empty table gives an empty result.
    """
    rows = stage(usable(vectors, id_col, vector).withColumn("kind", F.xxhash64("v")).dropDuplicates(["id", "kind"]), "vectors")
    # Equal vectors form a kind; a kind is known by the hash of its vector.
    kinds = stage(rows.groupBy("kind").agg(F.first("v").alias("v")), "kinds")
    shards = max(1, -(-kinds.count() // shard_rows))
    by_id = W.partitionBy("kind").orderBy("id")
    members = rows.select("kind", "id").withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= k + 1).drop("nth")

    def index(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("kind", ignore_index=True)
        x = np.stack(pdf["v"].to_numpy())
        graph, entry = build(x, degree, beam, relax)
        pdf["edges"] = list(graph.astype(np.int32))
        pdf["pos"], pdf["entry"] = np.arange(len(pdf), dtype=np.int32), np.isin(np.arange(len(pdf)), entry)
        return pdf[["shard", "length", "kind", "v", "pos", "entry", "edges"]]

    dealt = kinds.withColumn("shard", F.pmod(F.xxhash64("kind"), F.lit(shards)).cast("int")).withColumn("length", F.size("v"))
    built = stage(dealt.groupBy("shard", "length").applyInPandas(
        index, "shard int, length int, kind long, v array<double>, pos int, entry boolean, edges array<int>"), "graphs")

    asked = usable(queries, id_col, vector).withColumn("length", F.size("v")).dropDuplicates(["id"])
    blocks = max(1, -(-asked.count() // query_rows))
    asked = (asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    shelves = built.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    want = max(beam, 2 * (k + 1))

    def look(shelf: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if shelf.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "kind": [], "score": []})
        shelf = shelf.sort_values("pos", ignore_index=True)
        x, q = np.stack(shelf["v"].to_numpy()), np.stack(asked["v"].to_numpy())
        graph, entry = np.stack(shelf["edges"].to_numpy()).astype(np.int64), np.flatnonzero(shelf["entry"])
        ids, kinds = asked["id"].to_numpy(), shelf["kind"].to_numpy()
        parts = []
        for at in range(0, len(q), 256):
            own = q[at:at + 256]
            found, _ = beam_search(x, graph, entry, own, want)
            exact = np.sqrt(((x[np.maximum(found, 0)] - own[:, None]) ** 2).sum(2))
            exact[found < 0] = np.inf
            best = np.argsort(exact, 1, kind="stable")[:, :k + 1]
            row, pick, score = np.arange(len(own))[:, None], np.take_along_axis(found, best, 1), np.take_along_axis(exact, best, 1)
            ok = pick >= 0
            parts.append(pd.DataFrame({"query_id": np.broadcast_to(ids[at:at + 256][row], pick.shape)[ok], "kind": kinds[pick[ok]],
                                       "score": score[ok]}))
        return pd.concat(parts)

    found = (shelves.groupBy("shard", "length", "block").cogroup(asked.groupBy("shard", "length", "block")).applyInPandas(look, _FOUND))
    # A kind that ties with the last one may hold smaller ids, so ties stay.
    near = found.withColumn("_r", F.rank().over(W.partitionBy("query_id").orderBy("score"))).where(F.col("_r") <= k + 1).drop("_r")
    order = W.partitionBy("query_id").orderBy("score", "id")
    return (near.join(members, "kind").where("id != query_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
