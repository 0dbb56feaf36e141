"""HDBSCAN over groups of any size against the whole hierarchy in memory."""

import numpy as np
import pytest

from paceline.operators import density
from paceline.operators.hierarchy import solve
from paceline.operators.nearest import Cells, distances, neighbours
from paceline.operators.spanning import local_tree, spanning_trees
from tests.brute_hdbscan import labels, spanning_tree


def frame(spark, groups):
    rows = [(g, i * 3 + 1, float(a), float(b)) for g, x in groups.items() for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "g int, id long, x double, y double").repartition(7)


def some_groups():
    rng = np.random.default_rng(5)
    blobs = np.concatenate([rng.normal(c, 0.3, (40, 2)) for c in ((0, 0), (3, 3), (0, 4))] + [rng.uniform(-2, 6, (20, 2))])
    return {1: blobs, 2: rng.integers(0, 7, (120, 2)).astype(float), 3: rng.normal(size=(90, 2)), 4: np.repeat(rng.normal(size=(9, 2)), 6, axis=0),
            5: rng.normal(size=(3, 2)), 6: rng.normal(size=(2, 2)), 7: rng.normal(size=(1, 2)), 8: np.zeros((30, 2))}


def clusters(rows):
    out = {}
    for r in rows:
        if r.cluster_label >= 0:
            out.setdefault((r.g, r.cluster_label), set()).add((r.id - 1) // 3)
    return {g: {frozenset(v) for (h, _), v in out.items() if h == g} for g in {r.g for r in rows}}


@pytest.mark.parametrize("tile,edges", [(1024, None), (1024, 11), (40, 30)])
def test_clusters_against_the_whole_hierarchy(spark, tile, edges):
    groups = some_groups() if tile > 40 else {g: x for g, x in some_groups().items() if g in (1, 2, 4, 6)}
    got = density.hdbscan(frame(spark, groups), ["g"], "id", ["x", "y"], tile_rows=tile, edges=edges).collect()
    assert len(got) == sum(map(len, groups.values()))
    assert clusters(got) == {g: labels(x) for g, x in groups.items()}
    # Labels are numbered by the smallest row.
    for g in groups:
        least = {}
        for r in got:
            if r.g == g and r.cluster_label >= 0:
                least[r.cluster_label] = min(r.id, least.get(r.cluster_label, r.id))
        assert sorted(least) == list(range(len(least))) and [least[c] for c in sorted(least)] == sorted(least.values())


def test_one_problem_is_the_whole_hierarchy():
    rng = np.random.default_rng(6)
    for i in range(60):
        n = int(rng.integers(2, 70))
        x = rng.integers(0, 5, (n, 2)).astype(float) if i % 2 else rng.normal(size=(n, 2))
        least = min(5, max(2, n // 4))
        u, v, w = local_tree(x, np.arange(n), min(3, least))
        assert sorted(zip(w, u, v)) == spanning_tree(x, min(3, least))
        order = sorted(range(len(u)), key=lambda j: (w[j], u[j], v[j]))
        _, top = solve([u[j] for j in order], [v[j] for j in order], [w[j] for j in order], {r: (1.0, 0.0, 0.0) for r in range(n)}, least)
        own = {}
        for r, c in top.items():
            own.setdefault(c, set()).add(r)
        assert {frozenset(s) for c, s in own.items() if c is not None} == (labels(x) if n >= 3 else set())


def test_trees_by_rounds(spark):
    rng = np.random.default_rng(7)
    groups = {1: rng.normal(size=(200, 2)), 2: rng.integers(0, 6, (150, 2)).astype(float)}
    rows = [(g, i, x.tolist(), 3) for g, own in groups.items() for i, x in enumerate(own)]
    d = spark.createDataFrame(rows, "g int, _id long, _f array<double>, _k int")
    got = spanning_trees(d, ["g"], tile_rows=50, cell_rows=20).collect()
    for g, own in groups.items():
        assert sorted((r.w, r.u, r.v) for r in got if r.g == g) == spanning_tree(own, 3)


def test_compared_pairs_grow_in_proportion(spark):
    counts = []
    for n in (3000, 30_000):
        x = np.random.default_rng(8).uniform(0, 1, (n, 2))
        d = spark.createDataFrame([(1, i, v.tolist()) for i, v in enumerate(x)], "g int, _id long, _f array<double>")
        seen = spark.sparkContext.accumulator(0)
        got = neighbours(Cells(d, ["g"], 128), 3, seen).where("_id < 20").collect()
        for i in range(20):
            assert sorted(r.d for r in got if r._id == i) == pytest.approx(np.sort(distances(x[i:i + 1], x)[0])[1:4])
        counts.append(seen.value)
    assert counts[1] < 20 * counts[0] and counts[1] < n * n / 20
