"""Clusters, densities, change points and forests against brute force on small frames."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from paceline.operators import changepoints, clustering, density, forest, metrics, tiles
from paceline.roles import Roles

ROLES = Roles()


def _points(spark, xs, key=1):
    return spark.createDataFrame([(key, i, *map(float, p)) for i, p in enumerate(xs)], "g int, id long, x double, y double")


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(0)
    return np.vstack([rng.normal(c, 0.15, (25, 2)) for c in ((0, 0), (3, 3), (0, 4))] + [rng.uniform(-4, 8, (6, 2))])


def test_kmeans_is_a_fixed_point(spark, blobs):
    rows = clustering.kmeans(_points(spark, blobs), ["g"], ["x", "y"]).orderBy("id").collect()
    lab = np.array([r.cluster_label for r in rows])
    cents = np.array([blobs[lab == j].mean(0) for j in range(3)])
    d = np.sqrt(((blobs[:, None] - cents) ** 2).sum(2))
    assert (d.argmin(1) == lab).all()
    assert [r.cluster_centroid_distance for r in rows] == pytest.approx(d.min(1).tolist())


def test_kmeans_small_group_and_missing_feature(spark):
    d = _points(spark, [(0, 0), (1, 1)]).unionByName(_points(spark, [(0, 0), (1, 1), (5, 5), (np.nan, 1)], key=2))
    out = {(r.g, r.id): r.cluster_label for r in clustering.kmeans(d, ["g"], ["x", "y"]).collect()}
    assert out[1, 0] == out[1, 1] == -1 and out[2, 3] == -1 and {out[2, i] for i in range(3)} == {0, 1, 2}


def test_semantics(spark):
    rows = [(1, 0, 0, 0.0), (1, 1, 0, 0.1), (1, 2, 0, 0.0), (1, 3, 1, -2.0), (1, 4, 2, 3.0), (2, 0, 5, 1.0), (2, 1, 5, 1.0), (2, 2, 7, 0.5)]
    d = spark.createDataFrame(rows, "g int, id int, cluster_label int, lap_delta double")
    out = {(r.g, r.id): (r.cluster_semantic, r.cluster_semantic_clean) for r in clustering.normalize_semantics(d, ["g"]).collect()}
    assert out[1, 0] == ("base", True) and out[1, 3] == ("push", True) and out[1, 4] == ("degraded", True)
    assert out[2, 0] == ("base", True) and out[2, 2] == ("push", True)


@pytest.mark.parametrize("rows", [7, 1024])
def test_silhouette(spark, blobs, rows, monkeypatch):
    monkeypatch.setattr(metrics, "tile_pairs", lambda *a: tiles.tile_pairs(*a, tile_rows=rows))
    lab = np.arange(len(blobs)) // 25
    lab[-1] = 9
    d = _points(spark, blobs).join(spark.createDataFrame([(i, int(v)) for i, v in enumerate(lab)], "id long, cluster_label int"), "id")
    dist = np.sqrt(((blobs[:, None] - blobs) ** 2).sum(2))
    s = []
    for i, v in enumerate(lab):
        own = lab == v
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = dist[i, own].sum() / (own.sum() - 1)
        b = min(dist[i, lab == o].mean() for o in set(lab) if o != v)
        s.append((b - a) / max(a, b))
    assert metrics.silhouette(d, ["g"], "id", ["x", "y"]).first().silhouette_score == pytest.approx(np.mean(s))


def _dbscan(x, eps, m):
    near = np.sqrt(((x[:, None] - x) ** 2).sum(2)) <= eps
    core, lab, c = near.sum(1) >= m, np.full(len(x), -1), 0
    for i in range(len(x)):
        if not core[i] or lab[i] >= 0:
            continue
        todo, lab[i] = [i], c
        while todo:
            for j in np.flatnonzero(near[todo.pop()]):
                if lab[j] < 0:
                    lab[j] = c
                    if core[j]:
                        todo.append(j)
        c += 1
    return lab


@pytest.mark.parametrize("rows", [5, 1024])
@pytest.mark.parametrize("eps", [0.2, 0.5])
def test_dbscan(spark, blobs, rows, eps, monkeypatch):
    monkeypatch.setattr(density, "TILE_ROWS", rows)
    monkeypatch.setattr(density, "tile_pairs", lambda *a: tiles.tile_pairs(*a, tile_rows=rows))
    x = np.vstack([blobs, blobs[:4], blobs[:1]])
    out = density.dbscan(_points(spark, x), ["g"], "id", ["x", "y"], eps=eps).orderBy("id").collect()
    assert [r.cluster_label for r in out] == _dbscan(x, eps, 3).tolist()
    assert all(r.is_noise == (r.cluster_label == -1) for r in out)


def test_dbscan_estimated_radius(spark, blobs):
    k = np.sort(np.sqrt(((blobs[:, None] - blobs) ** 2).sum(2)), axis=1)[:, 2]
    out = density.dbscan(_points(spark, blobs), ["g"], "id", ["x", "y"], eps=None).orderBy("id").collect()
    assert [r.cluster_label for r in out] == _dbscan(blobs, np.percentile(k, 90), 3).tolist()


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([(1, i, i + 1) for i in range(40)] + [(2, 5, 9), (1, 100, 101)], "g int, u long, v long")
    out = {(r.g, r.node): r.component for r in density.connected_components(e, ["g"]).collect()}
    assert all(out[1, i] == 0 for i in range(41)) and out[1, 101] == 100 and out[2, 9] == 5


def test_hdbscan_finds_blobs(spark, blobs):
    lab = np.array([r.cluster_label for r in density.hdbscan(_points(spark, blobs), ["g"], "id", ["x", "y"]).orderBy("id").collect()])
    for b in range(3):
        part = lab[b * 25:(b + 1) * 25]
        top = np.bincount(part[part >= 0]).argmax()
        assert (part == top).mean() > 0.8
    assert len({np.bincount(lab[b * 25:(b + 1) * 25][lab[b * 25:(b + 1) * 25] >= 0]).argmax() for b in range(3)}) == 3
    with pytest.raises(ValueError):
        density.hdbscan(_points(spark, blobs), ["g"], "id", ["x", "y"], max_rows=10)


def _cost(y, cuts, pen):
    edges = [0, *cuts, len(y)]
    return sum(((y[a:b] - y[a:b].mean()) ** 2).sum() + pen for a, b in itertools.pairwise(edges))


@pytest.mark.parametrize("pen,min_size", [(0.5, 2), (1.0, 3), (3.0, 3)])
def test_partition_is_optimal(pen, min_size):
    for seed in range(12):
        rng = np.random.default_rng(seed)
        y = np.concatenate([rng.normal(m, 0.6, rng.integers(2, 6)) for m in rng.normal(0, 2, 3)])
        state = changepoints.fresh_state()
        back = changepoints.advance(y, state, pen, min_size, 1)
        cuts = sorted(changepoints._breaks(back, 0, len(y))[0])
        best = min((_cost(y, c, pen) for k in range(len(y) // min_size)
                    for c in itertools.combinations(range(1, len(y)), k)
                    if all(b - a >= min_size for a, b in itertools.pairwise([0, *c, len(y)]))))
        assert _cost(y, cuts, pen) == pytest.approx(best)


@pytest.mark.parametrize("lane", [7, 50, 10_000])
def test_breaks_do_not_depend_on_lanes(spark, lane):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(3):
        y = np.concatenate([rng.normal(m, 0.3, 40) for m in (0, 2, -1, 4)][:g + 2])
        rows += [(g, i, float(v)) for i, v in enumerate(y)]
    d = spark.createDataFrame(rows, "g int, idx long, y double")
    got = changepoints.find_breaks(d, ["g"], lane_rows=lane).collect()
    cuts = {g: sorted(r.cut for r in got if r.g == g) for g in range(3)}
    assert cuts == {0: [40], 1: [40, 80], 2: [40, 80, 120]}


def test_cliff_rules(spark):
    rows = []
    for run, tail in ((1, 2.0), (2, -2.0), (3, None)):
        n = 25 if tail is not None else 7
        for s in range(1, n + 1):
            y = 0.08 * s if s <= 13 else 0.08 * 13 + (tail or 0)
            rows.append((1, run, (run - 1) * 30 + s, y, s == 10))
    d = spark.createDataFrame(rows, "entity int, run int, seq long, lap_delta double, is_anomaly boolean")
    laps, runs = changepoints.detect_changepoints(d, ROLES, penalty=1.0)
    r = {x.run: x for x in runs.collect()}
    assert r[1].has_cliff and r[1].cliff_lap == 14 and r[1].cliff_validated and r[1].n_anomalies_filtered == 1
    assert r[1].laps_before_cliff == 9 and r[1].n_laps_analyzed == 21 and r[1].cliff_delta_magnitude > 1
    assert not r[2].has_cliff and not r[3].has_cliff and r[3].n_laps_in_stint == 7
    marks = laps.where("run = 1").orderBy("seq").collect()
    assert [x.seq for x in marks if x.is_cliff_lap] == [14] and [x.stint_regime for x in marks] == [0] * 13 + [1] * 12
    assert laps.where("run <> 1").agg(F.max("stint_regime")).first()[0] == 0


def test_penalty_sweep_is_monotone(spark):
    rng = np.random.default_rng(8)
    rows = [(1, 1, i, float(v), False) for i, v in enumerate(np.concatenate([rng.normal(m, 0.5, 12) for m in (0, 1, 2)]), 1)]
    d = spark.createDataFrame(rows, "entity int, run int, seq long, lap_delta double, is_anomaly boolean")
    out = changepoints.penalty_sweep(d, ROLES, (0.5, 3.0, 1000.0)).orderBy("penalty").collect()
    assert [r.n_stints for r in out] == [1, 1, 1] and out[0].n_cliffs >= out[-1].n_cliffs == 0


def test_forest_finds_planted_rows(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 2))
    x[[5, 77, 123]] = [[9, 9], [-9, 8], [10, -10]]
    d = _points(spark, x).unionByName(_points(spark, x[:5], key=2))
    a = forest.detect_anomalies(d, ["g"], "id", ["x", "y"], contamination=0.02).collect()
    flagged = {r.id for r in a if r.g == 1 and r.is_anomaly}
    assert {5, 77, 123} <= flagged and len(flagged) <= 6
    assert all(not r.is_anomaly and r.anomaly_score == 0.0 for r in a if r.g == 2)
    b = forest.isolation_scores(d, ["g"], "id", ["x", "y"], score_rows=40).collect()
    scores = {r.id: r.anomaly_score for r in a if r.g == 1}
    assert all(scores[r.id] == pytest.approx(r.anomaly_score) for r in b)


def test_forest_with_a_share_per_group(spark):
    rng = np.random.default_rng(9)
    d = _points(spark, rng.normal(size=(100, 2))).unionByName(_points(spark, rng.normal(size=(100, 2)), key=2))
    d = d.withColumn("share", F.when(F.col("g") == 1, 0.05).otherwise(0.2))
    n = {r.g: r.n for r in forest.detect_anomalies(d, ["g"], "id", ["x", "y"], "share").groupBy("g").agg(F.count_if("is_anomaly").alias("n")).collect()}
    assert n == {1: 5, 2: 20}


def test_choose_k(spark, blobs):
    d = _points(spark, blobs[:75])
    assert metrics.choose_k(d, ["g"], "id", ["x", "y"], (2, 3, 4)).first().k == 3
    assert metrics.choose_k(d, ["g"], "id", ["x", "y"], (2, 3, 4), method="elbow").first().k == 3


def test_forest_trees_against_a_plain_walk(spark):
    """Trees grown row by row from the same draws, on points with ties, give the nodes and scores."""
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(60, 2)), 1)
    d = _points(spark, x).unionByName(_points(spark, [[1, 1]] * 12, key=2))
    number = dict(d.where("g = 1").select("id", forest.row_number_of("id")).collect())
    trees, sample = 20, 16
    want, total, m = {}, np.zeros(len(x)), None
    picks = []
    for t in range(trees):
        h = {i: int(forest.draws(number[i], t, 42)) for i in range(60)}
        picks.append(sorted((i for i in h if h[i] < 2 * sample / 60 * forest.PRIME), key=lambda i: (h[i], i)))
    m = min(sample, min(map(len, picks)))
    for t in range(trees):
        def build(v, level, rows, t=t):
            luck = [int(forest.draws(v * 3 + k, t, 43)) for k in range(3)]
            wide = [k for k in range(2) if len({x[i][k] for i in rows}) > 1]
            if len(rows) < 2 or not wide or level == int(np.ceil(np.log2(m))):
                want[t, v] = (None, None, level + float(forest._c(np.array([len(rows)]))[0]))
                return
            k = max(wide, key=lambda k: (luck[k], -k))
            lo, hi = min(x[i][k] for i in rows), max(x[i][k] for i in rows)
            cut = lo + luck[2] / forest.PRIME * (hi - lo)
            want[t, v] = (k, cut, None)
            build(2 * v, level + 1, [i for i in rows if x[i][k] <= cut])
            build(2 * v + 1, level + 1, [i for i in rows if x[i][k] > cut])
        build(1, 0, picks[t][:m])
        for i in range(60):
            v = 1
            while want[t, v][0] is not None:
                v = 2 * v + int(x[i][want[t, v][0]] > want[t, v][1])
            total[i] += want[t, v][2]
    got = forest.isolation_trees(d, ["g"], "id", ["x", "y"], trees=trees, sample=sample)
    mine = {(r.tree, r.node): (r.feature, r.cut, r.depth) for r in got.where("g = 1").collect()}
    assert set(mine) == set(want)
    for at, (k, cut, depth) in want.items():
        assert mine[at][0] == k and mine[at][1:] == (pytest.approx(cut), pytest.approx(depth))
    assert got.where("g = 2 AND node <> 1").count() == 0 and got.where("g = 2").count() == trees
    scores = forest.isolation_scores(d, ["g"], "id", ["x", "y"], trees=trees, sample=sample).where("g = 1").collect()
    assert len(scores) == 60
    for r in scores:
        assert r.anomaly_score == pytest.approx(-2 ** (-total[r.id] / trees / float(forest._c(np.array([m]))[0])))
