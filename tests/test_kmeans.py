"""K-means with several starts, many models at once, and the silhouette from moments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paceline.operators import clustering, metrics


def frame(spark, groups):
    rows = [(g, i, float(a), float(b)) for g, x in groups.items() for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "g int, id long, x double, y double").repartition(5)


def blobs(seed, centres, n=30, scale=1.0):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(c, 0.2, (n, 2)) for c in centres]) * scale


FOUR = [(0, 0), (0, 5), (9, 0), (9, 5)]


def lloyd(x, c):
    while True:
        label = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[label == j].mean(0) if (label == j).any() else c[j] for j in range(len(c))])
        if np.allclose(new, c, rtol=0, atol=1e-12):
            return c, ((x[:, None] - c[None]) ** 2).sum(2).min(1).sum()
        c = new


def test_best_of_several_starts(spark):
    groups = {1: blobs(1, FOUR), 2: blobs(2, FOUR[:2]), 3: blobs(3, FOUR, scale=1e12), 4: np.zeros((2, 2))}
    got = {(r.g, r.k): r for r in clustering.kmeans_models(frame(spark, groups), ["g"], "id", ["x", "y"], (2, 4), starts=8).collect()}
    assert set(got) == {(1, 2), (1, 4), (2, 2), (2, 4), (3, 2), (3, 4), (4, 2)}
    for g in (1, 3):
        x = groups[g]
        ideal = sum(((p - p.mean(0)) ** 2).sum() for p in np.split(x, 4))
        assert got[g, 4].inertia == pytest.approx(ideal)  # a single start may end in a worse one
    for (g, k), r in got.items():
        c, cost = lloyd(groups[g], np.array(r._c))
        assert cost == pytest.approx(r.inertia, rel=1e-9, abs=1e-9) and np.allclose(c, r._c)  # a fixed point


def test_labels_of_the_best_model(spark):
    x = blobs(4, FOUR)
    rows = clustering.kmeans_best(frame(spark, {1: x}), ["g"], "id", ["x", "y"], 4).orderBy("id").collect()
    label = [r.cluster_label for r in rows]
    assert all(len(set(label[j * 30:j * 30 + 30])) == 1 for j in range(4)) and set(label[:60]) == {0, 1} and set(label[60:]) == {2, 3}
    again = clustering.kmeans_best(frame(spark, {1: x}), [], "id", ["x", "y"], 4).orderBy("id").collect()
    assert [r.cluster_label for r in again] == [r.cluster_label for r in rows]


def test_each_k_is_the_single_model(spark):
    d = frame(spark, {1: blobs(5, FOUR, 9), 2: blobs(6, FOUR[:1], 1), 3: blobs(7, FOUR[:3], 1)})
    many = {(r.k, r.g, r.id): r.cluster_label for r in clustering.kmeans_each_k(d, ["g"], ["x", "y"], (2, 3, 5)).collect()}
    for k in (2, 3, 5):
        one = {(k, r.g, r.id): r.cluster_label for r in clustering.kmeans(d, ["g"], ["x", "y"], k).collect() if r.cluster_label >= 0}
        assert one == {p: label for p, label in many.items() if p[0] == k}


@pytest.mark.parametrize("offset", [0.0, 1e7])
def test_squared_silhouette_against_all_pairs(spark, offset):
    rng = np.random.default_rng(9)
    x, label = rng.normal(size=(60, 2)) + offset, rng.integers(0, 4, 60)
    label[0] = 7  # a cluster of one row
    d = frame(spark, {1: x}).join(spark.createDataFrame([(i, int(v)) for i, v in enumerate(label)], "id long, cluster_label int"), "id")
    sq = ((x[:, None] - x[None]) ** 2).sum(2)
    scores = []
    for i in range(60):
        mine = label == label[i]
        a = sq[i][mine].sum() / (mine.sum() - 1) if mine.sum() > 1 else None
        b = min(sq[i][label == c].mean() for c in set(label.tolist()) - {label[i]})
        scores.append(0.0 if a is None else (b - a) / max(a, b))
    assert metrics.silhouette_squared(d, ["g"], ["x", "y"]).first().silhouette_score == pytest.approx(np.mean(scores), abs=1e-6)
    alone = d.withColumn("cluster_label", F.lit(1))
    assert metrics.silhouette_squared(alone, [], ["x", "y"]).first().silhouette_score is None


def test_choose_k_by_either_silhouette(spark):
    d = frame(spark, {1: blobs(8, FOUR[:3], 25)})
    assert metrics.choose_k(d, ["g"], "id", ["x", "y"], (2, 3, 4), method="silhouette_squared").first().k == 3
    assert metrics.choose_k(d, ["g"], "id", ["x", "y"], (2, 3, 4)).first().k == 3
