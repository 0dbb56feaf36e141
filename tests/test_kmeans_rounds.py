"""A round over shares is one job that writes no table, and labels of many features are those of the differences."""

import numpy as np
import pytest

from paceline.operators import clustering
from tests.test_kmeans import frame, lloyd


def test_rounds_write_no_tables(spark, monkeypatch):
    x = np.random.default_rng(2).normal(0, 1, (300, 2))
    whole = clustering.kmeans(frame(spark, {1: x}), [], ["x", "y"]).orderBy("id").collect()
    written, moves, stage, moved = [], [], clustering.stage, clustering._moved
    monkeypatch.setattr(clustering, "stage", lambda df, name: written.append(name) or stage(df, name))
    monkeypatch.setattr(clustering, "_moved", lambda *a: moves.append(1) or moved(*a))
    monkeypatch.setattr(clustering, "GROUP_ROWS", 1)
    monkeypatch.setattr(clustering, "SHARE_ROWS", 40)
    shared = clustering.kmeans(frame(spark, {1: x}), [], ["x", "y"]).orderBy("id").collect()
    assert [r.cluster_label for r in shared] == [r.cluster_label for r in whole]
    assert len(moves) > 8 and len(written) < 8


def test_models_of_a_round_in_several_jobs(spark, monkeypatch):
    monkeypatch.setattr(clustering, "GROUP_ROWS", 1)
    monkeypatch.setattr(clustering, "SHARE_ROWS", 7)
    groups = {g: np.random.default_rng(g).normal(0, 1, (50, 2)) for g in range(4)}
    found = []
    for room in (1 << 25, 1):
        monkeypatch.setattr(clustering, "SUMS_BYTES", room)
        rows = clustering.kmeans_each_k(frame(spark, groups), ["g"], ["x", "y"], (2, 3)).collect()
        found.append(sorted((r.g, r.k, r.id, r.cluster_label) for r in rows))
    assert found[0] == found[1] and len(found[0]) == 400
    x = groups[3]
    at = lloyd(x, np.stack([x.mean(0) + (j - 1) * x.std(0) for j in range(3)]))[0]
    assert [f[3] for f in found[0] if f[:2] == (3, 3)] == ((x[:, None] - at) ** 2).sum(2).argmin(1).tolist()


@pytest.mark.parametrize("dims", [8, 64])
@pytest.mark.parametrize("far", [0.0, 1e7, 1e200])
def test_labels_and_sums_from_products(dims, far):
    rng = np.random.default_rng(dims)
    f = np.concatenate([rng.normal(0, 1, (300, dims)), rng.normal(9, 1, (20, dims))]) + far
    c = f[[3, 5, 3, 310]]  # two equal centroids; rows that are a centroid
    f[100:150] = (c[0] + c[1]) / 2  # rows between two
    label = clustering._labels(f, c)
    want = ((f[:, None] - c) ** 2).sum(2)
    assert (label == clustering._compared(f, c)).all() and (label != 2).all()
    assert np.allclose(want[np.arange(len(f)), label], want.min(1), rtol=1e-9)
    n, sums = clustering._sums(f, c)
    assert n.tolist() == [(label == j).sum() for j in range(4)]
    for j in range(4):
        assert np.allclose(sums[j], f[label == j].sum(0), rtol=1e-12)
