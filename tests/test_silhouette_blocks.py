"""The silhouette of a whole table: blocks of tiles meet without copies of rows, to the figures of the SQL that groups all pairs."""

import numpy as np
import pytest

from paceline.operators import metrics


def paired(x, ids, label):
    """As SQL has it: sums of distances by row id, own and other label; rows of one id are one row, rows without a label none."""
    has = [i for i, v in enumerate(label) if v is not None]
    sums = {}
    for i in has:
        for j in has:
            cell = sums.setdefault(ids[i], {}).setdefault((label[i], label[j]), [0.0, 0])
            cell[0] += float(np.sqrt(((x[i] - x[j]) ** 2).sum()))
            cell[1] += 1
    found = []
    for cells in sums.values():
        n = max((c for (own, o), (_, c) in cells.items() if own == o), default=None)
        a = max((d / (c - 1) for (own, o), (d, c) in cells.items() if own == o and c > 1), default=None)
        b = min((d / c for (own, o), (d, c) in cells.items() if own != o), default=None)
        if b is not None:
            found.append(0.0 if n == 1 else (b - a) / max(a, b))
    return np.mean(found)


@pytest.mark.parametrize("dims", [2, 9])
@pytest.mark.parametrize("kinds", [3, 40])
def test_blocks(spark, monkeypatch, dims, kinds):
    def copied(*args, **kwargs):
        raise AssertionError("rows are copied once per tile")

    rng = np.random.default_rng(dims)
    n = 150
    label = [int(v) for v in rng.integers(0, kinds, n)]
    x = rng.normal(0, 1, (n, dims)) + np.array(label)[:, None] % 5
    ids = [None if i % 40 == 39 else f"r{i - i % 30 // 29}" for i in range(n)]  # some come twice, some are missing
    label[7] = label[70] = None
    d = spark.createDataFrame([(r, v, *map(float, f)) for r, v, f in zip(ids, label, x)],
                              "id string, cluster_label int, " + ", ".join(f"f{i} double" for i in range(dims))).repartition(3)
    monkeypatch.setattr(metrics, "tile_pairs", copied)
    monkeypatch.setattr(metrics, "TILE_ROWS", 5)
    monkeypatch.setattr(metrics, "_STRIP", 3)
    for held in (1 << 22, 60):
        monkeypatch.setattr(metrics, "_HELD_SUMS", held)
        got = metrics.silhouette(d, [], "id", [f"f{i}" for i in range(dims)]).first().silhouette_score
        assert got == pytest.approx(paired(x, ids, label), rel=1e-9)


def test_no_rows(spark):
    d = spark.createDataFrame([], "id long, cluster_label int, x double")
    assert metrics.silhouette(d, [], "id", ["x"]).first().silhouette_score is None
