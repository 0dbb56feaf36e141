"""The silhouette of a group that fits in one tile is scored in one task, to the same figure as over tiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paceline.operators import metrics, tiles


def test_one_tile_and_many_agree(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(g, i, *map(float, rng.normal(3 * (i % k), 1, 2).round(1)), i % k) for g, n, k in ((1, 90, 3), (2, 40, 2), (3, 12, 1), (4, 5, 5)) for i in range(n)]
    rows += [(5, i, 1.0, 1.0, i % 2) for i in range(8)]
    d = spark.createDataFrame(rows, "g int, id long, x double, y double, cluster_label int").repartition(3)
    whole = {r.g: r.silhouette_score for r in metrics.silhouette(d, ["g"], "id", ["x", "y"]).collect()}
    monkeypatch.setattr(metrics, "TILE_ROWS", 4)
    monkeypatch.setattr(metrics, "tile_pairs", lambda *a: tiles.tile_pairs(*a, tile_rows=4))
    tiled = {r.g: r.silhouette_score for r in metrics.silhouette(d, ["g"], "id", ["x", "y"]).collect()}
    assert whole.keys() == tiled.keys() == {1, 2, 3, 4, 5}
    for g, s in tiled.items():
        assert whole[g] is None if s is None else whole[g] == pytest.approx(s, abs=1e-12)
    alone = metrics.silhouette(d.where(F.col("g") == 1), [], "id", ["x", "y"]).first()
    assert alone.silhouette_score == pytest.approx(whole[1], abs=1e-12) and whole[3] is None and whole[4] == 0


def test_a_group_of_one_tile_makes_no_pairs(spark):
    d = spark.range(50).select(F.lit(1).alias("g"), "id", F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("cluster_label"))
    assert metrics._group_silhouette(np.arange(50.0)[:, None], np.arange(50) % 2) == pytest.approx(
        metrics.silhouette(d, ["g"], "id", ["x"]).first().silhouette_score, abs=1e-12)
