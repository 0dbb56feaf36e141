"""K-means of a group gives the same centroids in one task and over shares."""

import numpy as np
from pyspark.sql import functions as F

from paceline.operators import clustering
from paceline.session import stage
from tests.test_kmeans import FOUR, blobs, frame, lloyd


def test_groups_over_shares_and_in_one_task_agree(spark):
    d = frame(spark, {1: blobs(8, FOUR, 25), 2: blobs(9, FOUR[:2], 8)}).select("g", F.array("x", "y").alias("_f"))
    seeds = {1: [[[0.0, 1.0], [8.0, 2.0]], [[0.0, 0.0], [0.0, 4.0], [9.0, 9.0], [99.0, 99.0]]], 2: [[[0.0, 1.0], [0.0, 2.0]]]}
    for keys, groups in ((["g"], (1, 2)), ([], (1,))):
        rows = [(g, 100 if g == 1 else 16, 1.0, [(i, c) for i, c in enumerate(seeds[g])]) for g in groups]
        cents = spark.createDataFrame(rows, "g int, _n long, _var double, _m array<struct<id:int,c:array<array<double>>>>")
        points = stage(d.where(F.col("g").isin(*groups)).select(*keys, "_f"), "points")
        found = []
        for group_rows in (1000, 50, 1):
            got = clustering._settled(points, cents if keys else cents.drop("g"), keys, 2, 1e-9, group_rows, 7).collect()
            found.append({tuple(r[:-1]): r._c for r in got})
        assert len(found[0]) == sum(len(seeds[g]) for g in groups)
        for other in found[1:]:
            assert found[0].keys() == other.keys() and all(np.allclose(found[0][k], other[k], rtol=0, atol=1e-9) for k in other)
        first = (1, 0) if keys else (0,)
        assert np.allclose(found[0][first], lloyd(np.array(points.select("_f").where("g = 1" if keys else "true").toPandas()["_f"].tolist()), np.array(seeds[1][0]))[0])
