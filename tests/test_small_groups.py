"""Small groups are unpacked together and solved in place."""

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.operators import density, tiles


def test_columns_of_many_groups_are_cut_from_one_and_keep_their_types(spark):
    big = (1 << 53) + 1
    rows = spark.createDataFrame([(1, big, 0.5), (1, big + 2, 1.5), (2, 7, 2.5), (2, 5, None)], "g int, v long, x double")
    schema = T.StructType([T.StructField("g", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("v", T.LongType())])

    @tiles.plain
    def work(own: dict) -> dict:
        assert isinstance(own["x"], np.ndarray)
        return {"g": own["g"][:1], "n": np.array([len(own["x"])]), "v": own["v"].max(keepdims=True)}

    packed = tiles.pack(rows, ["g"], "p:").coalesce(1)
    got = tiles.map_packed(packed, ["g"], ["p:"], work, schema).orderBy("g").collect()
    assert [tuple(r) for r in got] == [(1, 2, big + 2), (2, 2, 7)]


def test_the_radius_of_small_groups_needs_no_pivots(spark, monkeypatch):
    def none(*args):
        raise AssertionError("pivots for a group of one tile")

    monkeypatch.setattr(density, "Cells", none)
    x = np.random.default_rng(5).integers(0, 9, (130, 2)).astype(float)
    rows = [(i % 3, i, float(a), float(b)) for i, (a, b) in enumerate(x)] + [(9, 500, 1.0, 1.0), (9, 501, 2.0, 2.0)]
    points = spark.createDataFrame(rows, "g int, _id long, a double, b double").select("g", "_id", F.array("a", "b").alias("_f"))
    got = {(r["g"], r["_id"]): r["distance"] for r in density.nearest_distances(points, ["g"], 3).collect()}
    want = {}
    for g, i, a, b in rows[:-2]:  # a group of two has no third row
        d = sorted(((a - c) ** 2 + (b - e) ** 2) ** 0.5 for h, j, c, e in rows if h == g and j != i)
        want[g, i] = d[1]
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
