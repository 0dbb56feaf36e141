"""Quantiles of a whole table: slices are counted from the rows, and the numbers are exact."""

import random

import numpy as np
from paceline.operators.keyed import group_quantiles


def test_whole_table_with_ties_gaps_and_outliers(spark):
    rng = random.Random(1)
    values = [rng.random() for _ in range(30_000)] + [0.5] * 9_000 + [1e12, -1e15] + [None] * 50
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(6)
    probs = {"lo": 0.25, "mid": 0.5, "hi": 0.75, "top": 1.0}
    quantiles = group_quantiles(df, [], "v", probs)
    want = np.quantile([v for v in values if v is not None], list(probs.values()))
    assert np.allclose(list(quantiles.first().asDict().values()), want, rtol=1e-12)
    by_group = group_quantiles(df.selectExpr("v", "1 AS g"), ["g"], "v", probs, few=True).first()
    assert np.allclose([by_group[n] for n in probs], want, rtol=1e-12)
