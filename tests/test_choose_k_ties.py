"""Models that are equal but for rounding noise: the smallest k wins."""

import pytest

from paceline.operators import metrics


@pytest.mark.parametrize("method, name, values", [
    ("elbow", "inertia", {2: 10.0, 3: 10.0, 4: 4.0, 5: 4.0 + 1e-12}),
    ("silhouette_squared", "silhouette_squared", {2: 0.1, 3: 0.5, 4: 0.5 + 1e-13, 5: 0.2}),
])
def test_noise_does_not_choose(spark, monkeypatch, method, name, values):
    column = "inertia" if method == "elbow" else "silhouette_score"
    table = spark.createDataFrame([(1, k, v) for k, v in values.items()], f"g int, k int, {column} double")
    monkeypatch.setattr(metrics, name, lambda *args, **kwargs: table)
    d = spark.createDataFrame([(1, i, float(i * i)) for i in range(12)], "g int, id int, x double")
    assert [r.k for r in metrics.choose_k(d, ["g"], "id", ["x"], (2, 3, 4, 5), method).collect()] == [3]
