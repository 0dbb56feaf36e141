"""Distances from one matrix product are those of the differences, also far out and between copies."""

import numpy as np
import pytest

from paceline.operators.metrics import squared_distances


@pytest.mark.parametrize("dims", [2, 8, 64])
@pytest.mark.parametrize("far", [0.0, 1e6, 1e200])
def test_distances(dims, far):
    rng = np.random.default_rng(dims)
    a, b = rng.normal(0, 1, (50, dims)), rng.normal(0, 1, (70, dims))
    b[:20] = a[:20]
    b[20:30] = a[20:30] + 1e-7
    a[0] += far
    b[:35] += far / 2
    want = ((a[:, None] - b[None]) ** 2).sum(2)
    with np.errstate(over="ignore", invalid="ignore"):
        got = squared_distances(a, b)
    assert np.allclose(got, want, rtol=1e-9, atol=0)
