"""U2 kernels: exact DTW against a brute-force recursion, FastDTW bounds, edge series."""

import functools
import math

import numpy as np
import pytest

from issuewatch.functions import dtw


def brute(x, y):
    @functools.lru_cache(None)
    def d(i, j):
        if i < 0 or j < 0:
            return 0.0 if i == -1 and j == -1 else math.inf
        return float(np.linalg.norm(x[i] - y[j])) + min(d(i - 1, j), d(i, j - 1), d(i - 1, j - 1))

    return d(len(x) - 1, len(y) - 1)


@pytest.mark.parametrize("seed", range(40))
def test_exact_matches_brute_force(seed):
    rng = np.random.default_rng(seed)
    n, m = rng.integers(1, 14, 2)
    x, y = rng.normal(size=(n, 2)), rng.normal(size=(m, 2))
    assert dtw.dtw_exact(x, y)[0] == pytest.approx(brute(x, y), rel=1e-12)


@pytest.mark.parametrize("seed", range(40))
def test_fast_is_upper_bound(seed):
    rng = np.random.default_rng(100 + seed)
    n, m = rng.integers(2, 80, 2)
    x, y = rng.normal(size=(n, 2)), rng.normal(size=(m, 2))
    assert dtw.fast_dtw(x, y, 1)[0] >= dtw.dtw_exact(x, y)[0] - 1e-9


def test_identical_series_distance_zero():
    idx = [1, 5, 9, 20]
    z = [0.5, -1.0, 1.2, -0.7]
    assert dtw.series_distance(idx, z, idx, z) == 0.0


def test_empty_series_is_none():
    assert dtw.series_distance([], [], [1], [0.0]) is None


def test_warp_path_is_monotone():
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=(50, 2)), rng.normal(size=(37, 2))
    _, path = dtw.fast_dtw(x, y, 1, want_path=True)
    assert path[0] == (0, 0) and path[-1] == (49, 36)
    for (a, b), (c, d) in zip(path, path[1:]):
        assert (c - a, d - b) in {(1, 0), (0, 1), (1, 1)}
