"""Dynamic time warping kernels (numpy), used inside an Arrow-batched pandas UDF.

Points are 2-D: (hour index, z-score). Point distance is Euclidean.

* `dtw_banded` - DTW restricted to a per-row column band [lo[i], hi[i]].
* `dtw_exact`  - full DTW (band = whole row).
* `fast_dtw`   - multi-resolution approximation (Salvador & Chan, "FastDTW: Toward
  accurate dynamic time warping in linear time and space", 2007): coarsen both
  series by averaging neighbouring pairs, solve the coarse problem recursively,
  project its warp path to the finer grid, widen it by `radius` cells and solve DTW
  inside that band. Series shorter than radius + 2 are solved exactly.

Recurrence: D(i, j) = cost(i, j) + min(D(i-1, j), D(i, j-1), D(i-1, j-1)), with
D(-1, -1) = 0. On equal candidates the earlier one in that order wins; that choice
fixes the warp path and, through it, the band of the next finer level.
"""

from __future__ import annotations

import math

import numpy as np

INF = math.inf


def _row_costs(x: np.ndarray, y: np.ndarray, i: int, lo: int, hi: int) -> list:
    d = y[lo : hi + 1] - x[i]
    return np.sqrt((d * d).sum(axis=1)).tolist()


def dtw_banded(x: np.ndarray, y: np.ndarray, lo: np.ndarray, hi: np.ndarray, want_path: bool = True):
    """DTW distance (and warp path) over the band; x is (n, 2), y is (m, 2)."""
    n = len(x)
    rows: list[list] = []
    moves: list[list] = []
    p_lo, p_hi, prev = 0, -1, []
    for i in range(n):
        a, b = int(lo[i]), int(hi[i])
        cost = _row_costs(x, y, i, a, b)
        cur = [0.0] * (b - a + 1)
        mv = [0] * (b - a + 1)
        left = INF
        for k in range(b - a + 1):
            j = a + k
            up = prev[j - p_lo] if p_lo <= j <= p_hi else INF
            dg = prev[j - 1 - p_lo] if p_lo <= j - 1 <= p_hi else (0.0 if i == 0 and j == 0 else INF)
            best, code = up, 0
            if left < best:
                best, code = left, 1
            if dg < best:
                best, code = dg, 2
            left = best + cost[k]
            cur[k] = left
            mv[k] = code
        rows.append(cur)
        moves.append(mv)
        p_lo, p_hi, prev = a, b, cur
    m_last = len(y) - 1
    if not (p_lo <= m_last <= p_hi):
        return INF, []
    dist = prev[m_last - p_lo]
    if not want_path:
        return dist, []
    path = []
    i, j = n - 1, m_last
    while i >= 0 and j >= 0:
        path.append((i, j))
        code = moves[i][j - int(lo[i])]
        if i == 0 and j == 0:
            break
        if code == 0:
            i -= 1
        elif code == 1:
            j -= 1
        else:
            i, j = i - 1, j - 1
    path.reverse()
    return dist, path


def dtw_exact(x: np.ndarray, y: np.ndarray, want_path: bool = False):
    n, m = len(x), len(y)
    if want_path:
        return dtw_banded(x, y, np.zeros(n, dtype=np.int64), np.full(n, m - 1, dtype=np.int64), True)
    # a whole row at once: D(i, j) = S(j) + min over k <= j of (from_above(k) - S(k - 1)),
    # S the row's running cost
    prev = np.full(m, INF)
    for i in range(n):
        d = y - x[i]
        total = np.cumsum(np.sqrt((d * d).sum(axis=1)))
        above = np.minimum(prev, np.concatenate(([0.0 if i == 0 else INF], prev[:-1])))
        prev = total + np.minimum.accumulate(above - np.concatenate(([0.0], total[:-1])))
    return float(prev[-1]), []


def _coarsen(x: np.ndarray) -> np.ndarray:
    h = len(x) // 2
    return (x[0 : 2 * h : 2] + x[1 : 2 * h : 2]) / 2.0


def _project_band(path, n: int, m: int, radius: int):
    """Fine-grid band from a coarse path: each coarse cell widened by `radius` in both
    directions, then split into its 2 x 2 fine cells. Per fine row the covered columns
    form one interval because the path is monotone and connected."""
    nc = (n + 1) // 2 + radius + 1
    cmin = np.full(nc + radius + 1, np.iinfo(np.int64).max, dtype=np.int64)
    cmax = np.full(nc + radius + 1, -1, dtype=np.int64)
    for ci, cj in path:
        for a in range(max(ci - radius, 0), ci + radius + 1):
            if a < len(cmin):
                if cj < cmin[a]:
                    cmin[a] = cj
                if cj > cmax[a]:
                    cmax[a] = cj
    rows = np.arange(n) // 2
    lo = 2 * (cmin[rows] - radius)
    hi = 2 * (cmax[rows] + radius) + 1
    return np.clip(lo, 0, m - 1), np.clip(hi, 0, m - 1)


def fast_dtw(x: np.ndarray, y: np.ndarray, radius: int = 1, want_path: bool = False):
    min_size = radius + 2
    if len(x) < min_size or len(y) < min_size:
        return dtw_exact(x, y, want_path)
    _, coarse_path = fast_dtw(_coarsen(x), _coarsen(y), radius, want_path=True)
    lo, hi = _project_band(coarse_path, len(x), len(y), radius)
    return dtw_banded(x, y, lo, hi, want_path)


def points(idx, z) -> np.ndarray:
    return np.column_stack([np.asarray(idx, dtype=np.float64), np.asarray(z, dtype=np.float64)])


def series_distance(a_idx, a_z, b_idx, b_z, radius: int = 1, exact: bool = False) -> float | None:
    """Distance between two sparse series given as (index, z) points; None if either is empty."""
    if a_idx is None or b_idx is None or len(a_idx) == 0 or len(b_idx) == 0:
        return None
    x, y = points(a_idx, a_z), points(b_idx, b_z)
    d, _ = dtw_exact(x, y) if exact else fast_dtw(x, y, radius)
    return float(d)
