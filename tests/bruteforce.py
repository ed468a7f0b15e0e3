"""Sequential NumPy restatement of the operator semantics, used as the test oracle.

Distances are accumulated dimension by dimension (a left fold), exactly like the Spark
expressions, so boundary decisions (``d <= r``) agree bit for bit.
"""

from __future__ import annotations

import numpy as np


def dist_to(points: np.ndarray, c: np.ndarray) -> np.ndarray:
    total = np.zeros(len(points))
    for i in range(points.shape[1]):
        diff = points[:, i] - c[i]
        total = total + diff * diff
    return np.sqrt(total)


def merge(points: np.ndarray, weights: np.ndarray, ords: np.ndarray, ids: np.ndarray):
    """Merge equal vectors: summed weight, earliest ord (and its id); sorted by ord."""
    seen: dict[tuple, int] = {}
    out_p, out_w, out_o, out_i = [], [], [], []
    for j in np.argsort(ords, kind="stable"):
        key = tuple(points[j])
        if key in seen:
            out_w[seen[key]] += weights[j]
        else:
            seen[key] = len(out_p)
            out_p.append(points[j]); out_w.append(int(weights[j])); out_o.append(int(ords[j])); out_i.append(int(ids[j]))
    return np.array(out_p, dtype=float).reshape(len(out_p), points.shape[1]), np.array(out_w), \
        np.array(out_o), np.array(out_i)


def ball_weights(points, weights, active, radius):
    out = np.zeros(len(points), dtype=np.int64)
    for j in range(len(points)):
        d = dist_to(points, points[j])
        out[j] = int(weights[(d <= radius) & active].sum())
    return out


def greedy(points, weights, ords, ids, r_in, r_out, k):
    """One greedy cover on merged points; returns (center ids, ball weights, left weight)."""
    active = np.ones(len(points), dtype=bool)
    centers, bws = [], []
    left = int(weights.sum())
    while len(centers) < k and left > 0:
        bw = ball_weights(points, weights, active, r_in)
        best = None
        for j in np.argsort(ords, kind="stable"):
            if bw[j] > 0 and (best is None or bw[j] > bw[best]):
                best = j
        if best is None:
            break
        centers.append(int(ids[best])); bws.append(int(bw[best]))
        removed = active & (dist_to(points, points[best]) <= r_out)
        left -= int(weights[removed].sum())
        active &= ~removed
    return centers, bws, left


def kcenter(points, weights, ords, ids, k, z, alpha, guard_n=None):
    """Weighted k-center with outliers with the documented deviations (merged duplicates,
    r = 0 tried once, first k+z+1 clamped to n). Returns (centers, r0, r_final, guesses)."""
    n = len(points) if guard_n is None else guard_n
    if k > n or n == 0 or n <= z:
        return [], 0.0, 0.0, 0
    if n == k and guard_n is None:
        return list(ids), 0.0, 0.0, 0
    mp, mw, mo, mi = merge(points, weights, ords, ids)
    if len(mp) <= k:
        return list(mi), 0.0, 0.0, 1
    m = min(k + z + 1, len(points))

    def half_min(pts, os_):
        first = pts[np.argsort(os_, kind="stable")[:m]]
        best = None
        for a in range(len(first)):
            for b in range(a + 1, len(first)):
                d = dist_to(first[b:b + 1], first[a])[0]
                best = d if best is None or d < best else best
        return best / 2 if best is not None else 0.0

    r0 = half_min(points, ords)
    rs = []
    if r0 > 0:
        r = r0
    else:
        rs.append(0.0)
        r = half_min(mp, mo)
    g = 0
    while True:
        radius = rs[g] if g < len(rs) else r * 2 ** (g - len(rs))
        rin, rout = (1 + 2 * alpha) * radius, (3 + 4 * alpha) * radius
        cs, _, left = greedy(mp, mw, mo, mi, rin, rout, k)
        if left <= z:
            return cs, r0, radius, g + 1
        g += 1


def fft(points, ords, m):
    """Farthest-first traversal in one group; stops when the farthest distance is 0."""
    order = np.argsort(ords, kind="stable")
    pts = points[order]
    chosen = [0]
    mins = np.full(len(pts), np.inf)
    for _ in range(1, m):
        mins = np.minimum(mins, dist_to(pts, pts[chosen[-1]]))
        far = int(np.argmax(mins))
        if mins[far] <= 0:
            break
        chosen.append(far)
    return [int(order[c]) for c in chosen]


def nearest(points, centers):
    """Index of the nearest center, ties to the lowest index."""
    best = np.full(len(points), np.inf)
    arg = np.zeros(len(points), dtype=int)
    for j, c in enumerate(centers):
        d = dist_to(points, c)
        better = d < best
        best = np.where(better, d, best)
        arg = np.where(better, j, arg)
    return arg, best
