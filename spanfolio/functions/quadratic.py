"""Smallest-variance weights under linear bounds, for one small dense matrix."""

from __future__ import annotations

import numpy as np

TOLERANCE = 1e-12
#: A bound whose normal lies this close to the span of the active ones cannot move the weights.
INDEPENDENT = 1e-11
#: A bound missed by no more than this counts as met where nothing can move any more.
STUCK_TOLERANCE = 1e-9
#: What weights with status ``ok`` may miss a bound by, relative to its size.
ACCEPTED = 1e-7

OK, INFEASIBLE, NOT_CONVERGED = "ok", "infeasible", "not_converged"


def least_variance(
    cov: np.ndarray, bounds: list[tuple[np.ndarray, float]], short_limit: float | None = None
) -> tuple[np.ndarray | None, str]:
    """Weights summing to 1 with the smallest variance, and a status; no weights unless it is ``ok``.

    ``infeasible``: no weights meet the bounds. ``not_converged``: the method came back
    to where it was, or its weights miss a bound. Each bound ``(g, h)`` asks ``g @ w >= h``. ``short_limit`` bounds the sum of
    negative weights; it equals one linear bound per set of assets, of which the
    currently violated one is added until the limit holds.
    """
    bounds = list(bounds)
    seen: set[bytes] = set()
    while True:
        w, status = _with_bounds(cov, bounds)
        if w is None:
            return None, status
        negative = w < 0
        if short_limit is None or -w[negative].sum() <= short_limit + TOLERANCE:
            return (w, OK) if _met(w, bounds, short_limit) else (None, NOT_CONVERGED)
        if negative.tobytes() in seen:
            return (w, OK) if _met(w, bounds, short_limit) else (None, NOT_CONVERGED)
        seen.add(negative.tobytes())
        bounds.append((negative.astype(float), -short_limit))


def _met(w: np.ndarray, bounds: list[tuple[np.ndarray, float]], short_limit: float | None) -> bool:
    """Whether the weights meet every bound, the budget and the short limit."""
    size = 1.0 + np.abs(w).max()
    short = short_limit is None or -w[w < 0].sum() <= short_limit + ACCEPTED * size
    return short and abs(w.sum() - 1) <= ACCEPTED * size and all(g @ w - h >= -ACCEPTED * (size * np.abs(g).max() + abs(h)) for g, h in bounds)


def _with_bounds(cov: np.ndarray, bounds: list[tuple[np.ndarray, float]]) -> tuple[np.ndarray | None, str]:
    """Dual active-set method: start without bounds, add the most violated one at a time.

    Each round raises the least variance under the active bounds, so a set of them can't
    come back except by rounding; that ends the search.
    """
    n = len(cov)
    inverse = np.linalg.inv(cov)
    rows = [np.ones(n)]
    active: list[int] = []
    u: list[float] = []
    w = inverse.sum(axis=1) / inverse.sum()
    if not bounds:
        return w, OK
    g_all = np.array([g for g, _ in bounds])
    h_all = np.array([h for _, h in bounds])
    scale = 1.0 + np.abs(g_all).max(axis=1)
    visited: set[tuple] = set()
    while True:
        slack = (g_all @ w - h_all) / scale
        slack[active] = np.inf
        p = int(np.argmin(slack))
        if slack[p] >= -TOLERANCE:
            return w, OK
        state = (p, *sorted(active))
        if state in visited:
            return None, NOT_CONVERGED
        visited.add(state)
        u_p = 0.0
        while True:
            normals = np.array(rows + [g_all[a] for a in active]).T
            weighted = inverse @ normals
            step = inverse @ g_all[p]
            r = np.linalg.solve(normals.T @ weighted, normals.T @ step)
            z = step - weighted @ r
            curvature = float(z @ g_all[p])
            r_active = r[1:]
            blocking = [(u[i] / r_active[i], i) for i in range(len(active)) if r_active[i] > TOLERANCE]
            dual_step, drop = min(blocking, default=(np.inf, -1))
            independent = curvature > INDEPENDENT * float(step @ g_all[p])
            full = independent and len(active) + 1 < n
            primal_step = (h_all[p] - g_all[p] @ w) / curvature if full else np.inf
            t = min(dual_step, primal_step)
            if np.isinf(t):
                return (w, OK) if slack[p] >= -STUCK_TOLERANCE else (None, INFEASIBLE)
            u = [v - t * s for v, s in zip(u, r_active)]
            u_p += t
            if full:
                w = w + t * z
            if t == primal_step:
                active.append(p)
                u.append(u_p)
                break
            del active[drop], u[drop]
