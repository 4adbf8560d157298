"""Small second-order boosted trees for logistic loss, on numpy arrays of a
bounded sample: histogram splits, flat node arrays, monotonic constraints."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """Node i goes left when ``x[feature[i]] <= threshold[i]``; a leaf has feature -1."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Midpoints between distinct quantiles of each column."""
    out = []
    for j in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)))
        out.append((q[1:] + q[:-1]) / 2)
    return out


def grow(binned, edges, g, h, rows, depth, min_rows, lam, monotone, rate) -> Tree:
    nodes = {k: [] for k in ("feature", "threshold", "left", "right", "value")}

    def add(value):
        for k, v in zip(nodes, (-1, 0.0, -1, -1, value), strict=True):
            nodes[k].append(v)
        return len(nodes["value"]) - 1

    def weight(sg, sh, lo, hi):
        return np.clip(-sg / (sh + lam), lo, hi)

    root = add(rate * weight(g[rows].sum(), h[rows].sum(), -np.inf, np.inf))
    todo = [(root, rows, 0, -np.inf, np.inf)]
    while todo:
        node, rs, level, lo, hi = todo.pop()
        if level >= depth or len(rs) < 2 * min_rows:
            continue
        sg, sh, best = g[rs].sum(), h[rs].sum(), None
        for f, e in enumerate(edges):
            if len(e) == 0:
                continue
            b = binned[rs, f]
            gl = np.cumsum(np.bincount(b, g[rs], len(e) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[rs], len(e) + 1))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=len(e) + 1))[:-1]
            wl, wr = weight(gl, hl, lo, hi), weight(sg - gl, sh - hl, lo, hi)
            gain = -(gl * wl + 0.5 * (hl + lam) * wl ** 2) \
                - ((sg - gl) * wr + 0.5 * (sh - hl + lam) * wr ** 2)
            ok = (nl >= min_rows) & (len(rs) - nl >= min_rows) & ((wr - wl) * monotone[f] >= 0)
            gain = np.where(ok, gain, -np.inf)
            k = int(np.argmax(gain))
            if best is None or gain[k] > best[0]:
                best = (gain[k], f, k, wl[k], wr[k])
        w0 = weight(sg, sh, lo, hi)
        if best is None or best[0] <= -(sg * w0 + 0.5 * (sh + lam) * w0 ** 2) + 1e-6:
            continue
        _, f, k, wl, wr = best
        on = binned[rs, f] <= k
        mid = (wl + wr) / 2
        bounds = {1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid))}.get(
            int(monotone[f]), ((lo, hi), (lo, hi)))
        a, b = add(rate * wl), add(rate * wr)
        nodes["feature"][node], nodes["threshold"][node] = f, edges[f][k]
        nodes["left"][node], nodes["right"][node] = a, b
        todo += [(a, rs[on], level + 1, *bounds[0]), (b, rs[~on], level + 1, *bounds[1])]
    return Tree(*(np.array(nodes[k], dtype=np.float64 if k in ("threshold", "value") else np.int32)
                  for k in ("feature", "threshold", "left", "right", "value")))


def predict_tree(t: Tree, x: np.ndarray) -> np.ndarray:
    """Leaf value of every row: all rows step down one level at a time."""
    node = np.zeros(len(x), dtype=np.int32)
    rows = np.arange(len(x))
    while True:
        f = t.feature[node]
        inner = f >= 0
        if not inner.any():
            return t.value[node]
        goes_left = x[rows, np.maximum(f, 0)] <= t.threshold[node]
        node = np.where(inner, np.where(goes_left, t.left[node], t.right[node]), node)


def boost(x, y, n_trees=60, depth=3, rate=0.15, min_rows=8, lam=1.0, bins=64, monotone=None,
          subsample=1.0, seed=7) -> tuple[float, list[Tree]]:
    """(base logit, trees). Both classes must be present, else no tree is grown."""
    monotone = np.zeros(x.shape[1]) if monotone is None else np.asarray(monotone)
    p = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(p / (1 - p)))
    if len(y) == 0 or y.min() == y.max():
        return base, []
    edges = bin_edges(x, bins)
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    z, rng, trees = np.full(len(y), base), np.random.default_rng(seed), []
    for _ in range(n_trees):
        q = sigmoid(z)
        rows = np.flatnonzero(rng.random(len(y)) < subsample) if subsample < 1 else np.arange(len(y))
        t = grow(binned, edges, q - y, q * (1 - q), rows, depth, min_rows, lam, monotone, rate)
        trees.append(t)
        z = z + predict_tree(t, x)
    return base, trees
