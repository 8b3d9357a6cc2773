"""Gradient-boosted trees for two classes, in numpy: small models that are trained on bounded samples.

A model is a plain dict, so it travels to workers as it is.
"""

from __future__ import annotations


def fit(x, y, *, trees: int = 60, depth: int = 3, rate: float = 0.3, bins: int = 24, least: int = 8) -> dict:
    """Logistic loss, Newton leaves, splits on quantile cuts.  x: rows by features, y: 0 or 1."""
    import numpy as np

    x, y = np.asarray(x, float), np.asarray(y, float)
    start = float(np.log((y.sum() + 1.0) / (len(y) - y.sum() + 1.0)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, bins))) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
    score, forest = np.full(len(y), start), []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        nodes: list[tuple] = []  # (feature, cut, left, right) or (-1, value, 0, 0)

        def grow(rows, level, nodes=nodes, g=g, h=h):
            at = len(nodes)
            nodes.append(())
            total_g, total_h = g[rows].sum(), h[rows].sum()
            best = (1e-6, -1, 0)
            if level < depth and len(rows) >= 2 * least:
                base = total_g**2 / (total_h + 1.0)
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = binned[rows, f]
                    cg = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1]
                    ch = np.cumsum(np.bincount(b, h[rows], len(c) + 1))[:-1]
                    cn = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                    gain = cg**2 / (ch + 1.0) + (total_g - cg) ** 2 / (total_h - ch + 1.0) - base
                    gain[(cn < least) | (len(rows) - cn < least)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], f, k)
            if best[1] < 0:
                value = rate * total_g / (total_h + 1.0)
                nodes[at] = (-1, value, 0, 0)
                score[rows] += value
            else:
                _, f, k = best
                left = binned[rows, f] <= k
                nodes[at] = (f, float(cuts[f][k]), grow(rows[left], level + 1), grow(rows[~left], level + 1))
            return at

        grow(np.arange(len(y)), 0)
        forest.append(nodes)
    return {"start": start, "trees": forest}


def predict(model: dict, x):
    """The probability of class 1 for each row."""
    import numpy as np

    x = np.asarray(x, float)
    score = np.full(len(x), model["start"])
    for nodes in model["trees"]:
        at = np.zeros(len(x), int)
        feature = np.array([n[0] for n in nodes])
        cut = np.array([n[1] for n in nodes])
        left, right = np.array([n[2] for n in nodes]), np.array([n[3] for n in nodes])
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                break
            a = at[inner]
            at[inner] = np.where(x[inner, feature[a]] <= cut[a], left[a], right[a])
        score += cut[at]
    return 1.0 / (1.0 + np.exp(-score))
