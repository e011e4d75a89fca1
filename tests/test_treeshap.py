"""TreeSHAP against brute-force Shapley values on small random trees."""
import itertools
import math

import numpy as np

from pitwall.operators.attribution import expected_value, shap_matrix, tree_predict


def make_tree(rng, depth=3, nf=4):
    n = 2 ** (depth + 1) - 1
    t = {"left": np.full(n, -1), "right": np.full(n, -1), "feature": np.full(n, -1),
         "threshold": np.zeros(n), "value": rng.normal(size=n), "cover": np.zeros(n), "weight": 0.5}
    for i in range(2 ** depth - 1):
        t["left"][i], t["right"][i] = 2 * i + 1, 2 * i + 2
        t["feature"][i], t["threshold"][i] = rng.integers(nf), rng.normal()
    for i in range(2 ** depth - 1, n):
        t["cover"][i] = rng.integers(1, 30)
    for i in range(2 ** depth - 2, -1, -1):
        t["cover"][i] = t["cover"][2 * i + 1] + t["cover"][2 * i + 2]
    return t


def cond_exp(t, x, S, j=0):
    """E[f(x) | x_S] with the cover-weighted path-dependent rule."""
    if t["left"][j] < 0:
        return t["value"][j]
    f, lft, rgt = t["feature"][j], t["left"][j], t["right"][j]
    if f in S:
        return cond_exp(t, x, S, lft if x[f] <= t["threshold"][j] else rgt)
    return (t["cover"][lft] * cond_exp(t, x, S, lft) + t["cover"][rgt] * cond_exp(t, x, S, rgt)) / t["cover"][j]


def brute_shap(trees, x, nf):
    phi = np.zeros(nf)
    for i in range(nf):
        others = [k for k in range(nf) if k != i]
        for r in range(nf):
            for S in itertools.combinations(others, r):
                w = math.factorial(len(S)) * math.factorial(nf - len(S) - 1) / math.factorial(nf)
                for t in trees:
                    phi[i] += t["weight"] * w * (cond_exp(t, x, set(S) | {i}) - cond_exp(t, x, set(S)))
    return phi


def test_tree_shap_matches_brute_force():
    rng = np.random.default_rng(7)
    nf = 4
    trees = [make_tree(rng, 3, nf) for _ in range(3)]
    X = rng.normal(size=(12, nf))
    phi, bias = shap_matrix(trees, X)
    assert math.isclose(bias, sum(t["weight"] * expected_value(t) for t in trees))
    for r in range(X.shape[0]):
        np.testing.assert_allclose(phi[r], brute_shap(trees, X[r], nf), atol=1e-10)
        assert abs(phi[r].sum() + bias - tree_predict(trees, X[r])) < 1e-10


def test_batch_equals_rowwise_on_deeper_trees():
    from pitwall.operators.attribution import shap_matrix_rowwise
    rng = np.random.default_rng(3)
    trees = [make_tree(rng, 5, 6) for _ in range(8)]
    # repeated features along paths exercise the unwind step
    X = rng.normal(size=(300, 6))
    a, ba = shap_matrix(trees, X)
    b, bb = shap_matrix_rowwise(trees, X)
    np.testing.assert_allclose(a, b, atol=1e-9)
    assert ba == bb
