"""Property tests of the driver-side numerics (no Spark needed)."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.operators.features import poly_terms
from cadenza.operators.gd import descend
from cadenza.operators.linreg import mse_on, solve
from cadenza.operators.split import _bounds
from cadenza.operators.stats import Moments


def _moments(z: np.ndarray) -> Moments:
    return Moments(float(len(z)), z.mean(axis=0), np.cov(z.T, bias=True))


@given(st.integers(1, 5), st.integers(1, 4))
def test_poly_terms_count_and_degrees(n, degree):
    terms = poly_terms(n, degree)
    assert len(terms) == math.comb(n + degree, degree) - 1
    assert len(set(terms)) == len(terms)
    assert all(1 <= sum(t) <= degree and len(t) == n for t in terms)


@given(st.lists(st.floats(0.01, 10), min_size=1, max_size=6), st.integers(10, 1000))
def test_split_bounds_cover_all_buckets(weights, buckets):
    try:
        b = _bounds(weights, buckets)
    except ValueError:  # a positive weight must not get no bucket
        assert min(weights) / sum(weights) * buckets < 1
        return
    assert all(x < y for x, y in zip(b, b[1:]))
    assert b[0] == 0 and b[-1] == buckets and all(x <= y for x, y in zip(b, b[1:]))


@settings(max_examples=30, deadline=None)
@given(st.integers(2, 60), st.integers(2, 60), st.integers(1, 4), st.integers(0, 10_000))
def test_moments_combine_equals_concatenation(n1, n2, d, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=(n1, d + 1)), rng.normal(3, 2, size=(n2, d + 1))
    m = _moments(a).combine(_moments(b))
    full = _moments(np.vstack([a, b]))
    assert m.n == full.n
    np.testing.assert_allclose(m.mean, full.mean, rtol=1e-10, atol=1e-12)
    np.testing.assert_allclose(m.cov, full.cov, rtol=1e-9, atol=1e-12)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 5), st.floats(0.01, 3.0), st.floats(0.0, 1.0))
def test_elastic_net_satisfies_kkt(seed, d, reg, alpha):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(200, d))
    x[:, 0] += 0.8 * x[:, -1]  # some correlation
    y = x @ rng.normal(size=d) + rng.normal(size=200)
    m = _moments(np.column_stack([x, y]))
    found = solve(m, reg, alpha)
    coef, b0 = found.coef, found.intercept
    assert found.converged
    sx = np.sqrt(np.diag(m.cov)[:d]); sy = math.sqrt(m.cov[d, d])
    R = m.cov[:d, :d] / np.outer(sx, sx); r = m.cov[:d, d] / (sx * sy)
    w = coef * sx / sy
    lam = reg / sy
    g = -(r - R @ w) + lam * (1 - alpha) * w
    for j in range(d):
        if w[j] != 0:
            assert abs(g[j] + lam * alpha * np.sign(w[j])) < 1e-8
        else:
            assert abs(g[j]) <= lam * alpha + 1e-8
    assert abs(b0 - (m.mean[d] - coef @ m.mean[:d])) < 1e-9
    # training MSE from moments equals the row computation
    e = y - b0 - x @ coef
    assert abs(mse_on(m, coef, b0) - np.mean(e * e)) < 1e-9 * max(1.0, np.mean(e * e))


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 4), st.integers(1, 40))
def test_gram_descent_equals_per_row_recursion(seed, d, iters):
    rng = np.random.default_rng(seed)
    X = rng.uniform(0, 1, size=(50, d))
    y = X @ rng.uniform(0, 5, size=d)
    m = _moments(np.column_stack([X, y]))
    G, b, yy = m.gram()
    w, hist = descend(G, b, yy, m.n, iters, 1.0)
    wr = np.zeros(d)
    for i in range(iters):
        p = X @ wr
        assert abs(hist[i] - math.sqrt(np.mean((y - p) ** 2))) < 1e-8
        wr = wr - 1.0 / (len(y) * math.sqrt(i + 1)) * ((p - y) @ X)
    np.testing.assert_allclose(w, wr, rtol=1e-8, atol=1e-10)


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 5), st.floats(0.0, 2.0))
def test_ridge_closed_form_equals_coordinate_descent(seed, d, reg):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(100, d))
    y = x @ rng.normal(size=d) + rng.normal(size=100)
    m = _moments(np.column_stack([x, y]))
    x = solve(m, reg, 0.0)
    closed, b_closed = x.coef, x.intercept
    # a tiny L1 weight forces the iterative path
    x = solve(m, reg, 1e-12)
    cd, b_cd = x.coef, x.intercept
    np.testing.assert_allclose(closed, cd, rtol=1e-6, atol=1e-8)
    assert abs(b_closed - b_cd) < 1e-6
