"""Gradient descent and elastic net without d x d numbers on the driver."""

import uuid
import warnings

import numpy as np
import pytest

from cadenza.operators import stats, wide
from cadenza.operators.gd import GradientDescentRegression, descend
from cadenza.operators.linreg import ElasticNet, solve


def table(spark, tmp_path, n, d, seed=1, rank=20):
    """Rows with a few strong directions, as parquet files; (x, y, frame)."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, rank)) @ rng.normal(size=(rank, d)) * 0.3 + rng.normal(size=(n, d))) / np.sqrt(d) + 0.02
    x[:, d // 2] = 0.25  # a constant feature
    y = x[:, :10].sum(axis=1) * 5 + rng.normal(size=n) * 0.1 + 3
    for i in range(4):
        s = slice(i * n // 4, (i + 1) * n // 4)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(x[s].ravel()), d).cast(pa.list_(pa.float64()))
        pq.write_table(pa.table({"x": lists, "y": y[s]}), tmp_path / f"p{i}.parquet")
    return x, y, spark.read.parquet(str(tmp_path))


def jobs(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("", "")


@pytest.mark.parametrize("n,d", [(400, 3), (800, 64), (900, 300)])
def test_descent_in_a_span_equals_the_loop(spark, tmp_path, n, d):
    x, y, df = table(spark, tmp_path, n, d)
    w, hist = descend(x.T @ x, x.T @ y, y @ y, n, 100, 1.0)
    est = GradientDescentRegression(featuresCol="x", labelCol="y", mode="span")
    model, made = jobs(spark, f"span-{d}", lambda: est.fit(df))
    assert np.linalg.norm(np.subtract(model.getWeights(), w)) <= 1e-9 * np.linalg.norm(w)
    np.testing.assert_allclose(model.getTrainingError(), hist, rtol=1e-8)
    assert made <= 21 and len(model.getTrainingError()) == 100  # one of them finds the vector size


def test_error_bound_holds_while_the_span_is_small(spark, tmp_path):
    """Every trajectory on the way is as close to the true one as it says."""
    x, y, _ = table(spark, tmp_path, 500, 120)
    G, b = x.T @ x, x.T @ y
    true, _ = descend(G, b, y @ y, 500, 40, 1.0)
    V = wide._random_block(120, 8)
    span, bounds = wide.Span(V, G @ V), []
    for _ in range(15):
        w, _, _, bound, lost = wide._trajectory(span, b, y @ y, 500, float(np.trace(G)), 40, 1.0)
        assert np.linalg.norm(w - true) <= bound * (1 + 1e-9) + 1e-12
        bounds.append(bound)
        V = span.fresh([b, lost], 8)
        if not V.shape[1]:
            break
        span = span.grown(V, G @ V)
        assert np.abs(span.S.T @ span.S - np.eye(span.S.shape[1])).max() < 1e-12
    assert bounds[-1] < 1e-9 < bounds[0]


def test_descent_in_a_span_edge_cases(spark, tmp_path):
    _, _, df = table(spark, tmp_path, 200, 5)
    for bad, message in (([None, 1.0], "null"), ([[1.0], 1.0], "size 5"), ([[float("nan")] * 5, 1.0], "NaN")):
        rows = df.union(spark.createDataFrame([tuple(bad)], df.schema))
        for est in (GradientDescentRegression(featuresCol="x", labelCol="y", mode="span"),
                    ElasticNet(featuresCol="x", labelCol="y", solver="span", regParam=0.1, elasticNetParam=0.5),
                    ElasticNet(featuresCol="x", labelCol="y", solver="span", regParam=0.1)):
            with pytest.raises(ValueError, match=message):
                est.fit(rows)
    with pytest.raises(ValueError, match="empty"):
        GradientDescentRegression(featuresCol="x", labelCol="y", mode="span").fit(df.where("false"))
    big = spark.createDataFrame([([1000.0, 2000.0], 1.0)] * 5, "x array<double>, y double")
    with pytest.raises(FloatingPointError, match="diverged"):
        GradientDescentRegression(featuresCol="x", labelCol="y", mode="span").fit(big)
    flat = spark.createDataFrame([([1.0, 2.0], 4.0)] * 5, "x array<double>, y double")
    for alpha in (0.0, 0.5):
        m = ElasticNet(featuresCol="x", labelCol="y", solver="span", regParam=0.1, elasticNetParam=alpha).fit(flat)
        assert m.getCoefficients() == [0.0, 0.0] and m.getIntercept() == 4.0


@pytest.mark.parametrize("n,d", [(400, 4), (600, 60), (700, 350)])
@pytest.mark.parametrize("reg,alpha", [(0.05, 0.1), (0.02, 0.9), (0.1, 0.0), (100.0, 0.5)])
def test_elastic_net_by_passes_equals_moments(spark, tmp_path, n, d, reg, alpha):
    x, y, df = table(spark, tmp_path, n, d)
    z = np.column_stack([x, y])
    want = solve(stats.Moments(n, z.mean(axis=0), np.cov(z.T, bias=True)), reg, alpha)
    got = ElasticNet(featuresCol="x", labelCol="y", solver="span", regParam=reg, elasticNetParam=alpha).fit(df)
    assert got.hasConverged() and got.getRounds() <= 40
    np.testing.assert_allclose(got.getCoefficients(), want.coef, atol=1e-6 * max(1.0, np.abs(want.coef).max()))
    assert abs(got.getIntercept() - want.intercept) < 1e-6


def test_five_thousand_features(spark, tmp_path):
    """No d x d numbers anywhere: a few passes, and the optimality conditions hold."""
    n, d, reg, alpha = 400, 5000, 0.05, 0.3
    x, y, df = table(spark, tmp_path, n, d)
    m, made = jobs(spark, "wide-5000", lambda: ElasticNet(featuresCol="x", labelCol="y", solver="span", regParam=reg, elasticNetParam=alpha).fit(df))
    assert m.hasConverged() and made <= 25
    sd, sy = x.std(axis=0), y.std()
    live = sd > 1e-12
    zx, zy = (x - x.mean(axis=0))[:, live] / sd[live], (y - y.mean()) / sy
    w = np.array(m.getCoefficients())[live] * sd[live] / sy
    g = zx.T @ (zx @ w - zy) / n + reg / sy * (1 - alpha) * w
    l1 = reg / sy * alpha
    assert np.where(w != 0, np.abs(g + l1 * np.sign(w)), np.maximum(np.abs(g) - l1, 0)).max() < 1e-8


def test_a_fit_that_ends_early_says_so(spark, tmp_path):
    _, _, df = table(spark, tmp_path, 300, 300)
    for alpha in (0.0, 0.1):
        with warnings.catch_warnings(record=True) as caught:
            warnings.simplefilter("always")
            m = ElasticNet(featuresCol="x", labelCol="y", solver="span", regParam=0.001, elasticNetParam=alpha, maxIter=2).fit(df)
        assert not m.hasConverged() and any("not converged" in str(c.message) for c in caught)


@pytest.mark.parametrize("kind", ["descent", "columns", "ridge"])
def test_a_driver_that_starts_again_goes_on(spark, tmp_path, monkeypatch, kind):
    _, _, df = table(spark, tmp_path, 600, 200)
    real, made = wide._passed, []

    def fit(key):
        if kind == "descent":
            return wide.descend_in_span(df, "x", "y", 200, 60, 1.0, block=3, state_key=key)[0]
        if kind == "columns":
            return wide.elastic_net_by_columns(df, "x", "y", 200, 0.02, 0.2, 100, block=8, state_key=key)[0]
        return wide.ridge_in_span(df, "x", "y", 200, 0.1, 100, block=32, state_key=key)[0]

    def counted(*args, **kwargs):
        made.append(1)
        if len(made) == 4:
            raise RuntimeError("the driver is lost")
        return real(*args, **kwargs)
    want = fit(None)
    monkeypatch.setattr(wide, "_passed", counted)
    key = f"{kind}-{uuid.uuid4().hex}"
    with pytest.raises(RuntimeError, match="lost"):
        fit(key)
    name = {"columns": "elastic"}.get(kind, kind)
    with pytest.raises(ValueError, match="vectors of size 200"):
        wide.Saved(df, key, name, 7).load()
    before = len(made)
    np.testing.assert_allclose(fit(key), want, rtol=1e-7, atol=1e-10)
    resumed = len(made) - before
    assert wide.Saved(df, key, name, 200).load() is None  # a complete fit leaves nothing
    made.clear()
    monkeypatch.setattr(wide, "_passed", lambda *a, **k: made.append(1) or real(*a, **k))
    fit(None)
    assert resumed < len(made)  # rounding may add or save a pass
