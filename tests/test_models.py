import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import split as sp
from cadenza.operators import stats
from cadenza.operators.gd import GradientDescentRegression, descend
from cadenza.operators.linreg import ElasticNet, mllib_fit, mse_on
from cadenza.operators.tuning import cross_validate, mllib_cross_validate, param_grid
from cadenza.plans import fixtures as fx
from cadenza.plans.queries_ml import _train_test


@pytest.fixture(scope="module")
def data(spark, sf):
    train, test = _train_test(spark, sf)
    cols = ["song_id", "features", "label_shifted"]
    return train.select(*cols).cache(), test.select(*cols).cache()


def test_split_disjoint_complete_and_partition_invariant(spark, sf):
    lines = fx.song_lines(spark, sf)
    a, b = sp.hash_split(lines, ["song_id"], [0.8, 0.2])
    n, na, nb = lines.count(), a.count(), b.count()
    assert na + nb == n and 0.7 * n < na < 0.9 * n
    assert a.join(b, "song_id", "left_semi").count() == 0
    a8, _ = sp.hash_split(lines.repartition(8), ["song_id"], [0.8, 0.2])
    a1, _ = sp.hash_split(lines.coalesce(1), ["song_id"], [0.8, 0.2])
    ids8 = {r[0] for r in a8.select("song_id").collect()}
    ids1 = {r[0] for r in a1.select("song_id").collect()}
    assert ids8 == ids1 == {r[0] for r in a.select("song_id").collect()}


def test_folds_cover_and_balance(spark, sf):
    f = sp.with_fold(fx.song_lines(spark, sf), ["song_id"], 3)
    counts = {r["fold"]: r["count"] for r in f.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2} and min(counts.values()) > 0.25 * sum(counts.values())


def test_moments_match_numpy(data):
    train, _ = data
    m = stats.moments(train, "features", "label_shifted")[None]
    rows = train.select("features", "label_shifted").collect()
    z = np.array([list(r[0]) + [r[1]] for r in rows])
    np.testing.assert_allclose(m.mean, z.mean(axis=0), rtol=1e-12)
    np.testing.assert_allclose(m.cov, np.cov(z.T, bias=True), rtol=1e-9, atol=1e-12)
    # per-group moments combine to the total
    byf = stats.moments(train.withColumn("g", F.length("song_id") % 3), "features",
                        "label_shifted", by="g")
    t = stats.total(byf)
    np.testing.assert_allclose(t.cov, m.cov, rtol=1e-9, atol=1e-12)


def test_wide_moments_path_matches(data, monkeypatch):
    train, _ = data
    narrow = stats.moments(train, "features", "label_shifted")[None]
    monkeypatch.setattr(stats, "WIDE_D", 1)
    wide = stats.moments(train, "features", "label_shifted")[None]
    assert wide.n == narrow.n
    np.testing.assert_allclose(wide.cov, narrow.cov, rtol=1e-7, atol=1e-9)


def _per_row_gd(rows, iters=100, step=1.0):
    X = np.array([r[0] for r in rows])
    y = np.array([r[1] for r in rows])
    n, d = X.shape
    w = np.zeros(d)
    hist = []
    for i in range(iters):
        p = X @ w
        hist.append(math.sqrt(((y - p) ** 2).sum() / n))
        g = ((p - y)[:, None] * X).sum(axis=0)
        w = w - step / (n * math.sqrt(i + 1)) * g
    return w, hist


def test_gd_gram_equals_per_row_loop_and_iterative(data):
    train, _ = data
    est = GradientDescentRegression(featuresCol="features", labelCol="label_shifted")
    gram = est.fit(train)
    rows = train.select("features", "label_shifted").collect()
    w, hist = _per_row_gd(rows)
    np.testing.assert_allclose(gram.getWeights(), w, rtol=1e-9)
    np.testing.assert_allclose(gram.getTrainingError(), hist, rtol=1e-9)
    it = GradientDescentRegression(featuresCol="features", labelCol="label_shifted",
                                   maxIter=10, mode="iterative").fit(train)
    w10, h10 = _per_row_gd(rows, iters=10)
    np.testing.assert_allclose(it.getWeights(), w10, rtol=1e-9)
    np.testing.assert_allclose(it.getTrainingError(), h10, rtol=1e-9)


def test_gd_history_non_increasing_and_predicts(data, spark):
    train, test = data
    m = GradientDescentRegression(featuresCol="features", labelCol="label_shifted").fit(train)
    h = m.getTrainingError()
    assert len(h) == 100 and all(b <= a + 1e-12 for a, b in zip(h, h[1:]))
    p = m.transform(test).select("features", "prediction").first()
    assert abs(p["prediction"] - float(np.dot(p["features"], m.getWeights()))) < 1e-9
    assert m.history(spark).count() == 100


def test_gd_empty_and_divergence(spark):
    empty = spark.createDataFrame([], "features array<double>, label double")
    with pytest.raises(ValueError):
        GradientDescentRegression().fit(empty)
    big = spark.createDataFrame([([1000.0, 2000.0], 1.0)] * 5, "features array<double>, label double")
    with pytest.raises(FloatingPointError):
        GradientDescentRegression(maxIter=100).fit(big)


def test_descend_uses_history_before_update():
    G = np.array([[2.0]]); b = np.array([2.0])
    w, hist = descend(G, b, 2.0, 2.0, 1, 1.0)
    assert hist == [1.0] and w[0] == pytest.approx(1.0)


@pytest.mark.parametrize("reg,alpha", [(0.9, 0.1), (0.1, 0.1), (0.5, 1.0), (0.3, 0.0)])
def test_elastic_net_matches_mllib(data, reg, alpha):
    train, _ = data
    ours = ElasticNet(featuresCol="features", labelCol="label_shifted", regParam=reg,
                      elasticNetParam=alpha).fit(train)
    coef, b0, _ = mllib_fit(train, "features", "label_shifted", reg, alpha)
    np.testing.assert_allclose(ours.getCoefficients(), coef, rtol=1e-5, atol=1e-5)
    assert ours.getIntercept() == pytest.approx(b0, rel=1e-5, abs=1e-5)


def test_training_metrics_match_mllib_summary(data):
    train, _ = data
    ours = ElasticNet(featuresCol="features", labelCol="label_shifted", regParam=0.9,
                      elasticNetParam=0.1).fit(train)
    m = ours.evaluate(train).first()
    _, _, ml = mllib_fit(train, "features", "label_shifted", 0.9, 0.1)
    s = ml.summary
    assert m["rmse"] == pytest.approx(s.rootMeanSquaredError, rel=1e-6)
    assert m["mae"] == pytest.approx(s.meanAbsoluteError, rel=1e-6)
    assert m["mse"] == pytest.approx(s.meanSquaredError, rel=1e-6)


def test_mse_from_moments_equals_row_pass(data):
    train, test = data
    model = ElasticNet(featuresCol="features", labelCol="label_shifted", regParam=0.9,
                       elasticNetParam=0.1).fit(train)
    tm = stats.moments(test, "features", "label_shifted")[None]
    mse = mse_on(tm, np.array(model.getCoefficients()), model.getIntercept())
    assert mse == pytest.approx(model.evaluate(test).first()["mse"], rel=1e-9)


def test_cross_validation_matches_mllib(data):
    train, _ = data
    tr = sp.with_fold(train, ["song_id"], 3)
    grid = param_grid([20], [0.4, 0.9, 1.4])
    est = ElasticNet(featuresCol="features", labelCol="label_shifted", elasticNetParam=0.1)
    res = cross_validate(tr, est, grid)
    cvm = mllib_cross_validate(tr, "features", "label_shifted", grid, alpha=0.1, parallelism=2)
    np.testing.assert_allclose(res.avg_metrics, cvm.avgMetrics, rtol=1e-5)
    assert res.best_params["regParam"] == cvm.bestModel.getRegParam()


def test_cv_label_offset_parity_mode(data):
    train, _ = data
    tr = sp.with_fold(train, ["song_id"], 3)
    est = ElasticNet(featuresCol="features", labelCol="label_shifted", elasticNetParam=0.1)
    off = cross_validate(tr, est, param_grid([20], [0.4, 1.4]), eval_label_offset=1922.0)
    assert all(1900 < m < 1950 for m in off.avg_metrics)


def test_vector_size_from_metadata_without_a_job(spark, sf):
    from cadenza.plans.queries_ml import _train_test
    train, _ = _train_test(spark, sf, poly=True)
    assert train.schema["features"].metadata.get("vector_size") == 3
    assert train.schema["polyfeatures"].metadata.get("vector_size") == 9
    sc = spark.sparkContext
    sc.setJobGroup("size-probe", "size-probe")
    assert stats.feature_size(train, "polyfeatures") == 9
    assert len(sc.statusTracker().getJobIdsForGroup("size-probe")) == 0
    sc.setJobGroup("", "")


def test_moments_rejects_wrong_size_and_too_many_groups(spark):
    df = spark.createDataFrame([([1.0, 2.0], 1.0, 0), ([1.0], 2.0, 1)],
                               "features array<double>, label double, g int")
    with pytest.raises(ValueError):
        stats.moments(df, "features", "label", d=2)
    ok = spark.createDataFrame([([1.0, 2.0], 1.0, i) for i in range(5)],
                               "features array<double>, label double, g int")
    with pytest.raises(ValueError):
        stats.moments(ok, "features", "label", d=2, by="g", max_groups=3)


def test_empty_training_set_after_pipeline_raises(spark, sf):
    from cadenza.plans.queries_ml import _train_test
    train, _ = _train_test(spark, sf)
    empty = train.filter(F.lit(False))
    with pytest.raises(ValueError):
        GradientDescentRegression(featuresCol="features", labelCol="label_shifted").fit(empty)
    with pytest.raises(ValueError):
        ElasticNet(featuresCol="features", labelCol="label_shifted", regParam=0.1).fit(empty)


def test_gd_final_error_is_rmse_of_returned_weights(data):
    train, _ = data
    m = GradientDescentRegression(featuresCol="features", labelCol="label_shifted").fit(train)
    rows = train.select("features", "label_shifted").collect()
    X = np.array([r[0] for r in rows]); y = np.array([r[1] for r in rows])
    direct = math.sqrt(np.mean((y - X @ np.array(m.getWeights())) ** 2))
    assert m.getFinalError() == pytest.approx(direct, rel=1e-9)
    assert m.getFinalError() < m.getTrainingError()[-1]
    it = GradientDescentRegression(featuresCol="features", labelCol="label_shifted",
                                   mode="iterative", maxIter=5).fit(train)
    g = GradientDescentRegression(featuresCol="features", labelCol="label_shifted",
                                  maxIter=5).fit(train)
    assert it.getFinalError() == pytest.approx(g.getFinalError(), rel=1e-9)


def test_cv_best_model_carries_its_params(data):
    train, _ = data
    tr = sp.with_fold(train, ["song_id"], 3)
    est = ElasticNet(featuresCol="features", labelCol="label_shifted", elasticNetParam=0.1)
    res = cross_validate(tr, est, param_grid([20, 30], [0.4, 1.4]))
    assert res.best_model.getRegParam() == res.best_params["regParam"]
    assert res.best_model.getMaxIter() == res.best_params["maxIter"]


def test_cv_wide_statistics_path_matches(data, monkeypatch):
    train, _ = data
    tr = sp.with_fold(train, ["song_id"], 3)
    est = ElasticNet(featuresCol="features", labelCol="label_shifted", elasticNetParam=0.1)
    grid = param_grid([20], [0.4, 1.4])
    narrow = cross_validate(tr, est, grid).avg_metrics
    monkeypatch.setattr(stats, "WIDE_D", 1)
    wide = cross_validate(tr, est, grid).avg_metrics
    np.testing.assert_allclose(wide, narrow, rtol=1e-7)


def test_models_invariant_to_partitioning(data):
    train, _ = data
    tr = sp.with_fold(train, ["song_id"], 3)
    out = []
    for parts in (1, 8):
        t = tr.repartition(parts)
        gd = GradientDescentRegression(featuresCol="features", labelCol="label_shifted").fit(t)
        en = ElasticNet(featuresCol="features", labelCol="label_shifted", regParam=0.9,
                        elasticNetParam=0.1).fit(t)
        cv = cross_validate(t, ElasticNet(featuresCol="features", labelCol="label_shifted",
                                          elasticNetParam=0.1), param_grid([20], [0.4, 0.9]))
        out.append((gd.getWeights(), en.getCoefficients() + [en.getIntercept()], cv.avg_metrics))
    for a, b in zip(out[0], out[1]):
        np.testing.assert_allclose(a, b, rtol=1e-9)


def test_wide_moments_stable_with_large_means(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 1.0, size=(500, 2))
    y = x @ np.array([1.0, -1.0]) + rng.normal(size=500)
    df = spark.createDataFrame([(list(map(float, a)), float(b)) for a, b in zip(x, y)],
                               "features array<double>, label double")
    narrow = stats.moments(df, "features", "label", d=2)[None]
    monkeypatch.setattr(stats, "WIDE_D", 1)
    wide = stats.moments(df, "features", "label", d=2)[None]
    np.testing.assert_allclose(wide.cov, narrow.cov, rtol=1e-6, atol=1e-8)
    np.testing.assert_allclose(wide.cov[:2, :2], np.cov(x.T, bias=True), rtol=1e-6)


def test_poly_size_from_metadata(spark, sf):
    from cadenza.operators import features as fe
    from cadenza.plans import fixtures as fx
    from pyspark.ml import Pipeline
    lines = fx.song_lines(spark, sf)
    stages = fe.song_stages([1, 2, 3, 4]) + [fe.PolyExpansion(inputCol="features", outputCol="p")]
    out = Pipeline(stages=stages).fit(lines).transform(lines)
    assert out.schema["p"].metadata["vector_size"] == 14
    assert len(out.select("p").first()[0]) == 14


@pytest.mark.parametrize("metric", ["rmse", "mse", "mae"])
def test_regression_evaluator_matches_mllib(data, metric):
    from pyspark.ml.evaluation import RegressionEvaluator as MLEval
    from cadenza.functions.metrics import RegressionEvaluator
    train, test = data
    m = ElasticNet(featuresCol="features", labelCol="label_shifted", regParam=0.9,
                   elasticNetParam=0.1).fit(train)
    scored = m.transform(test)
    ours = RegressionEvaluator(metricName=metric, labelCol="label_shifted").evaluate(scored)
    theirs = MLEval(metricName=metric, labelCol="label_shifted").evaluate(scored)
    assert ours == pytest.approx(theirs, rel=1e-9)
    assert not RegressionEvaluator().isLargerBetter()


def test_moments_reject_null_or_nan(spark, monkeypatch):
    for rows in ([([1.0, 2.0], None), ([1.0, 3.0], 2.0)],
                 [([1.0, float("nan")], 1.0), ([1.0, 3.0], 2.0)]):
        df = spark.createDataFrame(rows, "features array<double>, label double")
        with pytest.raises(ValueError):
            stats.moments(df, "features", "label", d=2)
    monkeypatch.setattr(stats, "WIDE_D", 1)
    df = spark.createDataFrame([([1.0, float("nan")], 1.0), ([1.0, 3.0], 2.0)],
                               "features array<double>, label double")
    with pytest.raises(Exception):
        stats.moments(df, "features", "label", d=2)


def test_min_over_all_rows_changes_gd_weights_without_intercept(spark):
    # the smallest label sits in the test rows: learning the minimum on the
    # training rows vs on all rows shifts the labels differently, and GD
    # (no intercept) ends at different weights
    from pyspark.ml import Pipeline
    from cadenza.operators import features as fe
    rows = [([0.2, 0.4], 10.0), ([0.5, 0.1], 12.0), ([0.9, 0.3], 15.0), ([0.3, 0.8], 11.0)]
    train = spark.createDataFrame(rows, "features array<double>, label double")
    all_min = 5.0  # e.g. from a held-out row
    def fit(offset):
        stages = [fe.MinShift(inputCol="label", outputCol="y", offset=offset),
                  GradientDescentRegression(featuresCol="features", labelCol="y")]
        return Pipeline(stages=stages).fit(train).stages[-1].getWeights()
    learned = Pipeline(stages=[fe.MinShift(inputCol="label", outputCol="y")]).fit(train)
    assert learned.stages[0].getOrDefault("offset") == 10.0
    assert not np.allclose(fit(all_min), fit(10.0))
