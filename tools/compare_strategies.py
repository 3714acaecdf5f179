"""Wall time of the one-pass strategies against the per-iteration ones on
the same featurised training rows (default sf0.1). Prints one JSON line.

  gd_gram        gradient descent from one aggregate of sufficient statistics
  gd_iterative   one aggregate job per iteration (100 jobs), input persisted
  enet_moments   elastic net from one pass of moments
  enet_mllib     MLlib LinearRegression (normal-equation solver)
  cv_moments     49 settings x 3 folds from one grouped aggregate
  cv_mllib       MLlib CrossValidator, 147 fits + refit, input persisted
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadenza.operators import split as sp  # noqa: E402
from cadenza.operators.gd import GradientDescentRegression  # noqa: E402
from cadenza.operators.linreg import ElasticNet, mllib_fit  # noqa: E402
from cadenza.operators.tuning import cross_validate, mllib_cross_validate, param_grid  # noqa: E402
from cadenza.plans.queries_ml import GRID_MAX_ITER, GRID_REG, _train_test  # noqa: E402
from cadenza.session import local_session  # noqa: E402


def timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return round(time.perf_counter() - t0, 3), out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    skip_mllib_cv = "--no-mllib-cv" in sys.argv
    spark = local_session()
    train, _ = _train_test(spark, sf)
    train = sp.with_fold(train.select("song_id", "features", "label_shifted"), ["song_id"], 3)
    train.count()  # materialise the split and label minimum once (not timed)
    res = {}
    gd = lambda mode: GradientDescentRegression(
        featuresCol="features", labelCol="label_shifted", mode=mode).fit(train)
    res["gd_gram"], m1 = timed(lambda: gd("gram"))
    res["gd_iterative"], m2 = timed(lambda: gd("iterative"))
    res["gd_max_weight_diff"] = max(abs(a - b) for a, b in zip(m1.getWeights(), m2.getWeights()))
    est = ElasticNet(featuresCol="features", labelCol="label_shifted", regParam=0.9,
                     elasticNetParam=0.1)
    res["enet_moments"], _ = timed(lambda: est.fit(train))
    res["enet_mllib"], _ = timed(lambda: mllib_fit(train, "features", "label_shifted", 0.9, 0.1))
    grid = param_grid(GRID_MAX_ITER, GRID_REG)
    cv_est = ElasticNet(featuresCol="features", labelCol="label_shifted", elasticNetParam=0.1)
    res["cv_moments"], cvr = timed(lambda: cross_validate(train, cv_est, grid))
    if not skip_mllib_cv:
        cached = train.persist()
        cached.count()
        res["cv_mllib"], cvm = timed(lambda: mllib_cross_validate(
            cached, "features", "label_shifted", grid, alpha=0.1, parallelism=4))
        res["cv_max_metric_diff"] = max(abs(a - b) for a, b in zip(cvr.avg_metrics, cvm.avgMetrics))
        cached.unpersist()
    res["sf"] = sf
    print(json.dumps(res))
    spark.stop()


if __name__ == "__main__":
    main()
