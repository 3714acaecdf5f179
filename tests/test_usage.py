"""The README quick-start, executed (kept in sync by hand)."""


def test_quick_start(spark, tmp_path):
    from cadenza.functions.metrics import RegressionEvaluator
    from cadenza.operators import features as fe
    from cadenza.operators import profile, songs, split
    from cadenza.operators.gd import GradientDescentRegression
    from cadenza.operators.linreg import ElasticNet
    from cadenza.operators.pipeline import Pipeline
    from cadenza.operators.tuning import cross_validate, param_grid
    from cadenza.plans import fixtures as fx
    from cadenza.sources import text

    # song lines as a text file (year,f1,...,f12 per line)
    path = text.write_lines(fx.song_lines(spark, "/root/testdata/sf0.001", with_id=False),
                            str(tmp_path / "songs"))
    lines = text.read_lines(spark, path)

    # profiling: typed rows, then DataFrame or SQL questions
    typed = songs.parse_songs(lines)
    profile.counts_by(typed, "year", name="numberSongs").show(3)
    typed.createOrReplaceTempView("song")
    spark.sql("select max(year), min(year), avg(year) from song").show()

    # reproducible split by row hash (here on the line text itself)
    train, test = split.hash_split(lines, ["value"], [0.8, 0.2])

    # feature pipeline + elastic net, fitted on the training rows
    stages = fe.song_stages([1, 2, 3]) + [
        ElasticNet(featuresCol="features", labelCol="label_shifted",
                   regParam=0.9, elasticNetParam=0.1, maxIter=50)]
    model = Pipeline(stages=stages).fit(train)
    scored = model.transform(test)
    rmse = RegressionEvaluator(labelCol="label_shifted").evaluate(scored)

    # 49-point grid x 3-fold CV in one grouped aggregate
    feats = split.with_fold(Pipeline(stages=fe.song_stages([1, 2, 3])).fit(train)
                            .transform(train), ["value"], 3)
    cv = cross_validate(feats, ElasticNet(featuresCol="features", labelCol="label_shifted",
                                          elasticNetParam=0.1),
                        param_grid([20, 30, 40, 50, 60, 70, 80],
                                   [0.4, 0.6, 0.8, 0.9, 1.0, 1.2, 1.4]))
    best = cv.best_model  # getRegParam(), getCoefficients(), getIntercept()

    # gradient descent as a pipeline stage
    gd = GradientDescentRegression(featuresCol="features", labelCol="label_shifted")
    gd_model = Pipeline(stages=fe.song_stages([1, 2, 3]) + [gd]).fit(train).stages[-1]

    assert rmse > 0 and best.getRegParam() in (0.4, 0.6, 0.8, 0.9, 1.0, 1.2, 1.4)
    assert len(gd_model.getTrainingError()) == 100 and len(gd_model.getWeights()) == 3
