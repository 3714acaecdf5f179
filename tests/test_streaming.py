"""A fitted pipeline is made of column expressions, so it scores a
Structured Streaming source unchanged (file source -> memory sink)."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from cadenza.operators import features as fe
from cadenza.operators.linreg import ElasticNet
from cadenza.plans import fixtures as fx
from cadenza.sources import text


def test_fitted_pipeline_scores_a_stream(spark, sf, tmp_path):
    lines = fx.song_lines(spark, sf, with_id=False)
    stages = fe.song_stages([1, 2, 3], label_offset=1922.0) + [
        ElasticNet(featuresCol="features", labelCol="label_shifted", regParam=0.9,
                   elasticNetParam=0.1)]
    model = Pipeline(stages=stages).fit(lines)
    src = str(tmp_path / "incoming")
    text.write_lines(lines, src)
    stream = spark.readStream.schema("value string").text(src)
    q = (model.transform(stream).select("value", "prediction")
         .writeStream.format("memory").queryName("scored_songs").outputMode("append").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    streamed = spark.table("scored_songs")
    batch = model.transform(lines).select("value", "prediction")
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0
    assert streamed.agg(F.max(F.abs("prediction"))).first()[0] < 1e6
