"""Registered queries on the ``embeddings`` table: the vector operators on
64-dimensional vectors (element-wise sums per label, inner products, and
gradient descent, which takes the wide-vector statistics path)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from ..functions import vectors as V
from ..operators import features as fe
from ..operators.gd import GradientDescentRegression
from ..operators.linreg import ElasticNet
from .queries import R, query

EMBED_DIM = 64  # fixed size of the embedding vectors
ENET_REG, ENET_ALPHA = 0.5, 0.3


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """``vec_id, features array<double>, label double``; the vector size is
    recorded in the column metadata."""
    e = fx.table(spark, sf, "embeddings")
    e = e.select("vec_id", F.col("label").cast("double").alias("label"),
                 F.col("embedding").cast("array<double>").alias("features"))
    return fe.with_vector(e, "features", F.col("features"), EMBED_DIM)


@query("embedding_sum")
def q_embedding_sum(spark, sf):
    """Element-wise vector sum per label, as (label, i, s) rows."""
    sums = V.sum_by(embeddings(spark, sf), "features", EMBED_DIM, ["label"])
    return sums.select(F.col("label").cast("int").alias("label"), "i", F.round("s", R).alias("s"))


@query("embedding_norm")
def q_embedding_norm(spark, sf):
    e = embeddings(spark, sf)
    return e.select("vec_id", F.round(V.dot("features", "features"), R).alias("norm2"))


@query("embedding_gd_iterative")
def q_embedding_gd_iterative(spark, sf):
    """The same descent without d x d numbers on the driver, many steps a pass."""
    model = GradientDescentRegression(featuresCol="features", labelCol="label", maxIter=100, stepSize=1.0,
                                      mode="span").fit(embeddings(spark, sf))
    return model.weights_frame(spark).select("i", F.round("weight", R).alias("weight"))


@query("embedding_enet_span")
def q_embedding_enet_span(spark, sf):
    """Elastic net without d x d numbers on the driver."""
    model = ElasticNet(featuresCol="features", labelCol="label", regParam=ENET_REG, elasticNetParam=ENET_ALPHA,
                       solver="span").fit(embeddings(spark, sf))
    return model.terms_frame(spark).select("term", F.round(F.col("value"), R).alias("value"))


@query("embedding_gd_weights")
def q_embedding_gd_weights(spark, sf):
    model = GradientDescentRegression(featuresCol="features", labelCol="label",
                                      maxIter=100, stepSize=1.0).fit(embeddings(spark, sf))
    return model.weights_frame(spark).select("i", F.round("weight", R).alias("weight"))
