"""Regression error metrics as aggregate expressions (one pass, no UDF)."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .parse import ColumnOrName, _c


def squared_error(label: ColumnOrName, prediction: ColumnOrName) -> Column:
    e = _c(label) - _c(prediction)
    return e * e


def error_aggs(label: ColumnOrName = "label",
               prediction: ColumnOrName = "prediction") -> list[Column]:
    """``rmse``, ``mse``, ``mae``, ``n`` as aggregate columns. A row without a
    label or a prediction cannot be scored and raises."""
    e = _c(label) - _c(prediction)
    lost = F.count_if(e.isNull())

    def whole(c: Column) -> Column:
        return F.when(lost == 0, c).otherwise(F.raise_error(F.concat(
            lost.cast("string"), F.lit(" rows have no label or no prediction"))))

    mse = F.avg(e * e)
    return [whole(F.sqrt(mse)).alias("rmse"), whole(mse).alias("mse"),
            whole(F.avg(F.abs(e))).alias("mae"), F.count(e).alias("n")]


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> dict:
    """Evaluate rmse/mse/mae in one aggregate job; returns a small dict."""
    row = df.agg(*error_aggs(label, prediction)).first()
    return row.asDict()


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return regression_metrics(df, label, prediction)["rmse"]


class RegressionEvaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """``rmse`` / ``mse`` / ``mae`` of a scored frame in one aggregate,
    usable wherever a ``pyspark.ml`` evaluator is (smaller is better)."""

    metricName = Param(Params._dummy(), "metricName", "rmse, mse or mae",
                       typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, metricName="rmse", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(metricName="rmse", labelCol="label", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset):
        name = self.getOrDefault(self.metricName)
        if name not in ("rmse", "mse", "mae"):
            raise ValueError(f"unknown metric {name}")
        return float(regression_metrics(dataset, self.getLabelCol(),
                                        self.getPredictionCol())[name])

    def isLargerBetter(self) -> bool:
        return False
