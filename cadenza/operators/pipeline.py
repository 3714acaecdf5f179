"""Pipelines that learn their stages and their model in one pass over the data.

A fitted stage such as :class:`~.features.MinShift` is itself an aggregate. Where
the model fits on moments, the minimum and the moments are taken by the same
aggregate, over rows to which the shift has not been applied; subtracting a
constant from the label then only moves its mean. :class:`Pipeline` does so when
the stages allow it and otherwise fits stage by stage, with the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml import Pipeline as MLPipeline
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import MinShift
from .stats import Moments, feature_size, moments


@dataclass
class Folded:
    """Stages whose learned shifts are left to be applied to moments.

    ``rows`` have all stages but the learned shifts applied; ``label`` is the
    column of the model's label before its shift, which is ``label_shift`` (a
    place in ``shifts``) or None; ``low`` holds the shifts' inputs.
    """

    stages: list
    rows: DataFrame
    label: str
    label_shift: int | None
    shifts: dict[int, int]
    low: list[Column]

    def learned(self, mins) -> list:
        """The stages with the learned minima."""
        return [s.learned(mins[self.shifts[i]]) if i in self.shifts else s for i, s in enumerate(self.stages)]

    def shifted(self, m: Moments, mins) -> Moments:
        """The moments with the label's shift applied."""
        return m if self.label_shift is None else m.with_label_minus(mins[self.label_shift])


def fold(stages: list, estimator: Estimator, df: DataFrame) -> Folded | None:
    """The stages folded for one pass, or None where that is not possible: an
    estimator other than a label shift, or a stage that needs a shift's output."""
    done, shifts, low, outputs = [], {}, [], {}
    label = estimator.getLabelCol()
    try:
        for i, s in enumerate(stages):
            if isinstance(s, MinShift) and not s.isFixed():
                name = f"_low{len(low)}"
                # the shift's input as it is here, whatever a later stage makes of its name
                df = df.withColumn(name, F.col(s.getInputCol())).drop(s.getOutputCol())
                outputs[s.getOutputCol()] = len(low)
                shifts[i] = len(low)
                low.append(F.col(name))
                done.append(s)
                continue
            if isinstance(s, Estimator):
                if not isinstance(s, MinShift):
                    return None
                s = s.fit(df)
            # a stage that reads a shift's output does not resolve here
            df = s.transform(df)
            done.append(s)
        shift = None if label in df.columns else outputs.get(label)
        label = label if shift is None else f"_low{shift}"
        df.select(label, estimator.getFeaturesCol())
    except AnalysisException:
        return None
    return Folded(done, df, label, shift, shifts, low)


class Pipeline(MLPipeline):
    """A ``pyspark.ml`` pipeline; one pass fits all of it where :func:`fold` can."""

    def _fit(self, df: DataFrame) -> PipelineModel:
        *stages, estimator = self.getStages()
        if not (hasattr(estimator, "fit_moments") and estimator.fitsOnMoments()):
            return super()._fit(df)
        folded = fold(stages, estimator, df)
        if folded is None:
            return super()._fit(df)
        fc = estimator.getFeaturesCol()
        m = moments(folded.rows, fc, folded.label, feature_size(folded.rows, fc), mins=folded.low)[None]
        return PipelineModel(stages=[*folded.learned(m.mins), estimator.fit_moments(folded.shifted(m, m.mins))])
