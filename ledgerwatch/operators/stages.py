"""Feature engineering and exact robust scaling as pipeline stages: fit, transform, save, load.

Both are fitted on training rows only and carry their parameters, so one ``Pipeline`` of them and a
classifier is fitted, saved, loaded and cross-validated whole.
"""

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.operators.features import add_features, fit_median_amount, fit_robust_scaling
from ledgerwatch.schemas import ENGINEERED


class RiskFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the median amount of the training rows."""

    def _fit(self, dataset: DataFrame) -> "RiskFeaturesModel":
        return self._copyValues(RiskFeaturesModel(medianAmount=float(fit_median_amount(dataset))))


class RiskFeaturesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the five engineered columns."""

    medianAmount = Param(Params._dummy(), "medianAmount", "median amount of the training rows", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, medianAmount: float | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_features(dataset, self.getOrDefault(self.medianAmount))


class _Scaled(HasInputCols, HasOutputCol):
    approx = Param(Params._dummy(), "approx", "one pass with a bounded rank error", TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(outputCol="features", approx=False)


class ExactRobustScaler(Estimator, _Scaled, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the exact median and interquartile range of each input column."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCol: str = "features", approx: bool = False):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ExactRobustScalerModel":
        names = self.getInputCols()
        scaling = fit_robust_scaling(dataset, names, self.getOrDefault(self.approx))
        model = ExactRobustScalerModel(
            center=[scaling.center[c] for c in names], scale=[scaling.scale[c] for c in names]
        )
        return self._copyValues(model)


class ExactRobustScalerModel(Model, _Scaled, DefaultParamsReadable, DefaultParamsWritable):
    """Centres and scales the input columns into one vector; a missing value becomes NaN."""

    center = Param(Params._dummy(), "center", "median per input column", TypeConverters.toListFloat)
    scale = Param(Params._dummy(), "scale", "interquartile range per input column, 1 for 0", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, center: list[float] | None = None, scale: list[float] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = zip(self.getInputCols(), self.getOrDefault(self.center), self.getOrDefault(self.scale), strict=True)
        values = [F.coalesce((F.col(f"`{c}`") - F.lit(m)) / F.lit(s), F.lit(float("nan"))) for c, m, s in fitted]
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.array(*values)))


def preprocessing(columns: list[str], approx: bool = False) -> Pipeline:
    """Unfitted stages: engineered features, then ``columns`` and those scaled into ``features``."""
    return Pipeline(stages=[RiskFeatures(), ExactRobustScaler(inputCols=[*columns, *ENGINEERED], approx=approx)])
