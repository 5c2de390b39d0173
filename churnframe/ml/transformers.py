"""Custom pipeline stages: feature engineering and exact imputers.

They are ordinary ``pyspark.ml`` stages: parameters are Params, fitted state is
a short list of values, ``transform`` is a column expression and the stages
save/load with a ``PipelineModel``.  Fits run as distributed aggregations;
only the fitted values (one per column) reach the driver.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnframe.functions.features import engineer
from churnframe.operators.profile import medians, most_frequent
from churnframe.schema import ADDON_COLUMNS


class FeatureEngineer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless: coerces measures, adds avg_monthly_spend, tenure_band,
    addon_count; keeps all input columns."""

    addonCols = Param(Params._dummy(), "addonCols", "add-on service columns",
                      typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, addonCols=None):
        super().__init__()
        self._setDefault(addonCols=list(ADDON_COLUMNS))
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return engineer(dataset, self.getOrDefault(self.addonCols))


class _ColumnsParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to impute",
                      typeConverter=TypeConverters.toListString)


class MedianImputerModel(Model, _ColumnsParams, DefaultParamsReadable, DefaultParamsWritable):
    fillValues = Param(Params._dummy(), "fillValues", "fitted medians",
                       typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCols=None, fillValues=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.getOrDefault(self.inputCols)
        vals = self.getOrDefault(self.fillValues)
        return dataset.withColumns({
            c: F.coalesce(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")),
                          F.lit(v))
            for c, v in zip(cols, vals)})


def _require_values(fitted: dict, cols) -> None:
    """A column without any value has nothing to impute from."""
    empty = [c for c in cols if fitted.get(c) is None]
    if empty:
        raise ValueError(f"Cannot fit imputation, no values in: {empty}")


class MedianImputer(Estimator, _ColumnsParams, DefaultParamsReadable, DefaultParamsWritable):
    """Median imputation with the exact (interpolated) median: Spark's
    ``Imputer`` uses an approximate quantile and returns an order statistic."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        cols = self.getOrDefault(self.inputCols)
        got = {r["column_name"]: r["median"] for r in medians(dataset, cols).collect()}
        _require_values(got, cols)
        vals = [float(got[c]) for c in cols]
        return MedianImputerModel(inputCols=cols, fillValues=vals)


class ModeImputerModel(Model, _ColumnsParams, DefaultParamsReadable, DefaultParamsWritable):
    fillValues = Param(Params._dummy(), "fillValues", "fitted most frequent values",
                       typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCols=None, fillValues=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.getOrDefault(self.inputCols)
        vals = self.getOrDefault(self.fillValues)
        return dataset.withColumns({
            c: F.coalesce(F.col(c).cast("string"), F.lit(v)) for c, v in zip(cols, vals)})


class ModeImputer(Estimator, _ColumnsParams, DefaultParamsReadable, DefaultParamsWritable):
    """Most-frequent imputation for categorical columns (ties -> smallest)."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ModeImputerModel:
        cols = self.getOrDefault(self.inputCols)
        got = {r["column_name"]: r["fill_value"] for r in most_frequent(dataset, cols).collect()}
        _require_values(got, cols)
        return ModeImputerModel(inputCols=cols, fillValues=[got[c] for c in cols])
