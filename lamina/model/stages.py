"""Spark ML pipeline stages for the preprocessing of the modelling stage.

Fitted statistics are small (one value per column) and live in JSON params,
so the stock param writer/reader persists them; the target encoder's table
grows with the number of categories and is saved as Parquet next to its
metadata. Fitting uses the distributed aggregations of ``prep``.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.model import prep
from lamina.plans.joins import materialize, sized_broadcast


class _Cols(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to process",
                      typeConverter=TypeConverters.toListString)

    def getInputCols(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class _Fitted(Params):
    fitted = Param(Params._dummy(), "fitted", "fitted statistics as JSON",
                   typeConverter=TypeConverters.toString)

    def fitted_values(self) -> dict:
        return json.loads(self.getOrDefault(self.fitted))


# -- median imputation ------------------------------------------------------------------


class MedianImputer(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """Replace nulls by the exact (interpolated) median of the fit data;
    output columns are doubles."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MedianImputerModel":
        meds = prep.exact_medians(dataset, self.getInputCols())
        return MedianImputerModel(inputCols=self.getInputCols(), fitted=json.dumps(meds))


class MedianImputerModel(Model, _Cols, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, fitted=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return prep.impute(dataset, self.fitted_values())


# -- standardising ----------------------------------------------------------------------


class Standardizer(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std of the fit data; a constant column is only centred."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "StandardizerModel":
        stats = prep.mean_std(dataset, self.getInputCols())
        return StandardizerModel(inputCols=self.getInputCols(), fitted=json.dumps(stats))


class StandardizerModel(Model, _Cols, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, fitted=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        stats = {c: (v[0] if v[0] is not None else 0.0, v[1])
                 for c, v in self.fitted_values().items()}
        return prep.standardize(dataset, stats)


# -- most-frequent imputation ---------------------------------------------------------------


class ModeImputer(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """Replace nulls by the most frequent value (ties -> smallest); output strings."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ModeImputerModel":
        rows = prep.most_frequent(dataset, self.getInputCols()).collect()
        modes = {r["feature"]: r["category"] for r in rows}
        return ModeImputerModel(inputCols=self.getInputCols(), fitted=json.dumps(modes))


class ModeImputerModel(Model, _Cols, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, fitted=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        modes = self.fitted_values()
        cols = self.getInputCols()
        out = prep.impute_modes(dataset, {c: modes[c] for c in cols if c in modes})
        missing = [c for c in cols if c not in modes]  # never seen a value: keep as text
        return out.withColumns({c: F.col(c).cast("string") for c in missing}) if missing else out


# -- cross-fitted target encoding ------------------------------------------------------------


class _TEParams(_Cols):
    labelCol = Param(Params._dummy(), "labelCol", "0/1 target", TypeConverters.toString)
    foldCol = Param(Params._dummy(), "foldCol", "fold id column", TypeConverters.toString)
    oofCol = Param(Params._dummy(), "oofCol",
                   "boolean column; where true the out-of-fold encoding is used",
                   TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="label", foldCol="fold", oofCol="__oof")


class CrossFitTargetEncoder(Estimator, _TEParams, DefaultParamsReadable, DefaultParamsWritable):
    """Empirical-Bayes target encoding. Fit rows flagged by ``oofCol`` are
    encoded out-of-fold (statistics of the other folds), other rows with the
    full-fit encoding; an unseen category gets the global mean."""

    @keyword_only
    def __init__(self, inputCols=None, labelCol="label", foldCol="fold", oofCol="__oof"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "TargetEncoderModel":
        cols, y, fold = (self.getInputCols(), self.getOrDefault(self.labelCol),
                         self.getOrDefault(self.foldCol))
        full = prep.target_encoding(dataset, cols, y).select("feature", "category", "encoding")
        oof = prep.target_encoding_oof(dataset, cols, y, fold).select(
            "feature", "category", fold, "encoding")
        gm = prep.global_rate(dataset, y)
        gm_fold = prep.global_rate(dataset, y, fold)
        fitted = json.dumps({"global": gm, "by_fold": {str(k): v for k, v in gm_fold.items()}})
        model = TargetEncoderModel(inputCols=cols, labelCol=y, foldCol=fold,
                                   oofCol=self.getOrDefault(self.oofCol), fitted=fitted)
        # write the per-category tables once so that transform does not re-fit
        model.set_tables(materialize(full, "encoding"), materialize(oof, "encoding-oof"))
        return model


class TargetEncoderModel(Model, _TEParams, _Fitted, MLReadable, MLWritable):
    @keyword_only
    def __init__(self, inputCols=None, labelCol="label", foldCol="fold", oofCol="__oof",
                 fitted=None):
        super().__init__()
        self._set(**self._input_kwargs)
        self.full: DataFrame | None = None
        self.oof: DataFrame | None = None

    def set_tables(self, full: DataFrame, oof: DataFrame) -> None:
        self.full, self.oof = full, oof

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """One pass: every column joins the full-fit table on its category and,
        when the out-of-fold flag column is present, the out-of-fold table on
        (category, fold); the flag picks which encoding the row gets."""
        cols, fold = self.getInputCols(), self.getOrDefault(self.foldCol)
        flag = self.getOrDefault(self.oofCol)
        vals = self.fitted_values()
        gm = F.lit(vals["global"])
        use_oof = flag in dataset.columns
        out = dataset
        for c in cols:
            full = (self.full.where(F.col("feature") == F.lit(c))
                    .select(F.col("category").alias("__cat"), F.col("encoding").alias("__full")))
            out = (out.withColumn("__cat", F.col(c).cast("string"))
                   .join(sized_broadcast(full), "__cat", "left"))
            value = F.coalesce(F.col("__full"), gm)
            if use_oof:
                oof = (self.oof.where(F.col("feature") == F.lit(c))
                       .select(F.col("category").alias("__cat"), F.col(fold).alias("__fold"),
                               F.col("encoding").alias("__oofv")))
                out = (out.withColumn("__fold", F.col(fold))
                       .join(sized_broadcast(oof), ["__cat", "__fold"], "left"))
                by_fold = None
                for k, v in sorted(vals["by_fold"].items()):
                    cond = F.col(fold) == F.lit(int(k))
                    by_fold = (F.when(cond, F.lit(v)) if by_fold is None
                               else by_fold.when(cond, F.lit(v)))
                value = F.when(F.col(flag), F.coalesce(F.col("__oofv"), by_fold)).otherwise(value)
            out = out.withColumn(c, value).drop("__cat", "__full", "__fold", "__oofv")
        return out

    def write(self) -> MLWriter:
        return _TEWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TEReader(cls)


class _TEWriter(MLWriter):
    def __init__(self, instance: TargetEncoderModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.full.write.mode("overwrite").parquet(f"{path}/full")
        self.instance.oof.write.mode("overwrite").parquet(f"{path}/oof")


class _TEReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TargetEncoderModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.set_tables(spark.read.parquet(f"{path}/full"), spark.read.parquet(f"{path}/oof"))
        return model
