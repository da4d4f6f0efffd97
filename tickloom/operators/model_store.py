"""Models that are fitted, saved, loaded and found by name.

``GroupedRidge`` and ``ModelSweep`` are Spark ML estimators whose models keep their parameters as metadata and their fits as a parquet table or as
saved Spark ML models, so ``save`` and ``load`` work in any session. ``REGISTRY`` maps names to estimators; ``save_model`` and ``load_model``
keep a model under its name in a folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import models as m


class _Columns(Params):
    features = Param(Params._dummy(), "features", "feature columns", TypeConverters.toListString)
    target = Param(Params._dummy(), "target", "column to predict", TypeConverters.toString)
    keys = Param(Params._dummy(), "keys", "columns of a fit (ridge) or of a row (sweep)", TypeConverters.toListString)
    prediction = Param(Params._dummy(), "prediction", "output column", TypeConverters.toString)

    def _defaults(self) -> None:
        self._setDefault(keys=["instrument"], prediction="prediction")

    def _put(self, values: dict[str, Any]):
        return self._set(**{k: v for k, v in values.items() if v is not None})


class _RidgeParams(_Columns):
    alpha = Param(Params._dummy(), "alpha", "penalty; 0: least squares", TypeConverters.toFloat)
    scale = Param(Params._dummy(), "scale", "penalise coefficients of unit-variance features", TypeConverters.toBoolean)
    minRows = Param(Params._dummy(), "minRows", "keys with fewer rows get no fit", TypeConverters.toInt)

    def _defaults(self) -> None:
        super()._defaults()
        self._setDefault(alpha=1.0, scale=False, minRows=3)


class GroupedRidge(Estimator, _RidgeParams, DefaultParamsReadable, DefaultParamsWritable):
    """One ridge per key from map-side combined sums."""

    def __init__(self, features: Sequence[str] | None = None, target: str | None = None, keys: Sequence[str] | None = None, **params: Any):
        super().__init__()
        self._defaults()
        self._put({"features": features and list(features), "target": target, "keys": keys and list(keys), **params})

    def _fit(self, dataset: DataFrame) -> GroupedRidgeModel:
        get = self.getOrDefault
        fits = m.grouped_ridge(dataset, get("features"), get("target"), get("keys"), get("alpha"), get("scale"), get("minRows"))
        return self._copyValues(GroupedRidgeModel(fits))


class GroupedRidgeModel(Model, _RidgeParams, MLReadable, MLWritable):
    """Fits as a table of one row per key; a row without a fit or with a missing feature is predicted as null."""

    def __init__(self, fits: DataFrame | None = None):
        super().__init__()
        self._defaults()
        self.fits = fits

    def _transform(self, dataset: DataFrame) -> DataFrame:
        keys, out = self.getOrDefault("keys"), self.getOrDefault("prediction")
        terms = F.struct(F.col("intercept").alias("b"), F.col("coefficients").alias("w")).alias("_fit")
        fits = self.fits.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], terms)
        same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
        value = F.col("_fit.b")
        for i, f in enumerate(self.getOrDefault("features")):
            value = value + F.col("_fit.w")[i] * F.col(f)
        joined = dataset.join(fits, same, "left")
        return joined.withColumn(out, value).drop("_fit", *[f"_key{i}" for i in range(len(keys))])

    def write(self) -> MLWriter:
        return _RidgeWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _RidgeReader()


class _RidgeWriter(MLWriter):
    def __init__(self, model: GroupedRidgeModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.fits.write.parquet(f"{path}/fits")


class _RidgeReader(MLReader):
    def load(self, path: str) -> GroupedRidgeModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = GroupedRidgeModel(self.sparkSession.read.parquet(f"{path}/fits"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _SweepParams(_Columns):
    kinds = Param(Params._dummy(), "kinds", "model kinds that are compared", TypeConverters.toListString)
    best = Param(Params._dummy(), "best", "kind with the least test RMSE", TypeConverters.toString)

    def _defaults(self) -> None:
        super()._defaults()
        self._setDefault(kinds=["linear", "ridge", "random_forest", "boosted_trees"])


class ModelSweep(Estimator, _SweepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits every kind on the train split and keeps the one with the least RMSE on the test split; ties to the kind listed first."""

    def __init__(self, features: Sequence[str] | None = None, target: str | None = None, keys: Sequence[str] | None = None, **params: Any):
        super().__init__()
        self._defaults()
        self._put({"features": features and list(features), "target": target, "keys": keys and list(keys), **params})

    def _fit(self, dataset: DataFrame) -> ModelSweepModel:
        get = self.getOrDefault
        scored = []
        for i, kind in enumerate(get("kinds")):
            model, pred = m.fit_and_predict(dataset, get("features"), get("target"), kind, get("keys"))
            row = m.split_metrics(pred).where("split = 'test'").select("rmse").first()
            scored.append((row["rmse"] if row and row["rmse"] is not None else float("inf"), i, kind, model))
        rmse, _, kind, model = min(scored, key=lambda r: r[:2])
        out = self._copyValues(ModelSweepModel(model, [(k, float(e)) for e, _, k, _ in scored]))
        return out._set(best=kind)


class ModelSweepModel(Model, _SweepParams, MLReadable, MLWritable):
    """The best model, and the test RMSE of every kind in ``scores``; rows with a missing feature are left out."""

    def __init__(self, model: Any = None, scores: Sequence[tuple[str, float]] = ()):
        super().__init__()
        self._defaults()
        self.model, self.scores = model, list(scores)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = self.model.copy().setPredictionCol(self.getOrDefault("prediction"))
        return model.transform(m.assemble(dataset, self.getOrDefault("features"))).drop("features")

    def write(self) -> MLWriter:
        return _SweepWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _SweepReader()


class _SweepWriter(MLWriter):
    def __init__(self, model: ModelSweepModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        kept = {"scores": [list(r) for r in self.model.scores], "modelClass": type(self.model.model).__name__}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=kept)
        self.model.model.save(f"{path}/model")


class _SweepReader(MLReader):
    def load(self, path: str) -> ModelSweepModel:
        from pyspark.ml import regression

        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        best = getattr(regression, metadata["modelClass"]).load(f"{path}/model")
        model = ModelSweepModel(best, [tuple(r) for r in metadata["scores"]])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class TextClassifier(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """The TF-IDF text model; its fit is a Spark ``PipelineModel``, which saves and loads itself."""

    def __init__(self, features: Sequence[str] | None = None, target: str | None = None):
        super().__init__()
        self._defaults()
        self._put({"features": features and list(features), "target": target})

    def _fit(self, dataset: DataFrame) -> Model:
        (text,) = self.getOrDefault("features")
        return m.text_classifier(dataset, text, self.getOrDefault("target"))


def _model_types() -> dict[str, Callable[[], MLReader]]:
    from pyspark.ml import PipelineModel

    return {"grouped_ridge": GroupedRidgeModel.read, "sweep": ModelSweepModel.read, "text": PipelineModel.read}


#: Estimator by name.
REGISTRY: dict[str, Callable[..., Estimator]] = {"grouped_ridge": GroupedRidge, "sweep": ModelSweep, "text": TextClassifier}


def create(name: str, **params: Any) -> Estimator:
    if name not in REGISTRY:
        raise ValueError(f"no model named {name}; known: {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name](**params)


def save_model(model: Model, folder: str, kind: str, name: str, overwrite: bool = False) -> str:
    """Save under ``folder/kind/name``; an existing model is replaced only with ``overwrite``."""
    if kind not in REGISTRY:
        raise ValueError(f"no model named {kind}; known: {', '.join(sorted(REGISTRY))}")
    path = f"{folder.rstrip('/')}/{kind}/{name}"
    writer = model.write().overwrite() if overwrite else model.write()
    writer.save(path)
    return path


def load_model(spark: SparkSession, folder: str, kind: str, name: str) -> Model:
    return _model_types()[kind]().session(spark).load(f"{folder.rstrip('/')}/{kind}/{name}")
