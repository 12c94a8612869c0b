"""Fitted artefacts on shared storage: feature parameters, models, run settings.

Layout of a run folder: ``scaler`` and ``categories`` (Parquet), ``config``
(JSON), ``model/step=k`` (one model per forecast step).
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from tideline.operators.boosting import BoostedModel
from tideline.operators.encode import OneHot
from tideline.operators.features import FeatureModel
from tideline.operators.scale import PARAM_COLUMNS, Scaler
from tideline.spec import RunConfig, SeriesSpec

_SCALER_SCHEMA = "column string, mean double, scale double, position int"
_CATEGORY_SCHEMA = "column string, category string, position int"


def save_features(spark: SparkSession, model: FeatureModel, path: str) -> None:
    """Parameter tables of a feature model."""
    scaler = model.scaler
    if scaler.by:
        table = scaler.table.select(*scaler.by, *PARAM_COLUMNS)
    else:
        rows = [(c, *scaler.values[c], i) for i, c in enumerate(scaler.columns)]
        table = spark.createDataFrame(rows, _SCALER_SCHEMA).coalesce(1)
    table.write.mode("overwrite").parquet(f"{path}/scaler")
    rows = [(c, v, i) for c, values in model.encoder.categories.items() for i, v in enumerate(values)]
    spark.createDataFrame(rows, _CATEGORY_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/categories")
    settings = {
        "series": model.spec.to_dict(),
        "columns": list(scaler.columns),
        "by": list(scaler.by),
        "unseen": model.encoder.unseen,
        "scale_target": model.scale_target,
    }
    save_settings(spark, settings, f"{path}/settings")


def load_features(spark: SparkSession, path: str) -> FeatureModel:
    """S8."""
    settings = load_settings(spark, f"{path}/settings")
    table = spark.read.parquet(f"{path}/scaler")
    scaler = Scaler.from_table(table, settings["columns"], tuple(settings["by"]))
    categories: dict[str, list[str | None]] = {}
    saved = spark.read.schema(_CATEGORY_SCHEMA).parquet(f"{path}/categories")
    for row in saved.orderBy("column", "position").collect():
        categories.setdefault(row["column"], []).append(row["category"])
    spec = SeriesSpec.from_dict(settings["series"])
    ordered = {c: tuple(categories[c]) for c in spec.categoricals if c in categories}
    return FeatureModel(spec, scaler, OneHot(ordered, settings["unseen"]), settings["scale_target"])


def save_models(models: list[PipelineModel | BoostedModel], path: str, spark: SparkSession | None = None) -> None:
    """One fitted model per forecast step."""
    if not models:
        raise RuntimeError("no fitted model to save")
    for step, model in enumerate(models, start=1):
        if isinstance(model, BoostedModel):
            model.save(spark or SparkSession.active(), f"{path}/step={step}")
        else:
            model.write().overwrite().save(f"{path}/step={step}")


def load_models(path: str, horizon: int, boosted_by: SparkSession | None = None) -> list[PipelineModel | BoostedModel]:
    """Pipelines, or boosted models if a session for them is given."""
    paths = [f"{path}/step={step}" for step in range(1, horizon + 1)]
    return [BoostedModel.load(boosted_by, p) if boosted_by else PipelineModel.load(p) for p in paths]


def save_settings(spark: SparkSession, settings: dict, path: str) -> None:
    """A settings record as a one-line JSON table."""
    frame = spark.createDataFrame([(json.dumps(settings),)], "settings string").coalesce(1)
    frame.write.mode("overwrite").text(path)


def load_settings(spark: SparkSession, path: str) -> dict:
    """S4."""
    return json.loads(spark.read.text(path).first()[0])


def save_config(spark: SparkSession, config: RunConfig, path: str) -> None:
    """S5."""
    save_settings(spark, config.to_dict(), path)


def load_config(spark: SparkSession, path: str) -> RunConfig:
    """S5."""
    return RunConfig.from_dict(load_settings(spark, path))
