"""The training job: from a raw series table to a scored, storable run."""

from __future__ import annotations

from dataclasses import dataclass, field
from threading import Lock
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.metrics import METRICS, regression_metrics
from tideline.functions.missing import nan_to_null
from tideline.operators.boosting import Binned, BoostedModel, bin_windows
from tideline.operators.clean import clean, drop_duplicates, impute_mean
from tideline.operators.features import FeatureModel
from tideline.operators.models import (
    EVAL_METRIC,
    FEATURES,
    PREDICTION,
    as_vectors,
    fit_boosted,
    fit_step,
    importances_of,
    is_boosted,
    merged_params,
    model_kind,
    with_label,
)
from tideline.operators.order import choose_strategy, chronological_split, with_position
from tideline.operators.windows import build_windows, flat_columns, industrial_names, present_time_columns
from tideline.session import stage
from tideline.sources import artifacts
from tideline.sources.runs import append_runs
from tideline.spec import RunConfig, SeriesSpec


@dataclass(frozen=True)
class Samples:
    """Windows of all splits (a written table) and what is needed to read them."""

    windows: DataFrame
    features: FeatureModel
    names: tuple[str, ...]
    config: RunConfig
    rows: dict[str, int]
    _bins: dict[int, Binned] = field(default_factory=dict)
    _lock: Lock = field(default_factory=Lock)

    def binned(self, max_bins: int) -> Binned:
        """The windows in bins, written once for all steps and trials."""
        with self._lock:
            if max_bins not in self._bins:
                self._bins[max_bins] = bin_windows(self.windows, self.names, max_bins, self.assembled is None)
            return self._bins[max_bins]

    @property
    def assembled(self) -> tuple[str, ...] | None:
        """Named input columns, or None for flat windows."""
        return self.names if self.config.window.feature_mode == "industrial" else None


@dataclass(frozen=True)
class TrainedRun:
    """A fitted run: parameters, one model per forecast step, metrics by split."""

    config: RunConfig
    features: FeatureModel
    models: list[PipelineModel | BoostedModel]
    names: tuple[str, ...]
    record: dict[str, Any]


def clean_series(df: DataFrame, spec: SeriesSpec, strategy: str, per_series: bool = False) -> DataFrame:
    """C3 with keys and order columns left alone.

    Where every series fits one task, rows are compared in the partitioning of
    the series, so that cleaning and positions share one shuffle.
    """
    return clean(
        df,
        exclude=spec.reserved,
        by=spec.series_keys if per_series else (),
        colocate=spec.series_keys if strategy == "single" else (),
    )


def prepare_split(df: DataFrame, config: RunConfig, strategy: str) -> DataFrame:
    """L11 steps 1-3: cleaned rows with position and split, written once.

    The ranged path has written its rows already; the split is then only a
    projection on them.
    """
    spec = config.series
    if config.impute_on == "all":
        positioned = with_position(clean_series(df, spec, strategy, config.per_series), spec, strategy)
        split = chronological_split(positioned, config.split)
    else:
        colocate = spec.series_keys if strategy == "single" else ()
        distinct = drop_duplicates(nan_to_null(df), colocate=colocate)
        split = impute_mean(
            chronological_split(with_position(distinct, spec, strategy), config.split),
            exclude=spec.reserved,
            fit_on=F.col("split") == "train",
            by=spec.series_keys if config.per_series else (),
        )
    return stage(split, "split") if strategy == "single" else split


def prepare_samples(df: DataFrame, config: RunConfig) -> Samples:
    """L11 steps 1-5: clean, split, fit features on training rows, build windows.

    The windows are written once; every later pass, and every trial of a search,
    reads them.
    """
    spec = config.series
    strategy = choose_strategy(df, spec, config.strategy)
    split = prepare_split(df, config, strategy)
    features = FeatureModel.fit(split.where(F.col("split") == "train"), spec, by_series=config.per_series)
    transformed = features.transform(split)
    windows = stage(build_windows(transformed, spec, config.window, strategy), "windows", ("split",))
    rows = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    return Samples(windows, features, feature_names(transformed, config), config, rows)


def feature_names(transformed: DataFrame, config: RunConfig) -> tuple[str, ...]:
    """Names of the model inputs; in flat windows ``t0_…`` is the oldest row."""
    if config.window.feature_mode == "industrial":
        present = present_time_columns(transformed.columns, config.series)
        return tuple(industrial_names(config.series.sensors, present))
    columns = flat_columns(transformed, config.series)
    return tuple(f"t{t}_{c}" for t in range(config.window.size) for c in columns)


def train_samples(samples: Samples, params: dict[str, Any] | None = None) -> tuple[list[PipelineModel | BoostedModel], dict[str, Any]]:
    """Fit every forecast step, score all splits in one pass, return models and record."""
    config = samples.config
    kind = model_kind(config.model_kind)
    merged = {**config.model_params, **(params or {})}
    own = is_boosted(kind)
    windows = samples.windows if own else as_vectors(samples.windows, samples.assembled)
    train, val = windows.where(F.col("split") == "train"), windows.where(F.col("split") == "val")
    if train.isEmpty():
        raise ValueError("no training windows: every series is shorter than window + horizon")
    use_val = config.use_validation and not val.isEmpty()
    steps = range(1, config.window.horizon + 1)
    if own:
        binned = samples.binned(int(merged_params(kind, merged).get("max_bins", 64)))
        fitted = [fit_boosted(binned, step, kind, merged, config.seed, use_val) for step in steps]
    else:
        fitted = [
            fit_step(
                with_label(train, step),
                with_label(val, step) if use_val else None,
                samples.assembled,
                kind,
                merged,
                config.seed,
            )
            for step in steps
        ]
    models = [f.model for f in fitted]
    scored = score_windows(windows, models, samples.features, config)
    rows = regression_metrics(scored.where(F.col("actual").isNotNull()), "actual", "prediction", ["split"]).collect()
    importances = [dict(zip(samples.names, importances_of(m))) for m in models]
    record = {
        "status": "success",
        "model_kind": kind,
        "params": {k: str(v) for k, v in merged_params(kind, merged).items()},
        "sample_definition": {k: str(v) for k, v in vars(config.window).items()},
        "feature_count": len(samples.names),
        "rows": samples.rows,
        "samples": {r["split"]: r["n_samples"] for r in rows},
        "metrics": {r["split"]: {m: r[m] for m in METRICS} for r in rows},
        "eval_metric": merged.get("eval_metric", EVAL_METRIC) if use_val else None,
        "eval_history": [list(f.history) for f in fitted] if use_val else None,
        "best_rounds": [f.best_round for f in fitted] if use_val else None,
        "importances": importances[0],
        "step_importances": importances,
    }
    return models, record


def score_windows(
    windows: DataFrame, models: list[PipelineModel | BoostedModel], features: FeatureModel, config: RunConfig
) -> DataFrame:
    """Predictions and actuals in the original scale, one row per window and step.

    All steps are predicted side by side and turned into rows afterwards, so the
    windows are read once.
    """
    predicted = windows
    for step, model in enumerate(models, start=1):
        if isinstance(model, BoostedModel):
            predicted = model.transform(predicted, f"_p{step}")
            continue
        predicted = model.transform(predicted).withColumnRenamed(PREDICTION, f"_p{step}")
        if config.window.feature_mode == "industrial":
            predicted = predicted.drop(FEATURES)
    delta = config.window.target_mode == "delta"
    shift = F.col("baseline") if delta else F.lit(0.0)
    steps = F.array(
        *[
            F.struct(
                F.lit(step).alias("step"),
                (F.col(f"_p{step}") + shift).alias("prediction"),
                (F.col("y")[step - 1] + shift).alias("actual"),
                *([F.col("y_time")[step - 1].alias("target_time")] if "y_time" in windows.columns else []),
            )
            for step in range(1, len(models) + 1)
        ]
    )
    spec = config.series
    carried = [c for c in (*spec.series_keys, "split", "idx", spec.time_col) if c and c in windows.columns]
    rows = predicted.select(*carried, F.explode(steps).alias("_s")).select(*carried, "_s.*")
    if not features.scale_target:
        return rows
    return features.inverse_target(rows, {"prediction": "prediction", "actual": "actual"})


def run_training(
    spark: SparkSession,
    df: DataFrame,
    config: RunConfig,
    run_name: str,
    run_dir: str | None = None,
    runs_path: str | None = None,
) -> TrainedRun:
    """Prepare, train, score and, if asked, store everything."""
    samples = prepare_samples(df, config)
    models, record = train_samples(samples)
    record = {"run_name": run_name, **record}
    run = TrainedRun(config, samples.features, models, samples.names, record)
    if run_dir:
        save_run(spark, run, run_dir)
    if runs_path:
        append_runs(spark, runs_path, [record])
    return run


def save_run(spark: SparkSession, run: TrainedRun, run_dir: str) -> None:
    """S5/S7/S8."""
    artifacts.save_features(spark, run.features, f"{run_dir}/features")
    artifacts.save_models(run.models, f"{run_dir}/model", spark)
    artifacts.save_config(spark, run.config, f"{run_dir}/config")
    artifacts.save_settings(spark, {"names": list(run.names), "record": run.record}, f"{run_dir}/record")


def load_run(spark: SparkSession, run_dir: str) -> TrainedRun:
    """S7/S8."""
    config = artifacts.load_config(spark, f"{run_dir}/config")
    saved = artifacts.load_settings(spark, f"{run_dir}/record")
    return TrainedRun(
        config,
        artifacts.load_features(spark, f"{run_dir}/features"),
        artifacts.load_models(f"{run_dir}/model", config.window.horizon, spark if is_boosted(config.model_kind) else None),
        tuple(saved["names"]),
        saved["record"],
    )
