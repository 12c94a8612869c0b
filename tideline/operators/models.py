"""Boosted-tree forecasters: on ``pyspark.ml`` (``gbt_*``) and grown round by round (``boosted_*``, see ``boosting``)."""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.boosting import Binned, BoostedModel, Booster

# Default parameters of the regressors.
DEFAULTS: dict[str, dict[str, Any]] = {
    "gbt_absolute": {
        "learning_rate": 0.01,
        "n_estimators": 1000,
        "early_stopping_rounds": 50,
        "max_depth": 5,
        "min_child_weight": 5,
        "subsample": 0.7,
        "colsample_bytree": 0.8,
        "colsample_bylevel": 0.8,
    },
    "gbt_squared": {
        "learning_rate": 0.01,
        "n_estimators": 1000,
        "early_stopping_rounds": 50,
        "max_depth": 5,
        "num_leaves": 31,
        "subsample": 0.7,
        "colsample_bytree": 0.8,
    },
}

# Default leaf penalties of the regressors that know them.
PENALTIES = {"reg_alpha": 0.5, "reg_lambda": 2.0}
DEFAULTS["boosted_absolute"] = {**DEFAULTS["gbt_absolute"], **PENALTIES}
DEFAULTS["boosted_squared"] = {**DEFAULTS["gbt_squared"], **PENALTIES}

# Other names under which users know the regressors.
ALIASES = {"xgboost": "boosted_absolute", "lightgbm": "boosted_squared"}

# Names of the error by which rounds are compared, and the loss of ``pyspark.ml`` that measures it.
EVAL_METRICS = {"mae": "absolute", "l1": "absolute", "mse": "squared", "l2": "squared", "rmse": "squared"}
EVAL_METRIC = "mae"

#: Rounds of the first fit under early stopping; each further fit has twice as many.
FIRST_ROUNDS = 64

_LOSS = {"gbt_absolute": "absolute", "gbt_squared": "squared", "boosted_absolute": "absolute", "boosted_squared": "squared"}
WITHOUT_COUNTERPART = ("reg_alpha", "reg_lambda", "objective", "n_jobs", "verbosity", "verbose")
_NO_EFFECT = ("objective", "n_jobs", "verbosity", "verbose", "max_memory_mb", "tree_method", "metric")
_KNOWN = {
    *(name for params in DEFAULTS.values() for name in params), *WITHOUT_COUNTERPART,
    "eval_metric", "max_bins", "max_memory_mb", "random_state", "tree_method", "metric",
}

LABEL, FEATURES, PREDICTION = "_label", "_features", "_predicted"


def model_kind(kind: str) -> str:
    """The canonical name of a regressor; an unknown one is an error."""
    kind = ALIASES.get(kind, kind)
    if kind not in DEFAULTS:
        raise ValueError(f"unsupported model type {kind!r}; known: {sorted(DEFAULTS)}")
    return kind


def is_boosted(kind: str) -> bool:
    """Whether a kind is grown round by round."""
    return model_kind(kind).startswith("boosted_")


def without_effect(kind: str) -> tuple[str, ...]:
    """Known parameters that change nothing in a fit of this kind."""
    return _NO_EFFECT if is_boosted(kind) else WITHOUT_COUNTERPART


def merged_params(kind: str, params: dict[str, Any] | None = None) -> dict[str, Any]:
    """L3: defaults overridden by the given parameters."""
    unknown = sorted(set(params or {}) - _KNOWN)
    if unknown:
        raise ValueError(f"unknown model parameters: {', '.join(unknown)}")
    merged = {**DEFAULTS[model_kind(kind)], **(params or {})}
    if merged.get("eval_metric", EVAL_METRIC) not in EVAL_METRICS:
        raise ValueError(f"unknown eval_metric {merged['eval_metric']!r}; known: {sorted(EVAL_METRICS)}")
    return merged


def make_estimator(kind: str, params: dict[str, Any] | None = None, seed: int = 42) -> GBTRegressor:
    """L1/L2: a gradient-boosted regressor of ``pyspark.ml`` with absolute or squared loss.

    The absolute loss moves by residual signs, so train it on scaled targets.
    """
    kind = model_kind(kind)
    p = merged_params(kind, params)
    lost = [n for n in WITHOUT_COUNTERPART if p.get(n)]
    if lost:
        warnings.warn(f"no counterpart in Spark ML, ignored: {', '.join(lost)}", stacklevel=2)
    depth = int(p["max_depth"])
    if p.get("num_leaves"):
        depth = min(depth, math.ceil(math.log2(p["num_leaves"])))
    columns = min(1.0, float(p.get("colsample_bytree", 1.0)) * float(p.get("colsample_bylevel", 1.0)))
    return GBTRegressor(
        featuresCol=FEATURES,
        labelCol=LABEL,
        predictionCol=PREDICTION,
        lossType=_LOSS[kind],
        maxIter=int(p["n_estimators"]),
        stepSize=float(p["learning_rate"]),
        maxDepth=depth,
        minInstancesPerNode=int(p.get("min_child_weight", 1)),
        subsamplingRate=float(p.get("subsample", 1.0)),
        featureSubsetStrategy="all" if columns >= 1.0 else str(columns),
        maxBins=int(p.get("max_bins", 64)),
        maxMemoryInMB=int(p.get("max_memory_mb", 1024)),
        checkpointInterval=10,
        seed=int(p.get("random_state", seed)),
    )


def with_label(windows: DataFrame, step: int) -> DataFrame:
    """The target of one forecast step as the training label; rows without one cannot train."""
    return windows.withColumn(LABEL, F.col("y")[step - 1]).where(F.col(LABEL).isNotNull())


def as_vectors(windows: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """Flat samples (``x``) become vectors by a built-in function; named columns by an assembler stage.

    A missing reading is NaN for the trees in both modes.
    """
    if names:
        return windows
    readings = F.transform("x", lambda v: F.coalesce(v, F.lit(float("nan"))))
    return windows.withColumn(FEATURES, array_to_vector(readings))


def best_round(history: Sequence[float], patience: int | None) -> tuple[int, int]:
    """L4: 1-based best round and the rounds looked at, stopping after ``patience`` rounds without gain."""
    best, best_score = 0, math.inf
    for i, score in enumerate(history, start=1):
        if score < best_score:
            best, best_score = i, score
        elif patience and i - best >= patience:
            return max(best, 1), i
    return max(best, 1), len(history)


@dataclass(frozen=True)
class Fitted:
    """One fitted model with its validation history."""

    model: PipelineModel | BoostedModel
    history: tuple[float, ...]
    best_round: int | None

    @property
    def trees(self) -> GBTRegressionModel:
        return self.model.stages[-1]


def fit_step(
    train: DataFrame,
    val: DataFrame | None,
    names: Sequence[str] | None,
    kind: str,
    params: dict[str, Any] | None = None,
    seed: int = 42,
) -> Fitted:
    """Fit one forecast step, with early stopping when there are validation rows.

    ``train`` and ``val`` carry the label.  Boosting is sequential, so a fit with fewer rounds and the same
    seed is a prefix of the longer one.  Under early stopping the number of rounds starts at
    ``FIRST_ROUNDS`` and doubles until the stop lies inside, so a long limit costs nothing beyond it; the
    best prefix is refitted.  Rounds are compared by ``eval_metric`` on the validation rows.
    """
    merged = merged_params(kind, params)
    assembler = [VectorAssembler(inputCols=list(names), outputCol=FEATURES, handleInvalid="keep")] if names else []
    estimator = make_estimator(kind, params, seed)

    def fitted(rounds: int) -> PipelineModel:
        return Pipeline(stages=[*assembler, estimator.copy({estimator.maxIter: rounds})]).fit(train)

    limit = estimator.getMaxIter()
    if val is None:
        return Fitted(fitted(limit), (), None)
    patience = merged.get("early_stopping_rounds")
    rounds = min(FIRST_ROUNDS, limit) if patience else limit
    while True:
        model = fitted(rounds)
        scores = _scores(model, val, names, merged.get("eval_metric", EVAL_METRIC))
        best, seen = best_round(scores, patience)
        if rounds == limit or seen - best >= patience:
            break
        rounds = min(2 * rounds, limit)
    if patience and best < rounds:
        model = fitted(best)
    return Fitted(model, tuple(scores[:seen]), best)


def fit_boosted(
    binned: Binned,
    step: int,
    kind: str,
    params: dict[str, Any] | None = None,
    seed: int = 42,
    use_val: bool = True,
    start: BoostedModel | None = None,
) -> Fitted:
    """Fit one forecast step round by round on binned windows; see ``boosting``.

    With validation rows and ``early_stopping_rounds`` exactly the best round and the patience are fitted, each
    round once. ``start`` continues a fitted model on the same bins with up to ``n_estimators`` further rounds.
    """
    p = merged_params(kind, params)
    metric = p.get("eval_metric", EVAL_METRIC)
    own = {**p, "num_leaves": p.get("num_leaves") if model_kind(kind) == "boosted_squared" else None}
    booster = Booster(binned, step, _LOSS[model_kind(kind)], own, int(p.get("random_state", seed)), use_val, start)
    model, history, best = booster.fit(EVAL_METRICS[metric], metric == "rmse")
    return Fitted(model, tuple(history), best)


def importances_of(model: PipelineModel | BoostedModel) -> list[float]:
    """The share of every input in what the splits gain."""
    if isinstance(model, BoostedModel):
        return model.importances()
    return model.stages[-1].featureImportances.toArray().tolist()


def _scores(model: PipelineModel, val: DataFrame, names: Sequence[str] | None, metric: str) -> list[float]:
    """The error on the validation rows after every round."""
    assembled = model.stages[0].transform(val) if names else val
    scores = model.stages[-1].evaluateEachIteration(assembled, EVAL_METRICS[metric])
    return [math.sqrt(s) for s in scores] if metric == "rmse" else list(scores)


def feature_importance(spark: SparkSession, model: PipelineModel | BoostedModel | None, names: Sequence[str]) -> DataFrame:
    """(feature, importance), largest first."""
    if model is None:
        raise RuntimeError("the model is not fitted")
    frame = spark.createDataFrame(list(zip(names, importances_of(model))), "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature")
