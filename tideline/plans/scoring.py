"""Evaluation and batch prediction with a stored or fresh run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.metrics import METRICS, regression_metrics
from tideline.operators.models import as_vectors
from tideline.operators.order import choose_strategy, with_position
from tideline.operators.windows import build_windows
from tideline.plans.training import TrainedRun, clean_series, score_windows
from tideline.sources.runs import append_runs


def predict(df: DataFrame, run: TrainedRun, include_future: bool = False) -> DataFrame:
    """One row per window and step with prediction and actual, original scale.

    The rows are cleaned with their own means and taken as a whole, without a
    split; features are scaled with the parameters of the run.  ``idx`` and the
    timestamp are those of the last input row, ``target_time`` is the time the
    prediction is for.  ``include_future`` also scores
    the windows whose targets are not known yet.
    """
    if not run.models:
        raise RuntimeError("the run has no fitted model")
    config = run.config
    strategy = choose_strategy(df, config.series, config.strategy)
    cleaned = clean_series(df, config.series, strategy, config.per_series)
    positioned = with_position(cleaned, config.series, strategy)
    windows = build_windows(
        run.features.transform(positioned), config.series, config.window, strategy, include_future=include_future
    )
    named = run.names if config.window.feature_mode == "industrial" else None
    return score_windows(as_vectors(windows, named), run.models, run.features, config)


def evaluate(
    spark: SparkSession, df: DataFrame, run: TrainedRun, run_name: str | None = None, runs_path: str | None = None
) -> DataFrame:
    """The six metrics over all windows of the given table that have an actual value; optionally appended to the run table."""
    metrics = regression_metrics(predict(df, run).where(F.col("actual").isNotNull()), "actual", "prediction")
    if runs_path:
        row = metrics.first()
        append_runs(
            spark,
            runs_path,
            [
                {
                    "run_name": run_name or "evaluation",
                    "status": "evaluation",
                    "model_kind": run.config.model_kind,
                    "sample_definition": {k: str(v) for k, v in vars(run.config.window).items()},
                    "feature_count": len(run.names),
                    "samples": {"all": row["n_samples"]},
                    "metrics": {"all": {m: row[m] for m in METRICS}},
                }
            ],
        )
    return metrics


def persistence(windows: DataFrame, target_mode: str = "delta", step: int = 1) -> DataFrame:
    """The forecast "no change": the last known target, next to the actual one."""
    shift = F.col("baseline") if target_mode == "delta" else F.lit(0.0)
    return windows.withColumns({"prediction": F.col("baseline"), "actual": F.col("y")[step - 1] + shift})
