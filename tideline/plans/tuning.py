"""Hyper-parameter search: trial tables, trial runs, comparison.

Trials differ only in model parameters, so the windows are built and written
once and every trial reads them.  Fits run side by side from driver threads;
Spark shares the executors among their jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from threading import Lock
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.models import without_effect
from tideline.plans.training import Samples, TrainedRun, save_run, train_samples
from tideline.sources.runs import append_runs, run_frame

# Short parameter names used in the names of grid trials.
SHORT_NAMES = {
    "max_depth": "d",
    "learning_rate": "lr",
    "n_estimators": "ne",
    "min_child_weight": "mcw",
    "subsample": "ss",
    "colsample_bytree": "cbt",
    "colsample_bylevel": "cbl",
    "reg_alpha": "ra",
    "reg_lambda": "rl",
}

# Grids and ranges searched by default.
GRIDS: dict[str, dict[str, list[float]]] = {
    "gbt_absolute": {
        "max_depth": [3, 5],
        "learning_rate": [0.01, 0.05],
        "n_estimators": [500, 1000],
        "min_child_weight": [3, 10],
        "reg_alpha": [0.1, 1.0],
        "reg_lambda": [1.0, 5.0],
    },
    "gbt_squared": {
        "max_depth": [3, 5],
        "num_leaves": [15, 31],
        "learning_rate": [0.01, 0.05],
        "n_estimators": [500, 1000],
        "subsample": [0.6, 0.8],
        "colsample_bytree": [0.6, 0.8],
        "reg_alpha": [0.1, 1.0],
        "reg_lambda": [1.0, 5.0],
    },
}
RANGES: dict[str, dict[str, dict[str, Any]]] = {
    "gbt_absolute": {
        "max_depth": {"type": "int", "low": 3, "high": 8},
        "learning_rate": {"type": "float", "low": 0.001, "high": 0.1, "log": True},
        "n_estimators": {"type": "int", "low": 200, "high": 2000},
        "min_child_weight": {"type": "int", "low": 1, "high": 10},
        "reg_alpha": {"type": "float", "low": 0.01, "high": 1.0, "log": True},
        "reg_lambda": {"type": "float", "low": 0.5, "high": 5.0},
    },
    "gbt_squared": {
        "max_depth": {"type": "int", "low": 3, "high": 8},
        "num_leaves": {"type": "int", "low": 15, "high": 63},
        "learning_rate": {"type": "float", "low": 0.001, "high": 0.1, "log": True},
        "n_estimators": {"type": "int", "low": 200, "high": 2000},
        "subsample": {"type": "float", "low": 0.5, "high": 1.0},
        "colsample_bytree": {"type": "float", "low": 0.5, "high": 1.0},
        "reg_alpha": {"type": "float", "low": 0.01, "high": 1.0, "log": True},
        "reg_lambda": {"type": "float", "low": 0.5, "high": 5.0},
    },
}

for _loss in ("absolute", "squared"):
    GRIDS[f"boosted_{_loss}"], RANGES[f"boosted_{_loss}"] = GRIDS[f"gbt_{_loss}"], RANGES[f"gbt_{_loss}"]


def grid_table(spark: SparkSession, space: dict[str, Sequence[Any]], max_trials: int | None = None) -> DataFrame:
    """G1: every combination of the listed values, the last key varying fastest.

    One exploded list per key; ``run_idx`` is the mixed-radix number made of the
    positions in the lists.
    """
    trials = spark.range(1).select(F.lit(0).cast("int").alias("run_idx"))
    for i, (name, values) in enumerate(space.items()):
        digits = F.posexplode(F.array(*[F.lit(v) for v in values])).alias(f"_p{i}", name)
        trials = trials.select("*", digits)
        trials = trials.withColumn("run_idx", F.col("run_idx") * len(values) + F.col(f"_p{i}")).drop(f"_p{i}")
    if max_trials:
        trials = trials.where(F.col("run_idx") < max_trials)
    whole = {n for n, values in space.items() if not any(isinstance(v, float) for v in values)}
    parts = [_short(n, n in whole) for n in sorted(space)]
    name = F.concat_ws("_", F.format_string("grid_%03d", "run_idx"), *parts)
    return trials.select("run_idx", name.alias("run_name"), *space)


def _short(name: str, whole: bool) -> Column:
    """A value as text after its short name, decimals without their point."""
    text = F.col(name).cast("string")
    if not whole:
        text = F.when(F.abs(name) >= 1e-3, text).otherwise(F.rtrim(F.format_number(name, 17), F.lit("0")))
        text = F.replace(text, F.lit("."), F.lit(""))
    return F.concat(F.lit(SHORT_NAMES.get(name, name[:4])), text)


def random_table(spark: SparkSession, ranges: dict[str, dict[str, Any]], n_trials: int, seed: int = 42) -> DataFrame:
    """Seeded draws from integer, decimal and logarithmic ranges.

    A draw is hashed from seed, parameter and number of the trial, so it depends on nothing else.
    """
    drawn = [_draw(spec, _unit(seed, name)).alias(name) for name, spec in ranges.items()]
    trials = spark.range(n_trials).select(F.col("id").cast("int").alias("run_idx"), *drawn)
    return trials.select("run_idx", F.format_string("random_%03d", "run_idx").alias("run_name"), *ranges)


def _unit(seed: int, name: str) -> Column:
    """A number in [0, 1) of 52 hashed bits."""
    text = F.concat(F.lit(f"{seed}|{name}|"), F.col("id").cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _draw(spec: dict[str, Any], unit: Column) -> Column:
    low, high = spec["low"], spec["high"]
    if spec["type"] == "int":
        return (F.lit(low) + F.floor(unit * (high - low + 1))).cast("int")
    if spec["type"] != "float":
        raise ValueError(f"unknown range type {spec['type']!r}")
    if spec.get("log"):
        return F.exp(F.log(F.lit(float(low))) + unit * (F.log(F.lit(float(high))) - F.log(F.lit(float(low)))))
    return F.lit(float(low)) + unit * float(high - low)


def run_trials(
    spark: SparkSession,
    samples: Samples,
    trials: DataFrame,
    parallelism: int = 4,
    runs_path: str | None = None,
    models_dir: str | None = None,
) -> DataFrame:
    """Train every trial on the same windows; a failing trial is recorded, not raised.

    A trial's record is appended to ``runs_path``, and its run stored as ``models_dir/run_name``, as soon as
    it ends.  Trials that differ only in parameters without effect are fitted once; each gets a record (and
    a stored run) under its own name and parameters.

    The trial table is small control data; training, scoring and metrics are
    Spark jobs.  Returns the run table of these trials.
    """
    rows = [r.asDict() for r in trials.orderBy("run_idx").collect()]
    ignored = without_effect(samples.config.model_kind)
    alike: dict[tuple, list[dict[str, Any]]] = {}
    for row in rows:
        given = {k: v for k, v in row.items() if k not in ("run_idx", "run_name")}
        effective = tuple(sorted((k, str(v)) for k, v in given.items() if k not in ignored))
        alike.setdefault(effective, []).append(row)
    appending = Lock()

    @inheritable_thread_target(spark)
    def run(same: list[dict[str, Any]]) -> list[dict[str, Any]]:
        fitted: tuple | None = None
        records = []
        for row in same:
            labels = {"run_idx": row["run_idx"], "run_name": row["run_name"]}
            params = {k: v for k, v in row.items() if k not in labels}
            settings = {k: str(v) for k, v in params.items()}
            try:
                fitted = fitted or train_samples(samples, params)
                models, record = fitted
                record = {**labels, **record, "params": {**record["params"], **settings}}
                if models_dir:
                    done = TrainedRun(samples.config, samples.features, models, samples.names, record)
                    save_run(spark, done, f"{models_dir}/{row['run_name']}")
            except Exception as failure:  # recorded with the trial
                record = {**labels, "status": "failed", "error": str(failure), "params": settings}
            if runs_path:
                with appending:
                    append_runs(spark, runs_path, [record])
            records.append(record)
        return records

    pool = ThreadPool(max(1, min(parallelism, len(alike))))
    try:
        records = [r for group in pool.map(run, list(alike.values()), chunksize=1) for r in group]
    finally:
        pool.close()
        pool.join()
    return run_frame(spark, sorted(records, key=lambda r: r["run_idx"]))


def eligible(runs: DataFrame, metric: str = "RMSE", split: str = "val") -> DataFrame:
    """Successful runs that have the metric, with it as ``metric_value``."""
    value = F.col("metrics")[split][metric]
    return runs.withColumn("metric_value", value).where(
        (F.col("status") == "success") & F.col("metric_value").isNotNull() & ~F.isnan("metric_value")
    )


def best_run(runs: DataFrame, metric: str = "RMSE", split: str = "val") -> DataFrame:
    """The run with the smallest metric; the earliest wins a tie."""
    return eligible(runs, metric, split).orderBy("metric_value", "run_idx", "run_name").limit(1)


def compare(runs: DataFrame, metric: str = "RMSE", split: str = "val") -> DataFrame:
    """One row: best run, its parameters and metrics, and counts by state."""
    usable = eligible(runs, metric, split)
    best = usable.agg(
        F.min_by(
            F.struct("run_name", "params", F.col("metrics")[split].alias("metrics"), "metric_value"),
            F.struct("metric_value", "run_idx", "run_name"),
        ).alias("b")
    ).scalar()
    counts = runs.agg(
        F.count(F.lit(1)).alias("total_trials"),
        F.count_if(F.col("status") == "success").alias("completed_trials"),
        F.count_if(F.col("status") == "failed").alias("failed_trials"),
    )
    return counts.withColumn("_best", best).select(
        F.col("_best.run_name").alias("best_run"),
        F.col("_best.params").alias("best_params"),
        F.col("_best.metrics").alias("best_metrics"),
        F.col("_best.metric_value").alias("best_metric_value"),
        F.lit(f"{split}_{metric}").alias("optimization_metric"),
        "total_trials",
        "completed_trials",
        "failed_trials",
    )
