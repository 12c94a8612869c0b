"""The table of runs: one row per training run or trial, appended."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_METRICS = T.MapType(T.StringType(), T.DoubleType())

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_name", T.StringType(), False),
        T.StructField("run_idx", T.IntegerType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("error", T.StringType()),
        T.StructField("model_kind", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("sample_definition", T.MapType(T.StringType(), T.StringType())),
        T.StructField("feature_count", T.IntegerType()),
        T.StructField("rows", T.MapType(T.StringType(), T.LongType())),
        T.StructField("samples", T.MapType(T.StringType(), T.LongType())),
        T.StructField("metrics", T.MapType(T.StringType(), _METRICS)),
        T.StructField("eval_metric", T.StringType()),
        T.StructField("eval_history", T.ArrayType(T.ArrayType(T.DoubleType()))),
        T.StructField("best_rounds", T.ArrayType(T.IntegerType())),
        T.StructField("importances", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("step_importances", T.ArrayType(T.MapType(T.StringType(), T.DoubleType()))),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

# How the names of search trials begin.
TRIAL_PREFIXES = "^(optuna_trial_|grid_|random_)"


def run_frame(spark: SparkSession, rows: list[dict[str, Any]]) -> DataFrame:
    """Rows of the run table; fields that are not given are NULL."""
    names = RUN_SCHEMA.fieldNames()
    frame = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RUN_SCHEMA)
    now = F.current_timestamp().cast("timestamp_ntz")
    return frame.withColumn("created_at", F.coalesce("created_at", now)).coalesce(1)


def append_runs(spark: SparkSession, path: str, rows: list[dict[str, Any]]) -> None:
    """Append run records."""
    run_frame(spark, rows).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All run records."""
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def trials_only(runs: DataFrame) -> DataFrame:
    """Records of search trials that have results."""
    return runs.where(F.col("run_name").rlike(TRIAL_PREFIXES) & F.col("metrics").isNotNull())


def metrics_table(runs: DataFrame) -> DataFrame:
    """(run_idx, run_name, split, metric, value), one row per number."""
    by_split = runs.select("run_idx", "run_name", F.explode("metrics").alias("split", "_m"))
    return by_split.select("run_idx", "run_name", "split", F.explode("_m").alias("metric", "value"))


def history_table(runs: DataFrame) -> DataFrame:
    """(run_name, step, round, metric, score), rounds counted from 1."""
    steps = runs.select("run_name", "eval_metric", F.posexplode("eval_history").alias("_step", "_scores"))
    return steps.select(
        "run_name",
        (F.col("_step") + 1).alias("step"),
        F.col("eval_metric").alias("metric"),
        F.posexplode("_scores").alias("_round", "score"),
    ).select("run_name", "step", (F.col("_round") + 1).alias("round"), "metric", "score")


def importance_table(runs: DataFrame) -> DataFrame:
    """(run_name, feature, importance) of the first forecast step."""
    return runs.select("run_name", F.explode("importances").alias("feature", "importance"))


def step_importance_table(runs: DataFrame) -> DataFrame:
    """(run_name, step, feature, importance) of the models of all forecast steps."""
    steps = runs.select("run_name", F.posexplode("step_importances").alias("_step", "_m"))
    return steps.select("run_name", (F.col("_step") + 1).alias("step"), F.explode("_m").alias("feature", "importance"))
