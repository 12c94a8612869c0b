"""Tables behind run reports: rankings, comparisons, histories, importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.metrics import METRICS
from tideline.operators.order import with_position
from tideline.spec import SeriesSpec

# The metrics of a side-by-side chart of runs; the comparison table has all.
COMPARED = ("RMSE", "MAE", "R2", "SMAPE")


def rank_trials(metrics: DataFrame, metric: str = "RMSE", split: str = "test", run: str = "run_name") -> DataFrame:
    """Runs by ascending metric, runs without it last.

    ``metrics`` is long: (run, split, metric, value).  Ordered by a total sort,
    so the ranking of many runs is spread over all tasks.
    """
    wanted = (F.col("split") == split) & (F.col("metric") == metric)
    value = F.max(F.when(wanted & ~F.isnan("value"), F.col("value")))
    return metrics.groupBy(run).agg(value.alias(metric)).orderBy(F.asc_nulls_last(metric), run)


def test_or_val(metrics: DataFrame, run: str = "run_name") -> DataFrame:
    """The test metrics of every run under split ``test``; those of ``val`` stand in where there are none.

    The numbers of a run are few, so they meet in one group.
    """
    known = metrics.where(F.col("split").isin("test", "val") & F.col("value").isNotNull() & ~F.isnan("value"))
    value = F.coalesce(F.max(F.when(F.col("split") == "test", F.col("value"))), F.max("value"))
    return known.groupBy(run, "metric").agg(value.alias("value")).select(run, F.lit("test").alias("split"), "metric", "value")


def with_rank(ranked: DataFrame, metric: str, run: str = "run_name") -> DataFrame:
    """Number the runs of a ranking from 1; a missing metric counts as infinite."""
    order = SeriesSpec(order_by=("_metric", run), target=metric, sensors=())
    keyed = ranked.withColumn("_metric", F.coalesce(F.col(f"`{metric}`"), F.lit(float("inf"))))
    return with_position(keyed, order).withColumn("rank", F.col("idx") + 1).drop("_metric", "idx", "n_rows")


def comparison_matrix(
    metrics: DataFrame, split: str = "test", names: Sequence[str] = METRICS, run: str = "run_name"
) -> DataFrame:
    """One row per run, one column per metric."""
    return metrics.where(F.col("split") == split).groupBy(run).pivot("metric", list(names)).agg(F.first("value"))


def split_metric_table(metrics: DataFrame, names: Sequence[str] = METRICS) -> DataFrame:
    """One row per run and metric, one column per split."""
    wanted = metrics.where(F.col("metric").isin(*names))
    return wanted.groupBy("run_name", "metric").pivot("split", ["train", "val", "test"]).agg(F.first("value"))


def param_points(
    runs: DataFrame,
    metric: str = "RMSE",
    split: str = "test",
    params: Sequence[str] | None = None,
) -> DataFrame:
    """R2: (run_name, param, setting, value) for every parameter of every run, or for the given ones (NULL where a run has none)."""
    value = F.col("metrics")[split][metric].alias("value")
    if params is None:
        return runs.select("run_name", F.explode("params").alias("param", "setting"), value)
    pairs = F.array(
        *[F.struct(F.lit(p).alias("param"), F.col("params")[p].alias("setting")) for p in params]
    )
    return runs.select("run_name", F.explode(pairs).alias("p"), value).select("run_name", "p.param", "p.setting", "value")


def best_rounds(history: DataFrame) -> DataFrame:
    """Best round and its score per run and forecast step; the earliest wins a tie."""
    order = F.struct("score", "round")
    return history.groupBy("run_name", "step").agg(
        F.min_by("round", order).alias("best_round"), F.min("score").alias("best_score"), F.max("round").alias("rounds")
    )


def top_features(importances: DataFrame, k: int = 20) -> DataFrame:
    """O1/O2: the k most important features."""
    return importances.orderBy(F.desc("importance"), "feature").limit(k)
