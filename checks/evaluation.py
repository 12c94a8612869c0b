"""Metrics, formatted metrics, summaries, run tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import check
from checks.inputs import (
    H, H_CLEAN_SQL, L_SQL, Q,
    hourly, metrics_sql, persistence_ctes, rounded, sql_round, supplier_lines,
)
from tideline.functions.metrics import METRICS, format_metrics, metrics_long, prediction_summary, regression_metrics
from tideline.operators.features import FeatureModel
from tideline.operators.order import choose_strategy, chronological_split, with_position
from tideline.operators.windows import build_windows
from tideline.plans import reports, tuning
from tideline.plans.scoring import persistence
from tideline.plans.training import prepare_split
from tideline.session import new_path
from tideline.sources.runs import RUN_SCHEMA, metrics_table, read_runs, trials_only
from tideline.sources.tables import read_csv, write_csv
from tideline.spec import RunConfig, WindowSpec

_H_PERSISTENCE = f"with c as ({H_CLEAN_SQL}), {persistence_ctes('select * from c', H)}"
_Q_PERSISTENCE = f"with {persistence_ctes(L_SQL, Q)}"


def hourly_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, split, fit on training rows, scale, window, forecast "no change", restore."""
    raw = hourly(spark, sf_dir)
    strategy = choose_strategy(raw, H)
    split = prepare_split(raw, RunConfig(H), strategy)
    model = FeatureModel.fit(split.where(F.col("split") == "train"), H)
    windows = build_windows(model.transform(split), H, WindowSpec(), strategy)
    columns = {"prediction": "prediction", "actual": "actual"}
    return model.inverse_target(persistence(windows).select("split", "prediction", "actual"), columns)


def supplier_windows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Split rows of all suppliers and their windows."""
    lines = supplier_lines(spark, sf_dir)
    strategy = choose_strategy(lines, Q)
    split = chronological_split(with_position(lines, Q, strategy))
    return split, build_windows(split, Q, WindowSpec(), strategy)


def supplier_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast "no change" of the quantity of every supplier's lines."""
    forecast = persistence(supplier_windows(spark, sf_dir)[1])
    return forecast.select("l_suppkey", "split", "idx", "prediction", "actual")


def _rounded(df: DataFrame, *labels: str) -> DataFrame:
    return df.select(*labels, "n_samples", *[rounded(m) for m in METRICS])


@check(f"{_H_PERSISTENCE} select split, {metrics_sql()} from m group by split")
def minimum_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(regression_metrics(hourly_forecast(spark, sf_dir), "actual", "prediction", ["split"]), "split")


@check(f"{_Q_PERSISTENCE} select {metrics_sql()} from m")
def metrics_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(regression_metrics(supplier_forecast(spark, sf_dir), "actual", "prediction"))


@check(f"{_Q_PERSISTENCE} select l_suppkey, split, {metrics_sql()} from m group by all")
def metrics_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["l_suppkey", "split"]
    return _rounded(regression_metrics(supplier_forecast(spark, sf_dir), "actual", "prediction", by), *by)


@check(
    f"{_Q_PERSISTENCE}, r as (select split, {metrics_sql()} from m group by split) "
    "select split, " + ", ".join(f"printf('%.4f', \"{m}\") as \"{m}\"" for m in METRICS) + " from r"
)
def metrics_formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_metrics(regression_metrics(supplier_forecast(spark, sf_dir), "actual", "prediction", ["split"]), ["split"])


@check(
    f"{_Q_PERSISTENCE} select split, {sql_round('avg(p)', 'mean')}, {sql_round('stddev_pop(p)', 'std')}, "
    'min(p) as "min", max(p) as "max" from m group by split'
)
def prediction_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = prediction_summary(supplier_forecast(spark, sf_dir), "prediction", ["split"])
    return out.select("split", rounded("mean"), rounded("std"), "min", "max")


# ---- every supplier's forecast as one run ----


def supplier_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run table with one row per supplier, written and read back.

    A run counts as failed when its validation R² is below -1.
    """
    by_split = regression_metrics(supplier_forecast(spark, sf_dir), "actual", "prediction", ["l_suppkey", "split"])
    values = F.map_from_arrays(F.array(*[F.lit(m) for m in METRICS]), F.array(*METRICS))
    # At most three entries per supplier: one per split.
    runs = by_split.groupBy("l_suppkey").agg(
        F.map_from_entries(F.collect_list(F.struct("split", values.alias("v")))).alias("metrics"),
        F.sum("n_samples").alias("n"),
        F.max(F.when(F.col("split") == "val", F.col("R2"))).alias("val_r2"),
    )
    given = {
        "run_name": F.format_string("grid_%05d", "l_suppkey"),
        "run_idx": F.col("l_suppkey").cast("int"),
        "status": F.when(F.col("val_r2") < -1, "failed").otherwise("success"),
        "params": F.create_map(F.lit("samples"), F.col("n").cast("string")),
        "metrics": F.col("metrics"),
    }
    table = runs.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RUN_SCHEMA]
    )
    path = new_path(spark, "runs")
    table.write.mode("append").parquet(path)
    return trials_only(read_runs(spark, path))


_RUNS = (
    f"{_Q_PERSISTENCE}, runs as (select printf('grid_%05d', l_suppkey) as run_name, l_suppkey, split, "
    f"{metrics_sql()} from m group by l_suppkey, split), "
    "good as (select run_name from runs where split = 'val' and \"R2\" >= -1)"
)


@check(
    f"{_RUNS} select run_name, split, metric, value from "
    f"(unpivot (select run_name, split, {', '.join(METRICS)} from runs) "
    f"on {', '.join(METRICS)} into name metric value value)"
)
def run_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics_table(supplier_runs(spark, sf_dir)).select("run_name", "split", "metric", rounded("value"))


@check(
    f"{_Q_PERSISTENCE}, r as (select split, {metrics_sql()} from m group by split) "
    f"select split, metric, value from (unpivot (select split, {', '.join(METRICS)} from r) "
    f"on {', '.join(METRICS)} into name metric value value)"
)
def metrics_by_split_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = regression_metrics(supplier_forecast(spark, sf_dir), "actual", "prediction", ["split"])
    return metrics_long(metrics, ["split"]).select("split", "metric", rounded("value"))


@check(
    f"""{_RUNS} select run_name, "RMSE", row_number() over (order by "RMSE", run_name) as rank
    from runs where split = 'test'"""
)
def rank_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = reports.rank_trials(metrics_table(supplier_runs(spark, sf_dir)), "RMSE")
    return reports.with_rank(ranked, "RMSE").select("run_name", rounded("RMSE"), "rank")


@check(
    f"""{_RUNS} select run_name, "RMSE" as metric_value from runs
    where split = 'val' and run_name in (from good) order by "RMSE", run_name limit 1"""
)
def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tuning.best_run(supplier_runs(spark, sf_dir)).select("run_name", rounded("metric_value"))


@check(
    f"""{_RUNS}, ok as (select * from runs where split = 'val' and run_name in (from good))
    select min_by(run_name, "RMSE") as best_run, min("RMSE") as best_metric_value, 'val_RMSE' as optimization_metric,
      (select count(distinct run_name) from runs) as total_trials,
      (select count(*) from good) as completed_trials,
      (select count(distinct run_name) from runs where run_name not in (from good)) as failed_trials from ok"""
)
def compare_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tuning.compare(supplier_runs(spark, sf_dir))
    return out.select(
        "best_run", rounded("best_metric_value"), "optimization_metric", "total_trials", "completed_trials", "failed_trials"
    )


@check(f"""{_RUNS} select run_name, {', '.join(METRICS)} from runs where split = 'test'""")
def comparison_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six metrics of all runs, written as CSV and read back."""
    matrix = reports.comparison_matrix(metrics_table(supplier_runs(spark, sf_dir)))
    path = new_path(spark, "comparison")
    write_csv(matrix, path)
    return read_csv(spark, path, matrix.schema).select("run_name", *[rounded(m) for m in METRICS])


@check(
    f"""{_RUNS}, t as (select run_name, coalesce(max("RMSE") filter (where split = 'test'),
      max("RMSE") filter (where split = 'val')) as "RMSE" from runs where split <> 'test' or run_name in (from good) group by run_name)
    select run_name, "RMSE" from t where "RMSE" is not null"""
)
def rank_runs_test_or_val(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation metrics stand in for runs that failed before they were tested."""
    runs = supplier_runs(spark, sf_dir)
    good = runs.where("status = 'success'").select("run_name")
    long = metrics_table(runs)
    partly = long.where("split <> 'test'").unionByName(long.where("split = 'test'").join(good, "run_name", "left_semi"))
    return reports.rank_trials(reports.test_or_val(partly), "RMSE").select("run_name", rounded("RMSE"))


@check(
    f"""{_RUNS}, long as (select run_name, split, metric, value from
      (unpivot (select run_name, split, {', '.join(METRICS)} from runs)
       on {', '.join(METRICS)} into name metric value value))
    select run_name, metric, max(value) filter (where split = 'train') as train,
      max(value) filter (where split = 'val') as val, max(value) filter (where split = 'test') as test
    from long group by run_name, metric"""
)
def split_metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.split_metric_table(metrics_table(supplier_runs(spark, sf_dir)))
    return out.select("run_name", "metric", rounded("train"), rounded("val"), rounded("test"))


@check(
    f"""{_RUNS} select run_name, 'samples' as param, (sum(n_samples))::bigint::varchar as setting,
      max("RMSE") filter (where split = 'test') as value from runs group by run_name"""
)
def param_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.param_points(supplier_runs(spark, sf_dir))
    return out.select("run_name", "param", "setting", rounded("value"))


@check(
    f"""{_Q_PERSISTENCE}, e as (
      select printf('grid_%05d', l_suppkey) as run_name, (row_number() over (partition by l_suppkey order by idx))::int as round,
        abs(y - p) as score from m where split = 'val')
    select run_name, min_by(round, score * 1000000 + round) as best_round, min(score) as best_score, max(round) as rounds
    from e group by run_name"""
)
def best_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation errors in time order stand in for the scores of boosting rounds."""
    split, windows = supplier_windows(spark, sf_dir)
    errors = persistence(windows).where(F.col("split") == "val")
    val_start = F.floor(F.col("n_rows") * F.lit(0.7))
    starts = split.groupBy("l_suppkey").agg(F.max("n_rows").alias("n_rows")).select("l_suppkey", val_start.alias("v"))
    history = errors.join(starts, "l_suppkey").select(
        F.format_string("grid_%05d", "l_suppkey").alias("run_name"),
        F.lit(1).alias("step"),
        (F.col("idx") - F.col("v") - 22).cast("int").alias("round"),
        F.abs(F.col("actual") - F.col("prediction")).alias("score"),
    )
    return reports.best_rounds(history).select("run_name", "best_round", "best_score", "rounds")
