"""Training, scoring and search, with models that SQL can compute as well.

The one input of these models tells weekdays from weekends, so a tree of depth 1 predicts one value for each, a
tree of depth 0 one value for all.  The first round predicts the mean of the training targets; with squared loss
the later rounds add nothing, with absolute loss each adds the rate times the mean sign of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import check
from checks.inputs import (
    H, H_CLEAN_SQL, L_ORDER, L_SQL, Q,
    hourly, metrics_sql, rounded, split_ctes, sql_round, supplier_lines,
)
from tideline.functions.metrics import METRICS
from tideline.operators.models import feature_importance
from tideline.plans import tuning
from tideline.plans.reports import top_features
from tideline.plans.scoring import evaluate, predict
from tideline.plans.training import load_run, prepare_samples, run_training
from tideline.session import new_path
from tideline.sources.runs import history_table, metrics_table, read_runs, run_frame
from tideline.spec import RunConfig, SeriesSpec, WindowSpec

SMALL = {"n_estimators": 5, "learning_rate": 0.1, "max_depth": 3, "early_stopping_rounds": 3}


def _hourly_run(spark: SparkSession, sf_dir: str):
    config = RunConfig(H, model_kind="gbt_squared", model_params=SMALL)
    return run_training(spark, hourly(spark, sf_dir), config, "hourly")


def _grid_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = prepare_samples(hourly(spark, sf_dir), RunConfig(H, model_kind="gbt_squared", model_params=SMALL))
    trials = tuning.grid_table(spark, {"max_depth": [2, 3], "learning_rate": [0.05, 0.1]})
    return tuning.run_trials(spark, samples, trials)


WEEKEND = SeriesSpec(order_by=("ts",), target="ot", sensors=(), time_col="ts", time_columns=("is_weekend",))
LINES_WEEKEND = SeriesSpec(
    order_by=L_ORDER, target="l_quantity", sensors=(), series_keys=("l_suppkey",), time_col="l_shipdate",
    time_columns=("is_weekend",),
)
ROUNDS, RATE = 5, 0.1
WHOLE = {"subsample": 1.0, "colsample_bytree": 1.0, "colsample_bylevel": 1.0, "min_child_weight": 1}
EXACT = {**WHOLE, "n_estimators": ROUNDS, "learning_rate": RATE, "max_depth": 1, "early_stopping_rounds": 3}


def _exact_run(spark: SparkSession, sf_dir: str, run_dir: str | None = None, **changes):
    window = WindowSpec(size=2)
    given = {"series": WEEKEND, "window": window, "model_kind": "gbt_absolute", "model_params": EXACT}
    config = RunConfig(**{**given, **changes})
    return run_training(spark, hourly(spark, sf_dir), config, "hourly", run_dir)


def _samples_ctes(source: str, spec: SeriesSpec, size: int) -> str:
    """CTEs ``sc`` (mean and scale of the training targets) and ``m``: all samples, ``d`` is the scaled delta."""
    part, y = ", ".join([*spec.series_keys, "split"]), spec.target
    return f"""{split_ctes(source, spec)},
    sc as (select avg({y}) as mean, stddev_pop({y}) as scale from q where split = 'train'),
    m as (select split, y, o, w, 0 as one, (y - o) / scale as d, scale from (
      select split, pos, split_rows, {y} as o, (isodow({spec.time_col}) >= 6)::int as w,
        lead({y}) over (partition by {part} order by idx) as y from q), sc
      where pos >= {size - 1} and pos + 1 <= split_rows - 1)"""


def _rounds_ctes(by: str = "w", rate: float = RATE, rounds: int = ROUNDS, name: str = "p") -> str:
    """CTEs ``p1``, ``p2`` ...: what a sample is predicted after so many rounds with absolute loss; ``p``: all of them."""
    steps = [f"{name}1 as (select {by}, avg(d) as p from m where split = 'train' group by {by})"]
    for k in range(2, rounds + 1):
        steps.append(
            f"{name}{k} as (select {by}, any_value(p) + {rate} * avg(case when d < p then -1.0 else 1.0 end) as p "
            f"from m join {name}{k - 1} using ({by}) where split = 'train' group by {by})"
        )
    union = " union all ".join(f"select {k} as round, {by}, p from {name}{k}" for k in range(1, rounds + 1))
    return ", ".join([*steps, f"{name} as ({union})"])


_BEST_CTES = f"""with c as ({H_CLEAN_SQL}), {_samples_ctes('select ts, ot from c', WEEKEND, 2)}, {_rounds_ctes()},
    h as (select round, avg(abs(d - p)) as score from m join p using (w) where split = 'val' group by round),
    best as (select w, p from p where round = (select round from h order by score, round limit 1))"""


def _long(source: str, labels: str) -> str:
    """Six metrics of ``source`` (labels, y, p), one row each."""
    named = ", ".join(METRICS)
    return f"""select {labels}, metric, value from (unpivot (
      select {labels}, {metrics_sql()} from {source} group by all) on {named} into name metric value value)"""


@check(
    f"""{_BEST_CTES}, f as (select 'hourly' as run_name, split, y, o + p * scale as p from m join best using (w))
    {_long('f', 'run_name, split')}"""
)
def gbt_train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute loss, all splits, six metrics, after the best round."""
    run = _exact_run(spark, sf_dir)
    return metrics_table(run_frame(spark, [run.record])).select("run_name", "split", "metric", rounded("value"))


_LINES = f"with {_samples_ctes(L_SQL, LINES_WEEKEND, 24)}"


@check(
    f"""{_LINES}, b as (select w, avg(d) as p from m where split = 'train' group by w),
    f as (select 'suppliers' as run_name, split, y, o + p * scale as p from m join b using (w))
    {_long('f', 'run_name, split')}"""
)
def gbt_many_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model with squared loss over the line items of all suppliers."""
    config = RunConfig(LINES_WEEKEND, model_kind="gbt_squared", model_params={**EXACT, "n_estimators": 2})
    run = run_training(spark, supplier_lines(spark, sf_dir), config, "suppliers")
    return metrics_table(run_frame(spark, [run.record])).select("run_name", "split", "metric", rounded("value"))


@check(f"{_LINES} select split, count(*) as n_samples from m group by split")
def gbt_deep_many_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deeper trees over all sensors of all suppliers.

    The given lines are independent draws, so nothing can be foretold from them and SQL can only say what was
    scored; tests hold deep fits to "better than no change" on a series that has a pattern.
    """
    config = RunConfig(Q, model_kind="lightgbm", model_params=SMALL)
    run = run_training(spark, supplier_lines(spark, sf_dir), config, "suppliers")
    return run_frame(spark, [run.record]).select(F.explode("samples").alias("split", "n_samples"))


@check(
    f"""with c as ({H_CLEAN_SQL}), {split_ctes('select * from c', H)},
    two as (select split, pos, split_rows, unnest([1, 2]) as step,
      unnest([lead(ot, 1) over (partition by split order by idx), lead(ot, 2) over (partition by split order by idx)]) as y from q),
    m as (select split, step, y from two where pos >= 5 and pos + 2 <= split_rows - 1),
    b as (select step, avg(y) as p from m where split = 'train' group by step),
    f as (select 'hourly' as run_name, split, y, p from m join b using (step))
    {_long('f', 'run_name, split')}"""
)
def gbt_flat_two_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat samples with absolute targets, two forecast steps, one model each, trees of depth 0."""
    window = WindowSpec(size=6, horizon=2, target_mode="absolute", feature_mode="flat")
    params = {**EXACT, "max_depth": 0, "n_estimators": 2}
    run = _exact_run(spark, sf_dir, series=H, window=window, model_kind="gbt_squared", model_params=params)
    return metrics_table(run_frame(spark, [run.record])).select("run_name", "split", "metric", rounded("value"))


_WHOLE_CTES = f"""{_BEST_CTES}, n as (select ts, ot, row_number() over (order by ts) - 1 as idx,
      lead(ts) over (order by ts) as target_time, lead(ot) over (order by ts) as y, (isodow(ts) >= 6)::int as w from c),
    f as (select n.*, ot + best.p * scale as p from n join best using (w), sc where idx >= 1)"""


@check(
    f"""{_WHOLE_CTES} select idx, ts, 1 as step, target_time, {sql_round('p', 'prediction')}, {sql_round('y', 'actual')} from f"""
)
def gbt_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored, loaded, and applied to the whole table."""
    path = new_path(spark, "run")
    _exact_run(spark, sf_dir, path)
    out = predict(hourly(spark, sf_dir), load_run(spark, path), include_future=True)
    return out.select("idx", "ts", "step", "target_time", rounded("prediction"), rounded("actual"))


@check(
    f"""with c as ({H_CLEAN_SQL}), q as (select ts, ot, row_number() over (order by ts) - 1 as idx from c),
    n as (select idx, ts, lead(ts) over (order by idx) as target_time,
      {sql_round('lead(ot) over (order by idx)', 'actual')} from q)
    select idx, ts, 1 as step, target_time, actual from n where idx >= 23"""
)
def gbt_predict_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scoring path without the trees: windows of the whole table, deltas undone, original scale."""
    return predict(hourly(spark, sf_dir), _hourly_run(spark, sf_dir), include_future=True).select(
        "idx", "ts", "step", "target_time", rounded("actual")
    )


_H_COUNTS = f"""with c as ({H_CLEAN_SQL}), {split_ctes('select * from c', H)},
    counts as (select split, count(*) as n_rows, greatest(count(*) - 24, 0) as n_samples from q group by split)"""


@check(f"{_H_COUNTS} select 'hourly' as run_name, 'success' as status, 42 as feature_count, split, n_rows, n_samples from counts")
def gbt_run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run's record says about its data."""
    runs = run_frame(spark, [_hourly_run(spark, sf_dir).record])
    return runs.select("run_name", "status", "feature_count", "samples", F.explode("rows").alias("split", "n_rows")).select(
        "run_name", "status", "feature_count", "split", "n_rows", F.col("samples")[F.col("split")].alias("n_samples")
    )


@check(
    f"""{_H_COUNTS}, trials(run_idx, run_name) as (values
      (0, 'grid_000_lr005_d2'), (1, 'grid_001_lr01_d2'), (2, 'grid_002_lr005_d3'), (3, 'grid_003_lr01_d3'))
    select run_idx, run_name, 'success' as status, split, n_samples from trials cross join counts"""
)
def tune_grid_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, order, states and sample counts of the grid's trials."""
    return _grid_runs(spark, sf_dir).select(
        "run_idx", "run_name", "status", F.explode("samples").alias("split", "n_samples")
    )


@check(
    f"""{_WHOLE_CTES}, e as (select 'hourly-evaluation' as run_name, 'all' as split, y, p from f where y is not null)
    {_long('e', 'run_name, split')}"""
)
def gbt_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the whole table, appended to the table of runs and read from it."""
    runs = new_path(spark, "runs")
    evaluate(spark, hourly(spark, sf_dir), _exact_run(spark, sf_dir), "hourly-evaluation", runs)
    return metrics_table(read_runs(spark, runs)).select("run_name", "split", "metric", rounded("value"))


@check(
    f"""{_BEST_CTES}, seen as (select min(round) + 3 as last from h where score = (select min(score) from h))
    select 'hourly' as run_name, 1 as step, round, 'mae' as metric, {sql_round('score', 'score')}
    from h, seen where round <= last"""
)
def gbt_eval_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation error after every round looked at."""
    run = _exact_run(spark, sf_dir)
    return history_table(run_frame(spark, [run.record])).select("run_name", "step", "round", "metric", rounded("score"))


@check("select 'is_weekend' as feature, 1.0::double as importance from (select count(*) from events)")
def gbt_importance_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _exact_run(spark, sf_dir)
    return top_features(feature_importance(spark, run.models[0], run.names), 20).select("feature", rounded("importance"))


def _trial_sql(name: str, table: str, by: str) -> str:
    return f"""select '{name}' as run_name, 'success' as status, {metrics_sql()} from (
      select y, o + p * scale as p from m join {table}{ROUNDS} using ({by}) where split = 'val')"""


_GRID = [("grid_000_lr005_d0", "one", 0.05), ("grid_001_lr01_d0", "one", 0.1), ("grid_002_lr005_d1", "w", 0.05), ("grid_003_lr01_d1", "w", 0.1)]


@check(
    f"with c as ({H_CLEAN_SQL}), {_samples_ctes('select ts, ot from c', WEEKEND, 2)}, "
    + ", ".join(_rounds_ctes(by, rate, name=f"t{k}_") for k, (_, by, rate) in enumerate(_GRID))
    + " select run_name, status, "
    + ", ".join(f'"{m}"' for m in METRICS)
    + " from ("
    + " union all ".join(_trial_sql(name, f"t{k}_", by) for k, (name, by, _) in enumerate(_GRID))
    + ")"
)
def tune_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trial's validation metrics."""
    params = {**EXACT, "early_stopping_rounds": 0}
    samples = prepare_samples(hourly(spark, sf_dir), RunConfig(WEEKEND, WindowSpec(size=2), model_params=params))
    runs = tuning.run_trials(spark, samples, tuning.grid_table(spark, {"max_depth": [0, 1], "learning_rate": [0.05, 0.1]}))
    return runs.select("run_name", "status", *[F.round(F.col("metrics")["val"][m], 6).alias(m) for m in METRICS])


@check(
    f"""with c as ({H_CLEAN_SQL}), {_samples_ctes('select ts, ot from c', WEEKEND, 2)},
    b as (select w, avg(d) as p from m where split = 'train' group by w)
    select {sql_round('sqrt(avg((y - o - p * scale) * (y - o - p * scale)))', 'best_metric_value')}, 'val_RMSE' as optimization_metric,
      3::bigint as total_trials, 3::bigint as completed_trials, 0::bigint as failed_trials
    from m join b using (w) where split = 'val'"""
)
def tune_random_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random trials, recorded and compared; with squared loss and one two-valued input all draws give one model."""
    config = RunConfig(WEEKEND, WindowSpec(size=2), model_kind="gbt_squared", model_params=EXACT)
    samples = prepare_samples(hourly(spark, sf_dir), config)
    ranges = {
        "max_depth": {"type": "int", "low": 1, "high": 3},
        "learning_rate": {"type": "float", "low": 0.05, "high": 0.2, "log": True},
    }
    path = new_path(spark, "runs")
    tuning.run_trials(spark, samples, tuning.random_table(spark, ranges, 3), runs_path=path)
    return tuning.compare(read_runs(spark, path)).select(
        rounded("best_metric_value"), "optimization_metric", "total_trials", "completed_trials", "failed_trials"
    )
