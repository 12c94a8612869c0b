"""Trees grown round by round, with leaf penalties, medians and several inputs, beside what SQL computes for them.

Most models have the one input ``is_weekend``, so a tree is one value for weekdays and one for weekends, or, where a
split gains nothing, one for all; SQL follows them round by round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import check
from checks.inputs import H, H_CLEAN_SQL, L_ORDER, L_SQL, Q, hourly, metrics_sql, rounded, split_ctes, sql_round, supplier_lines
from checks.modelling import WEEKEND, WHOLE, _long, _samples_ctes
from tideline.functions.metrics import METRICS
from tideline.operators.models import feature_importance
from tideline.plans import tuning
from tideline.plans.reports import top_features
from tideline.plans.scoring import predict
from tideline.plans.training import load_run, prepare_samples, run_training
from tideline.session import new_path
from tideline.sources.runs import history_table, metrics_table, run_frame
from tideline.spec import RunConfig, SeriesSpec, WindowSpec

STUMPS = {**WHOLE, "max_depth": 1, "early_stopping_rounds": 0, "reg_alpha": 0.5, "reg_lambda": 2.0}
_M = f"c as ({H_CLEAN_SQL}), {_samples_ctes('select ts, ot from c', WEEKEND, 2)}"


def _run(spark: SparkSession, sf_dir: str, kind: str, params: dict, run_dir: str | None = None):
    config = RunConfig(WEEKEND, WindowSpec(size=2), model_kind=kind, model_params=params)
    return run_training(spark, hourly(spark, sf_dir), config, "hourly", run_dir)


def _soft(g: str, alpha: float) -> str:
    return f"(sign({g}) * greatest(abs({g}) - {alpha}, 0))"


def _squared_ctes(rate: float, alpha: float, lam: float, rounds: int) -> str:
    """CTE ``r`` (round, p0, p1): predictions of weekdays and weekends after every round of penalized squared loss."""
    worth = lambda g, n: f"({_soft(g, alpha)} ** 2 / ({n} + {lam}))"
    step = lambda g, n: f"{rate} * {_soft(g, alpha)} / ({n} + {lam})"
    return f"""t as (select sum(d) filter (w = 0) as s0, sum(d) filter (w = 1) as s1, count(*) filter (w = 0)::double as n0,
      count(*) filter (w = 1)::double as n1 from m where split = 'train'),
    r(round, p0, p1) as (
      select 0, (s0 + s1) / (n0 + n1), (s0 + s1) / (n0 + n1) from t
      union all
      select round + 1, p0 + case when gain then {step('g0', 'n0')} else {step('(g0 + g1)', '(n0 + n1)')} end,
        p1 + case when gain then {step('g1', 'n1')} else {step('(g0 + g1)', '(n0 + n1)')} end
      from (select *, {worth('g0', 'n0')} + {worth('g1', 'n1')} - {worth('(g0 + g1)', '(n0 + n1)')}
          > 1e-12 * greatest({worth('(g0 + g1)', '(n0 + n1)')}, 1e-12) as gain
        from (select *, s0 - n0 * p0 as g0, s1 - n1 * p1 as g1 from r, t)) where round < {rounds})"""


_SHOWN, _RATE = 20, 0.3
#: Rounds of the deep fits here; the default of 1,000 takes a thousand times five passes wherever the error keeps falling.
_DEEP_ROUNDS = 30


@check(
    f"""with recursive {_M}, {_squared_ctes(_RATE, 0.5, 2.0, _SHOWN)}
    select 'hourly' as run_name, 1 as step, round, 'mae' as metric, {sql_round('avg(abs(d - case when w = 0 then p0 else p1 end))', 'score')}
    from m, r where split = 'val' and round > 0 group by round"""
)
def boost_eval_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation error after the first rounds of a fit that may have 1,000 and stops after 50 without gain.

    Later rounds add less than a double can tell, so which of them is best is not for SQL to say; tests hold it.
    """
    params = {**STUMPS, "n_estimators": 1000, "early_stopping_rounds": 50, "learning_rate": _RATE}
    history = history_table(run_frame(spark, [_run(spark, sf_dir, "lightgbm", params).record]))
    return history.where(F.col("round") <= _SHOWN).select("run_name", "step", "round", "metric", rounded("score"))


@check(
    f"""with recursive {_M}, {_squared_ctes(0.3, 0.5, 2.0, 5)},
    n as (select ts, ot, row_number() over (order by ts) - 1 as idx, lead(ts) over (order by ts) as target_time,
      lead(ot) over (order by ts) as y, (isodow(ts) >= 6)::int as w from c)
    select idx, ts, 1 as step, target_time, {sql_round('ot + case when w = 0 then p0 else p1 end * scale', 'prediction')}, {sql_round('y', 'actual')}
    from n, r, sc where round = 5 and idx >= 1"""
)
def boost_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both leaf penalties; fitted, stored, loaded, applied to the whole table."""
    path = new_path(spark, "run")
    _run(spark, sf_dir, "lightgbm", {**STUMPS, "n_estimators": 5, "learning_rate": 0.3}, path)
    out = predict(hourly(spark, sf_dir), load_run(spark, path), include_future=True)
    return out.select("idx", "ts", "step", "target_time", rounded("prediction"), rounded("actual"))


def _median_ctes(rate: float, alpha: float, lam: float, rounds: int) -> str:
    """CTE ``b`` (w, p): predictions after so many rounds of absolute loss, whose leaves are medians of what is left."""
    worth = lambda g, n: f"({_soft(g, alpha)} ** 2 / ({n} + {lam}))"
    out = ["p0 as (select w, (select median(d) from m where split = 'train') as p from (values (0), (1)) as v(w))"]
    for k in range(rounds):
        out.append(f"""x{k} as (select w, d, p, d - p as e from m join p{k} using (w) where split = 'train'),
    g{k} as (select sum(sign(e)) filter (w = 0) as g0, sum(sign(e)) filter (w = 1) as g1, count(*) filter (w = 0) as n0, count(*) filter (w = 1) as n1 from x{k}),
    p{k + 1} as (select w, any_value(p) + {rate} * case when (select {worth('g0', 'n0')} + {worth('g1', 'n1')} - {worth('(g0 + g1)', '(n0 + n1)')} > 1e-12 from g{k})
      then median(e) else (select median(e) from x{k}) end as p from x{k} group by w)""")
    return ", ".join([*out, f"b as (select * from p{rounds})"])


@check(
    f"""with {_M}, {_median_ctes(0.5, 0.5, 2.0, 3)}, f as (select 'hourly' as run_name, split, y, o + p * scale as p from m join b using (w))
    {_long('f', 'run_name, split')}"""
)
def boost_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute loss: every leaf is the median of what is left in it."""
    run = _run(spark, sf_dir, "xgboost", {**STUMPS, "n_estimators": 3, "learning_rate": 0.5})
    return metrics_table(run_frame(spark, [run.record])).select("run_name", "split", "metric", rounded("value"))


_RANGES = {"learning_rate": {"type": "float", "low": 0.05, "high": 0.5, "log": True}, "reg_lambda": {"type": "float", "low": 0.5, "high": 50.0}}


def _draw_sql(name: str) -> str:
    unit = f"(('0x' || substr(md5('42|{name}|' || k), 1, 13))::bigint / {1 << 52}::double)"
    low, high = _RANGES[name]["low"], _RANGES[name]["high"]
    return f"exp(ln({low}) + {unit} * (ln({high}) - ln({low})))" if _RANGES[name].get("log") else f"({low} + {unit} * {high - low})"


@check(
    f"""with {_M}, t as (select w, avg(d) as own, count(*)::double as n, (select avg(d) from m where split = 'train') as base from m where split = 'train' group by w),
    z as (select k, {_draw_sql('learning_rate')} as lr, {_draw_sql('reg_lambda')} as lam from range(4) as v(k)),
    b as (select k, lr, lam, w, base + (own - base) * (1 - (1 - lr * n / (n + lam)) ** 4) as p from t, z),
    f as (select k, lr, lam, y, o + p * scale as p from m join b using (w) where split = 'val')
    select format('random_{{:03d}}', k) as run_name, {sql_round('lr', 'learning_rate')}, {sql_round('lam', 'reg_lambda')}, {', '.join(f'"{m}"' for m in METRICS)} from (
      select k, lr, lam, {metrics_sql()} from f group by k, lr, lam)"""
)
def boost_random_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random search over rate and penalty: each trial's draws and what they lead to."""
    params = {**STUMPS, "reg_alpha": 0.0, "n_estimators": 4}
    samples = prepare_samples(hourly(spark, sf_dir), RunConfig(WEEKEND, WindowSpec(size=2), model_kind="lightgbm", model_params=params))
    runs = tuning.run_trials(spark, samples, tuning.random_table(spark, _RANGES, 4))
    drawn = [F.round(F.col("params")[n].cast("double"), 6).alias(n) for n in _RANGES]
    return runs.select("run_name", *drawn, *[F.round(F.col("metrics")["val"][m], 6).alias(m) for m in METRICS])


LINES = SeriesSpec(order_by=L_ORDER, target="l_quantity", sensors=("l_discount", "l_tax"), series_keys=("l_suppkey",))
_INPUTS = ("l_discount", "l_tax")


def _splits(source: str, by: str) -> str:
    """All splits of groups ``by`` of a table (by, f, x, g, n): gain per input and cut."""
    over = f"partition by {by}, f"
    return f"""select {by}, f, x as cut, gl * gl / nl + (gs - gl) * (gs - gl) / (ns - nl) - gs * gs / ns as gain from (
      select {by}, f, x, sum(g) over ({over} order by x) as gl, sum(n) over ({over} order by x) as nl, sum(g) over ({over}) as gs, sum(n) over ({over}) as ns
      from {source}) where nl < ns"""


_GAINS = f"""with {split_ctes(L_SQL, LINES)},
    a as (select row_number() over () as id, l_discount, l_tax, y from (select split, pos, split_rows, l_discount, l_tax,
        lead(l_quantity) over (partition by l_suppkey, split order by idx) as y from q) where split = 'train' and pos + 1 <= split_rows - 1),
    e as (select *, y - avg(y) over () as g from a),
    v as (select id, 'l_discount' as f, l_discount as x, g from e union all select id, 'l_tax', l_tax, g from e),
    h0 as (select 0 as node, f, x, sum(g) as g, count(*)::double as n from v group by f, x),
    root as (select * from ({_splits('h0', 'node')}) order by gain desc, f, cut limit 1),
    side as (select v.id, (v.x <= root.cut)::int as node from v join root using (f)),
    h1 as (select node, f, x, sum(g) as g, count(*)::double as n from v join side using (id) group by node, f, x),
    kids as (select node, f, gain from ({_splits('h1', 'node')}) qualify row_number() over (partition by node order by gain desc, f, cut) = 1),
    sums as (select f, sum(gain) as gain from (select f, gain from root union all select f, gain from kids) group by f),
    imp as (select 't0_' || f as feature, coalesce(gain, 0) / (select sum(gain) from sums) as importance
      from (values ('l_discount'), ('l_tax')) as n(f) left join sums using (f))"""


def _importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = {**STUMPS, "max_depth": 2, "n_estimators": 1, "learning_rate": 0.1, "reg_alpha": 0.0, "reg_lambda": 0.0}
    window = WindowSpec(size=1, target_mode="absolute", feature_mode="flat")
    config = RunConfig(LINES, window, model_kind="lightgbm", model_params=params, use_validation=False)
    run = run_training(spark, supplier_lines(spark, sf_dir), config, "lines")
    return feature_importance(spark, run.models[0], run.names)


@check(f"{_GAINS} select feature, {sql_round('importance', 'importance')} from imp")
def boost_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of two inputs in the gains of a tree of depth 2 over all suppliers' lines."""
    return _importances(spark, sf_dir).select("feature", rounded("importance"))


@check(f"{_GAINS} select feature, {sql_round('importance', 'importance')} from imp order by importance desc, feature limit 1")
def boost_importance_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_features(_importances(spark, sf_dir), 1).select("feature", rounded("importance"))


@check()
def boost_deep_many_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf-wise trees of the default shape (depth 5, 31 leaves, penalties, column and row shares) over all suppliers' lines.

    Their metrics by split after the first rounds; tests hold such trees to brute force.
    """
    config = RunConfig(Q, model_kind="lightgbm", model_params={"n_estimators": _DEEP_ROUNDS})
    run = run_training(spark, supplier_lines(spark, sf_dir), config, "suppliers")
    return metrics_table(run_frame(spark, [run.record])).select("run_name", "split", "metric", rounded("value"))


@check()
def boost_deep_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level-wise trees with absolute loss, of the default shape, over the hourly series; metrics by split."""
    config = RunConfig(H, model_kind="xgboost", model_params={"n_estimators": _DEEP_ROUNDS})
    run = run_training(spark, hourly(spark, sf_dir), config, "hourly")
    return metrics_table(run_frame(spark, [run.record])).select("run_name", "split", "metric", rounded("value"))
