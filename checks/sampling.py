"""Sliding-window samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import check
from checks.inputs import (
    E, E_SQL, H, H_CLEAN_SQL, L, L_SQL,
    calendar_sql, event_line, hourly, rounded, split_ctes, sql_round, statistics, supplier_lines, window_clause,
)
from tideline.operators.clean import clean
from tideline.operators.order import choose_strategy, chronological_split, with_position
from tideline.operators.select import add_time_features
from tideline.operators.windows import build_windows, industrial_names
from tideline.spec import SeriesSpec, WindowSpec


def _lines_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chronological_split(with_position(supplier_lines(spark, sf_dir), L, "ranged"))


def _line_windows(spark: SparkSession, sf_dir: str, window: WindowSpec = WindowSpec()) -> DataFrame:
    """Windows of all suppliers' lines, by the path that suits the longest series."""
    lines = supplier_lines(spark, sf_dir)
    strategy = choose_strategy(lines, L)
    return build_windows(chronological_split(with_position(lines, L, strategy)), L, window, strategy)


def _industrial(windows: DataFrame, spec: SeriesSpec, *extra, horizon: int = 1) -> DataFrame:
    """Features rounded where they were computed, targets as columns."""
    present = [c for c in spec.time_columns if c in windows.columns]
    features = [
        rounded(n) if n.endswith(("_mean", "_std", "_sin", "_cos")) else F.col(f"`{n}`")
        for n in industrial_names(spec.sensors, present)
    ]
    ahead = [F.round(F.col("y")[j], 6).alias(f"y_{j + 1}") for j in range(horizon)]
    return windows.select(*extra, *features, *ahead, F.round("baseline", 6).alias("baseline"))


def _target_sql(target: str, mode: str, horizon: int = 1) -> str:
    less = f" - {target}" if mode == "delta" else ""
    return ", ".join(
        [sql_round(f"lead({target}, {j}) over w{less}", f"y_{j}") for j in range(1, horizon + 1)]
        + [sql_round(target, "baseline")]
    )


def _valid(size: int, horizon: int = 1, step: int = 1, length: str = "split_rows", pos: str = "pos") -> str:
    every = f" and ({pos} - {size - 1}) % {step} = 0" if step > 1 else ""
    return f"where {pos} >= {size - 1} and {pos} + {horizon} <= {length} - 1{every}"


def _l_sql(mode: str = "delta", size: int = 24, horizon: int = 1, step: int = 1) -> str:
    return f"""with {split_ctes(L_SQL, L)}
    select * exclude (pos, split_rows) from (
      select l_suppkey, split, idx, pos, split_rows, {statistics(L.sensors)}, {_target_sql(L.target, mode, horizon)}
      from q {window_clause(L, size)}) {_valid(size, horizon, step)}"""


@check(_l_sql())
def windows_industrial_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = _line_windows(spark, sf_dir)
    return _industrial(windows, L, "l_suppkey", "split", "idx")


@check(_l_sql())
def windows_industrial_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same samples by the path for series of any length, with chunks far shorter than a series."""
    windows = build_windows(_lines_split(spark, sf_dir), L, WindowSpec(), "ranged", chunk_rows=100)
    return _industrial(windows, L, "l_suppkey", "split", "idx")


@check(
    f"""with c as ({H_CLEAN_SQL}), {split_ctes('select * from c', H)}
    select * exclude (pos, split_rows) from (
      select split, idx, ts, pos, split_rows, {calendar_sql('ts')
        .replace('as day_of_week', '::double as day_of_week').replace('as is_weekend', '::double as is_weekend')},
        {', '.join(sql_round(e, n) for c in H.sensors for e, n in (
            (f'avg({c}) over f', c + '_mean'), (f'stddev_pop({c}) over f', c + '_std'), (f'max({c}) over f', c + '_max'),
            (f'min({c}) over f', c + '_min'), (c, c + '_t'), (f'lag({c}) over w', c + '_t-1')))},
        {_target_sql('ot', 'absolute')}
      from q {window_clause(H, 24)}) {_valid(24)}"""
)
def windows_industrial_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = chronological_split(with_position(clean(hourly(spark, sf_dir), exclude=("ts",)), H))
    windows = build_windows(add_time_features(split, "ts", keep=True), H, WindowSpec(target_mode="absolute"))
    names = [n for n in industrial_names(H.sensors, H.time_columns)]
    calendar = ("day_of_week", "is_weekend")
    return windows.select(
        "split", "idx", "ts",
        *[F.col(n) if n in calendar else rounded(n) for n in names],
        F.round(F.col("y")[0], 6).alias("y_1"),
        rounded("baseline"),
    )


_FLAT_SIZE = 24
_FLAT_COLUMNS = ("l_quantity", "l_discount", "l_tax")


_FLAT_CELLS = [(c, _FLAT_SIZE - 1 - i) for i in range(_FLAT_SIZE) for c in _FLAT_COLUMNS]


@check(
    f"""with {split_ctes(L_SQL, L)}
    select * exclude (pos, split_rows) from (
      select l_suppkey, split, idx, pos, split_rows,
             {', '.join(f'lag({c}, {back}) over w as x_{k}' for k, (c, back) in enumerate(_FLAT_CELLS))}
      from q {window_clause(L, _FLAT_SIZE)}) {_valid(_FLAT_SIZE)}"""
)
def windows_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = WindowSpec(size=_FLAT_SIZE, feature_mode="flat")
    windows = _line_windows(spark, sf_dir, window)
    cells = [F.col("x")[k].alias(f"x_{k}") for k in range(len(_FLAT_CELLS))]
    return windows.select("l_suppkey", "split", "idx", *cells)


@check(
    f"""with {split_ctes(L_SQL, L)}
    select * exclude (pos, split_rows) from (
      select l_suppkey, split, idx, pos, split_rows, {_target_sql(L.target, 'delta', 3)}
      from q {window_clause(L, 4)}) {_valid(4, 3)}"""
)
def windows_flat_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = WindowSpec(size=4, horizon=3, feature_mode="flat")
    windows = build_windows(_lines_split(spark, sf_dir), L, window, "ranged", chunk_rows=50)
    ahead = [F.round(F.col("y")[j], 6).alias(f"y_{j + 1}") for j in range(3)]
    return windows.select("l_suppkey", "split", "idx", *ahead, F.round("baseline", 6).alias("baseline"))


@check(_l_sql(step=6))
def windows_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = _line_windows(spark, sf_dir, WindowSpec(step=6))
    return _industrial(windows, L, "l_suppkey", "split", "idx")


@check(_l_sql("absolute", horizon=3))
def windows_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = _line_windows(spark, sf_dir, WindowSpec(horizon=3, target_mode="absolute"))
    return _industrial(windows, L, "l_suppkey", "split", "idx", horizon=3)


_WHOLE_SQL = f"""with q as (select *, row_number() over (order by ts, event_id) - 1 as idx, count(*) over () as n_rows from ({E_SQL}))
    select * exclude (n_rows) from (
      select idx, n_rows, {statistics(E.sensors)}, {_target_sql('value', 'delta')}
      from q {window_clause(E, 24, split=False)}) {_valid(24, length='n_rows', pos='idx')}"""


@check(_WHOLE_SQL)
def windows_one_long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one series, framed in chunks over all tasks."""
    placed = with_position(event_line(spark, sf_dir), E, "ranged")
    windows = build_windows(placed, E, WindowSpec(), "ranged", chunk_rows=1_000)
    return _industrial(windows, E, "idx")
