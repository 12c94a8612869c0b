"""Series derived from the given tables, in Spark and in SQL.

H: hourly totals of all events, one series with gaps.
L: all line items, one series per supplier.
Q: the same with the quantity as target.
E: all events as one long series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.spec import SeriesSpec

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

L_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")

H = SeriesSpec(
    order_by=("ts",),
    target="ot",
    sensors=("click", "error", "n_events", "purchase", "signup", "view"),
    time_col="ts",
)
L = SeriesSpec(
    order_by=L_ORDER,
    target="l_extendedprice",
    sensors=("l_quantity", "l_discount", "l_tax"),
    series_keys=("l_suppkey",),
    time_col="l_shipdate",
)
Q = SeriesSpec(
    order_by=L_ORDER,
    target="l_quantity",
    sensors=("l_discount", "l_tax", "l_extendedprice"),
    series_keys=("l_suppkey",),
    time_col="l_shipdate",
)
E = SeriesSpec(order_by=("ts", "event_id"), target="value", sensors=("value",), time_col="ts")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hour_of(ts: str) -> Column:
    """The full hour, without going through a session time zone."""
    c = F.col(ts)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.day(c), F.hour(c), F.lit(0), F.lit(0))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    sums = [F.sum(F.when(F.col("event_type") == t, value)).alias(t) for t in EVENT_TYPES]
    return (
        table(spark, sf_dir, "events")
        .groupBy(hour_of("ts").alias("ts"))
        .agg(*sums, F.count(F.lit(1)).cast("double").alias("n_events"), F.avg(value).alias("ot"))
    )


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
        "l_quantity", "l_discount", "l_tax", "l_extendedprice",
    )


def event_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "value")


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(F.col(f"`{name}`"), digits).alias(name)


# ---- the same in SQL ----

_SUMS = ", ".join(f"sum(value) filter (where event_type = '{t}') as {t}" for t in EVENT_TYPES)
H_SQL = (
    f"select date_trunc('hour', ts) as ts, {_SUMS}, count(*)::double as n_events, avg(value) as ot "
    "from events group by 1"
)
H_NUMBERS = ("click", "error", "purchase", "signup", "view", "n_events", "ot")
H_CLEAN_SQL = (
    "select ts, "
    + ", ".join(f"coalesce({c}, avg({c}) over ()) as {c}" for c in H_NUMBERS)
    + f" from (select distinct * from ({H_SQL}))"
)
L_SQL = (
    "select l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax, "
    "l_extendedprice from lineitem"
)
E_SQL = "select event_id, ts, value from events"


def sql_round(expr: str, name: str, digits: int = 6) -> str:
    return f'round({expr}, {digits}) + 0.0 as "{name}"'


def _over(keys: Sequence[str], order: str = "") -> str:
    parts = [f"partition by {', '.join(keys)}" if keys else "", f"order by {order}" if order else ""]
    return "(" + " ".join(p for p in parts if p) + ")"


def split_ctes(source: str, spec: SeriesSpec) -> str:
    """CTE ``q``: the source with idx, n_rows, split, pos and split_rows."""
    keys, order = list(spec.series_keys), ", ".join(spec.order_by)
    return f"""
src as ({source}),
i as (select *, row_number() over {_over(keys, order)} - 1 as idx, count(*) over {_over(keys)} as n_rows from src),
s as (select *, case when idx < floor(n_rows * 0.7::double) then 'train'
                     when idx < floor(n_rows * (0.7::double + 0.15::double)) then 'val'
                     else 'test' end as split from i),
q as (select *, row_number() over {_over([*keys, 'split'], 'idx')} - 1 as pos,
                count(*) over {_over([*keys, 'split'])} as split_rows from s)"""


def window_clause(spec: SeriesSpec, size: int, split: bool = True) -> str:
    labels = [*spec.series_keys, "split"] if split else list(spec.series_keys)
    w = _over(labels, "idx")
    return f"window w as {w}, f as ({w[1:-1]} rows between {size - 1} preceding and current row)"


def statistics(sensors: Sequence[str], digits: int = 6) -> str:
    """The select list of rolling statistics and last readings."""
    parts = []
    for c in sensors:
        parts += [
            sql_round(f"avg({c}) over f", f"{c}_mean", digits),
            sql_round(f"stddev_pop({c}) over f", f"{c}_std", digits),
            f'max({c}) over f as "{c}_max"',
            f'min({c}) over f as "{c}_min"',
            f'{c} as "{c}_t"',
            f'lag({c}) over w as "{c}_t-1"',
        ]
    return ", ".join(parts)


def calendar_sql(ts: str) -> str:
    cyc = "2 * pi()"
    return ", ".join(
        [
            f"(isodow({ts}) - 1)::int as day_of_week",
            f"(isodow({ts}) >= 6)::int as is_weekend",
            sql_round(f"sin({cyc} * hour({ts}) / 24)", "hour_sin"),
            sql_round(f"cos({cyc} * hour({ts}) / 24)", "hour_cos"),
            sql_round(f"sin({cyc} * month({ts}) / 12)", "month_sin"),
            sql_round(f"cos({cyc} * month({ts}) / 12)", "month_cos"),
        ]
    )


def metrics_sql(y: str = "y", p: str = "p", digits: int = 6) -> str:
    return ", ".join(
        [
            "count(*) as n_samples",
            sql_round(f"avg(({y} - {p}) * ({y} - {p}))", "MSE", digits),
            sql_round(f"sqrt(avg(({y} - {p}) * ({y} - {p})))", "RMSE", digits),
            sql_round(f"avg(abs({y} - {p}))", "MAE", digits),
            sql_round(f"1 - avg(({y} - {p}) * ({y} - {p})) / var_pop({y})", "R2", digits),
            sql_round(f"100 * avg(abs({p} - {y}) / abs({y})) filter (where abs({y}) > 1e-8)", "MAPE", digits),
            sql_round(
                f"100 * avg(2 * abs({p} - {y}) / (abs({y}) + abs({p}))) filter (where abs({y}) + abs({p}) > 1e-8)",
                "SMAPE",
                digits,
            ),
        ]
    )


def persistence_ctes(source: str, spec: SeriesSpec, size: int = 24) -> str:
    """CTE ``m``: (keys, split, idx, pos, y, p) of the forecast "no change" for every window."""
    keys = ", ".join([*spec.series_keys, "split"])
    return split_ctes(source, spec) + f""",
m as (select * from (
  select {keys}, idx, pos, split_rows, lead({spec.target}) over w as y, {spec.target} as p from q {window_clause(spec, size)})
  where pos >= {size - 1} and pos + 1 <= split_rows - 1)"""
