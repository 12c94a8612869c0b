"""Exploratory profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks import check
from checks.inputs import H_NUMBERS, H_SQL, hourly, rounded, sql_round, table
from tideline.operators import profile

_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

_LINES = (
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
)


@check(
    " union all ".join(
        f"select {i}::int as position, '{c}' as \"column\", '{t}' as dtype, count({c}) as non_null, count(*) as n_rows from lineitem"
        for i, (c, t) in enumerate(_LINES)
    )
)
def profile_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.info(table(spark, sf_dir, "lineitem"))


@check("select event_id, ts, value from events order by ts, event_id limit 5")
def profile_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.head(table(spark, sf_dir, "events").select("event_id", "ts", "value"), ["ts", "event_id"])


def _describe_sql(source: str, columns: tuple[str, ...]) -> str:
    return " union all ".join(
        f"select '{c}' as \"column\", count({c}) as count, {sql_round(f'avg({c})', 'mean')}, "
        f"{sql_round(f'stddev_samp({c})', 'std', 5)}, {sql_round(f'min({c})', 'min')}, "
        + ", ".join(sql_round(f"quantile_cont({c}, {p})", f"q{round(100 * p)}") for p in profile.QUARTILES)
        + f", {sql_round(f'max({c})', 'max')} from {source}"
        for c in columns
    )


def _described(df: DataFrame) -> DataFrame:
    return df.select("column", "count", rounded("std", 5), *[rounded(c) for c in ("mean", "min", "q25", "q50", "q75", "max")])


@check(_describe_sql("lineitem", _NUMBERS))
def profile_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(profile.describe(table(spark, sf_dir, "lineitem").select(*_NUMBERS)))


@check(f"with h as ({H_SQL}) " + _describe_sql("h", H_NUMBERS))
def profile_describe_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(profile.describe(hourly(spark, sf_dir).select(*H_NUMBERS)))


@check(_describe_sql("lineitem", _NUMBERS))
def profile_describe_narrowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same numbers by counting passes that hold no values."""
    return _described(profile.describe(table(spark, sf_dir, "lineitem").select(*_NUMBERS), method="narrowing"))


@check(
    f"with h as ({H_SQL}), r as ("
    + " union all ".join(
        f"select '{c}' as \"column\", count(*) filter (where {c} is null) as missing, count(*) as n from h"
        for c in ("ts", *H_NUMBERS)
    )
    + f") select \"column\", missing, {sql_round('missing * 100.0::double / n', 'percent')} from r where missing > 0"
)
def profile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.missing_report(hourly(spark, sf_dir)).select("column", "missing", rounded("percent"))


@check(
    "with u as (select event_type, user_id from events union all select event_type, user_id from events) "
    "select (count(*) - (select count(*) from (select distinct * from u)))::bigint as duplicates, count(*) as n_rows from u"
)
def profile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "user_id")
    return profile.duplicate_count(events.unionByName(events))


def _histogram_sql(source: str, columns: tuple[str, ...]) -> str:
    return " union all ".join(
        f"""select '{c}' as "column", b::int as bin, {sql_round('lo + b * ((hi - lo) / 30)', 'lower')},
          {sql_round('lo + (b + 1) * ((hi - lo) / 30)', 'upper')}, count(v.x) as count
        from (select unnest(range(30)) as b) cross join (select min({c}) as lo, max({c}) as hi from {source})
        left join (select {c} as x, least(floor(({c} - (select min({c}) from {source}))
          / ((select max({c}) from {source}) - (select min({c}) from {source})) * 30), 29) as at from {source}) v on v.at = b
        group by b, lo, hi"""
        for c in columns
    )


@check(f"with h as ({H_SQL}) " + _histogram_sql("h", H_NUMBERS))
def profile_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile.histogram(hourly(spark, sf_dir), H_NUMBERS)
    return out.select("column", "bin", rounded("lower"), rounded("upper"), "count")


@check(_histogram_sql("lineitem", _NUMBERS))
def profile_histogram_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile.histogram(table(spark, sf_dir, "lineitem"), _NUMBERS)
    return out.select("column", "bin", rounded("lower"), rounded("upper"), "count")


@check(
    f"with h as ({H_SQL}) "
    + " union all ".join(
        f"select '{a}' as a, '{b}' as b, {sql_round(f'corr({a}, {b})', 'r')} from h" for a in H_NUMBERS for b in H_NUMBERS
    )
)
def profile_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.corr_matrix(hourly(spark, sf_dir), H_NUMBERS).select("a", "b", rounded("r"))


@check(
    " union all ".join(
        f"select '{c}' as \"column\", {sql_round(f'abs(corr({c}, l_extendedprice))', 'abs_r')} from lineitem"
        for c in ("l_quantity", "l_discount", "l_tax")
    )
)
def profile_corr_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    out = profile.corr_with_target(lines, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return out.select("column", rounded("abs_r"))
