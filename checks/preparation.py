"""Reading, cleaning, ordering, splitting, calendar, scaling, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import check
from checks.inputs import (
    E, E_SQL, H, H_CLEAN_SQL, H_NUMBERS, H_SQL, L, L_ORDER, L_SQL,
    calendar_sql, event_line, hourly, rounded, split_ctes, sql_round, supplier_lines, table,
)
from tideline.operators.clean import clean, drop_duplicates, impute_mean
from tideline.operators.encode import OneHot, category_places, with_place
from tideline.operators.features import FeatureModel, feature_pipeline
from tideline.operators.order import chronological_split, with_position
from tideline.operators.scale import Scaler, scaler_table
from tideline.operators.select import add_time_features, select_existing, split_xy
from tideline.session import new_path, stage
from tideline.sources.tables import MISSING_TEXTS, read_csv, read_json, read_table, write_csv, write_json, write_table
from tideline.spec import SeriesSpec

EVENTS_SQL = "select event_id, ts, user_id, event_type, value, props from events"
EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


@check(EVENTS_SQL)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "events-csv")
    write_csv(table(spark, sf_dir, "events"), path)
    return read_csv(spark, path, EVENTS_SCHEMA)


@check("select ts, " + ", ".join(sql_round(c, c) for c in H_NUMBERS) + f" from ({H_SQL})")
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "hourly-csv")
    write_csv(hourly(spark, sf_dir), path)
    back = read_csv(spark, path)
    return back.select(F.col("ts").cast("timestamp_ntz").alias("ts"), *[rounded(c) for c in H_NUMBERS])


_MISSING = ", ".join(f"'{text}'" for text in MISSING_TEXTS)


@check(
    "select doc_id, source, case when trim(text) not in (" + _MISSING + ") then text end as text from documents"
)
def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "documents-csv")
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), path)
    schema = T.StructType().add("doc_id", "long").add("source", "string").add("text", "string")
    return read_csv(spark, path, schema, multiline=True)


@check(f"select event_id, row_number() over (order by ts, event_id) - 1 as idx, count(*) over () as n_rows from ({EVENTS_SQL})")
def csv_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "ordered-csv")
    write_csv(table(spark, sf_dir, "events").orderBy("ts", "event_id"), path)
    events = read_csv(spark, path, EVENTS_SCHEMA, file_order="place")
    as_in_files = SeriesSpec(order_by=("place",), target="value", sensors=("value",))
    return with_position(events, as_in_files, "ranged").select("event_id", "idx", "n_rows")


@check(EVENTS_SQL)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "events-json")
    write_json(table(spark, sf_dir, "events"), path)
    return read_json(spark, path, EVENTS_SCHEMA)


@check(EVENTS_SQL)
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "events-parquet")
    write_table(table(spark, sf_dir, "events"), path, partition_by=("event_type",))
    return read_table(spark, path).select(*EVENTS_SCHEMA.fieldNames())


@check(f"select distinct * from ({EVENTS_SQL} union all {EVENTS_SQL})")
def drop_duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return drop_duplicates(events.unionByName(events))


@check("select ts, " + ", ".join(sql_round(c, c) for c in H_NUMBERS) + f" from ({H_SQL})")
def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly(spark, sf_dir).select("ts", *[rounded(c) for c in H_NUMBERS])


@check("select ts, " + ", ".join(sql_round(c, c) for c in H_NUMBERS) + f" from ({H_CLEAN_SQL})")
def impute_column_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute_mean(hourly(spark, sf_dir)).select("ts", *[rounded(c) for c in H_NUMBERS])


@check("select ts, " + ", ".join(sql_round(c, c) for c in H_NUMBERS) + f" from ({H_CLEAN_SQL})")
def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hourly(spark, sf_dir)
    return clean(h.unionByName(h)).select("ts", *[rounded(c) for c in H_NUMBERS])


@check(
    f"with {split_ctes(H_SQL, H)} select ts, split, "
    + ", ".join(sql_round(f"coalesce({c}, avg({c}) filter (where split = 'train') over ())", c) for c in H_NUMBERS)
    + " from q"
)
def impute_train_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = chronological_split(with_position(hourly(spark, sf_dir), H))
    filled = impute_mean(split, columns=H_NUMBERS, fit_on=F.col("split") == "train")
    return filled.select("ts", "split", *[rounded(c) for c in H_NUMBERS])


@check(L_SQL.replace(", l_extendedprice", ""))
def split_off_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_xy(supplier_lines(spark, sf_dir), "l_extendedprice")[0]


@check("select l_extendedprice from lineitem")
def target_alone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_xy(supplier_lines(spark, sf_dir), "l_extendedprice")[1]


@check("select l_tax, l_quantity, l_orderkey from lineitem")
def select_existing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_existing(table(spark, sf_dir, "lineitem"), ["l_tax", "l_weight", "l_quantity", "l_orderkey"])


@check(f"select event_id, {calendar_sql('ts')} from events")
def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = add_time_features(table(spark, sf_dir, "events").select("event_id", "ts"), "ts")
    return out.select(
        "event_id", "day_of_week", "is_weekend", *[rounded(c) for c in ("hour_sin", "hour_cos", "month_sin", "month_cos")]
    )


_L_SPLIT = f"with {split_ctes(L_SQL, L)} select l_suppkey, {', '.join(L_ORDER)}, idx, n_rows, split, pos, split_rows from q"
_POSITIONS = ("idx", "n_rows", "split", "pos", "split_rows")


def _split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written, because parameters are fitted on it before it is transformed."""
    return stage(chronological_split(with_position(supplier_lines(spark, sf_dir), L)), "split")


@check(_L_SPLIT)
def chronological_split_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = chronological_split(with_position(supplier_lines(spark, sf_dir), L))
    return split.select("l_suppkey", *L_ORDER, *_POSITIONS)


@check(_L_SPLIT)
def chronological_split_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = chronological_split(with_position(supplier_lines(spark, sf_dir), L, "ranged", long_rows=0))
    return split.select("l_suppkey", *L_ORDER, *_POSITIONS)


_MIXED = SeriesSpec(order_by=("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"), target="l_extendedprice", sensors=(), series_keys=("series",))


@check(
    f"""with {split_ctes(f"select *, case when l_orderkey % 2 = 0 then 0 else l_orderkey end as series from ({L_SQL})", _MIXED)}
    select series, l_orderkey, l_linenumber, l_partkey, l_extendedprice, idx, n_rows, split from q"""
)
def chronological_split_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series of half of all rows, the others of a few rows each."""
    even = F.col("l_orderkey") % 2 == 0
    lines = supplier_lines(spark, sf_dir).withColumn("series", F.when(even, 0).otherwise(F.col("l_orderkey")))
    split = chronological_split(with_position(lines, _MIXED, "ranged", long_rows=1_000))
    return split.select("series", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "idx", "n_rows", "split")


@check(f"with {split_ctes(E_SQL, E)} select event_id, idx, n_rows, split, pos, split_rows from q")
def chronological_split_one_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = chronological_split(with_position(event_line(spark, sf_dir), E, "ranged"))
    return split.select("event_id", *_POSITIONS)


def _scaler_sql(source: str, columns: list[str], by: str = "") -> str:
    prefix, group = (f"{by}, ", f" group by {by}") if by else ("", "")
    return " union all ".join(
        f"select {prefix}'{c}' as \"column\", {sql_round(f'avg({c})', 'mean')}, "
        f"{sql_round(f'case when var_pop({c}) < 1e-20 then 1 else stddev_pop({c}) end', 'scale')}, "
        f"count({c}) as n from {source}{group}"
        for c in columns
    )


@check(f"with c as ({H_CLEAN_SQL}), {split_ctes('select * from c', H)}, t as (select * from q where split = 'train') "
       + _scaler_sql("t", list(H_NUMBERS)))
def scaler_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = chronological_split(with_position(clean(hourly(spark, sf_dir)), H))
    return scaler_table(split.where(F.col("split") == "train"), H_NUMBERS).select(
        "column", rounded("mean"), rounded("scale"), "n"
    )


_L_NUMBERS = ["l_quantity", "l_discount", "l_tax"]


@check(f"with {split_ctes(L_SQL, L)}, t as (select * from q where split = 'train') "
       + _scaler_sql("t", _L_NUMBERS, "l_suppkey"))
def scaler_fit_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = chronological_split(with_position(supplier_lines(spark, sf_dir), L))
    fitted = scaler_table(split.where(F.col("split") == "train"), _L_NUMBERS, by=["l_suppkey"])
    return fitted.select("l_suppkey", "column", rounded("mean"), rounded("scale"), "n")


def _scaled_sql(by: str) -> str:
    per = f"partition by {by}" if by else ""
    scaled = ", ".join(
        sql_round(
            f"({c} - avg({c}) filter (where split = 'train') over ({per})) "
            f"/ stddev_pop({c}) filter (where split = 'train') over ({per})",
            c,
        )
        for c in _L_NUMBERS
    )
    return f"with {split_ctes(L_SQL, L)} select l_suppkey, idx, split, {scaled} from q"


@check(_scaled_sql(""))
def scaler_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _split_lines(spark, sf_dir)
    scaler = Scaler.fit(split.where(F.col("split") == "train"), _L_NUMBERS)
    return scaler.transform(split).select("l_suppkey", "idx", "split", *[rounded(c) for c in _L_NUMBERS])


@check(_scaled_sql("l_suppkey"))
def scaler_transform_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _split_lines(spark, sf_dir)
    scaler = Scaler.fit(split.where(F.col("split") == "train"), _L_NUMBERS, by=["l_suppkey"])
    return scaler.transform(split).select("l_suppkey", "idx", "split", *[rounded(c) for c in _L_NUMBERS])


@check(
    f"with {split_ctes(L_SQL, L)} select l_suppkey, idx, {sql_round('l_extendedprice', 'restored', 4)}, "
    + sql_round(
        "(l_extendedprice - avg(l_extendedprice) filter (where split = 'train') over ()) "
        "/ stddev_pop(l_extendedprice) filter (where split = 'train') over ()",
        "scaled",
    )
    + " from q"
)
def target_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _split_lines(spark, sf_dir)
    model = FeatureModel.fit(split.where(F.col("split") == "train"), L)
    scaled = model.transform(split).select("l_suppkey", "idx", F.col("l_extendedprice").alias("scaled"))
    restored = model.inverse_target(scaled, {"restored": "scaled"})
    return restored.select("l_suppkey", "idx", rounded("restored", 4), rounded("scaled"))


def _flags(column: str) -> str:
    """Flags for the known values of the given tables, the first value left out."""
    values = {"l_returnflag": ("N", "R"), "l_linestatus": ("O",)}[column]
    return ", ".join(f"({column} = '{v}')::int::double as \"{column}_{v}\"" for v in values)


@check(
    f"select l_orderkey, l_linenumber, l_partkey, {_flags('l_returnflag')}, {_flags('l_linestatus')} from lineitem"
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"
    )
    return OneHot.fit(lines, ["l_returnflag", "l_linestatus", "l_absent"]).transform(lines)


@check("select o_custkey, o_orderkey, rank() over (order by o_orderkey) - 1 as place from orders")
def one_hot_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order key is a category: the place of the one flag that is set."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return with_place(orders, "o_orderkey", category_places(orders, "o_orderkey"))


@check(
    """select l_orderkey, l_linenumber, l_partkey, coalesce(l_returnflag = 'N' and l_linestatus = 'F', false)::int::double
       as "l_returnflag_N", (l_returnflag = 'R')::int::double as "l_returnflag_R" from lineitem"""
)
def one_hot_unseen_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on finished lines; what stands only in open lines sets no flag."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), "O").otherwise(F.col("l_returnflag")).alias("l_returnflag"),
    )
    return OneHot.fit(lines.where("l_returnflag != 'O'"), ["l_returnflag"], unseen="ignore").transform(lines)


_TIED = SeriesSpec(
    order_by=("l_shipdate",), target=L.target, sensors=L.sensors, series_keys=L.series_keys, time_col=L.time_col
)


@check(
    f"""with i as (select *, row_number() over (partition by l_suppkey order by l_shipdate, l_orderkey, l_linenumber, l_partkey,
        l_quantity, l_discount, l_tax, l_extendedprice) - 1 as idx, count(*) over (partition by l_suppkey) as n from ({L_SQL}))
    select l_suppkey, l_orderkey, l_linenumber, l_partkey, idx,
      case when idx < floor(n * 0.7::double) then 'train' when idx < floor(n * (0.7::double + 0.15::double)) then 'val' else 'test' end
        as split from i"""
)
def chronological_split_tied_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many lines of a supplier share a date; the other columns settle their order, whatever the partitions."""
    lines = supplier_lines(spark, sf_dir).repartition(7)
    split = chronological_split(with_position(lines, _TIED, "ranged"))
    return split.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "idx", "split")


_FULL = SeriesSpec(
    order_by=L.order_by, target=L.target, sensors=L.sensors, series_keys=L.series_keys, time_col=L.time_col,
    categoricals=("l_returnflag",),
)
_FULL_SQL = L_SQL.replace(" from lineitem", ", l_returnflag from lineitem")


@check(
    f"with {split_ctes(_FULL_SQL, L)} select l_suppkey, idx, {calendar_sql('l_shipdate')}, {_flags('l_returnflag')}, "
    + ", ".join(
        sql_round(
            f"({c} - avg({c}) filter (where split = 'train') over ()) / stddev_pop({c}) filter (where split = 'train') over ()",
            c,
        )
        for c in (*L.sensors, L.target)
    )
    + " from q"
)
def feature_transformer(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", *L_ORDER, "l_discount", "l_tax", "l_returnflag"
    )
    split = stage(chronological_split(with_position(lines, _FULL)), "split")
    out = FeatureModel.fit(split.where(F.col("split") == "train"), _FULL).transform(split)
    doubles = ("hour_sin", "hour_cos", "month_sin", "month_cos", *L.sensors, L.target)
    return out.select(
        "l_suppkey", "idx", "day_of_week", "is_weekend", "l_returnflag_N", "l_returnflag_R", *[rounded(c) for c in doubles]
    )


@check(
    f"select l_orderkey, l_linenumber, l_partkey, {calendar_sql('l_shipdate')}, {_flags('l_returnflag')}, "
    + ", ".join(sql_round(f"({c} - avg({c}) over ()) / stddev_pop({c}) over ()", c) for c in ("l_quantity", "l_tax"))
    + " from lineitem"
)
def feature_pipeline_whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_quantity", "l_tax", "l_returnflag"
    )
    out, _, _ = feature_pipeline(lines, "l_shipdate", ("l_quantity", "l_tax"), ("l_returnflag",))
    doubles = ("hour_sin", "hour_cos", "month_sin", "month_cos", "l_quantity", "l_tax")
    plain = [c for c in out.columns if c not in doubles]
    return out.select(*plain, *[rounded(c) for c in doubles])
