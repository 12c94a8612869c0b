"""Row positions inside a series and the chronological split.

Two ways lead to the same positions.  ``single`` numbers the rows of a series
in one window group; it needs one shuffle, but a whole series must fit one
task.  ``ranged`` does so for short series only: it sorts the rows of the long
ones by range over all tasks, writes them, and adds up the row counts of the
ranges; no task holds more than a range, whatever the length of a series.
``auto`` counts the rows per series and decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.missing import join_by_keys
from tideline.session import stage
from tideline.spec import SeriesSpec, SplitSpec

STRATEGIES = ("auto", "single", "ranged")

# A series up to this length is numbered and framed by one task in any case.
SMALL_SERIES_ROWS = 50_000

# Longer ones, up to this length, only where the longest series is at most
# 1/BALANCE of the table, so that the tasks stay evenly loaded.
SINGLE_TASK_ROWS = 1_000_000
BALANCE = 16

# monotonically_increasing_id keeps the row number inside a partition in its low 33 bits.
_ROW_BITS = (1 << 33) - 1


def series_sizes(df: DataFrame, series_keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the longest series and of the table (a map-side combined count over the keys)."""
    if not series_keys:
        n = df.count()
        return n, n
    counts = df.groupBy(*series_keys).count()
    row = counts.agg(F.max("count").alias("longest"), F.sum("count").alias("total")).first()
    return row["longest"] or 0, row["total"] or 0


def choose_strategy(df: DataFrame, spec: SeriesSpec, strategy: str = "auto") -> str:
    """Resolve ``auto`` by the length of the longest series and its share of the table."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    if strategy != "auto":
        return strategy
    longest, total = series_sizes(df, spec.series_keys)
    fits = longest <= SINGLE_TASK_ROWS and longest * BALANCE <= total
    return "single" if longest <= SMALL_SERIES_ROWS or fits else "ranged"


def with_position(
    df: DataFrame, spec: SeriesSpec, strategy: str = "auto", long_rows: int | None = None
) -> DataFrame:
    """Add ``idx`` (0-based position in the series) and ``n_rows`` (its length).

    On the ranged path only series of more than ``long_rows`` rows (``SMALL_SERIES_ROWS``) are sorted by range.
    """
    if choose_strategy(df, spec, strategy) == "single":
        return _number_in_one_group(df, spec)
    if not spec.series_keys:
        return _number_by_range(df, spec)
    return _number_by_length(df, spec, SMALL_SERIES_ROWS if long_rows is None else long_rows)


def total_order(df: DataFrame, spec: SeriesSpec) -> list[Column]:
    """The series order, then all other sortable columns: rows that still tie are equal, so any of them may come first."""
    given = {*spec.series_keys, *spec.order_by}
    rest = [f.name for f in df.schema if f.name not in given and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return [*[F.col(c) for c in spec.order_by], *[F.col(f"`{c}`") for c in rest]]


def _number_in_one_group(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    # Both in one window operator: same groups, same order.
    series = Window.partitionBy(*spec.series_keys).orderBy(*total_order(df, spec))
    whole = series.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns(
        {"idx": F.row_number().over(series).cast("long") - 1, "n_rows": F.count(F.lit(1)).over(whole)}
    )


def _number_by_length(df: DataFrame, spec: SeriesSpec, long_rows: int) -> DataFrame:
    # A long series has more than long_rows rows, so their list is short. It is written, so that the planner
    # knows its size; each row is written once to the part it belongs to.
    keys = list(spec.series_keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    long = stage(sizes.where(F.col("_size") > long_rows).select(*keys, F.lit(True).alias("_long")), "long-series")
    if long.isEmpty():
        return stage(_number_in_one_group(df, spec), "numbered")
    marked = join_by_keys(df, long, keys, ["_long"]).withColumn("_long", F.coalesce("_long", F.lit(False)))
    marked = stage(marked, "by-length", ("_long",))
    short = stage(_number_in_one_group(marked.where("not _long").drop("_long"), spec), "numbered")
    return short.unionByName(_number_by_range(marked.where("_long").drop("_long"), spec))


def _number_by_range(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    keys = list(spec.series_keys)
    sort_cols = [*[F.col(f"`{c}`") for c in keys], *total_order(df, spec)]
    ordered = stage(
        df.repartitionByRange(*sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumns(
            {
                "_range": F.spark_partition_id(),
                "_row": F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)),
            }
        ),
        "ordered",
    )
    # One row per (series, range): written, so that the planner knows its size
    # and broadcasts it only when small.
    ranges = ordered.groupBy(*keys, "_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_count"))
    series = Window.partitionBy(*keys)
    before = series.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        ranges.select(
            *keys,
            "_range",
            (F.coalesce(F.sum("_count").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_count").over(series).alias("n_rows"),
        ),
        "offsets",
    )
    placed = join_by_keys(ordered, offsets, [*keys, "_range"], ["_shift", "n_rows"])
    return placed.select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_row") + F.col("_shift")).alias("idx"), "n_rows"
    )


def chronological_split(df: DataFrame, split: SplitSpec = SplitSpec()) -> DataFrame:
    """Label rows train, val or test by position; one frame, no copies.

    Needs ``idx`` and ``n_rows``.  Adds ``split``, ``pos`` (position inside the
    split) and ``split_rows``.  Ends are truncated products in double precision;
    the last split takes whatever remains.
    """
    n, idx = F.col("n_rows"), F.col("idx")
    train_end = F.floor(n * F.lit(float(split.train)))
    val_end = F.floor(n * F.lit(float(split.train + split.val)))
    bounded = df.withColumns({"_train_end": train_end, "_val_end": val_end})
    in_train, in_val = idx < F.col("_train_end"), idx < F.col("_val_end")
    start = F.when(in_train, F.lit(0)).when(in_val, F.col("_train_end")).otherwise(F.col("_val_end"))
    end = F.when(in_train, F.col("_train_end")).when(in_val, F.col("_val_end")).otherwise(n)
    return bounded.withColumns(
        {
            "split": F.when(in_train, "train").when(in_val, "val").otherwise("test"),
            "pos": (idx - start).cast("long"),
            "split_rows": (end - start).cast("long"),
        }
    ).drop("_train_end", "_val_end")
