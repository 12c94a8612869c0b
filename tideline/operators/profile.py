"""Exploratory profiles: summary, gaps, duplicates, histograms, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.missing import nan_to_null, numeric_columns
from tideline.session import stage

QUARTILES = (0.25, 0.5, 0.75)

# Bins per interval and pass when quantiles are narrowed down.
NARROWING_BINS = 1_000

# Columns per block when columns are correlated pair by pair.
CORR_BLOCK = 4


def _numeric(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    return list(columns) if columns is not None else numeric_columns(df)


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) with one row per numeric cell that has a value."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns]
    )
    return nan_to_null(df.select(F.explode(cells).alias("e")).select("e.*")).where(F.col("value").isNotNull())


def info(df: DataFrame) -> DataFrame:
    """Per column its position, type and count of values, and the row count."""
    df = nan_to_null(df)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)]
    )
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(f"c{i}").alias("non_null"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return counts.select("n_rows", F.explode(F.array(*entries)).alias("e")).select("e.*", "n_rows")


def head(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows in series order."""
    return df.orderBy(*order_by).limit(n)


def describe(df: DataFrame, columns: Sequence[str] | None = None, method: str = "narrowing") -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles, maximum per column.

    Quartiles are exact with linear interpolation, from counting passes over the
    numbers, written once, that hold no values, whatever the size of the table.
    ``method="single"`` takes them from one aggregation buffer per column, for
    tables known to be small.
    """
    names = _numeric(df, columns)
    df = nan_to_null(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in names]))
    if method not in ("narrowing", "single"):
        raise ValueError(f"method must be narrowing or single, got {method!r}")
    labels = [f"q{round(100 * p)}" for p in QUARTILES]
    if method == "single":
        def quartile(c: str, k: int) -> Column:
            return F.percentile(f"`{c}`", list(QUARTILES))[k]
    else:
        df = stage(df, "numbers")
        found = exact_quantiles(df, names, QUARTILES)

        def quartile(c: str, k: int) -> Column:
            return F.lit(found[c][k]).cast("double")

    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(f"`{c}`").alias("count"),
            F.avg(f"`{c}`").alias("mean"),
            F.stddev_samp(f"`{c}`").alias("std"),
            F.min(f"`{c}`").alias("min"),
            *[quartile(c, k).alias(q) for k, q in enumerate(labels)],
            F.max(f"`{c}`").alias("max"),
        )
        for c in names
    ]
    return df.agg(F.array(*entries).alias("all")).select(F.explode("all").alias("e")).select("e.*")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles by repeated counting.

    Each pass counts the values of the intervals that still hold a wanted rank
    in equal-width bins (combined before the shuffle) and keeps the bin with the
    rank, shrunk to its smallest and largest value.  An interval of at most
    ``NARROWING_BINS`` rows is counted value by value instead.  It ends when its
    ends are equal, so hot values cost nothing and no task holds the values; the
    driver sees at most ``NARROWING_BINS`` + 3 counts per open interval.
    """
    spark = df.sparkSession
    values = long_values(df, columns)
    totals = values.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n"))
    found = {r["column"]: (r["lo"], r["hi"], r["n"]) for r in totals.collect()}
    # (column, rank) -> (smallest value, largest value, ranks below the interval, rows in it)
    ranks: dict[tuple[str, int], tuple[float, float, int, int]] = {}
    for column, (lo, hi, n) in found.items():
        for p in probabilities:
            at = p * (n - 1)
            for rank in {int(at), min(int(at) + 1, n - 1)}:
                ranks[column, rank] = (lo, hi, 0, n)
    while True:
        open_intervals = sorted({(c, *i) for (c, _), i in ranks.items() if i[0] < i[1]})
        if not open_intervals:
            break
        table = spark.createDataFrame(open_intervals, "column string, lo double, hi double, below long, size long")
        # Bounded: a few intervals per column.
        inside = values.join(F.broadcast(table), "column").where(F.col("value").between(F.col("lo"), F.col("hi")))
        # The ends have bins of their own: every pass shrinks every open interval,
        # also one with infinite ends.
        span = F.col("hi") / 2 - F.col("lo") / 2
        share = (F.col("value") / 2 - F.col("lo") / 2) / span
        place = (
            F.when(F.col("value") == F.col("lo"), F.lit(-1))
            .when(F.col("value") == F.col("hi"), F.lit(NARROWING_BINS + 1))
            .when(span > 0, F.floor(share * NARROWING_BINS))
            .otherwise(F.lit(0))
        )
        alone = F.when(F.col("size") <= NARROWING_BINS, F.col("value"))
        bins = (
            inside.groupBy("column", "lo", "hi", "below", place.alias("bin"), alone.alias("alone"))
            .agg(F.count("*").alias("n"), F.min("value").alias("first"), F.max("value").alias("last"))
            .orderBy("column", "lo", "hi", "below", "bin", "alone")
            .collect()
        )
        grouped: dict[tuple, list] = {}
        for row in bins:
            grouped.setdefault((row["column"], row["lo"], row["hi"], row["below"]), []).append(row)
        for (column, rank), (lo, hi, below, _) in list(ranks.items()):
            seen = below
            for row in grouped.get((column, lo, hi, below), []):
                if rank < seen + row["n"]:
                    ranks[column, rank] = (row["first"], row["last"], seen, row["n"])
                    break
                seen += row["n"]
    result: dict[str, list[float | None]] = {}
    for column in columns:
        if column not in found:
            result[column] = [None] * len(probabilities)
            continue
        n = found[column][2]
        result[column] = []
        for p in probabilities:
            at = p * (n - 1)
            low, high = ranks[column, int(at)][0], ranks[column, min(int(at) + 1, n - 1)][0]
            share = at - int(at)
            result[column].append(low + (high - low) * share if share else low)
    return result


def missing_report(df: DataFrame) -> DataFrame:
    """Count and share of missing cells of the columns that have any, most first."""
    df = nan_to_null(df)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)]
    )
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(df.columns)]
    return (
        counts.select("n", F.explode(F.array(*entries)).alias("e"))
        .where(F.col("e.missing") > 0)
        .select("e.column", "e.missing", (F.col("e.missing") * 100.0 / F.col("n")).alias("percent"))
        .orderBy(F.desc("missing"), "column")
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row; copies are counted before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
    )


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 30) -> DataFrame:
    """Equal-width bins per column, empty ones included, the last one closed.

    (column, bin, lower, upper, count).  A constant column gets the range of one
    around its value.  Two passes: the ranges enter the second one as a scalar
    subquery, and cells are counted inside their tasks before the shuffle.
    """
    names = _numeric(df, columns)
    df = nan_to_null(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in names]))
    ranges = df.agg(
        F.struct(
            *[F.min(f"`{c}`").alias(f"lo{i}") for i, c in enumerate(names)],
            *[F.max(f"`{c}`").alias(f"hi{i}") for i, c in enumerate(names)],
        ).alias("r")
    ).scalar()

    def ends(i: int) -> tuple[Column, Column]:
        lo, hi = F.col(f"_ranges.lo{i}"), F.col(f"_ranges.hi{i}")
        return F.when(lo == hi, lo - 0.5).otherwise(lo), F.when(lo == hi, hi + 0.5).otherwise(hi)

    def place(i: int) -> Column:
        lo, hi = ends(i)
        value = F.col(f"`{names[i]}`")
        at = F.least(F.floor((value - lo) / (hi - lo) * bins), F.lit(bins - 1))
        return F.when(value.isNotNull(), at.cast("int"))

    cells = F.array(*[F.struct(F.lit(c).alias("column"), place(i).alias("bin")) for i, c in enumerate(names)])
    counts = (
        df.withColumn("_ranges", ranges)
        .select(F.explode(cells).alias("e"))
        .select("e.*")
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    limits = F.array(
        *[
            F.struct(F.lit(c).alias("column"), ends(i)[0].alias("lo"), ends(i)[1].alias("hi"))
            for i, c in enumerate(names)
        ]
    )
    all_bins = (
        df.sparkSession.range(1)
        .select(ranges.alias("_ranges"))
        .select(F.explode(limits).alias("e"))
        .select("e.*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .where(F.col("lo").isNotNull())
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return all_bins.join(counts, ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def _in_blocks(df: DataFrame, names: Sequence[str], others: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """``others`` and ``_blocks``: the columns as doubles in arrays of equal length, the last one filled up with NULL."""
    df = nan_to_null(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in dict.fromkeys([*names, *others])]))
    width = min(CORR_BLOCK, len(names))
    cells = [F.col(f"`{c}`") for c in names] + [F.lit(None).cast("double")] * (-len(names) % width)
    blocks = F.array(*[F.array(*cells[k : k + width]) for k in range(0, len(cells), width)])
    return df.select(*[F.col(f"`{c}`") for c in others], blocks.alias("_blocks")), width


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of all column pairs over their common rows.

    (a, b, r) for every ordered pair.  Pairs of blocks of columns are the groups of one aggregation, so the
    plan is the same size for any number of columns.
    """
    names = _numeric(df, columns)
    if not names:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    blocks, width = _in_blocks(df, names)
    last = (len(names) - 1) // width
    pairs = blocks.select("_blocks", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("_i"))
    pairs = pairs.select("_blocks", "_i", F.explode(F.sequence("_i", F.lit(last))).alias("_j"))
    cells = [F.get(F.col("_blocks")[F.col(side)], F.lit(k)).alias(f"{side}{k}") for side in ("_i", "_j") for k in range(width)]
    every = [(i, j) for i in range(width) for j in range(width)]
    stats = pairs.select("_i", "_j", *cells).groupBy("_i", "_j").agg(*[_corr(f"_i{i}", f"_j{j}").alias(f"r_{i}_{j}") for i, j in every])
    entries = F.array(
        *[
            F.struct((F.col("_i") * width + i).alias("a"), (F.col("_j") * width + j).alias("b"), F.col(f"r_{i}_{j}").alias("r"))
            for i, j in every
        ]
    )
    swapped = F.transform(entries, lambda e: F.struct(e.b.alias("a"), e.a.alias("b"), e.r.alias("r")))
    both = F.when(F.col("_i") < F.col("_j"), F.concat(entries, swapped)).otherwise(entries)
    found = stats.select(F.explode(both).alias("e")).select("e.*").where((F.col("a") < len(names)) & (F.col("b") < len(names)))
    label = F.array(*[F.lit(n) for n in names])
    return found.select(label[F.col("a")].alias("a"), label[F.col("b")].alias("b"), "r")


def corr_with_target(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Absolute correlation of each column with the target, strongest first."""
    names = [c for c in _numeric(df, columns) if c != target]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, abs_r double")
    blocks, width = _in_blocks(df, names, (target,))
    rows = blocks.select(F.col(f"`{target}`").alias("_y"), F.posexplode("_blocks").alias("_i", "_x"))
    rows = rows.select("_y", "_i", *[F.col("_x")[k].alias(f"_x{k}") for k in range(width)])
    stats = rows.groupBy("_i").agg(*[_corr(f"_x{k}", "_y").alias(f"r_{k}") for k in range(width)])
    entries = [F.struct((F.col("_i") * width + k).alias("at"), F.abs(F.col(f"r_{k}")).alias("abs_r")) for k in range(width)]
    found = stats.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where(F.col("at") < len(names))
    label = F.array(*[F.lit(n) for n in names])
    return found.select(label[F.col("at")].alias("column"), "abs_r").orderBy(F.desc_nulls_last("abs_r"), "column")


def _corr(a: str, b: str) -> Column:
    """Correlation over the rows that have both values, NULL where one is constant there."""
    x, y = F.col(f"`{a}`"), F.col(f"`{b}`")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))
