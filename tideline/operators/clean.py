"""Cleaning: drop repeated rows, fill gaps with column means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.missing import join_by_keys, nan_to_null, numeric_columns
from tideline.session import stage


def drop_duplicates(
    df: DataFrame, columns: Sequence[str] | None = None, colocate: Sequence[str] = ()
) -> DataFrame:
    """One row per distinct row.

    Copies of a row are merged inside each input task before the shuffle, so
    a row that makes up a third of the table costs one row per task.

    ``colocate`` names columns to shuffle by before the rows are compared.  A
    later step grouped by the same columns then needs no shuffle of its own;
    use it only where no group is too large for one task.
    """
    if colocate:
        df = df.repartition(*colocate)
    return df.dropDuplicates(list(columns)) if columns else df.dropDuplicates()


def impute_mean(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    fit_on: Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Replace missing numbers by the mean of their column.

    The means come from all rows of ``df`` or, with ``fit_on``, from the rows
    where that condition holds.  They enter the plan as a scalar subquery: one
    pass, no driver round trip, no join.  With ``by`` each group has its own
    means, joined from a table with one row per group.  A column without any
    value stays missing.  Filled columns are DOUBLE.
    """
    return _fill(nan_to_null(df), columns, exclude, fit_on, by)


def _fill(
    df: DataFrame,
    columns: Sequence[str] | None,
    exclude: Sequence[str],
    fit_on: Column | None,
    by: Sequence[str],
) -> DataFrame:
    filled = list(columns) if columns is not None else numeric_columns(df, (*exclude, *by))
    if not filled:
        return df
    source = df if fit_on is None else df.where(fit_on)
    averages = F.struct(*[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(filled)]).alias("_means")
    if by:
        means = stage(source.groupBy(*by).agg(averages), "means")
        wide = join_by_keys(df, means, by, ["_means"])
    else:
        wide = df.withColumn("_means", source.agg(averages).scalar())
    mean = F.col("_means")
    position = {c: i for i, c in enumerate(filled)}
    return wide.select(
        *[
            F.coalesce(F.col(f"`{c}`").cast("double"), mean.getField(f"m{position[c]}")).alias(c)
            if c in position
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def clean(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    fit_on: Column | None = None,
    by: Sequence[str] = (),
    colocate: Sequence[str] = (),
) -> DataFrame:
    """Drop repeated rows, then fill gaps (see the two steps for the options)."""
    return _fill(drop_duplicates(nan_to_null(df), colocate=colocate), columns, exclude, fit_on, by)
