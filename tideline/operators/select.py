"""Projections: feature/target split, tolerant select, calendar columns."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tideline.functions.calendar import calendar_columns


def split_xy(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Features without the target, and the target alone."""
    if target not in df.columns:
        raise KeyError(target)
    return df.drop(target), df.select(target)


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The requested columns that exist, in the requested order."""
    absent = sorted(set(columns) - set(df.columns))
    if absent:
        warnings.warn(f"columns not in the frame: {', '.join(absent)}", stacklevel=2)
    return df.select([c for c in columns if c in df.columns])


def add_time_features(df: DataFrame, time_col: str | None, keep: bool = False) -> DataFrame:
    """Append the calendar columns and drop the timestamp.

    A frame without the timestamp comes back unchanged.  ``keep`` leaves the
    timestamp in place, which is needed where it is part of the row order.
    """
    if time_col is None or time_col not in df.columns:
        return df
    added = calendar_columns(time_col)
    kept = [c for c in df.columns if c not in added and (keep or c != time_col)]
    return df.select(*kept, *[expr.alias(name) for name, expr in added.items()])
