"""One notion of "missing": NULL.  NaN is turned into it at ingest; joins match NULL keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[_no_nan(c) if c in floating else F.col(f"`{c}`") for c in df.columns])


def _no_nan(name: str) -> Column:
    col = F.col(f"`{name}`")
    return F.when(~F.isnan(col), col).alias(name)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Names of the numeric columns, in frame order."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def join_by_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``df`` with ``columns`` of ``other``, matched on keys that may be NULL.

    ``other`` has at most one row per key.  No broadcast is forced: a written
    table has a known size, so the planner broadcasts it only when small.
    """
    on = F.lit(True)
    for key in keys:
        on = on & F.col(f"l.`{key}`").eqNullSafe(F.col(f"r.`{key}`"))
    return (
        df.alias("l")
        .join(other.alias("r"), on, "left")
        .select(*[F.col(f"l.`{c}`") for c in df.columns], *[F.col(f"r.`{c}`") for c in columns])
    )
