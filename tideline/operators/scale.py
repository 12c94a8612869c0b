"""Standardization: fit on some rows, apply to all.

The fitted values are a small table, one row per scaled column (and per series,
if fitted per series).  A single global set enters the plan as literals; a set
per series is joined on the series keys.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.missing import join_by_keys, numeric_columns
from tideline.session import stage

PARAM_COLUMNS = ("column", "mean", "scale", "n")


def scaler_table(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation per column, as (by…, column, mean, scale, n).

    Missing values are left out.  A column counts as constant, and is only
    centred, when its variance is within rounding error of zero.
    """
    names = list(columns) if columns is not None else numeric_columns(df, tuple(by))
    stats = df.groupBy(*by).agg(
        *[F.avg(f"`{c}`").alias(f"mean_{i}") for i, c in enumerate(names)],
        *[F.var_pop(f"`{c}`").alias(f"var_{i}") for i, c in enumerate(names)],
        *[F.count(f"`{c}`").alias(f"n_{i}") for i, c in enumerate(names)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"mean_{i}").alias("mean"),
                _scale(F.col(f"mean_{i}"), F.col(f"var_{i}"), F.col(f"n_{i}")).alias("scale"),
                F.col(f"n_{i}").alias("n"),
            )
            for i, c in enumerate(names)
        ]
    )
    return stats.select(*by, F.explode(entries).alias("e")).select(*by, "e.*")


def _scale(mean: Column, var: Column, n: Column) -> Column:
    eps = F.lit(sys.float_info.epsilon)
    noise = n * eps * var + F.pow(n * mean * eps, F.lit(2.0))
    return F.when(var <= noise, F.lit(1.0)).otherwise(F.sqrt(var))


@dataclass(frozen=True)
class Scaler:
    """Fitted means and scales.

    ``values`` holds a global set (one entry per column, whatever the size of
    the data).  With ``by`` the set stays a table, one row per series.
    """

    columns: tuple[str, ...]
    values: dict[str, tuple[float | None, float | None]] | None = None
    by: tuple[str, ...] = ()
    table: DataFrame | None = None

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> "Scaler":
        names = tuple(columns) if columns is not None else tuple(numeric_columns(df, tuple(by)))
        return cls.from_table(scaler_table(df, names, by), names, by)

    @classmethod
    def from_table(cls, table: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> "Scaler":
        if by:
            return cls(tuple(columns), None, tuple(by), stage(table, "scaler"))
        values = {r["column"]: (r["mean"], r["scale"]) for r in table.collect()}
        return cls(tuple(columns), values)

    def transform(self, df: DataFrame) -> DataFrame:
        """(x - mean) / scale; missing stays missing."""
        if self.values is not None:
            replaced = {c: self._apply(c, F.lit(self.values[c][0]), F.lit(self.values[c][1])) for c in self.columns}
            return df.select(*[replaced.get(c, F.col(f"`{c}`")) for c in df.columns])
        joined, mean, scale = self.attach(df, self.columns)
        replaced = {c: self._apply(c, mean[c], scale[c]) for c in self.columns}
        return joined.select(*[replaced.get(c, F.col(f"`{c}`")) for c in df.columns])

    def attach(
        self, df: DataFrame, columns: Sequence[str]
    ) -> tuple[DataFrame, dict[str, Column], dict[str, Column]]:
        """Mean and scale of some columns as expressions valid on the returned frame."""
        if self.values is not None:
            return (
                df,
                {c: F.lit(self.values[c][0]).cast("double") for c in columns},
                {c: F.lit(self.values[c][1]).cast("double") for c in columns},
            )
        params = self.table.where(F.col("column").isin(*columns)).groupBy(*self.by).agg(
            F.map_from_entries(F.collect_list(F.struct("column", F.struct("mean", "scale")))).alias("_params")
        )
        joined = join_by_keys(df, params, self.by, ["_params"])
        entry = {c: F.col("_params").getItem(c) for c in columns}
        return (
            joined,
            {c: e.getField("mean") for c, e in entry.items()},
            {c: e.getField("scale") for c, e in entry.items()},
        )

    @staticmethod
    def _apply(name: str, mean: Column, scale: Column) -> Column:
        return ((F.col(f"`{name}`") - mean) / scale).alias(name)
