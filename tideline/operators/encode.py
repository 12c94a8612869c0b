"""One-hot encoding with the first category left out."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.missing import numeric_columns
from tideline.operators.order import with_position
from tideline.session import stage
from tideline.spec import SeriesSpec

# Name of the category of missing values in output columns.
MISSING = "nan"


def category_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """E5: distinct (column, category) pairs; NULL is a category of its own.

    One job for all columns; repeated categories are merged before the shuffle.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("category")) for c in columns]
    )
    return df.select(F.explode(pairs).alias("e")).select("e.*").distinct()


def _sorted(values: Iterable[str | None], numeric: bool) -> tuple[str | None, ...]:
    present = [v for v in values if v is not None]
    ordered = sorted(present, key=float if numeric else None)
    return tuple(ordered) + ((None,) if len(present) < len(list(values)) else ())


@dataclass(frozen=True)
class OneHot:
    """Sorted categories per column; the first one has no output column.

    ``unseen`` says what a category outside the fitted ones does: "error" stops
    the job, "ignore" sets all flags to zero.
    """

    categories: dict[str, tuple[str | None, ...]]
    unseen: str = "error"

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], unseen: str = "error") -> "OneHot":
        present = [c for c in columns if c in df.columns]
        if not present:
            return cls({}, unseen)
        rows = category_table(df, present).collect()
        found: dict[str, list[str | None]] = {c: [] for c in present}
        for row in rows:
            found[row["column"]].append(row["category"])
        numeric = set(numeric_columns(df))
        return cls({c: _sorted(v, c in numeric) for c, v in found.items()}, unseen)

    @property
    def output_columns(self) -> list[str]:
        return [self._name(c, v) for c, values in self.categories.items() for v in values[1:]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Encoded columns replace their sources at the end of the frame."""
        if not self.categories:
            return df
        absent = [c for c in self.categories if c not in df.columns]
        if absent:
            raise KeyError(f"categorical columns not in the frame: {absent}")
        kept = [F.col(f"`{c}`") for c in df.columns if c not in self.categories]
        # The place of the cell among the categories is looked up once per source column, so
        # the plan grows with the categories, not with their square.
        places = [
            self._place(c, values).alias(f"_place_{i}") for i, (c, values) in enumerate(self.categories.items())
        ]
        encoded = [
            (F.col(f"_place_{i}") == k).cast("double").alias(self._name(c, value))
            for i, (c, values) in enumerate(self.categories.items())
            for k, value in enumerate(values)
            if k
        ]
        return df.select(*kept, *places).select(*kept, *encoded)

    @staticmethod
    def _name(column: str, value: str | None) -> str:
        return f"{column}_{MISSING if value is None else value}"

    def _place(self, column: str, values: tuple[str | None, ...]) -> Column:
        cell = F.col(f"`{column}`").cast("string")
        present = [v for v in values if v is not None]
        place = F.array_position(F.array(*[F.lit(v) for v in present]), cell) - 1 if present else F.lit(-1)
        place = F.when(cell.isNull(), len(present) if None in values else -1).otherwise(place)
        if self.unseen == "ignore":
            return place
        message = F.concat(F.lit(f"unseen category in {column}: "), F.coalesce(cell, F.lit("NULL")))
        return F.when(place >= 0, place).otherwise(F.raise_error(message).cast("long"))


def category_places(df: DataFrame, column: str) -> DataFrame:
    """E5 for any number of categories: ``(category, place)`` as a written table, in the order of the column.

    The categories are numbered over all tasks, as the rows of one long series are; nothing comes to the driver.
    """
    value = F.col(f"`{column}`")
    rows = df.select(value.alias("value"), value.cast("string").alias("category")).distinct()
    spec = SeriesSpec(order_by=("missing", "value"), target="category", sensors=())
    numbered = with_position(rows.withColumn("missing", F.col("value").isNull()), spec, "ranged")
    return stage(numbered.select("category", F.col("idx").alias("place")), "categories")


def with_place(df: DataFrame, column: str, places: DataFrame, unseen: str = "error", out: str = "place") -> DataFrame:
    """E6 for any number of categories: the frame with the one place that is set; 0, the first category, sets no flag.

    An unseen category stops the job, or with ``unseen="ignore"`` has no place. The join is left to the planner:
    it is broadcast only if the written table is small, else hot categories are split by adaptive execution.
    """
    side = places.select(F.col("category").alias("_category"), F.col("place").alias(out))
    cell = F.col(f"`{column}`").cast("string")
    joined = df.join(side, cell.eqNullSafe(F.col("_category")), "left").drop("_category")
    if unseen == "ignore":
        return joined
    message = F.concat(F.lit(f"unseen category in {column}: "), F.coalesce(cell, F.lit("NULL")))
    return joined.withColumn(out, F.coalesce(out, F.raise_error(message).cast("long")))
