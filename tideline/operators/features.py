"""The fitted feature step: calendar, scaling, encoding, target scaling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.encode import OneHot
from tideline.operators.scale import Scaler, scaler_table
from tideline.operators.select import add_time_features
from tideline.spec import SeriesSpec


@dataclass(frozen=True)
class FeatureModel:
    """Fitted on training rows, applied to any rows.

    ``by_series`` fits one parameter set per series instead of a global one.
    """

    spec: SeriesSpec
    scaler: Scaler
    encoder: OneHot
    scale_target: bool = True

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        spec: SeriesSpec,
        numerical: tuple[str, ...] | None = None,
        scale_target: bool = True,
        by_series: bool = False,
        unseen: str = "error",
    ) -> "FeatureModel":
        """One aggregation pass for all means and deviations, one for categories."""
        columns = list(numerical if numerical is not None else spec.sensors)
        has_target = scale_target and spec.target in train.columns
        if has_target and spec.target not in columns:
            columns.append(spec.target)
        by = spec.series_keys if by_series else ()
        scaler = Scaler.from_table(scaler_table(train, columns, by), columns, by)
        return cls(spec, scaler, OneHot.fit(train, spec.categoricals, unseen), has_target)

    def transform(self, df: DataFrame) -> DataFrame:
        """Calendar columns in, categories encoded, numbers scaled."""
        keep_time = self.spec.time_col is not None
        df = add_time_features(df, self.spec.time_col, keep=keep_time)
        present = tuple(c for c in self.scaler.columns if c in df.columns)
        absent = [c for c in self.scaler.columns if c not in present and c != self.spec.target]
        if absent:
            raise KeyError(f"scaled columns not in the frame: {absent}")
        scaler = Scaler(present, self.scaler.values, self.scaler.by, self.scaler.table)
        return self.encoder.transform(scaler.transform(df))

    def inverse_target(self, df: DataFrame, columns: dict[str, str]) -> DataFrame:
        """Add columns in the original scale, ``{new name: scaled column}``."""
        if not self.scale_target:
            raise RuntimeError("no target scaler was fitted")
        target = self.spec.target
        joined, mean, scale = self.scaler.attach(df, [target])
        restored = {new: F.col(f"`{old}`") * scale[target] + mean[target] for new, old in columns.items()}
        kept = [F.col(f"`{c}`") for c in df.columns if c not in restored]
        return joined.select(*kept, *[e.alias(n) for n, e in restored.items()])


def feature_pipeline(
    df: DataFrame,
    time_col: str | None,
    numerical: tuple[str, ...] | None = None,
    categoricals: tuple[str, ...] = (),
    scaler: Scaler | None = None,
    encoder: OneHot | None = None,
    fit_scaler: bool = True,
    fit_encoder: bool = True,
) -> tuple[DataFrame, Scaler, OneHot | None]:
    """Calendar, scaling and encoding with separate fit flags, no target scaling."""
    df = add_time_features(df, time_col)
    if fit_scaler:
        scaler = Scaler.fit(df, numerical)
    elif scaler is None:
        raise ValueError("a fitted scaler is required when fit_scaler is off")
    df = scaler.transform(df)
    present = [c for c in categoricals if c in df.columns]
    if present:
        if fit_encoder:
            encoder = OneHot.fit(df, present)
        elif encoder is None:
            raise ValueError("a fitted encoder is required when fit_encoder is off")
        df = encoder.transform(df)
    return df, scaler, encoder
