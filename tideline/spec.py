"""Descriptions of a series, its split, its windows and a training run."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from typing import Any

# Calendar columns in the order they are appended to a frame.
TIME_COLUMNS = (
    "day_of_week",
    "is_weekend",
    "hour_sin",
    "hour_cos",
    "month_sin",
    "month_cos",
)

# Columns that describe a row's place in its series; never model inputs.
POSITION_COLUMNS = ("idx", "n_rows", "split", "pos", "split_rows")

TARGET_MODES = ("absolute", "delta")
FEATURE_MODES = ("flat", "industrial")


@dataclass(frozen=True)
class SeriesSpec:
    """Which columns make up a series and in which total order its rows stand.

    ``order_by`` must be unique inside a series: Spark has no file order, so
    every position is derived from these columns.
    """

    order_by: tuple[str, ...]
    target: str
    sensors: tuple[str, ...]
    series_keys: tuple[str, ...] = ()
    time_col: str | None = None
    time_columns: tuple[str, ...] = TIME_COLUMNS
    categoricals: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.order_by:
            raise ValueError("order_by must name at least one column")
        if self.target in self.series_keys:
            raise ValueError("the target cannot be a series key")

    @property
    def reserved(self) -> tuple[str, ...]:
        """Keys, order columns and positions: carried along, never features.

        A sensor or target that also serves as a tie-breaker stays a feature.
        """
        names = [*self.series_keys, *self.order_by, *POSITION_COLUMNS]
        if self.time_col:
            names.append(self.time_col)
        return tuple(n for n in dict.fromkeys(names) if n not in self.sensors and n != self.target)

    def to_dict(self) -> dict[str, Any]:
        return asdict(self)

    @classmethod
    def from_dict(cls, values: dict[str, Any]) -> "SeriesSpec":
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


@dataclass(frozen=True)
class SplitSpec:
    """Shares of the leading, middle and trailing rows of each series."""

    train: float = 0.7
    val: float = 0.15
    test: float = 0.15

    def __post_init__(self) -> None:
        total = self.train + self.val + self.test
        if abs(total - 1.0) > 1e-6 + 1e-5:
            raise ValueError(f"split ratios must sum to 1, got {total}")


@dataclass(frozen=True)
class WindowSpec:
    """Shape of a sample: ``size`` past rows, ``horizon`` future targets."""

    size: int = 24
    horizon: int = 1
    step: int = 1
    target_mode: str = "delta"
    feature_mode: str = "industrial"

    def __post_init__(self) -> None:
        if self.target_mode not in TARGET_MODES:
            raise ValueError(f"target_mode must be one of {TARGET_MODES}, got {self.target_mode!r}")
        if self.feature_mode not in FEATURE_MODES:
            raise ValueError(f"feature_mode must be one of {FEATURE_MODES}, got {self.feature_mode!r}")
        if min(self.size, self.horizon, self.step) < 1:
            raise ValueError("size, horizon and step must be positive")
        if self.feature_mode == "industrial" and self.size < 2:
            raise ValueError("industrial windows need size >= 2 (they use the last two rows)")


@dataclass(frozen=True)
class RunConfig:
    """Everything one training run depends on besides its data.

    ``per_series`` fits means and scales for each series on its own; the default
    is one set for the whole table.  ``impute_on`` "all" fills gaps with means of
    all rows, "train" with means of the training rows only.
    """

    series: SeriesSpec
    window: WindowSpec = WindowSpec()
    split: SplitSpec = SplitSpec()
    model_kind: str = "gbt_absolute"
    model_params: dict[str, Any] = field(default_factory=dict)
    use_validation: bool = True
    per_series: bool = False
    impute_on: str = "all"
    seed: int = 42
    strategy: str = "auto"

    def __post_init__(self) -> None:
        if self.impute_on not in ("all", "train"):
            raise ValueError(f"impute_on must be 'all' or 'train', got {self.impute_on!r}")

    def to_dict(self) -> dict[str, Any]:
        return asdict(self)

    @classmethod
    def from_dict(cls, values: dict[str, Any]) -> "RunConfig":
        values = dict(values)
        values["series"] = SeriesSpec.from_dict(values["series"])
        values["window"] = WindowSpec(**values["window"])
        values["split"] = SplitSpec(**values["split"])
        return cls(**values)
