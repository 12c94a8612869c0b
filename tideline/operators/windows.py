"""Sliding-window samples.

A sample ends at a row, looks ``size`` rows back and ``horizon`` rows ahead,
and never leaves its split or series.  All columns of a sample share one
window specification, so a table of samples costs one shuffle and one sort.

With the ``ranged`` strategy the rows of a split are cut into chunks of equal
length; rows near a border are copied into the neighbouring chunk as context
(a share of about ``(size + horizon) / chunk_rows``).  Each chunk is framed on
its own, so a series of any length is spread over all tasks.

Spark evaluates a sliding frame anew for each row, so its cost grows with the size of the window.  Statistics of
long windows are put together from running ones instead, see ``block_frames``.

The cells of a flat window are lags, so that reading one of them costs no array: code that joins arrays and takes them
apart again, cell by cell, soon outgrows the 8,000 bytes of a method that the JVM compiles, and is interpreted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec as Frame
from pyspark.sql import functions as F

from tideline.operators.order import STRATEGIES
from tideline.spec import SeriesSpec, WindowSpec

CHUNK_ROWS = 65_536
#: Window size from which rolling statistics are put together from blocks.
BLOCKS_FROM = 48
#: Cells of a flat window, of less than ``BLOCKS_FROM`` rows, up to which each is a lag of its own; more would swell the plan.
MOST_LAGS = 512


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def flat_columns(df: DataFrame, spec: SeriesSpec) -> list[str]:
    """Inputs of a flat window: every column but the target, in frame order."""
    skipped = {spec.target, *spec.reserved}
    return [c for c in df.columns if c not in skipped]


def present_time_columns(columns: Sequence[str], spec: SeriesSpec) -> list[str]:
    """The configured calendar columns the frame really has."""
    return [c for c in spec.time_columns if c in columns]


def industrial_names(sensors: Sequence[str], time_columns: Sequence[str]) -> list[str]:
    """Feature names of a compact window in code-point order."""
    per_sensor = ("mean", "std", "max", "min", "t-1", "t")
    return sorted([f"{s}_{kind}" for s in sensors for kind in per_sensor] + list(time_columns))


_STATISTICS = {"mean": F.avg, "std": F.stddev_pop, "max": F.max, "min": F.min}


def sensor_frames(sensors: Sequence[str], size: int, rows: Frame) -> dict[str, Column]:
    """Rolling aggregates and the reading before the last, as raw window columns."""
    past = rows.rowsBetween(-(size - 1), 0)
    frames: dict[str, Column] = {}
    for i, name in enumerate(sensors):
        value = _col(name)
        frames[f"_n{i}"] = F.count(value).over(past)
        frames[f"_before{i}"] = F.lag(value, 1).over(rows)
        for kind, aggregate in _STATISTICS.items():
            frames[f"_{kind}{i}"] = aggregate(value).over(past)
    return frames


_RUNNING = {"n": F.count, "mean": F.avg, "var": F.var_pop, "max": F.max, "min": F.min}


def with_blocks(df: DataFrame, sensors: Sequence[str], size: int, group: Sequence[str]) -> DataFrame:
    """Running statistics from the start of each block of ``size`` positions (``_up``) and from its end (``_down``).

    Both are growing frames, which cost the same for each row whatever the size.
    """
    block = Window.partitionBy(*group, "_block")
    out = df.withColumn("_block", F.floor(F.col("_pos") / size))
    for side, order in (("down", F.desc("_pos")), ("up", F.asc("_pos"))):
        frame = block.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumns(
            {f"_{side}_{kind}{i}": f(_col(name)).over(frame) for i, name in enumerate(sensors) for kind, f in _RUNNING.items()}
        )
    return out


def block_frames(sensors: Sequence[str], size: int, rows: Frame) -> dict[str, Column]:
    """W7-W9 at any size: a window is the end of one block, seen from its first row, and the start of the next."""
    frames: dict[str, Column] = {}
    whole = F.col("_pos") % size == size - 1
    for i, name in enumerate(sensors):
        up = {kind: F.col(f"_up_{kind}{i}") for kind in _RUNNING}
        down = {kind: F.when(~whole, F.lag(f"_down_{kind}{i}", size - 1).over(rows)) for kind in _RUNNING}
        n, m = up["n"], F.coalesce(down["n"], F.lit(0))
        apart = F.coalesce(up["mean"] - down["mean"], F.lit(0.0))
        part = lambda stat, count: F.coalesce(stat * count, F.lit(0.0))
        squares = part(up["var"], n) + part(down["var"], m) + apart * apart * n * m / F.nullif(n + m, F.lit(0))
        frames[f"_n{i}"] = n + m
        frames[f"_mean{i}"] = (part(up["mean"], n) + part(down["mean"], m)) / F.nullif(n + m, F.lit(0))
        frames[f"_std{i}"] = F.sqrt(squares / F.nullif(n + m, F.lit(0)))
        frames[f"_max{i}"] = F.greatest(up["max"], down["max"])
        frames[f"_min{i}"] = F.least(up["min"], down["min"])
        frames[f"_before{i}"] = F.lag(_col(name), 1).over(rows)
    return frames


def industrial_features(sensors: Sequence[str], time_columns: Sequence[str], size: int) -> dict[str, Column]:
    """The features by name, from the raw window columns.

    A statistic over a window with a gap is missing, as it would be with NaN.
    """
    features: dict[str, Column] = {}
    for i, name in enumerate(sensors):
        for kind in _STATISTICS:
            features[f"{name}_{kind}"] = F.when(F.col(f"_n{i}") == size, F.col(f"_{kind}{i}"))
        features[f"{name}_t-1"] = F.col(f"_before{i}")
        features[f"{name}_t"] = _col(name)
    for name in time_columns:
        features[name] = _col(name).cast("double")
    return {name: features[name] for name in sorted(features)}


def flat_features(columns: Sequence[str], size: int, rows: Frame) -> Column:
    """All columns of all rows of the window, row after row."""
    values = [_col(c).cast("double") for c in columns]
    if columns and size < BLOCKS_FROM and size * len(columns) <= MOST_LAGS:
        return F.array(*[F.lag(v, back).over(rows) if back else v for back in range(size - 1, -1, -1) for v in values])
    row = F.array(*values)
    return F.flatten(F.collect_list(row).over(rows.rowsBetween(-(size - 1), 0)))


def future_targets(target: str, window: WindowSpec, rows: Frame) -> Column:
    """The next ``horizon`` targets, in delta mode less the last known one."""
    origin = _col(target)
    ahead = [F.lead(origin, j).over(rows) for j in range(1, window.horizon + 1)]
    return F.array(*[a - origin for a in ahead] if window.target_mode == "delta" else ahead)


def build_windows(
    df: DataFrame,
    spec: SeriesSpec,
    window: WindowSpec = WindowSpec(),
    strategy: str = "auto",
    chunk_rows: int | None = None,
    include_future: bool = False,
) -> DataFrame:
    """One row per window.

    ``df`` carries ``idx`` and ``n_rows`` and, when split, ``split``, ``pos`` and
    ``split_rows``; without a split, the whole series is one run of rows.
    Columns: series keys, ``split``, ``idx`` of the last input row, its timestamp,
    the features (named columns, or ``x`` for flat windows), ``y`` (array), the
    timestamps ``y_time`` of ``y`` (array) and ``baseline`` (the last known target).
    ``include_future`` also keeps the windows whose targets are not known yet.
    Building the plan starts no job: ``auto`` frames in chunks, which suits any length.
    """
    keys = list(spec.series_keys)
    is_split = "split" in df.columns
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    time_columns = present_time_columns(df.columns, spec)
    flat = flat_columns(df, spec) if window.feature_mode == "flat" else []
    if window.feature_mode == "industrial":
        absent = [s for s in spec.sensors if s not in df.columns]
        if absent:
            raise KeyError(f"sensor columns not in the frame: {absent}")

    if is_split:
        place = {"_pos": F.col("pos"), "_len": F.col("split_rows")}
        labels = [*keys, "split"]
    else:
        place = {"_pos": F.col("idx"), "_len": F.col("n_rows")}
        labels = keys
    inputs = flat if flat else [*spec.sensors, *time_columns]
    carried = [*labels, "idx"]
    if spec.time_col and spec.time_col in df.columns:
        carried.append(spec.time_col)
    # The position is the order: ties of the series order are settled there, once.
    ordering = ["idx"]
    needed = list(dict.fromkeys([*carried, *inputs, spec.target, *(ordering if strategy == "single" else [])]))
    rows_df = df.select(*[_col(c) for c in needed], *[e.alias(n) for n, e in place.items()])

    if strategy == "single":
        # One group per series, not per split: frames that would reach over a split
        # border belong to windows that are dropped below.
        rows = Window.partitionBy(*(labels if include_future else keys)).orderBy(*ordering)
        own, group = F.lit(True), labels
    else:
        chunk = chunk_rows or max(CHUNK_ROWS, 16 * (window.size + window.horizon))
        rows_df = _spread_over_chunks(rows_df, window, chunk)
        rows = Window.partitionBy(*labels, "_chunk").orderBy("_pos")
        own, group = F.floor(F.col("_pos") / chunk) == F.col("_chunk"), [*labels, "_chunk"]

    if window.feature_mode == "flat":
        frames = {"x": flat_features(flat, window.size, rows)}
        features = {"x": F.col("x")}
    else:
        if window.size >= BLOCKS_FROM and spec.sensors:
            rows_df = with_blocks(rows_df, spec.sensors, window.size, group)
            frames = block_frames(spec.sensors, window.size, rows)
        else:
            frames = sensor_frames(spec.sensors, window.size, rows)
        features = industrial_features(spec.sensors, time_columns, window.size)
    # Every frame is named once here and only referred to afterwards, so that no
    # aggregate is computed twice.
    ahead = {"_y": future_targets(spec.target, window, rows)}
    if spec.time_col in carried:
        times = [F.lead(_col(spec.time_col), j).over(rows) for j in range(1, window.horizon + 1)]
        ahead["_y_time"] = F.array(*times)
    framed = rows_df.withColumns({**frames, **ahead, "_own": own})
    return framed.where(_starts(window, include_future) & F.col("_own")).select(
        *[_col(c) for c in carried],
        *[e.alias(n) for n, e in features.items()],
        *[F.col(n).alias(n[1:]) for n in ahead],
        _col(spec.target).alias("baseline"),
    )


def _starts(window: WindowSpec, include_future: bool) -> Column:
    """Full windows at every ``step``-th start."""
    start = F.col("_pos") - (window.size - 1)
    last = F.col("_len") - 1 - (0 if include_future else window.horizon)
    return (start >= 0) & (F.col("_pos") <= last) & (start % window.step == 0)


def _spread_over_chunks(df: DataFrame, window: WindowSpec, chunk: int) -> DataFrame:
    """Give each row to its own chunk and to those that need it as context."""
    first = F.greatest(F.floor((F.col("_pos") - window.horizon) / chunk), F.lit(0))
    last = F.least(
        F.floor((F.col("_pos") + window.size - 1) / chunk),
        F.floor((F.col("_len") - 1) / chunk),
    )
    return df.withColumn("_chunk", F.explode(F.sequence(first, last)))
