"""Calendar expressions on a timestamp without time zone."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cycle(value: Column, period: int) -> Column:
    return value * F.lit(2 * math.pi) / F.lit(float(period))


def calendar_columns(time_col: str) -> dict[str, Column]:
    """Weekday (Monday is 0), weekend flag, hour and month on a circle."""
    ts = F.col(f"`{time_col}`").cast("timestamp_ntz")
    weekday = F.weekday(ts)
    hour, month = _cycle(F.hour(ts), 24), _cycle(F.month(ts), 12)
    return {
        "day_of_week": weekday,
        "is_weekend": (weekday >= 5).cast("int"),
        "hour_sin": F.sin(hour),
        "hour_cos": F.cos(hour),
        "month_sin": F.sin(month),
        "month_cos": F.cos(month),
    }
