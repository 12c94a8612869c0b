"""Error metrics as aggregate expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metric names, and the size below which a divisor counts as zero.
METRICS = ("MSE", "RMSE", "MAE", "R2", "MAPE", "SMAPE")
EPSILON = 1e-8

_NAN = float("nan")


def metric_columns(actual: str, predicted: str) -> dict[str, Column]:
    """M1-M6 over pairs of actual and predicted values.

    R² of constant actuals is 1 for an exact fit and 0 otherwise; with fewer
    than two rows, and for percentage errors without a usable row, it is NaN.
    """
    y, p = F.col(f"`{actual}`"), F.col(f"`{predicted}`")
    both = y.isNotNull() & p.isNotNull()
    y, p = F.when(both, y), F.when(both, p)
    error = F.abs(p - y)
    squared = F.pow(y - p, F.lit(2.0))
    mse = F.avg(squared)
    size = F.abs(y)
    sizes = size + F.abs(p)
    r2 = (
        F.when(F.count(y) < 2, F.lit(_NAN))
        .when((F.min(y) == F.max(y)) & (F.sum(squared) == 0), F.lit(1.0))
        .when(F.min(y) == F.max(y), F.lit(0.0))
        .otherwise(1.0 - mse / F.nullif(F.var_pop(y), F.lit(0.0)))
    )
    mape = F.avg(F.when(size > EPSILON, error / size)) * 100
    smape = F.avg(F.when(sizes > EPSILON, 2.0 * error / sizes)) * 100
    return {
        "MSE": mse,
        "RMSE": F.sqrt(mse),
        "MAE": F.avg(error),
        "R2": r2,
        "MAPE": F.coalesce(mape, F.lit(_NAN)),
        "SMAPE": F.coalesce(smape, F.lit(_NAN)),
    }


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """All six metrics and the sample count, in one pass."""
    metrics = metric_columns(actual, predicted)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"),
        *[expr.alias(name) for name, expr in metrics.items()],
    )


def metrics_long(df: DataFrame, by: Sequence[str] = (), names: Sequence[str] = METRICS) -> DataFrame:
    """One row per metric, (by…, metric, value)."""
    return df.unpivot(list(by), list(names), "metric", "value")


def format_value(value: Column, precision: int = 4) -> Column:
    """M8: fixed decimals, "N/A" for missing values."""
    return F.when(value.isNull() | F.isnan(value), F.lit("N/A")).otherwise(
        F.format_string(f"%.{precision}f", value)
    )


def format_metrics(df: DataFrame, by: Sequence[str] = (), precision: int = 4) -> DataFrame:
    """M8 over all metric columns of a metrics table."""
    return df.select(*by, *[format_value(F.col(m), precision).alias(m) for m in METRICS if m in df.columns])


def prediction_summary(df: DataFrame, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """M9: mean, population deviation and range of the predictions."""
    p = F.col(f"`{predicted}`")
    return df.groupBy(*by).agg(
        F.avg(p).alias("mean"), F.stddev_pop(p).alias("std"), F.min(p).alias("min"), F.max(p).alias("max")
    )
