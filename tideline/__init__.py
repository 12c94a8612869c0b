"""Supervised time-series forecasting on Spark DataFrames.

The package reads ordered tables of sensor readings, cleans them, splits each
series chronologically, builds sliding-window samples, trains boosted trees and
scores, compares and profiles the results.  Every step is a DataFrame job.
"""

from tideline.spec import RunConfig, SeriesSpec, SplitSpec, WindowSpec

__all__ = ["RunConfig", "SeriesSpec", "SplitSpec", "WindowSpec"]
