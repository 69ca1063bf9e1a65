"""Trailing windows over the observations of a series.

Every window counts observations, not days, ends at the current one, and gives null until it is full of
values. A daily series has at most some ten thousand rows however long it is kept, so series are the unit
of parallel work: one shuffle and one sort by (series, day) serve all features, whose frames only differ.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

KEY, ORDER = "series_id", "observation_date"


def observations() -> WindowSpec:
    return Window.partitionBy(KEY).orderBy(ORDER)


def trailing(n: int) -> WindowSpec:
    return observations().rowsBetween(-(n - 1), 0)


def full(value: Column, n: int, result: Column) -> Column:
    """The result where the last n values are all there."""
    return F.when(F.count(value).over(trailing(n)) == n, result)


def lagged(value: Column, n: int) -> Column:
    return F.lag(value, n).over(observations())


def delta(value: Column, n: int) -> Column:
    return value - lagged(value, n)


def rolling_mean(value: Column, n: int) -> Column:
    return full(value, n, F.avg(value).over(trailing(n)))


def rolling_deviation(value: Column, n: int) -> Column:
    """Population standard deviation."""
    return full(value, n, F.stddev_pop(value).over(trailing(n)))


def moments(value: Column, n: int, name: str) -> dict[str, Column]:
    """Columns {name}_n, {name}_mean and {name}_deviation of a trailing window, to be made once and then used by name."""
    w = trailing(n)
    return {f"{name}_n": F.count(value).over(w), f"{name}_mean": F.avg(value).over(w), f"{name}_deviation": F.stddev_pop(value).over(w)}


def zscore(value: Column, n: int, name: str) -> Column:
    """From the columns of moments(): null where the window isn't full or doesn't vary."""
    deviation = F.col(f"{name}_deviation")
    return F.when((F.col(f"{name}_n") == n) & (deviation > 0), F.try_divide(value - F.col(f"{name}_mean"), deviation))


def autocorrelation(covariance: Column, x: str, y: str, n: int) -> Column:
    """Correlation of two columns from their covariance and moments: null where undefined, 0 where not positive."""
    scale = F.col(f"{x}_deviation") * F.col(f"{y}_deviation")
    there = (F.col(f"{x}_n") == n) & (F.col(f"{y}_n") == n) & (scale > 0)
    return F.when(there, F.greatest(F.try_divide(covariance, scale), F.lit(0.0)))


def step_return(value: Column) -> Column:
    """Growth since the observation before, null unless both are over 0."""
    before = lagged(value, 1)
    return F.when((value > 0) & (before > 0), value / before - 1)


def compound_return(value: Column, step: Column, n: int) -> Column:
    """Per cent gained over n steps, all of which must be valid; their growth factors' product is the ratio of its ends."""
    return full(step, n, 100 * (F.try_divide(value, lagged(value, n)) - 1))


def mean_return(value: Column, step: Column, n: int) -> Column:
    """Per cent a step: the geometric mean of n growth factors."""
    return full(step, n, 100 * (F.pow(F.try_divide(value, lagged(value, n)), F.lit(1.0 / n)) - 1))
