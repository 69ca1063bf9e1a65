"""Feature columns of series and their assembly into one wide row a day.

All series are computed in one long frame; the wide frame is one pivot over a fixed list of series, which
gives the rows of a chain of full outer joins without its shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import windows as W
from tideline.functions.scalars import finite, midnight, nan_to_null, safe_ratio

SCHEMA_VERSION, FEATURE_VERSION = 4, 3
# The families in their order, lags and windows of the features.
VOLATILITY = ("vix", "vix9d", "vix3m", "vix6m", "vix1y", "vstoxx", "move")
MACRO = ("ciss", "euro_hy_oas", "us_2y", "us_10y", "estr", "usd_broad")
DELTAS = {s: (1, 5, 20) for s in (*VOLATILITY, "ciss", "euro_hy_oas")} | {s: (1, 20) for s in ("us_2y", "us_10y", "estr", "usd_broad")}
ZSCORE = 60
MOMENTUM = ((1, 60), (5, 60), (20, 120))
RETURNS = (10, 25, 60, 120, 240)
RATIOS = {"vix9d_vix_ratio": ("vix9d", "vix"), "vix_vix3m_ratio": ("vix", "vix3m")}
SPREADS = {"vix3m_minus_vix": ("vix3m", "vix"), "vix6m_minus_vix": ("vix6m", "vix"), "vix1y_minus_vix": ("vix1y", "vix")}
SLOPES = {"us_10y_minus_us_2y": ("us_10y", "us_2y")}

LONG_FEATURES = ("level", *(f"delta_{n}obs" for n in (1, 5, 20)), f"zscore_{ZSCORE}obs", *(f"momentum_autocorr_{h}_{w}obs" for h, w in MOMENTUM), *(f"return_geom_{w}obs_pct" for w in RETURNS))


def momentum_columns(series: Sequence[str]) -> list[str]:
    return [f"{s}_momentum_autocorr_{h}_{w}obs" for s in series for h, w in MOMENTUM]


def return_columns(series: Sequence[str]) -> list[str]:
    return [f"{s}_return_geom_{w}obs_pct" for s in series for w in RETURNS]


def base_columns(series: Sequence[str]) -> list[str]:
    """Level, deltas and, for the volatility family, the z-score of each."""
    return [f"{s}_{x}" for s in series for x in ("level", *(f"delta_{n}obs" for n in DELTAS[s]), *([f"zscore_{ZSCORE}obs"] if s in VOLATILITY else []))]


VOLATILITY_BASE = [*base_columns(VOLATILITY), *RATIOS, *SPREADS]
MACRO_BASE = [*base_columns(MACRO), *SLOPES]
WIDE_COLUMNS = ["timestamp_m1", *VOLATILITY_BASE, *MACRO_BASE, *momentum_columns((*VOLATILITY, *MACRO)), *return_columns((*VOLATILITY, *MACRO))]


def with_deltas(long: DataFrame, lags: Sequence[int] = (1, 5, 20), value: str = "value") -> DataFrame:
    return long.withColumns({f"delta_{n}obs": W.delta(F.col(value), n) for n in lags})


def with_zscore(long: DataFrame, n: int = ZSCORE, value: str = "value") -> DataFrame:
    parts = W.moments(F.col(value), n, "__z")
    return long.withColumns(parts).withColumn(f"zscore_{n}obs", W.zscore(F.col(value), n, "__z")).drop(*parts)


def with_momentum(long: DataFrame, pairs: Sequence[tuple[int, int]] = MOMENTUM, value: str = "value") -> DataFrame:
    """Positive autocorrelation of one-step changes; changes, lagged changes and each window's sums are made once, then used by name."""
    kept = long.columns
    long = long.withColumn("__change", W.delta(F.col(value), 1))
    long = long.withColumns({f"__change_{h}": W.lagged(F.col("__change"), h) for h in {h for h, _ in pairs}})
    parts = {}
    for h, w in pairs:
        parts |= W.moments(F.col("__change"), w, f"__x_{w}") | W.moments(F.col(f"__change_{h}"), w, f"__y_{h}_{w}")
        parts[f"__c_{h}_{w}"] = F.covar_pop(F.col("__change"), F.col(f"__change_{h}")).over(W.trailing(w))
    parts = {k: v for k, v in parts.items() if not k.endswith("_mean")}
    long = long.withColumns(parts)
    return long.select(*kept, *[W.autocorrelation(F.col(f"__c_{h}_{w}"), f"__x_{w}", f"__y_{h}_{w}", w).alias(f"momentum_autocorr_{h}_{w}obs") for h, w in pairs])


def with_returns(long: DataFrame, windows: Sequence[int] = RETURNS, value: str = "value") -> DataFrame:
    """Compounded return of each window in per cent."""
    long = long.withColumn("__step", W.step_return(F.col(value)))
    return long.withColumns({f"return_geom_{w}obs_pct": W.compound_return(F.col(value), F.col("__step"), w) for w in windows}).drop("__step")


def with_mean_returns(long: DataFrame, windows: Sequence[int] = RETURNS, value: str = "value") -> DataFrame:
    """Geometric mean return a step of each window in per cent."""
    long = long.withColumn("__step", W.step_return(F.col(value)))
    return long.withColumns({f"return_mean_{w}obs_pct": W.mean_return(F.col(value), F.col("__step"), w) for w in windows}).drop("__step")


def long_features(silver: DataFrame) -> DataFrame:
    """All features of all series: one shuffle by series, one sort, and windows over it."""
    long = silver.select("series_id", "observation_date", "value")
    long = with_returns(with_momentum(with_zscore(with_deltas(long))))
    return long.withColumn("level", F.col("value")).drop("value")


def wide(long: DataFrame, series: Sequence[str], features: Sequence[str] = LONG_FEATURES) -> DataFrame:
    """One row a day with columns {series}_{feature}; days on which no series has a row don't occur."""
    # of plain columns Spark pivots in two small aggregations; a struct a series, tried instead, takes half as long again
    return long.groupBy(midnight(F.col("observation_date")).alias("timestamp_m1")).pivot("series_id", list(series)).agg(*[F.first(f).alias(f) for f in features])


def _between(names: dict[str, tuple[str, str]], how) -> dict[str, Column]:
    return {name: how(F.col(f"{a}_level"), F.col(f"{b}_level")) for name, (a, b) in names.items()}


def with_cross_series(frame: DataFrame) -> DataFrame:
    """Ratios, spreads and slopes between series of the same day; null where one of the two is missing."""
    minus = lambda a, b: a - b
    there = lambda names: {k: v for k, v in names.items() if {f"{s}_level" for s in v} <= set(frame.columns)}
    return frame.withColumns(_between(there(RATIOS), safe_ratio) | _between(there(SPREADS), minus) | _between(there(SLOPES), minus))


def family(long: DataFrame, series: Sequence[str]) -> DataFrame:
    """The frame of one family: its own columns in their fixed order."""
    columns = (VOLATILITY_BASE if tuple(series) == VOLATILITY else MACRO_BASE) + momentum_columns(series) + return_columns(series)
    frame = with_cross_series(wide(long.where(F.col("series_id").isin(*series)), series))
    return frame.select("timestamp_m1", *[nan_to_null(F.col(c)).alias(c) for c in columns])


def assemble(long: DataFrame) -> DataFrame:
    """The wide frame of both families: 166 columns in their fixed order, without NaN."""
    frame = with_cross_series(wide(long, (*VOLATILITY, *MACRO)))
    return frame.select("timestamp_m1", *[nan_to_null(F.col(c)).alias(c) for c in WIDE_COLUMNS[1:]])


def join_families(volatility: DataFrame, macro: DataFrame) -> DataFrame:
    """The same frame from two family frames made apart."""
    return volatility.join(macro, "timestamp_m1", "full").select(*WIDE_COLUMNS)


def infinite_cells(frame: DataFrame) -> DataFrame:
    """(cells): how many values are neither null nor finite."""
    doubles = [c for c, t in frame.dtypes if t == "double"]
    bad = [F.coalesce(F.sum(F.when(F.col(c).isNotNull() & ~finite(F.col(c)), 1)), F.lit(0)) for c in doubles]
    return frame.select(sum(bad[1:], bad[0]).cast("long").alias("cells"))
