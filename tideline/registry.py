"""The registered daily series: what each is, where it comes from, and how it can be fetched."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession

PROVIDERS = ("cboe", "stoxx", "yahoo", "ecb", "fred")
SHAPES = ("ohlc", "scalar")
CAPABILITIES = ("date_range", "full_file")


@dataclass(frozen=True)
class Series:
    series_id: str
    provider: str
    source_id: str
    unit: str
    shape: str
    capability: str
    frequency: str = "daily"
    bootstrap: str = "maximum_exposed_history"

    def __post_init__(self):
        for name in ("series_id", "source_id", "unit"):
            if not getattr(self, name).strip():
                raise ValueError(f"{name} must not be empty")
        for name, known in (("provider", PROVIDERS), ("shape", SHAPES), ("capability", CAPABILITIES), ("frequency", ("daily",))):
            if getattr(self, name) not in known:
                raise ValueError(f"{name} must be one of {', '.join(known)}")


# The public identifiers of the series at their providers.
_ROWS = """
vix          cboe   VIX_History.csv                  index_points  ohlc    full_file
vix9d        cboe   VIX9D_History.csv                index_points  ohlc    full_file
vix3m        cboe   VIX3M_History.csv                index_points  ohlc    full_file
vix6m        cboe   VIX6M_History.csv                index_points  ohlc    full_file
vix1y        cboe   VIX1Y_History.csv                index_points  ohlc    full_file
vstoxx       stoxx  V2TX                             index_points  scalar  full_file
move         yahoo  ^MOVE                            index_points  ohlc    date_range
ciss         ecb    CISS.D.U2.Z0Z.4F.EC.SS_CIN.IDX   index         scalar  date_range
estr         ecb    EST.B.EU000A2X2A25.WT            percent       scalar  date_range
euro_hy_oas  fred   BAMLHE00EHYIOAS                  percent       scalar  date_range
us_2y        fred   DGS2                             percent       scalar  date_range
us_10y       fred   DGS10                            percent       scalar  date_range
usd_broad    fred   DTWEXBGS                         index         scalar  date_range
"""


def registered(series: Sequence[Series]) -> dict[str, Series]:
    """By id; an id that occurs twice raises."""
    by_id = {s.series_id: s for s in series}
    if len(by_id) < len(series):
        raise ValueError("a series id is registered twice")
    return by_id


SERIES = registered([Series(*line.split()) for line in _ROWS.strip().splitlines()])


def series(series_id: str) -> Series:
    if series_id not in SERIES:
        raise KeyError(f"unknown series: {series_id}")
    return SERIES[series_id]


def selected(ids: Sequence[str] = ()) -> list[str]:
    """The ids asked for, all if none are; unknown and repeated ids raise."""
    if len(set(ids)) < len(ids):
        raise ValueError("a series is selected twice")
    for x in ids:
        series(x)
    return list(ids) or list(SERIES)


def registry_frame(spark: SparkSession) -> DataFrame:
    """The registry as a table; it is as small as the list above."""
    return spark.createDataFrame([astuple(s) for s in SERIES.values()], "series_id string, provider string, source_id string, unit string, shape string, capability string, frequency string, bootstrap string")
