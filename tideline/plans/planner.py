"""What to fetch: bootstrap without history, else a window that overlaps the newest stored days, or all on explicit wish."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.registry import Series

OVERLAP_DAYS = 7


class PlanError(ValueError):
    """A fetch that can't be planned."""


@dataclass(frozen=True)
class Fetch:
    """One series' fetch: what to ask the provider for, and which days of its answer count."""

    mode: str
    request_start: date | None
    request_end: date
    maximum_history: bool
    filter_start: date | None = None
    filter_end: date | None = None

    def __post_init__(self):
        if self.mode == "update" and not self.filter_start:
            raise PlanError("an update needs a start")
        if self.mode != "update" and not self.maximum_history:
            raise PlanError(f"a {self.mode} takes all history")
        if self.request_start and self.request_start > self.request_end:
            raise PlanError("a request starts after its end")


def choose_mode(newest: date | None, reconcile: bool = False) -> str:
    if newest is None:
        if reconcile:
            raise PlanError("nothing is stored that could be reconciled")
        return "bootstrap"
    return "reconcile" if reconcile else "update"


def plan(series: Series, newest: date | None, today: date, reconcile: bool = False, overlap_days: int = OVERLAP_DAYS) -> Fetch:
    """The fetch of one series, from the newest day that is stored."""
    if overlap_days < 0:
        raise PlanError("an overlap can't be negative")
    mode = choose_mode(newest, reconcile)
    if newest is not None and today < newest:
        raise PlanError("today is before the newest stored day")
    if mode != "update":
        return Fetch(mode, None, today, True)
    start = newest - timedelta(days=overlap_days)
    return Fetch(mode, start if series.capability == "date_range" else None, today, False, start, today)


def plan_frame(registered: DataFrame, bounds: DataFrame, today: date, overlap_days: int = OVERLAP_DAYS) -> DataFrame:
    """The same for all series at once: bounds has series_id and maximum. Series whose newest day is after today fail the job."""
    newest = F.when(F.col("maximum") > F.lit(today), F.raise_error(F.lit("today is before the newest stored day")).cast("date")).otherwise(F.col("maximum"))
    rows = registered.join(bounds.select("series_id", "maximum"), "series_id", "left").withColumn("newest", newest)
    start = F.date_sub("newest", overlap_days)
    return rows.select(
        "series_id",
        F.when(F.col("newest").isNull(), "bootstrap").otherwise("update").alias("mode"),
        F.when(F.col("capability") == "date_range", start).alias("request_start"),
        F.lit(today).alias("request_end"),
        F.col("newest").isNull().alias("maximum_history"),
        start.alias("filter_start"),
        F.when(F.col("newest").isNotNull(), F.lit(today)).alias("filter_end"),
    )


def in_window(day: Column, start: date | None, end: date | None) -> Column:
    """Whether a day lies within a window whose ends count and may be open."""
    return (F.lit(True) if start is None else day >= F.lit(start)) & (F.lit(True) if end is None else day <= F.lit(end))


def apply_window(rows: DataFrame, fetch: Fetch, on_late: str, day: str = "observation_date") -> DataFrame:
    """Rows within the fetch's window. Those outside are dropped (a source that always sends all) or fail (one that was asked for a range)."""
    inside = in_window(F.col(day), fetch.filter_start, fetch.filter_end)
    if on_late == "fail":
        if n := rows.where(~inside).count():
            raise PlanError(f"{n} rows lie outside the window asked for")
        return rows
    return rows.where(inside)
