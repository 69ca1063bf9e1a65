"""What providers are asked for, and fetching it: a request is built from data, its answer is landed, and Spark reads that."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import UTC, date, datetime, timedelta
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from tideline import schemas
from tideline.plans.planner import Fetch, PlanError
from tideline.registry import Series
from tideline.sources import http, payloads
from tideline.sources.lake import Files


def _iso(day: date) -> str:
    return day.isoformat()


def _epoch(day: date) -> str:
    return str(int(datetime(day.year, day.month, day.day, tzinfo=UTC).timestamp()))


def _epoch_after(day: date) -> str:
    """The end of a range that leaves its end out."""
    return _epoch(day + timedelta(days=1))


@dataclass(frozen=True)
class Provider:
    """How one provider is asked. start and end: a parameter's name and how it writes a day; without start a request can't be bounded."""

    url: str
    fixed: Mapping[str, str] = field(default_factory=dict)
    start: tuple[str, Callable[[date], str]] | None = None
    end: tuple[str, Callable[[date], str]] | None = None
    #: Parameters of a request for all history, of the series' id, and of the key.
    all_history: Mapping[str, str] = field(default_factory=dict)
    series: str | None = None
    key: str | None = None
    #: A source id's first dot parts two steps of the path.
    parted: bool = False
    #: Statuses with one of these words in the answer say that there is nothing for the window.
    nothing: tuple[tuple[int, ...], tuple[str, ...]] = ((), ())


# The providers' public endpoints and parameters.
PROVIDERS = {
    "cboe": Provider("https://cdn.cboe.com/api/global/us_indices/daily_prices/{id}"),
    "stoxx": Provider("https://www.stoxx.com/document/Indices/Current/HistoricalData/h_v2tx.txt"),
    "yahoo": Provider("https://query1.finance.yahoo.com/v8/finance/chart/{id}", {"interval": "1d", "events": "history", "includeAdjustedClose": "false"}, ("period1", _epoch), ("period2", _epoch_after), {"period1": "0"}),
    "ecb": Provider("https://data-api.ecb.europa.eu/service/data/{id}", {"format": "csvdata", "detail": "dataonly"}, ("startPeriod", _iso), ("endPeriod", _iso), parted=True, nothing=((404, 406), ("no record", "no result", "no data"))),
    "fred": Provider("https://api.stlouisfed.org/fred/series/observations", {"file_type": "json", "sort_order": "asc"}, ("observation_start", _iso), ("observation_end", _iso), series="series_id", key="api_key"),
}


def request(series: Series, plan: Fetch, keys: Mapping[str, str] | None = None) -> tuple[str, dict[str, str]]:
    """URL and query of a plan's request. keys: API keys by provider."""
    asked = PROVIDERS[series.provider]
    steps = series.source_id.split(".", 1) if asked.parted else [series.source_id]
    if asked.parted and len(steps) < 2:
        raise PlanError(f"{series.series_id}: the source id has no dot")
    query = dict(asked.fixed)
    if asked.series:
        query[asked.series] = series.source_id
    if asked.key:
        if not (key := (keys or {}).get(series.provider, "").strip()):
            raise PlanError(f"{series.provider} needs an API key")
        query[asked.key] = key
    if asked.start:
        if plan.mode == "update":
            if plan.request_start is None or plan.maximum_history:
                raise PlanError("an update needs a start and an end")
            query[asked.start[0]] = asked.start[1](plan.request_start)
        else:
            query |= asked.all_history
    if asked.end:
        query[asked.end[0]] = asked.end[1](plan.request_end)
    return asked.url.format(id="/".join(quote(x, safe="") for x in steps)), query


def is_nothing(provider: str, response: http.Response) -> bool:
    """Whether an error only says that there is nothing for the window."""
    statuses, words = PROVIDERS[provider].nothing
    return response.status in statuses and any(w in response.body.decode(errors="ignore").lower() for w in words)


def fetcher(spark: SparkSession, landing: str, clock: Callable[[], datetime], keys: Mapping[str, str] | None = None, **options) -> Callable[[Series, Fetch], DataFrame]:
    """A fetcher that asks the providers. Answers are kept below the landing folder, by series, as they came; options: http.fetch()'s."""
    files = Files(spark, landing)

    def fetch(series: Series, plan: Fetch) -> DataFrame:
        url, query = request(series, plan, keys)
        got = http.fetch(url, query, accepted=lambda r: r.status == 200 or is_nothing(series.provider, r), **options)
        if got.status != 200:
            return spark.createDataFrame([], schemas.bronze(series.shape))
        path = files.path(series.series_id, f"{clock():%Y%m%dT%H%M%S}-{uuid.uuid4().hex}")
        files.create(path, got.body)
        return payloads.observations(spark, series, path, clock(), http.endpoint(url))

    return fetch
