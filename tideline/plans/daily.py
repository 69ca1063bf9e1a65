"""The daily chain: ingest, long table, wide frame, snapshot, retention and inventory."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Row

from tideline import registry
from tideline.operators import features, quality
from tideline.plans import ingest
from tideline.plans.publish import Publisher, input_records
from tideline.sources.lake import Lake


class SourceFailure(RuntimeError):
    """Some series failed; the good ones are stored."""

    def __init__(self, outcome: ingest.Outcome):
        super().__init__("; ".join(f"{k}: {v}" for k, v in outcome.failed.items()))
        self.outcome = outcome


def require_all(outcome: ingest.Outcome) -> ingest.Outcome:
    if outcome.failed:
        raise SourceFailure(outcome)
    return outcome


def gold_frame(lake: Lake) -> tuple[DataFrame, list[dict]]:
    """The wide frame of all registered series, whichever were updated, and what it is made from."""
    silver = lake.silver.read()
    quality.require(quality.silver_checks(silver), "long table")
    return features.assemble(features.long_features(silver)), input_records(silver)


def build_gold(publisher: Publisher) -> Row:
    frame, inputs = gold_frame(publisher.lake)
    return publisher.publish(frame, inputs)


class Maintenance(RuntimeError):
    """A reconstruction is under way."""


def maintenance(lake: Lake) -> str:
    """A file that is there while daily runs are refused."""
    return lake.files.path("maintenance")


def run_daily(ingestion: ingest.Ingestion, publisher: Publisher, today: date, series: Sequence[str] = ()) -> Row:
    """A failed series ends the run before the long table is touched, as does a stored file with other columns than its table's."""
    if publisher.lake.files.exists(maintenance(publisher.lake)):
        raise Maintenance("a reconstruction is under way")
    publisher.reconcile()
    chosen = registry.selected(series)
    require_all(ingestion.run_many(chosen, today))
    for series_id in chosen:
        s = registry.series(series_id)
        publisher.lake.bronze[s.shape].check_files(provider=s.provider, series_id=s.series_id)
    ingest.build_silver(publisher.lake, chosen)
    row = build_gold(publisher)
    publisher.retain()
    ingest.refresh_inventory(publisher.lake)
    return row
