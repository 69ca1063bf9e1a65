"""Command line: python -m tideline.cli --root LAKE COMMAND."""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys
from collections.abc import Callable, Sequence
from datetime import UTC, date, datetime

from tideline import registry
from tideline.operators.catalog import CatalogError
from tideline.operators.quality import QualityError
from tideline.plans import daily, ingest, planner
from tideline.plans.database import DatabaseReplica
from tideline.plans.publish import Publisher
from tideline.plans.reconstruct import Reconstruction
from tideline.plans.serve import Replica, Sync, SyncError
from tideline.session import session
from tideline.sources import providers
from tideline.sources.database import Database, DatabaseError
from tideline.sources.http import TransportError
from tideline.sources.lake import Lake
from tideline.sources.payloads import PayloadError, observations

OK, INPUT, SOURCE, PIPELINE = 0, 2, 10, 20
_log = logging.getLogger("tideline")


#: The commands, and which of them take --series, --provider, --json and --execute.
COMMANDS = {
    "bootstrap": ["series"], "update": ["series"], "reconcile": ["series"], "silver-build": ["series"], "run-daily": ["series"], "gold-build": [], "sync": [], "verify": [], "reconstruct": ["execute"], "reconstruct-all": ["execute"], "migrate": [], "inventory": ["json", "series", "provider"],
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tideline")
    top.add_argument("--root", default="lake")
    top.add_argument("--replica", default="replica", help="folder of the replica")
    top.add_argument("--database", help="a database instead of that folder: the DB-API module, a colon, and JSON of what its connect takes; an argument env:NAME is taken from the environment")
    top.add_argument("--landing", default="landing", help="folder of payloads, one file or folder named by series")
    top.add_argument("--fetch", action="store_true", help="ask the providers, and keep their answers in the landing folder")
    top.add_argument("--today", type=date.fromisoformat)
    top.add_argument("--overlap-days", type=int, default=planner.OVERLAP_DAYS)
    commands = top.add_subparsers(dest="command", required=True)
    for name, options in COMMANDS.items():
        command = commands.add_parser(name)
        for option in options:
            command.add_argument(f"--{option}", **({"action": "store_true"} if option in ("json", "execute") else {"action": "append", "default": []}))
    return top


def redacted(value, secrets: Sequence[str]):
    """A value for the log, with secrets replaced at any depth."""
    if isinstance(value, dict):
        return {k: redacted(v, secrets) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [redacted(v, secrets) for v in value]
    if isinstance(value, str):
        for s in filter(None, secrets):
            value = value.replace(s, "***")
    return value


def log_event(event: str, secrets: Sequence[str] = (), **fields) -> None:
    _log.info(json.dumps(redacted({"event": event, **fields}, secrets), sort_keys=True, default=str))


def landed_fetcher(spark, folder: str, clock: Callable[[], datetime]) -> ingest.Fetcher:
    """Payloads that another process has put into a folder, under each series' id."""
    return lambda series, plan: observations(spark, series, f"{folder}/{series.series_id}", clock(), f"{folder}/{series.series_id}")


def replica(args: argparse.Namespace, spark) -> Replica | DatabaseReplica:
    if not args.database:
        return Replica(spark, args.replica)
    driver, _, arguments = args.database.partition(":")
    return DatabaseReplica(spark, Database.of(driver, **json.loads(arguments)))


def dispatch(args: argparse.Namespace, spark, clock: Callable[[], datetime] = lambda: datetime.now(UTC), fetch: ingest.Fetcher | None = None, out=sys.stdout) -> int:
    lake = Lake(spark, args.root)
    keys = {name: os.environ[f"{name.upper()}_API_KEY"] for name, asked in providers.PROVIDERS.items() if asked.key and os.environ.get(f"{name.upper()}_API_KEY")}
    fetch = fetch or (providers.fetcher(spark, args.landing, clock, keys) if args.fetch else landed_fetcher(spark, args.landing, clock))
    ingestion = ingest.Ingestion(lake, fetch, clock, args.overlap_days, secrets=[*keys.values()])
    publisher = Publisher(lake, clock)
    today = args.today or clock().date()
    if args.command in ("bootstrap", "update", "reconcile"):
        daily.require_all(ingestion.run_many(registry.selected(args.series), today, args.command == "reconcile"))
    elif args.command == "run-daily":
        daily.run_daily(ingestion, publisher, today, args.series)
    elif args.command == "silver-build":
        ingest.build_silver(lake, registry.selected(args.series))
    elif args.command == "gold-build":
        daily.build_gold(publisher)
    elif args.command == "sync":
        print(json.dumps(vars(Sync(publisher, replica(args, spark), clock).run())), file=out)
    elif args.command == "migrate":
        if not args.database:
            raise ValueError("only a database is migrated")
        print(json.dumps(replica(args, spark).migrate(clock)), file=out)
    elif args.command == "verify":
        report = Sync(publisher, replica(args, spark), clock).verify()
        print(json.dumps(report), file=out)
        return OK if report["status"] == "PASS" else PIPELINE
    elif args.command in ("reconstruct", "reconstruct-all"):
        sync = Sync(publisher, replica(args, spark), clock)
        steps = sync.reconstruct(args.execute) if args.command == "reconstruct" else Reconstruction(ingestion, publisher, sync, today, clock=clock).run(args.execute)
        print(json.dumps(steps, default=str), file=out)
        return OK if all(x["status"] != "FAIL" for x in steps) else PIPELINE
    else:
        rows = ingest.select_inventory(ingest.refresh_inventory(lake), args.series, args.provider)
        for r in (ingest.as_json if args.json else ingest.as_lines)(rows).toLocalIterator():
            print(r.line, file=out)
    return OK


def main(argv: Sequence[str] | None = None, spark=None, **options) -> int:
    try:
        args = parser().parse_args(argv)
    except SystemExit as stop:
        return OK if not stop.code else INPUT
    try:
        log_event("started", command=args.command)
        return dispatch(args, spark or session(), **options)
    except (KeyError, planner.PlanError) as error:
        code, kind = INPUT, type(error).__name__
    except (PayloadError, TransportError, daily.SourceFailure) as error:
        code, kind = SOURCE, type(error).__name__
    except (QualityError, CatalogError, SyncError, DatabaseError, daily.Maintenance, OSError, ValueError, TypeError) as error:
        code, kind = PIPELINE, type(error).__name__
    log_event("failed", command=args.command, kind=kind, code=code)
    return code


if __name__ == "__main__":
    sys.exit(main())
