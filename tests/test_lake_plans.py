import io
import json
import os
from datetime import UTC, date, datetime, timedelta

import pytest
from helpers import Clock
from pyspark.sql import functions as F

from tideline import cli, registry, schemas
from tideline.operators import features
from tideline.operators.catalog import CatalogError, resolve_latest, resolve_strict
from tideline.operators.quality import QualityError
from tideline.plans import daily, ingest, planner
from tideline.plans.publish import DATASET, Publisher
from tideline.plans.serve import Replica, Sync, SyncError
from tideline.sources.lake import Lake, SmallTable

TODAY = date(2020, 3, 1)


def scalar(spark, values: dict, at=datetime(2024, 1, 1, tzinfo=UTC), s="us_2y"):
    x = registry.series(s)
    return spark.createDataFrame([(s, x.provider, d, at, x.source_id, "u", v) for d, v in values.items()], schemas.BRONZE_SCALAR)


def stamps(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) if "_staging" not in d for f in fs if f.endswith(".parquet")}


def test_monthly_upsert_touches_only_changed_months(spark, tmp_path):
    table = Lake(spark, str(tmp_path)).bronze["scalar"]
    first = table.upsert(scalar(spark, {date(2020, 1, 5): 1.0, date(2020, 2, 5): 2.0}))
    assert (first["inserted"], first["months"]) == (2, 2)
    before = stamps(tmp_path)
    later = datetime(2024, 2, 1, tzinfo=UTC)
    done = table.upsert(scalar(spark, {date(2020, 1, 5): 1.5, date(2020, 2, 5): 2.0}, later))
    assert done == {"inserted": 0, "revised": 1, "unchanged": 1, "months": 1}
    after = stamps(tmp_path)
    assert {p for p in before if "month=02" in p} == {p for p in after if "month=02" in p} and all(before[p] == after[p] for p in after if "month=02" in p)
    kept = {r.observation_date: r.fetched_at_utc for r in table.read().collect()}
    assert kept[date(2020, 2, 5)] < kept[date(2020, 1, 5)]
    assert table.upsert(scalar(spark, {date(2020, 2, 5): 2.0}, later))["months"] == 0 and stamps(tmp_path) == after
    assert table.read().count() == 2 and table.newest(series_id="us_2y") == date(2020, 2, 5)
    with pytest.raises(ValueError):
        table.upsert(scalar(spark, {date(2020, 2, 5): 2.0}).union(scalar(spark, {date(2020, 2, 5): 3.0})))


def test_a_failure_after_the_write_restores_the_months(spark, tmp_path):
    table = Lake(spark, str(tmp_path)).bronze["scalar"]
    table.upsert(scalar(spark, {date(2020, 1, 5): 1.0}))

    def fail(counts):
        raise RuntimeError("record")

    with pytest.raises(RuntimeError):
        table.upsert(scalar(spark, {date(2020, 1, 5): 5.0, date(2020, 7, 1): 7.0}), fail)
    assert [(r.observation_date, r.value) for r in table.read().collect()] == [(date(2020, 1, 5), 1.0)]


def test_small_tables_replace_and_upsert(spark, tmp_path):
    table = SmallTable(spark, str(tmp_path / "t"), schemas.INVENTORY, ["series_id"])
    assert table.read().isEmpty()
    row = lambda s, n: spark.createDataFrame([(s, "p", None, None, n, 0, 0)], schemas.INVENTORY)
    for s, n in (("a", 1), ("b", 2), ("a", 3)):
        table.upsert(row(s, n))
    assert [(r.series_id, r.row_count) for r in table.read().collect()] == [("a", 3), ("b", 2)]
    assert sorted(n for n in os.listdir(tmp_path / "t") if not n.startswith("rows-")) == [f"commit-00000000{k}" for k in (1, 2, 3)]


def inventory_row(spark, s, n):
    return spark.createDataFrame([(s, "p", None, None, n, 0, 0)], schemas.INVENTORY)


def test_two_writers_of_a_small_table_lose_nothing(spark, tmp_path, monkeypatch):
    one, two = (SmallTable(spark, str(tmp_path / "t"), schemas.INVENTORY, ["series_id"]) for _ in range(2))
    one.upsert(inventory_row(spark, "a", 1))
    publish, between = one.files.publish, [lambda: two.upsert(inventory_row(spark, "b", 2)), lambda: two.update(lambda now: now.withColumn("row_count", F.col("row_count") + 10))]

    def late(path, content):  # another writer's commit comes after this one has read and before it publishes
        if between and "commit-" in path:
            between.pop(0)()
        return publish(path, content)

    monkeypatch.setattr(one.files, "publish", late)
    one.upsert(inventory_row(spark, "c", 3))
    held = lambda: [(r.series_id, r.row_count) for r in two.read().collect()]
    assert held() == [("a", 11), ("b", 12), ("c", 3)] and not between
    between.append(lambda: two.upsert(inventory_row(spark, "d", 4)))
    one.update(lambda now: now.withColumn("row_count", F.col("row_count") + 1))
    assert held() == [("a", 12), ("b", 13), ("c", 4), ("d", 5)]
    assert not one.update(lambda now: None) and held() == [("a", 12), ("b", 13), ("c", 4), ("d", 5)]
    monkeypatch.setattr(one.files, "publish", publish)
    # a writer that slept through all the commits that are kept doesn't take an old number for a free one
    monkeypatch.setattr(SmallTable, "KEPT", 2)
    two.upsert(inventory_row(spark, "e", 5))
    newest = one._newest()[0]
    assert not one._commit(newest - 5, []) and one._newest()[0] == newest and len(held()) == 5


def test_upserts_write_their_own_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(SmallTable, "FAN_IN", 3)
    table = SmallTable(spark, str(tmp_path / "t"), schemas.INVENTORY, ["series_id"])
    written, write = [], table._write
    monkeypatch.setattr(table, "_write", lambda rows: written.append(rows.count()) or write(rows))
    for k in range(10):
        table.upsert(inventory_row(spark, f"s{k}", k))
    assert table.read().count() == 10 and len(table._newest()[1]) <= 4
    assert sum(written) <= 10 * 3 and sorted(written)[-2:] == [3, 9]  # 9 rows are written once for themselves, in threes, and together


def test_a_replaced_file_is_never_missing(spark, tmp_path):
    import threading

    files, missed, ended = Lake(spark, str(tmp_path)).files, [], threading.Event()
    path = files.path("view")
    files.write(path, "0")

    def look():
        while not ended.is_set():
            try:
                with open(tmp_path / "view") as file:
                    if not file.read():
                        missed.append("empty")
            except OSError as error:
                missed.append(error)

    reader = threading.Thread(target=look)
    reader.start()
    for k in range(200):
        files.write(path, str(k))
    ended.set()
    reader.join()
    assert not missed and files.read(path) == "199" and os.listdir(tmp_path) == ["view"]
    assert not files.publish(path, "other") and files.read(path) == "199" and files.publish(files.path("new"), "x") and sorted(os.listdir(tmp_path)) == ["new", "view"]


def test_files_with_other_columns_are_named(spark, tmp_path):
    table = Lake(spark, str(tmp_path)).bronze["scalar"]
    table.check_files()
    table.upsert(scalar(spark, {date(2020, 1, 5): 1.0, date(2020, 2, 5): 2.0}))
    table.check_files()
    month = f"{table.files.root}/provider={registry.series('us_2y').provider}/series_id=us_2y/year=2020/month=02"
    good = spark.read.parquet(month)
    held = spark.createDataFrame(good.collect(), good.schema)
    for spoilt in (held.withColumn("value", F.col("value").cast("string")), held.drop("value"), held.withColumn("more", F.lit(1))):
        spoilt.write.mode("overwrite").parquet(month)
        with pytest.raises(TypeError, match="year=2020/month=02"):
            table.check_files(series_id="us_2y", provider=registry.series("us_2y").provider)


def test_a_lock_is_its_writers_own(spark, tmp_path):
    replica, now = Replica(spark, str(tmp_path / "r")), datetime(2024, 1, 1, tzinfo=UTC)
    path = replica.files.path("lock")
    with pytest.raises(SyncError, match="locked"), replica.locked(lambda: now):
        with replica.locked(lambda: now):
            pass
    assert not replica.files.exists(path)
    with replica.locked(lambda: now):  # it takes so long that another takes over; what is the other's stays
        later = replica.locked(lambda: now + timedelta(hours=13))
        later.__enter__()
    assert replica.files.exists(path)
    later.__exit__(None, None, None)
    assert not replica.files.exists(path)


def test_reconstruction_goes_on_where_it_was_killed(spark, tmp_path, monkeypatch):
    from tideline.plans import reconstruct
    from tideline.plans.database import DatabaseReplica
    from tideline.sources.database import Database

    lake, clock = Lake(spark, str(tmp_path / "lake")), Clock()
    ingestion, publisher = ingest.Ingestion(lake, source(spark, clock), clock), Publisher(lake, clock)
    daily.run_daily(ingestion, publisher, TODAY)
    replica = DatabaseReplica(spark, Database.of("sqlite3", database=str(tmp_path / "db")))
    replica.migrate()
    work = lambda: reconstruct.Reconstruction(ingestion, publisher, Sync(publisher, replica, clock), TODAY, clock=clock)
    assert [x["status"] for x in work().run()] == ["PLANNED"] * 12 and not lake.files.exists(lake.files.path("maintenance"))
    monkeypatch.setattr(reconstruct.Reconstruction, "_schema", lambda self: 1 / 0)
    killed = work().run(execute=True)
    assert [(x["step"], x["status"]) for x in killed] == [(s, "PASS") for s in reconstruct.STEPS[:7]] + [("schema", "FAIL")]
    with pytest.raises(daily.Maintenance):
        daily.run_daily(ingestion, publisher, TODAY)
    monkeypatch.undo()
    monkeypatch.setattr(reconstruct.Reconstruction, "_reconcile", lambda self: 1 / 0)  # isn't done again
    done = work().run(execute=True)
    assert [x["status"] for x in done] == ["PASSED BEFORE"] * 7 + ["PASS"] * 5 and done[6]["result"] == publisher.lake.catalog.read().where("current").first().build_id
    assert not lake.files.exists(lake.files.path("maintenance")) and work().journal.passed() == {} and Sync(publisher, replica, clock).verify()["status"] == "PASS"
    with pytest.raises(SyncError, match="next step"):
        work().journal.mark("gold", None)
    out = io.StringIO()
    args = ["--root", str(tmp_path / "lake"), "--database", f'sqlite3:{json.dumps({"database": str(tmp_path / "db")})}']
    assert cli.main([*args, "verify"], spark, out=out) == cli.OK and cli.main([*args, "migrate"], spark, out=out) == cli.OK
    assert cli.main([*args, "reconstruct-all"], spark, out=out) == cli.OK and len(json.loads(out.getvalue().splitlines()[-1])) == 12


def test_paths_stay_inside(spark, tmp_path):
    files = Lake(spark, str(tmp_path)).files
    for bad in ("..", "a/../b", "/x", "a b"):
        with pytest.raises(ValueError):
            files.path(bad)


def test_planner(spark):
    ranged, full = registry.series("us_2y"), registry.series("vix")
    update = planner.plan(ranged, date(2026, 8, 18), date(2026, 8, 19))
    assert (update.request_start, update.filter_start, update.filter_end) == (date(2026, 8, 11), date(2026, 8, 11), date(2026, 8, 19))
    assert planner.plan(full, date(2026, 8, 18), date(2026, 8, 19)).request_start is None
    assert planner.plan(full, None, TODAY).maximum_history and planner.plan(full, TODAY, TODAY, True).mode == "reconcile"
    for bad in (lambda: planner.plan(full, None, TODAY, True), lambda: planner.plan(full, TODAY, TODAY - timedelta(days=1)), lambda: planner.plan(full, TODAY, TODAY, overlap_days=-1), lambda: planner.Fetch("update", None, TODAY, False)):
        with pytest.raises(planner.PlanError):
            bad()


def source(spark, clock, n=65, change=0.0, only=None, fail=()):
    """Every series has n days up to TODAY; the last one can be changed."""

    def fetch(series, plan):
        if series.series_id in fail:
            raise OSError("no route with key=hunter2")
        k = list(registry.SERIES).index(series.series_id)
        rows = []
        for i in range(n):
            day, v = TODAY - timedelta(days=n - 1 - i), 10.0 + k + i + (change if i == n - 1 else 0.0)
            if plan.request_start and day < plan.request_start:
                continue
            rows.append((series.series_id, series.provider, day, clock(), series.source_id, "u", *((v, v + 1, v - 1, v) if series.shape == "ohlc" else (v,))))
        return spark.createDataFrame(rows, schemas.bronze(series.shape))

    return fetch


def test_ingestion_records_success_and_failure(spark, tmp_path):
    lake, clock = Lake(spark, str(tmp_path)), Clock()
    run = ingest.Ingestion(lake, source(spark, clock, fail=("estr",)), clock, secrets=["hunter2"])
    outcome = run.run_many(["us_2y", "estr"], TODAY)
    assert outcome.done["us_2y"]["inserted"] == 65 and "hunter2" not in outcome.failed["estr"]
    runs = {r.series_id: r for r in lake.runs.read().collect()}
    assert (runs["us_2y"].status, runs["estr"].status, runs["us_2y"].mode) == ("success", "failed", "bootstrap")
    assert "hunter2" not in runs["estr"].error_message
    state = lake.state.read().collect()
    assert [(r.series_id, r.last_observed_date, r.changed_row_count, r.last_reconcile_utc) for r in state] == [("us_2y", TODAY, 65, None)]
    again = run.run("us_2y", TODAY)
    assert again == {"inserted": 0, "revised": 0, "unchanged": 8, "months": 0}
    revised = ingest.Ingestion(lake, source(spark, clock, change=5.0), clock).run("us_2y", TODAY)
    assert revised["revised"] == 1
    ingest.Ingestion(lake, source(spark, clock, n=3), clock).run("us_2y", TODAY, reconcile=True)
    assert lake.bronze["scalar"].read().count() == 65
    assert lake.state.read().first().last_reconcile_utc is not None
    early = ingest.Ingestion(lake, lambda s, p: source(spark, clock)(s, planner.Fetch("bootstrap", None, TODAY, True)), clock)
    with pytest.raises(planner.PlanError):
        early.run("us_2y", TODAY)


def test_daily_chain_publication_serving_and_cli(spark, tmp_path):
    lake, clock = Lake(spark, str(tmp_path / "lake")), Clock()
    publisher = Publisher(lake, clock, keep=1)
    with pytest.raises(daily.SourceFailure):
        daily.run_daily(ingest.Ingestion(lake, source(spark, clock, fail=("vix",)), clock), publisher, TODAY, ("us_2y", "vix"))
    assert lake.silver.read().isEmpty() and lake.bronze["scalar"].read().count() > 0
    row = daily.run_daily(ingest.Ingestion(lake, source(spark, clock), clock), publisher, TODAY)
    assert row.current and row.row_count == 65 and publisher.validate(row).count() == 65
    manifest = json.loads(lake.files.read(row.build_manifest_path))
    assert [x["series_id"] for x in manifest["inputs"]] == list(registry.SERIES) and manifest["dataset_id"] == DATASET
    assert {r.file_count > 0 for r in lake.inventory.read().collect()} == {True}

    replica = Replica(spark, str(tmp_path / "replica"))
    sync = Sync(publisher, replica, clock)
    first = sync.run()
    assert (first.inserted, first.updated, first.deleted, first.unchanged) == (65, 0, 0, 0)
    assert sync.verify()["status"] == "PASS"
    assert sync.run().unchanged == 65

    second = daily.run_daily(ingest.Ingestion(lake, source(spark, clock, change=3.0), clock), publisher, TODAY, ("vix",))
    assert second.build_id != row.build_id
    records = {r.build_id: r for r in lake.catalog.read().collect()}
    assert records[row.build_id].pruned_at_utc is not None and records[row.build_id].data_path is None and not lake.files.exists(publisher.folder(row.build_id))
    assert sync.verify()["status"] == "FAIL"
    moved = sync.run()
    assert (moved.inserted, moved.updated, moved.deleted) == (0, 1, 0) and sync.verify()["status"] == "PASS"

    # tampering shows
    folder = replica._states()[-1]
    spoilt = replica.rows().withColumn("vix_level", F.col("vix_level") + 1).collect()
    schema = replica.rows().schema
    spark.createDataFrame(spoilt, schema).write.mode("overwrite").parquet(replica.files.path(folder, "rows"))
    assert "consumer" in sync.verify()["failed"]
    with pytest.raises(SyncError, match="rows differ"):
        sync.run()
    replica.files.create(replica.files.path("lock"), "x")
    with pytest.raises(SyncError, match="locked"):
        sync.run()
    replica.files.delete(replica.files.path("lock"))

    out = io.StringIO()
    args = ["--root", str(tmp_path / "lake"), "--replica", str(tmp_path / "replica"), "--today", str(TODAY)]
    assert cli.main([*args, "verify"], spark, out=out) == cli.PIPELINE
    assert cli.main([*args, "reconstruct"], spark, out=out) == cli.OK
    assert [(x["step"], x["status"]) for x in json.loads(out.getvalue().splitlines()[-1])] == [("source", "PASS"), ("rebuild", "PLANNED"), ("verify", "PLANNED")]
    assert cli.main([*args, "verify"], spark, out=out) == cli.PIPELINE
    replica.files.create(replica.files.path("lock"), datetime.now(UTC).isoformat())
    assert cli.main([*args, "reconstruct", "--execute"], spark, out=out) == cli.PIPELINE and replica.rows() is not None
    assert [x["status"] for x in json.loads(out.getvalue().splitlines()[-1])] == ["PASS", "FAIL"]
    replica.files.write(replica.files.path("lock"), datetime(2020, 1, 1, tzinfo=UTC).isoformat())  # of a writer that crashed
    assert cli.main([*args, "reconstruct", "--execute"], spark, out=out) == cli.OK
    assert cli.main([*args, "inventory", "--json", "--series", "vix"], spark, out=out) == cli.OK
    assert json.loads(out.getvalue().splitlines()[-1])["row_count"] == 65
    assert cli.main([*args, "inventory", "--series", "nope"], spark, out=out) == cli.INPUT
    assert cli.main([*args, "nothing"], spark) == cli.INPUT
    assert cli.main([*args, "update", "--series", "vix"], spark, fetch=source(spark, clock, fail=("vix",))) == cli.SOURCE

    # a snapshot that breaks a rule leaves a failed row and the old one current
    with pytest.raises(QualityError):
        publisher.publish(publisher.read(second).withColumn("vix_level", F.lit(float("inf"))))
    catalog = lake.catalog.read()
    assert catalog.where("status = 'failed'").count() == 1 and resolve_strict(catalog, 4, 3).first().build_id == second.build_id
    # and one that a crash left building is failed by the next run
    lake.catalog.replace(catalog.unionByName(spark.createDataFrame([(DATASET, "20300101T000000Z", "building", False, clock(), None, 4, 3, *[None] * 7)], schemas.CATALOG)))
    assert publisher.reconcile().where("status = 'building'").isEmpty()
    assert resolve_latest(lake.catalog.read(), 4, 3).first().build_id == second.build_id
    assert resolve_latest(lake.catalog.read(), 5, 3).isEmpty()


def test_rules_of_resolution(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    with pytest.raises(CatalogError):
        Sync(Publisher(lake), Replica(spark, str(tmp_path / "r"))).run()
    with pytest.raises(QualityError):
        daily.gold_frame(lake)
    assert cli.redacted({"a": ["k=abc"], "b": 1}, ["abc"]) == {"a": ["k=***"], "b": 1}
    assert features.SCHEMA_VERSION == 4
