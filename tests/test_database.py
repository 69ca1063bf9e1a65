import json
import sqlite3
from datetime import UTC, datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tideline import schemas
from tideline.operators import contract, diff, serving
from tideline.plans import database as P
from tideline.plans.publish import DATASET
from tideline.plans.serve import KEY, Replica, Sync, SyncError
from tideline.sources import database as D

NOW = datetime(2024, 2, 1, tzinfo=UTC)
WIDE = f'{KEY} timestamp, a double, `b"x` double'


@pytest.fixture
def database(tmp_path):
    return D.Database.of("sqlite3", database=str(tmp_path / "replica.db"))


def ask(database, sql, values=()):
    with database.transaction() as cursor:
        return cursor.execute(sql, values).fetchall()


def frame(spark, rows):
    return spark.createDataFrame([(datetime(2024, 1, 1) + timedelta(days=d), a, b) for d, a, b in rows], WIDE)


# --- source ------------------------------------------------------------------------------------------

ITEMS = schemas._schema("id bigint, at timestamp, day date, name string, x double, ok boolean")


@pytest.fixture
def items(spark, database):
    D.register(spark)
    with database.transaction("x") as cursor:
        D.create_table(database, cursor, "items", ITEMS)
        for i in range(97):
            row = (None if i == 50 else i, datetime(2024, 1, 1, tzinfo=UTC) + timedelta(hours=i), datetime(2024, 1, 1).date(), None if i % 7 == 0 else f'n"{i}', i / 3, i % 2 == 0)
            cursor.execute("INSERT INTO items VALUES (?, ?, ?, ?, ?, ?)", list(map(database.stored, row)))

    def read(parts=4, key="id"):
        return spark.read.format(D.FORMAT).schema(ITEMS).options(**database.options(), table="items", key=key, partitions=str(parts)).load()

    return read


def test_a_table_is_read_in_ranges_of_its_key(items):
    rows = items()
    assert rows.rdd.getNumPartitions() == 4
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    assert sorted(r["count"] for r in sizes) == [24, 24, 24, 25]
    assert sorted(r.x for r in rows.collect()) == sorted(i / 3 for i in range(97))
    for other in (items(1), items(3, "name"), items(5, "at"), items(200, "ok")):  # keys that are texts, times, or nearly all alike
        assert other.count() == 97
    r = items().where("id = 8").first()
    assert (r.at.astimezone(UTC), r.name, r.ok) == (datetime(2024, 1, 1, 8, tzinfo=UTC), 'n"8', True)


def test_filters_reach_the_database(items, database):
    reader = D.DatabaseReader({**database.options(), "table": "items", "key": "id", "partitions": "3"}, ITEMS)
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, Not

    left = [f for f in (EqualTo(("name",), 'n"8'), GreaterThan(("x",), 1.0), Not(IsNull(("x",))), In(("id",), (1, 8)))]
    assert list(reader.pushFilters(left)) == [left[1], left[2]]
    assert reader._query("id") == ('SELECT "id" FROM "items" WHERE "name" = ? AND "id" IN (?, ?)'.replace('"id" FROM', "id FROM"), ['n"8', 1, 8])
    assert [r.id for r in items().where((F.col("id") > 90) & (F.col("id") <= 93) & F.col("name").isNotNull()).orderBy("id").collect()] == [92, 93]
    assert items().where(F.col("at") == datetime(2024, 1, 1, 5)).count() == 1 and items().where("id is null").count() == 1
    assert items().where("x > 30 and name is null").count() == len([i for i in range(97) if i / 3 > 30 and i % 7 == 0])


# --- sink --------------------------------------------------------------------------------------------


def names(database):
    return sorted(r[0] for r in ask(database, "SELECT name FROM sqlite_master WHERE type = 'table'"))


def test_a_delta_counts_whole_or_not_at_all(spark, database):
    D.register(spark)
    schema = schemas._schema("k bigint, v double")
    with database.transaction("x") as cursor:
        D.create_table(database, cursor, "target", schema, ["k"])

    def write(rows, **options):
        rows.repartition(3).write.format(D.FORMAT).options(**database.options(), table="target", key="k", **options).mode("append").save()

    held = lambda: ask(database, "SELECT k, v FROM target ORDER BY k")
    write(spark.range(20).select(F.col("id").alias("k"), (F.col("id") / 2).alias("v")))
    assert held() == [(i, i / 2) for i in range(20)] and names(database) == ["target"]
    delta = lambda *rows: spark.createDataFrame(rows, "op string, k long, v double")
    write(delta(("insert", 30, 1.0), ("update", 3, None), ("delete", 5, None)), op="op")
    after = sorted({**{i: i / 2 for i in range(20) if i != 5}, 30: 1.0, 3: None}.items())
    assert held() == after
    for bad in (delta(("insert", 40, 1.0), ("delete", 77, None)), delta(("insert", 40, 1.0), ("insert", 3, 2.0)), delta(("insert", 40, 1.0), ("update", 41, 2.0))):
        with pytest.raises(Exception, match="hit|UNIQUE"):
            write(bad, op="op")
        assert held() == after and names(database) == ["target"]
    broken = spark.range(100, 160).select(F.col("id").alias("k"), F.when(F.col("id") == 133, F.raise_error(F.lit("a part fails")).cast("double")).otherwise(1.0).alias("v"))
    with pytest.raises(Exception, match="a part fails"):
        write(broken)
    assert held() == after and names(database) == ["target"]


def test_what_a_repeated_task_left_counts_for_nothing(database):
    import pyarrow as pa

    schema = schemas._schema("k bigint, v double")
    with database.transaction("x") as cursor:
        D.create_table(database, cursor, "target", schema, ["k"])
    writer = D.StageWriter({**database.options(), "table": "target", "key": "k"}, schema)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([0.5, None])], ["k", "v"])
    writer.write(iter([batch]))  # an attempt whose answer was lost
    writer.commit([writer.write(iter([batch])), None])
    assert ask(database, "SELECT k, v FROM target ORDER BY k") == [(1, 0.5), (2, None)] and names(database) == ["target"]


# --- replica -----------------------------------------------------------------------------------------


def state(source, build):
    digested = serving.digests(source)
    bounds = serving.summary(source).first()
    utc = lambda at: None if at is None else at.replace(tzinfo=UTC) if at.tzinfo is None else at
    return (DATASET, build, serving.table_digest(digested), 4, 3, bounds.row_count, utc(bounds.min_timestamp), utc(bounds.max_timestamp), NOW)


@pytest.fixture
def replica(spark, database):
    out = P.DatabaseReplica(spark, database, frame(spark, []).schema, parts=3)
    assert out.migrate() == [P.ROWS, P.DIGESTS, P.STATE, P.LEDGER] and out.migrate() == []
    return out


def bring(replica, source, build):
    replica.state()
    replica.apply(source, diff.delta(serving.digests(source), replica.digests(), [KEY], "row_sha256"), state(source, build))


def stored(database):
    return [ask(database, f"SELECT * FROM {t} ORDER BY 1, 2") for t in (P.ROWS, P.DIGESTS, P.STATE)]


def test_delta_digests_and_state_go_together(spark, database, replica):
    first, second = frame(spark, [(1, 1.0, None), (2, 2.0, 2.0), (3, 3.0, -0.0)]), frame(spark, [(1, 1.0, None), (2, 9.0, 2.0), (4, 5e-324, None)])
    bring(replica, first, "one")
    assert diff.equal_tables(replica.rows(), first, [KEY]) and replica.state().source_build_id == "one"
    bring(replica, second, "two")
    assert diff.equal_tables(serving.digests(replica.rows()), serving.digests(second), [KEY]) and diff.equal_tables(replica.digests(), serving.digests(second), [KEY])
    assert len(names(database)) == 4 and replica.state().row_count == 3
    bring(replica, second, "three")  # no rows change, the state does
    assert replica.state().source_build_id == "three"


def test_what_the_database_spoils_is_rolled_back(spark, database, replica):
    bring(replica, frame(spark, [(1, 1.0, None), (2, 2.0, 2.0)]), "one")
    before = stored(database)
    source = frame(spark, [(1, 1.0, None), (2, 3.0, 2.0), (3, 3.0, 3.0)])
    spoil = {
        "rows": f"CREATE TRIGGER spoil AFTER INSERT ON {P.ROWS} BEGIN UPDATE {P.ROWS} SET a = a + 1 WHERE rowid = NEW.rowid; END",
        "digests": f"CREATE TRIGGER spoil AFTER INSERT ON {P.DIGESTS} BEGIN DELETE FROM {P.DIGESTS} WHERE {KEY} < NEW.{KEY}; END",
        "lacks|bounds": f"CREATE TRIGGER spoil AFTER INSERT ON {P.DIGESTS} BEGIN INSERT INTO {P.ROWS} ({KEY}) VALUES ('2030-01-01 00:00:00.000000+00:00') ON CONFLICT DO NOTHING; END",
    }
    for what, trigger in spoil.items():
        ask(database, trigger)
        with pytest.raises(SyncError, match=what):
            bring(replica, source, "two")
        ask(database, "DROP TRIGGER spoil")
        assert stored(database) == before and len(names(database)) == 4
    bring(replica, source, "two")


def test_of_two_writers_one_fails(spark, database, replica):
    other = P.DatabaseReplica(spark, database, frame(spark, []).schema)
    one, two = frame(spark, [(1, 1.0, None)]), frame(spark, [(1, 2.0, None), (2, 2.0, None)])
    for r in (replica, other):
        r.state()
    plans = [diff.delta(serving.digests(s), r.digests(), [KEY], "row_sha256") for s, r in ((one, replica), (two, other))]
    replica.apply(one, plans[0], state(one, "one"))
    after = stored(database)
    with pytest.raises(SyncError, match="another writer"):
        other.apply(two, plans[1], state(two, "two"))
    assert stored(database) == after
    holder = sqlite3.connect(json.loads(database.arguments)["database"], isolation_level=None)
    holder.execute("BEGIN IMMEDIATE")
    impatient = D.Database.of("sqlite3", database=json.loads(database.arguments)["database"], timeout=0.2)
    with pytest.raises(sqlite3.OperationalError, match="locked"), impatient.transaction("x"):
        pass
    holder.rollback()
    assert D.lock_number("x") == D.lock_number("x") != D.lock_number("y") and -(2**63) <= D.lock_number("x") < 2**63


def test_the_contract_is_checked_before_anything_is_written(spark, database, replica):
    assert replica.violations().isEmpty()
    ask(database, f"ALTER TABLE {P.ROWS} RENAME COLUMN a TO z")
    ask(database, f"DROP TABLE {P.DIGESTS}")
    ask(database, f"CREATE TABLE {P.DIGESTS} (dataset_id TEXT NOT NULL, row_sha256 INTEGER, {KEY} TIMESTAMP WITH TIME ZONE NOT NULL, PRIMARY KEY ({KEY}, dataset_id), UNIQUE (row_sha256))")
    ask(database, "CREATE TABLE stray (x TEXT)")
    found = {(r.table_name, r.violation, r.item) for r in replica.violations().collect()}
    assert found == {
        (P.ROWS, "missing_column", "a"), (P.ROWS, "extra_column", "z"), ("stray", "extra_table", "stray"), (P.DIGESTS, "moved_column", KEY), (P.DIGESTS, "moved_column", "row_sha256"), (P.DIGESTS, "retyped_column", "row_sha256"), (P.DIGESTS, "wrong_key", "p"), (P.DIGESTS, "extra_key", "u"),
    }
    with pytest.raises(SyncError, match="contract"):
        bring(replica, frame(spark, [(1, 1.0, None)]), "one")
    ask(database, "DROP TABLE stray")
    ask(database, f"DROP TABLE {P.STATE}")
    assert (P.STATE, "missing_table") in {(r.table_name, r.violation) for r in replica.violations().collect()}


def test_a_wider_schema_is_migrated(spark, database, replica):
    bring(replica, frame(spark, [(1, 1.0, None)]), "one")
    wider = frame(spark, [(1, 1.0, None), (2, 2.0, 2.0)]).withColumn("c", F.lit(7.0))
    next_ = P.DatabaseReplica(spark, database, wider.schema)
    assert [(r.violation, r.item) for r in next_.violations().collect()] == [("missing_column", "c")]
    assert next_.migrate() == [f"{P.ROWS}.c"] and next_.violations().isEmpty()
    bring(next_, wider, "two")
    assert diff.equal_tables(next_.rows(), wider, [KEY])


def test_the_chain_serves_a_database_like_a_folder(spark, tmp_path, database, monkeypatch):
    source = frame(spark, [(d, float(d), None if d % 3 else 1 / (d + 1)) for d in range(40)])
    row = SimpleNamespace(build_id="b1", schema_version=4, feature_version=3, row_count=40, min_timestamp=datetime(2024, 1, 1), max_timestamp=datetime(2024, 2, 9))
    own, folder = P.DatabaseReplica(spark, database, source.schema), Replica(spark, str(tmp_path / "folder"))
    own.migrate()
    syncs = [Sync(None, r, lambda: NOW) for r in (own, folder)]
    for s in syncs:
        monkeypatch.setattr(s, "_source", lambda: (row, source))
        assert vars(s.run()) == {"build_id": "b1", "inserted": 40, "updated": 0, "deleted": 0, "unchanged": 0}
        assert s.verify() == {"status": "PASS", "failed": [], "row_count": 40} and s.run().unchanged == 40
    assert diff.equal_tables(own.rows(), folder.rows(), [KEY]) and diff.equal_tables(own.digests(), folder.digests(), [KEY])
    assert serving.summary(own.rows()).first() == serving.summary(folder.rows()).first()
    assert [own.state()[c] for c in ("source_build_id", "data_sha256", "row_count")] == [folder.state()[c] for c in ("source_build_id", "data_sha256", "row_count")]
    ask(database, f"UPDATE {P.ROWS} SET a = 99 WHERE a = 7")
    assert syncs[0].verify()["failed"] == ["consumer"]
    with pytest.raises(SyncError, match="rows differ"):
        syncs[0].run()
    ask(database, f"DELETE FROM {P.STATE}")
    with pytest.raises(SyncError, match="no state"):
        syncs[0].run()
    assert vars(syncs[0].run(afresh=True))["inserted"] == 40 and syncs[0].verify()["status"] == "PASS"


def test_keys_are_listed_in_their_own_order(spark):
    make = spark.createDataFrame
    found = contract.key_columns(make([("pk", 1, "p", [3, 1]), ("uq", 1, "u", [2])], contract.CONSTRAINTS), make([(1, "t", 9)], contract.CLASSES), make([(9, "s")], contract.NAMESPACES), make([(1, k, c, "text", True) for k, c in enumerate("abc", 1)], contract.ATTRIBUTES))
    assert sorted(map(tuple, found.collect())) == [("s", "t", "pk", "p", ["c", "a"]), ("s", "t", "uq", "u", ["b"])]
