from datetime import date, datetime

import pytest
from helpers import days
from pyspark.sql import functions as F

from tideline import registry, schemas
from tideline.functions import scalars as S
from tideline.operators import diff, profile, quality, serving, silver

SCHEMA = "series_id string, observation_date date, value double"
KEYS = ["series_id", "observation_date"]


def rows(spark, *values):
    return spark.createDataFrame([("a", d, v) for d, v in values], SCHEMA)


def test_classify_and_merge(spark):
    d = days(4)
    old = rows(spark, (d[0], 1.0), (d[1], None), (d[3], 9.0))
    new = rows(spark, (d[0], 2.0), (d[1], None), (d[2], 3.0))
    kinds = {r.observation_date: r.change_type for r in diff.classify(old, new, KEYS).collect()}
    assert kinds == {d[0]: "revision", d[1]: "unchanged", d[2]: "insert"}
    assert {(r.observation_date, r.value) for r in diff.merge(old, new, KEYS).collect()} == {(d[0], 2.0), (d[1], None), (d[2], 3.0), (d[3], 9.0)}
    assert diff.merge(old, old.limit(0), KEYS).exceptAll(old).isEmpty()
    assert diff.merge(old.limit(0), new, KEYS).count() == 3


def test_kept_value_stays_only_without_change(spark):
    schema = "k int, v int, at string"
    old, new = spark.createDataFrame([(1, 5, "old"), (2, 5, "old")], schema), spark.createDataFrame([(1, 5, "new"), (2, 6, "new"), (3, 1, "new")], schema)
    assert {(r.k, r["at"]) for r in diff.keep_when_same(old, new, ["k"], "at").collect()} == {(1, "old"), (2, "new"), (3, "new")}


def test_delta_and_apply(spark):
    source, target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, h string"), spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], "k int, h string")
    plan = diff.delta(source, target, ["k"], "h")
    assert {(r.k, r.op) for r in plan.collect()} == {(1, "unchanged"), (2, "update"), (3, "insert"), (4, "delete")}
    assert tuple(diff.delta_counts(plan).first()) == (1, 1, 1, 1)
    assert diff.equal_tables(diff.apply_delta(source, target, plan, ["k"]), source, ["k"])
    assert not diff.equal_tables(source, target, ["k"])


def test_quality_counts(spark):
    df = spark.createDataFrame([("a", date(2020, 1, 1), 1.0), ("a", date(2020, 1, 1), float("nan")), (None, None, None)], SCHEMA)
    assert {r.check: r.violations for r in quality.silver_checks(df).collect()} == {"series_id_null": 1, "observation_date_null": 1, "value_not_finite": 2, "duplicate_key": 2}
    with pytest.raises(quality.QualityError, match="value_not_finite"):
        quality.require(quality.silver_checks(df), "x")
    quality.require(quality.silver_checks(df.limit(0)), "empty")
    with pytest.raises(quality.QualityError, match="missing columns: b"):
        quality.require_columns(df.select(F.lit(1).alias("a")), ["a", "b"])


def test_run_rules(spark):
    at = datetime(2020, 1, 1)
    row = ("", "p", "s", "update", None, None, 1, 1, 1, 0, -1, "failed", at, datetime(2019, 1, 1), None, None)
    bad = {r.check for r in quality.run_checks(spark.createDataFrame([row], schemas.RUNS)).where("violations > 0").collect()}
    assert bad == {"run_id_empty", "written_partitions_negative", "completed_before_started"}


def test_silver_of_both_shapes(spark):
    s = registry.series("vix")
    bar = spark.createDataFrame([("vix", "cboe", date(2020, 1, 1), datetime(2020, 1, 2), s.source_id, "u", 1.0, 3.0, 0.5, 2.0)], schemas.BRONZE_OHLC)
    out = silver.canonicalize(s, bar)
    assert schemas.same_schema(out, schemas.SILVER) and out.first().value == 2.0
    with pytest.raises(quality.QualityError):
        silver.canonicalize(registry.series("vix9d"), bar)
    scalar = spark.createDataFrame([("us_2y", "fred", date(2020, 1, 1), datetime(2020, 1, 2), "DGS2", "u", 1.5)], schemas.BRONZE_SCALAR)
    assert silver.canonicalize(registry.series("us_2y"), scalar).first().open is None


def test_digest_tells_rows_apart(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, 1.0, None), (3, 0.0, None), (4, -0.0, None)], "k int, a double, b double").withColumn("at", F.lit(datetime(2020, 1, 1)))
    found = [r[0] for r in df.orderBy("k").select(S.row_digest(F.col("at"), ["a", "b"])).collect()]
    assert len(set(found)) == 3 and found[2] == found[3] and all(len(x) == 64 for x in found)


def test_table_digest_ignores_order(spark):
    df = spark.range(50).select(F.timestamp_seconds("id").alias("timestamp_m1"), F.col("id").cast("double").alias("x"))
    digested = serving.digests(df)
    assert serving.table_digest(digested) == serving.table_digest(digested.orderBy(F.desc("timestamp_m1")).repartition(3))
    assert serving.table_digest(digested) != serving.table_digest(digested.where("timestamp_m1 > timestamp'1970-01-01'"))
    assert len(serving.table_digest(digested.limit(0))) == 64


def test_versions_move_only_as_listed():
    assert serving.may_move((4, 3), (4, 3)) and serving.may_move((3, 2), (4, 3)) and serving.may_move((1, 7), (2, 7))
    assert not serving.may_move((2, 2), (4, 3)) and not serving.may_move((4, 3), (3, 2)) and not serving.may_move((1, 7), (2, 8))
    assert serving.columns_change((2, 1), (3, 2)) and not serving.columns_change((1, 1), (2, 1))


def test_scalars(spark):
    row = spark.range(1).select(
        S.is_build_id(F.lit("20240229T000000Z")).alias("a"), S.is_build_id(F.lit("20240230T000000Z")).alias("b"), S.is_build_id(F.lit(None).cast("string")).alias("c"),
        S.redacted(F.lit("key=abc"), ["abc", ""]).alias("d"), S.path_only(F.lit("https://u:p@h.org/x/y?k=1#z")).alias("e"), S.finite(F.lit(float("inf"))).alias("f"),
        S.first_date(F.lit("01/02/2024"), ("MM/dd/yyyy", "yyyy-MM-dd")).alias("g"), S.number(F.lit("abc")).alias("h"), S.safe_ratio(F.lit(1.0), F.lit(0.0)).alias("i"), S.missing(F.lit(" . ")).alias("j"), S.is_sha256(F.lit("0" * 64)).alias("k"),
    ).first()
    assert tuple(row) == (True, False, False, "key=***", "https://h.org/x/y", False, date(2024, 1, 2), None, None, True, True)


def test_registry():
    assert len(registry.SERIES) == 13 and registry.selected() == list(registry.SERIES)
    for bad in (["vix", "vix"], ["nope"]):
        with pytest.raises((ValueError, KeyError)):
            registry.selected(bad)
    with pytest.raises(ValueError):
        registry.Series("x", "nobody", "y", "z", "ohlc", "full_file")
    with pytest.raises(ValueError):
        registry.registered([registry.series("vix")] * 2)


def test_inventory_of_nothing_has_every_series(spark):
    empty = spark.createDataFrame([], "series_id string, observation_date date")
    found = profile.inventory(registry.registry_frame(spark), empty).collect()
    assert len(found) == 13 and {r.row_count for r in found} == {0}


def test_disjoint_sets_and_increasing_keys(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert [r.k for r in diff.shared_keys([a, b], ["k"]).collect()] == [2]
    assert [r.k for r in quality.not_increasing(a.union(b), "k").collect()] == [2]
