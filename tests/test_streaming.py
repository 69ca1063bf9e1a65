from datetime import UTC, date, datetime

from pyspark.sql import functions as F

from tideline import schemas
from tideline.sources.lake import Lake
from tideline.streaming import landing


def test_landed_files_merge_as_batches_do(spark, tmp_path):
    table = Lake(spark, str(tmp_path / "lake")).bronze["scalar"]
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    row = lambda v, at: ("us_2y", "fred", date(2020, 1, 1), at, "DGS2", "u", v)
    early, late = datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 2, tzinfo=UTC)
    spark.createDataFrame([row(1.0, early), row(2.0, late)], schemas.BRONZE_SCALAR).write.json(folder)
    seen = []
    run = lambda: landing.merge_stream(landing.landed(spark, folder, schemas.BRONZE_SCALAR), table, checkpoint, after=seen.append).awaitTermination()
    run()
    assert [r.value for r in table.read().collect()] == [2.0]
    spark.createDataFrame([row(3.0, late)], schemas.BRONZE_SCALAR).write.mode("append").json(folder)
    run()
    assert [r.value for r in table.read().collect()] == [3.0] and [c["revised"] for c in seen] == [0, 1]


def test_bars_of_a_stream_equal_those_of_a_table(spark, tmp_path):
    folder = str(tmp_path / "ticks")
    ticks = spark.range(200).select(F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 3600).alias("ts"), (F.col("id") % 2).cast("string").alias("series_id"), (F.col("id") * 7 % 31).cast("double").alias("value"))
    ticks.write.parquet(folder)
    stream = landing.landed(spark, folder, ticks.schema, "parquet")
    query = landing.daily_bars(stream).writeStream.format("memory").queryName("bars").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    want = landing.daily_bars(ticks)
    assert spark.table("bars").exceptAll(want).isEmpty() and want.exceptAll(spark.table("bars")).isEmpty()
