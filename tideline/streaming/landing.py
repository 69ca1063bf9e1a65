"""Observations as a stream of landed files: the same merge as in batches, and event-time aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tideline.sources.lake import MonthlyTable


def landed(spark: SparkSession, path: str, schema: StructType, kind: str = "json", files_a_batch: int = 1000) -> DataFrame:
    """New files of a folder as a stream of rows."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files_a_batch).load(path)


def latest(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """For each key its row with the greatest value of `by`; equal rows are one."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(by), *[F.desc(c) for c in rows.columns if c not in (*keys, by)])
    return rows.withColumn("__rank", F.row_number().over(newest)).where("__rank = 1").drop("__rank")


def merge_stream(stream: DataFrame, table: MonthlyTable, checkpoint: str, by: str = "fetched_at_utc", after: Callable[[dict[str, int]], None] = lambda counts: None, available_now: bool = True) -> StreamingQuery:
    """Merges each batch into a monthly table. A batch that runs again after a failure finds its rows unchanged."""

    def merge(batch: DataFrame, _: int) -> None:
        table.upsert(latest(batch, table.keys, by).select(*table.schema.fieldNames()), after)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def daily_bars(ticks: DataFrame, *, time: str = "ts", key: str = "series_id", value: str = "value", late: str = "7 days") -> DataFrame:
    """Open, high, low and close a day from timed values, for streams (with a watermark) and tables alike."""
    rows = ticks.withWatermark(time, late) if ticks.isStreaming else ticks
    return rows.groupBy(F.window(time, "1 day").alias("day"), key).agg(F.min_by(value, time).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, time).alias("close")).select(
        key, F.to_date("day.start").alias("observation_date"), "open", "high", "low", "close"
    )
