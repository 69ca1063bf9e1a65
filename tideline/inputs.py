"""Series-shaped views of the test tables, on which the library's operators are queried."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Which group of line items or orders stands for which series; the totals stand for the last two.
LINE_SERIES = {"AF": "vix", "AO": "vix9d", "NF": "vix3m", "NO": "vix6m", "RF": "vix1y", "RO": "vstoxx"}
ORDER_SERIES = {"1-URGENT": "move", "2-HIGH": "ciss", "3-MEDIUM": "estr", "4-NOT SPECIFIED": "euro_hy_oas", "5-LOW": "us_2y"}
LINE_TOTAL, ORDER_TOTAL = "us_10y", "usd_broad"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """series_id, observation_date, value: quantities a day of each flag and status."""
    rows = read(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("series_id"), F.to_date("l_shipdate").alias("observation_date"), "l_quantity")
    return rows.groupBy("series_id", "observation_date").agg(F.sum("l_quantity").alias("value"))


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of order totals by priority."""
    rows = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("observation_date"), "o_totalprice")
    return rows.groupBy("series_id", "observation_date").agg(F.round(F.sum("o_totalprice"), 2).alias("value"))


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """series_id, observation_date, open, high, low, close: values a day of each event type, by time."""
    rows = read(spark, sf_dir, "events").select(F.col("event_type").alias("series_id"), F.to_date("ts").alias("observation_date"), "ts", "value")
    return rows.groupBy("series_id", "observation_date").agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "ts").alias("close"))


def _named(names: dict[str, str], total: str):
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("key")), F.lit(total))


def all_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirteen series under the registered ids: groups of line items and orders, and their totals, each table read once."""
    lines = read(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("key"), F.to_date("l_shipdate").alias("observation_date"), F.col("l_quantity").alias("x"))
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("key"), F.to_date("o_orderdate").alias("observation_date"), F.col("o_totalprice").alias("x"))
    parts = []
    for rows, names, total in ((lines, LINE_SERIES, LINE_TOTAL), (orders, ORDER_SERIES, ORDER_TOTAL)):
        sums = rows.groupingSets([["key", "observation_date"], ["observation_date"]], "key", "observation_date").agg(F.round(F.sum("x"), 2).alias("value"))
        parts.append(sums.select(_named(names, total).alias("series_id"), "observation_date", "value"))
    return parts[0].unionByName(parts[1])


# The same views for DuckDB.
LINE_SQL = "s_line AS (SELECT l_returnflag || l_linestatus AS series_id, l_shipdate::DATE AS observation_date, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2)"
ORDER_SQL = "s_order AS (SELECT o_orderpriority AS series_id, o_orderdate::DATE AS observation_date, round(sum(o_totalprice), 2) AS value FROM orders GROUP BY 1, 2)"
BARS_SQL = "bars AS (SELECT event_type AS series_id, ts::DATE AS observation_date, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close FROM events GROUP BY 1, 2)"


def _case(column: str, names: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items()) + " END"


ALL_SQL = (
    f"{LINE_SQL}, {ORDER_SQL}, s_all AS ("
    f"SELECT {_case('series_id', LINE_SERIES)} AS series_id, observation_date, value FROM s_line UNION ALL "
    f"SELECT {_case('series_id', ORDER_SERIES)}, observation_date, value FROM s_order UNION ALL "
    f"SELECT '{LINE_TOTAL}', l_shipdate::DATE, sum(l_quantity) FROM lineitem GROUP BY 2 UNION ALL "
    f"SELECT '{ORDER_TOTAL}', o_orderdate::DATE, round(sum(o_totalprice), 2) FROM orders GROUP BY 2)"
)
