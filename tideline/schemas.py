"""Schemas of the stored tables. Readers and writers take exactly these columns in this order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

_TYPES = {"string": StringType(), "date": DateType(), "timestamp": TimestampType(), "double": DoubleType(), "bigint": LongType(), "int": IntegerType(), "boolean": BooleanType()}


def _schema(columns: str) -> StructType:
    """From "name type, ...", without a session, which StructType.fromDDL needs."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (x.split() for x in columns.split(","))])


_COMMON = "series_id string, provider string, observation_date date, fetched_at_utc timestamp, source_id string, source_url string"
BRONZE_OHLC = _schema(_COMMON + ", open double, high double, low double, close double")
BRONZE_SCALAR = _schema(_COMMON + ", value double")
SILVER = _schema("observation_date date, series_id string, value double, open double, high double, low double, close double, unit string, provider string, source_id string, fetched_at_utc timestamp")
STATE = _schema(
    "provider string, series_id string, last_success_utc timestamp, last_observed_date date, last_requested_start date, last_requested_end date, mode string, fetched_row_count bigint, accepted_row_count bigint, changed_row_count bigint, last_reconcile_utc timestamp"
)
RUNS = _schema(
    "run_id string, provider string, series_id string, mode string, requested_start date, requested_end date, fetched_rows bigint, accepted_rows bigint, inserted_rows bigint, revised_rows bigint, written_partitions bigint, status string, started_at_utc timestamp, completed_at_utc timestamp, error_category string, error_message string"
)
INVENTORY = _schema("series_id string, provider string, min_observation_date date, max_observation_date date, row_count bigint, duplicate_key_count bigint, file_count bigint")
CATALOG = _schema(
    "dataset_id string, build_id string, status string, current boolean, started_at_utc timestamp, completed_at_utc timestamp, schema_version bigint, feature_version bigint, min_timestamp timestamp, max_timestamp timestamp, row_count bigint, data_path string, build_manifest_path string, plot_path string, pruned_at_utc timestamp"
)
DIGESTS = _schema("dataset_id string, timestamp_m1 timestamp, row_sha256 string")
SYNC_STATE = _schema("dataset_id string, source_build_id string, data_sha256 string, schema_version int, feature_version int, row_count bigint, min_timestamp timestamp, max_timestamp timestamp, synced_at_utc timestamp")


def bronze(shape: str) -> StructType:
    return BRONZE_OHLC if shape == "ohlc" else BRONZE_SCALAR


def same_schema(df: DataFrame, schema: StructType) -> bool:
    """Names, order and types; nullability doesn't count."""
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def require_schema(df: DataFrame, schema: StructType, what: str) -> DataFrame:
    if not same_schema(df, schema):
        raise TypeError(f"{what} must have exactly the columns {schema.simpleString()}, not {df.schema.simpleString()}")
    return df
