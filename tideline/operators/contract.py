"""What a database has against what it should have: tables, columns in order, and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Schemas of a database's catalog, and of a contract's two parts.
NAMESPACES = "oid bigint, nspname string"
CLASSES = "oid bigint, relname string, relnamespace bigint"
ATTRIBUTES = "attrelid bigint, attnum int, attname string, data_type string, nullable boolean"
CONSTRAINTS = "conname string, conrelid bigint, contype string, conkey array<int>"
COLUMNS = "table_schema string, table_name string, position int, column_name string, data_type string, nullable boolean"
KEYS = "table_schema string, table_name string, key_type string, columns array<string>"


def key_columns(constraints: DataFrame, classes: DataFrame, namespaces: DataFrame, attributes: DataFrame) -> DataFrame:
    """(table_schema, table_name, key_name, key_type, columns): each key with its columns in the key's order, not the table's."""
    each = constraints.select("conname", "conrelid", "contype", F.posexplode("conkey").alias("ordinal", "attnum"))
    tables = classes.withColumnRenamed("oid", "conrelid").join(namespaces.withColumnRenamed("oid", "relnamespace"), "relnamespace")
    named = each.join(attributes.withColumnRenamed("attrelid", "conrelid").select("conrelid", "attnum", "attname"), ["conrelid", "attnum"]).join(tables, "conrelid")
    grouped = named.groupBy(F.col("nspname").alias("table_schema"), F.col("relname").alias("table_name"), F.col("conname").alias("key_name"), F.col("contype").alias("key_type"))
    return grouped.agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "attname"))), lambda x: x.attname).alias("columns"))


def table_columns(classes: DataFrame, namespaces: DataFrame, attributes: DataFrame) -> DataFrame:
    """The columns of all tables, numbered from 1 without gaps."""
    tables = classes.withColumnRenamed("oid", "attrelid").join(namespaces.withColumnRenamed("oid", "relnamespace"), "relnamespace")
    place = F.row_number().over(Window.partitionBy("attrelid").orderBy("attnum"))
    return attributes.withColumn("position", place).join(tables, "attrelid").select(F.col("nspname").alias("table_schema"), F.col("relname").alias("table_name"), "position", F.col("attname").alias("column_name"), "data_type", "nullable")


_TABLE = ["table_schema", "table_name"]


def _both(wanted: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    """A full join by keys that may be null; columns wanted and found hold each side's other columns, null where a side lacks the key."""
    side = lambda df, name: df.select(*[F.col(c).alias(f"{name}_{c}") for c in on], F.struct(*[c for c in df.columns if c not in on], F.lit(True).alias("here")).alias(name))
    same = [F.col(f"wanted_{c}").eqNullSafe(F.col(f"found_{c}")) for c in on]
    joined = side(wanted, "wanted").join(side(found, "found"), same, "full")
    here = F.col("wanted").isNotNull()
    return joined.select(*[F.when(here, F.col(f"wanted_{c}")).otherwise(F.col(f"found_{c}")).alias(c) for c in on], "wanted", "found")


def _kind(missing: str, extra: str) -> Column:
    return F.when(F.col("found").isNull(), missing).when(F.col("wanted").isNull(), extra)


def violations(wanted_columns: DataFrame, found_columns: DataFrame, wanted_keys: DataFrame, found_keys: DataFrame) -> DataFrame:
    """A row for each way in which what is found isn't what is wanted: (table_schema, table_name, violation, item, wanted, found).

    Tables: missing_table, extra_table; the columns and keys of such a table aren't listed one by one. Columns:
    missing_column, extra_column, moved_column (at another position), retyped_column (another type or nullability).
    Keys, by table and type: missing_key, extra_key, wrong_key (other columns or another order of them).
    """
    tables = _both(wanted_columns.select(*_TABLE).distinct(), found_columns.select(*_TABLE).distinct(), _TABLE)
    none = F.lit(None).cast("string")
    of_tables = tables.select(*_TABLE, _kind("missing_table", "extra_table").alias("violation"), F.col("table_name").alias("item"), none.alias("wanted"), none.alias("found"))
    common = tables.where("wanted is not null and found is not null").select(*[F.col(c).alias(f"common_{c}") for c in _TABLE])
    in_both = lambda df: df.join(common, [df[c].eqNullSafe(common[f"common_{c}"]) for c in _TABLE], "left_semi")

    columns = in_both(_both(wanted_columns, found_columns, [*_TABLE, "column_name"]))
    typed = lambda side: F.concat(F.coalesce(F.col(f"{side}.data_type"), F.lit("?")), F.when(F.col(f"{side}.nullable"), "").otherwise(" not null"))
    moved = F.when(~F.col("wanted.position").eqNullSafe(F.col("found.position")), F.struct(F.lit("moved_column").alias("violation"), F.col("wanted.position").cast("string").alias("wanted"), F.col("found.position").cast("string").alias("found")))
    retyped = F.when(~typed("wanted").eqNullSafe(typed("found")), F.struct(F.lit("retyped_column").alias("violation"), typed("wanted").alias("wanted"), typed("found").alias("found")))
    lone = F.struct(_kind("missing_column", "extra_column").alias("violation"), F.when(F.col("wanted").isNotNull(), typed("wanted")).alias("wanted"), F.when(F.col("found").isNotNull(), typed("found")).alias("found"))
    of_columns = columns.select(*_TABLE, F.col("column_name").alias("item"), F.explode(F.when(F.col("wanted").isNull() | F.col("found").isNull(), F.array(lone)).otherwise(F.array(moved, retyped))).alias("v")).where("v is not null").select(*_TABLE, "v.violation", "item", "v.wanted", "v.found")

    keys = in_both(_both(wanted_keys, found_keys, [*_TABLE, "key_type"]))
    listed = lambda side: F.array_join(F.col(f"{side}.columns"), ",")
    wrong = F.coalesce(_kind("missing_key", "extra_key"), F.when(~F.col("wanted.columns").eqNullSafe(F.col("found.columns")), "wrong_key"))
    of_keys = keys.select(*_TABLE, wrong.alias("violation"), F.col("key_type").alias("item"), listed("wanted").alias("wanted"), listed("found").alias("found"))
    return of_tables.unionByName(of_columns).unionByName(of_keys).where("violation is not null")
