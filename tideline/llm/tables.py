"""Shared helpers: reading a table and cutting a plan at a fault-tolerant checkpoint."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names in spark.checkpoint.dir; where none is set, a new local one if the master is local, else it raises."""
    sc = spark.sparkContext
    set_already = sc._jsc.sc().getCheckpointDir()
    if set_already.isDefined():
        return set_already.get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tideline-")
    sc.setCheckpointDir(path)
    return sc._jsc.sc().getCheckpointDir().get()


_made: list[str] = []


def made(path: str) -> str:
    """Notes a folder of intermediate data, for clear()."""
    _made.append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Removes the intermediate folders of this driver's operators, once results made from them are written or no longer wanted."""
    jvm = spark.sparkContext._jvm
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name like the wanted one that df doesn't have, whatever the case of its names."""
    taken, name = {c.lower() for c in df.columns}, f"own_{wanted}"
    while name.lower() in taken:
        name += "_"
    return name


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows of df, computed once and kept in the shared folder; a lost executor loses none of them."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Rows of df, written as Parquet in the shared folder and read again: columns that aren't used later aren't read.

    Unlike a checkpoint it forgets how rows were dealt out, so that a join on a hot key can be dealt anew and split.
    """
    path = made(f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
