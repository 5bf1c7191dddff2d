"""Where intermediate tables go.

Iterative jobs cut their lineage by writing a table and reading it back. The folder is the
session's ``spark.checkpoint.dir``, which a cluster sets to shared storage, so a lost
executor only costs the tasks it was running. Where the setting is absent the folder lies in
the session's warehouse; on a cluster a warehouse in a plain file system is refused, as it may be
another folder on each machine.
"""

from __future__ import annotations

import re
import uuid

import pyarrow.fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"


def work_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(SETTING, None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
        if folder.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{folder} may be local to each machine: set {SETTING}")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the work folder that nothing uses yet."""
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def shared_uri(spark: SparkSession, path: str) -> str:
    """The path with its file system's name, as tasks on other machines need it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()) \
        .makeQualified(where).toString()


def opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a URI, for tasks."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def release(df: DataFrame, part: str = "") -> None:
    """Delete the staged table ``df``, or one part of it, once nothing reads it any more."""
    folder = df.__dict__.get("staged_at")
    if folder:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{folder}/{part}".rstrip("/"))
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the work folder and return the table as read back."""
    return counted_stage(df, name, F.lit(True))[0]


def counted_stage(
    df: DataFrame, name: str, counted: Column, parts: str | None = None,
) -> tuple[DataFrame, int]:
    """The same, with the number of rows that meet ``counted``, taken while writing.

    The rows lie apart by the column ``parts``, if given, so that a part can be released.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    seen = Observation()
    writer = df.observe(seen, F.count_if(counted).alias("rows")).write
    (writer.partitionBy(parts) if parts else writer).parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.staged_at = path
    return found, seen.get["rows"]
