"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, one of its own in local mode (tests), else an error."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-"))
        at = spark.sparkContext.getCheckpointDir()
    return at.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark's own setting: a query's shuffle files go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and reread: a lost executor costs no more than the tasks after it. The shuffles of the write, which nothing else reads, go with its end."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes what saved wrote for these tables, which nothing reads any more."""
    for df in tables:
        fs, path = located(df.sparkSession, df.saved_at)
        fs.delete(path, True)


def located(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def put(spark: SparkSession, path: str, content: str) -> None:
    """A small file in any file system of Spark's; written under another name and renamed, so it is there whole or not at all."""
    fs, to = located(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part-{uuid.uuid4().hex}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    fs.delete(to, False)
    if not fs.rename(part, to):
        raise OSError(f"{path} could not be written")


def files_at(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, as pyarrow.fs knows it, and the path there; for executors, which have no JVM to ask."""
    if "://" in uri or uri.startswith("file:"):
        fs, path = pafs.FileSystem.from_uri(uri)
    else:
        fs, path = pafs.LocalFileSystem(), os.path.abspath(uri)
    return fs, path.rstrip("/")
