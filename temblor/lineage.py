"""Cutting lineage through a written table in the folder the cluster shares.

A cached block dies with its executor and takes a rescan of the source to rebuild. A small
result that many jobs read again, such as a training set, is therefore written once to
``spark.checkpoint.dir`` and read back from there.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local one is made only for a local master."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="temblor-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/temblor-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once, write it to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def materialised(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As ``materialise``, for a table that is not needed after the block."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, through the file system it lies on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    return [found.getPath().getName() for found in system.listStatus(target) if found.isDirectory()]


def move_new(spark: SparkSession, path: str, new: str) -> bool:
    """Renames a folder in one step; false, and nothing moved, if ``new`` is there already."""
    jvm = spark._jvm
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, new))
    if target.toUri().getScheme() is None:
        system = target.getFileSystem(spark._jsc.hadoopConfiguration())
        source, target = system.makeQualified(source), system.makeQualified(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    if context.util().exists(target):
        return False
    try:
        context.rename(source, target, options)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True
