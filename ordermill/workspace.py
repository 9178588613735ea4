"""Shared scratch space: lineage cuts and staging folders that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the executors would
    not see it, so an unset folder is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ordermill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def stable(df: DataFrame) -> DataFrame:
    """A small ``df`` (a list of keys, totals) checkpointed: later reads see the same rows in the same order."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as compressed Parquet to the shared folder, for results that the caller goes on to use.

    For whole tables, where a checkpoint would store uncompressed rows. Spark does not remove these files; the folder
    ``spark.checkpoint.dir`` is scratch space, to be emptied with the application.
    """
    return staged(df, f"{new_folder(df.sparkSession)}/{name}")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/ordermill-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """The names in ``folder``, which need not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(path)] if system.exists(path) else []


def file_bytes(df: DataFrame) -> int:
    """The size of all files that ``df`` is made from; no job is started."""
    spark = df.sparkSession
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name)) for name in df.inputFiles()]
    return sum(path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen() for path in paths)


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """A fresh shared folder, removed at the end."""
    folder = new_folder(spark)
    try:
        yield folder
    finally:
        remove(spark, folder)


def staged(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: compressed, and later reads prune columns."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
