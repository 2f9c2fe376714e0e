"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only where it is unset, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gridloom-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """An empty folder of its own, deleted at the latest when the driver ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/gridloom/{name}-{uuid.uuid4().hex}"
    path = make_folder(spark, folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def make_folder(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return path


def staged(df: DataFrame, name: str, folder: str | None = None, split_by: str | None = None, compression: str | None = None) -> DataFrame:
    """Writes ``df`` once and reads it back; later readers see one fixed result.

    Rows are put into one subfolder per value of ``split_by``, a column with few values.
    ``compression`` is that of the session if not given.
    """
    spark = df.sparkSession
    path = f"{folder or new_folder(spark, 'stage')}/{name}"
    # With few values, open a file for each instead of sorting the rows.
    with session_conf(spark, {"spark.sql.maxConcurrentOutputFileWriters": "8"} if split_by else {}):
        df.write.partitionBy(*([split_by] if split_by else [])).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Deletes a folder made by :func:`new_folder`."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def exists(spark: SparkSession, place: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def child_folders(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly under ``root``, sorted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(path) if entry.isDirectory())


def holds_data(spark: SparkSession, folder: str) -> bool:
    """Whether a folder looks like a written table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [e.getPath().getName() for e in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    return any(name in ("_SUCCESS", "_delta_log") or name.startswith("part-") or "=" in name for name in names)


@contextmanager
def session_conf(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for one action."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
