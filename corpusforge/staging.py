"""Written intermediate tables in the cluster's shared folder.

A stage that is read several times (the pair table feeds every output format)
is written once as parquet: it cuts the lineage, survives lost executors and,
unlike an RDD checkpoint, can still be read column by column.
"""

from __future__ import annotations

import atexit
import uuid
from contextlib import contextmanager, suppress
from typing import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, else a folder of the session's warehouse.

    The warehouse may only stand in where executors can see it: on a local master, or on a
    file system other than each machine's own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    own_disk = warehouse.startswith(("file:", "/"))
    if own_disk and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/.staging"


_registered: set[str] = set()


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the application's own folder, which goes when this process ends."""
    folder = f"{shared_root(spark)}/corpusforge/{spark.sparkContext.applicationId}"
    if folder not in _registered:
        _registered.add(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        atexit.register(_drop_at_exit, path, spark.sparkContext._jsc.hadoopConfiguration())
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def _drop_at_exit(path, configuration) -> None:
    with suppress(Exception):  # the JVM may be gone; what stays is named after the application
        path.getFileSystem(configuration).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet and return the written table."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like ``stage``, for one ``with`` block; the table is dropped after it."""
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop_path(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does a file or folder exist, on whatever file system ``path`` names?"""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return file_system.exists(hadoop_path)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder within one file system; the target's parent folders are made, an older target goes."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(path) for path in (source, target))
    file_system = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    file_system.mkdirs(new.getParent())
    file_system.delete(new, True)
    if not file_system.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    file_system.delete(hadoop_path, True)
