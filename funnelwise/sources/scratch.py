"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local session without it gets a temporary folder, a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="funnelwise-")
    spark.sparkContext.setCheckpointDir(f"file://{folder}")
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A folder name in the shared folder that nothing has used."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside delete their shuffle files as they end. Else these lie on the disks until the driver happens to collect garbage.

    For writes only: a DataFrame that is shown or collected twice would shuffle anew.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def keep(df: DataFrame) -> DataFrame:
    """Write a result that later plans read more than once, and read it back.

    The files outlive lost executors, cut the lineage and give the optimizer a true size.
    """
    folder = new_folder(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _plain(folder: str) -> str:
    """A folder's path without scheme and host."""
    rest = folder.split(":", 1)[-1]
    return "/" + (rest[2:].partition("/")[2] if rest.startswith("//") else rest.lstrip("/"))


def forget(*tables: DataFrame) -> None:
    """Delete the files of tables made by `keep` that no result reads any more."""
    for df in tables:
        root = _plain(shared_folder(df.sparkSession)).rstrip("/") + "/"
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if not _plain(folder).startswith(root):
                raise ValueError(f"{folder} is not a scratch table")
            delete(df.sparkSession, folder)


def _path(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder in whatever store it is."""
    path, store = _path(spark, folder)
    store.delete(path, True)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder, none if it does not exist."""
    path, store = _path(spark, folder)
    return sorted(f.getPath().getName() for f in store.listStatus(path) if f.isDirectory()) if store.exists(path) else []
