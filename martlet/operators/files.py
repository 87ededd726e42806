"""Folders of stored tables, through the file system that Spark itself uses for their path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    system, path = _system(spark, folder)
    return system.exists(path)


def folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the sub-folders, in order."""
    system, path = _system(spark, folder)
    if not system.exists(path):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(path) if entry.isDirectory())


def numbered_folders(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the sub-folders ``prefix`` N."""
    return sorted(int(n.removeprefix(prefix)) for n in folders(spark, folder) if n.startswith(prefix))


def rename(spark: SparkSession, folder: str, to: str) -> None:
    """Move a folder whole, so that a reader sees none of it or all."""
    system, path = _system(spark, folder)
    if not system.rename(path, _system(spark, to)[1]):
        raise RuntimeError(f"{folder} could not be moved to {to}")


def delete(spark: SparkSession, folder: str) -> None:
    system, path = _system(spark, folder)
    system.delete(path, True)


def make(spark: SparkSession, folder: str) -> None:
    system, path = _system(spark, folder)
    system.mkdirs(path)
