"""Folders and marker files through Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def path_and_fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    path, fs = path_and_fs(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, made in one step."""
    marker, fs = path_and_fs(spark, path)
    fs.create(marker, True).close()


def delete(spark: SparkSession, path: str) -> None:
    folder, fs = path_and_fs(spark, path)
    fs.delete(folder, True)


def make_folder(spark: SparkSession, path: str) -> None:
    folder, fs = path_and_fs(spark, path)
    fs.mkdirs(folder)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Make a written folder visible in one step; what an earlier run published stands."""
    source, fs = path_and_fs(spark, staged)
    place, _ = path_and_fs(spark, target)
    if fs.exists(source) and not fs.exists(place):
        fs.mkdirs(place.getParent())
        if not fs.rename(source, place):
            raise OSError(f"could not publish {target}")
