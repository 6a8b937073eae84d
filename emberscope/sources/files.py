"""Questions to the file system that holds the tables."""

from __future__ import annotations

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def blank(spark: SparkSession, path: str) -> bool:
    """Whether a folder is absent or has no data files yet."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(hadoop_path):
        return True
    return all(f.getPath().getName().startswith(("_", ".")) for f in system.listStatus(hadoop_path))


def mark(spark: SparkSession, path: str) -> None:
    """An empty file, if there is none yet."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(hadoop_path)
