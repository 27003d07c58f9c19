"""Small helpers over the Hadoop file system the session already uses (local, HDFS, object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def make_dir(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.mkdirs(target)


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether a write job into ``path`` committed."""
    fs, marker = _path(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: under another name first, then renamed."""
    fs, draft = _path(spark, f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(draft, _path(spark, path)[1])


def read_text(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, path):
        return None
    return spark.read.text(path, wholetext=True).first()[0]


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)
