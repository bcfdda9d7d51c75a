"""Opening files by path or URI inside a task."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a full URI. A path without a scheme is on Hadoop's default file system,
    where Spark's own readers and writers look for it too."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = files.makeQualified(hadoop).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and uri[6] != "/" else uri


def file_system(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``root`` and the path of ``root`` on it."""
    if "://" not in root:
        return fs.LocalFileSystem(), root.removeprefix("file:")
    return fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))
