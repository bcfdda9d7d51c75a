"""The catalog of crawls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pyspark.sql import functions as F

from pagestrata.functions.records import parse_iso_time

_ENTRY = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("id", "name", "from", "to")]
)


def read_crawl_catalog(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``name``, ``from_ts``, ``to_ts`` of every crawl in a JSON array file."""
    raw = spark.read.schema(_ENTRY).option("multiLine", True).json(path)
    catalog = raw.filter(F.length("id") > 0).select(
        "id",
        "name",
        parse_iso_time(F.col("from")).alias("from_ts"),
        parse_iso_time(F.col("to")).alias("to_ts"),
    )
    if catalog.isEmpty():
        raise ValueError(f"no crawls in {path}")
    return catalog
