"""New index files as they arrive.

Parsing, filters and derived columns are row by row, so they work on these streams as
on tables; ``streaming.firsts`` keeps captures per key. Collapse and whole-index top-k are for tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pagestrata.sources.cdx import parse_cdx
from pagestrata.sources.cdxj import parse_cdxj


def tail_cdx(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return parse_cdx(_lines(spark, path, max_files))


def tail_cdxj(
    spark: SparkSession, path: str, crawl_id: str | None = None, max_files: int = 1000
) -> DataFrame:
    return parse_cdxj(_lines(spark, path, max_files), crawl_id)


def append_to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add what has arrived to a Parquet table, then stop. Each file is added once."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def _lines(spark: SparkSession, path: str, max_files: int) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
