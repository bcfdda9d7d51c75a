"""The capture index as a table laid out for scans by crawl, host and URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata.schema import index_order

# Rows that one task sorts and writes, some hundreds of megabytes without bodies.
ROWS_PER_TASK = 2_000_000
# Tasks that write; beyond, each sorts more rows, on disk.
MOST_TASKS = 50_000


def to_index_table(
    df: DataFrame,
    path: str,
    files: int | None = None,
    rows_per_file: int = 20_000_000,
    number_rows: bool = False,
) -> None:
    """Write ``df`` as Parquet, one directory per crawl, files sorted by URL key.

    Rows are spread by range, so a very large crawl or site is cut into several files
    and each file covers a narrow span of keys that row-group statistics can skip.
    ``files`` is about how many tasks write; by default one for each ``ROWS_PER_TASK`` rows,
    which are counted first, and at least the shuffle partitions. ``number_rows`` adds ``row_id``,
    which never falls along the files' order; ``sources.grams`` tells rows by it.
    """
    if files is None:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        files = max(least, min(MOST_TASKS, -(-df.count() // ROWS_PER_TASK)))
    order = [c for c in index_order(df) if c != "crawl_id"]
    by = ["crawl_id", *order]
    spread = df.repartitionByRange(files, *by)
    spread = spread.sortWithinPartitions(*by)
    if number_rows:
        spread = spread.withColumn("row_id", F.monotonically_increasing_id())
    writer = spread.write.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy("crawl_id").parquet(path)


def read_index_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def register_index(df: DataFrame, name: str) -> DataFrame:
    """Make an index known to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df
