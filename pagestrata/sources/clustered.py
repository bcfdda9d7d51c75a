"""An index table that is clustered by key and time together, with a table of its files' bounds.

Files sorted by key alone all cover all times, so a time condition reads every file of a crawl. Here both orders are
cut into cells, whose numbers are interleaved bit by bit: a file covers a short span of keys and a short span of
times, and a condition on either one leaves a share of the files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata.functions.urls import surt_hosts
from pagestrata.operators import filters
from pagestrata.plans.ranges import RANGE, with_range
from pagestrata.schema import index_order
from pagestrata.sources.layout import MOST_TASKS, ROWS_PER_TASK

#: Bits of a cell's number along keys and along times: 256 cells each.
BITS = 8
BOUNDS = "_bounds"
#: A file without rows that holds the columns, also of an empty index.
COLUMNS = "_columns"


def write_clustered(df: DataFrame, path: str, files: int | None = None, bits: int = BITS) -> None:
    """Write ``df`` as Parquet by crawl, clustered by ``urlkey`` and ``timestamp``, and its files' bounds.

    ``files`` is about how many tasks write, by default one for each ``ROWS_PER_TASK`` rows. A key or a second with a
    third of all rows is spread: cells are dealt by the other order and then by all columns that separate captures. NULLs come first;
    an empty index leaves a table without rows.
    """
    if files is None:
        files = max(1, min(MOST_TASKS, -(-df.count() // ROWS_PER_TASK)))
    keys = [c for c in index_order(df) if c != "crawl_id"]
    times = ["timestamp", *[c for c in keys if c != "timestamp"]]
    celled = df
    for name, order in (("_by_key", keys), ("_by_time", times)):
        celled = with_range(celled, order, rows_per_range=1, max_ranges=1 << bits).withColumnRenamed(RANGE, name)
    by = ["crawl_id", "_curve", *keys]
    spread = celled.withColumn("_curve", _interleaved(F.col("_by_key"), F.col("_by_time"), bits))
    spread = spread.repartitionByRange(files, *by).sortWithinPartitions(*by).drop("_by_key", "_by_time", "_curve")
    spread.write.partitionBy("crawl_id").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    # Paths come as URIs and are given back to the reader as they are.
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    bounds = table.groupBy(file.alias("file"), "crawl_id").agg(
        F.min("urlkey").alias("key_from"), F.max("urlkey").alias("key_to"),
        F.min("timestamp").alias("time_from"), F.max("timestamp").alias("time_to"), F.count("*").alias("rows"),
    )
    df.limit(0).coalesce(1).write.parquet(f"{path}/{COLUMNS}")
    bounds.coalesce(1 + files // 10_000).write.parquet(f"{path}/{BOUNDS}")


def find_clustered(
    spark: SparkSession, path: str, host: str | None = None, domain: str | None = None, since=None, until=None,
    crawl_id: str | None = None,
) -> DataFrame:
    """Captures on ``host`` or in ``domain``, from ``since`` to ``until`` inclusive, of one crawl; all optional.

    Only files whose bounds allow it are opened or listed. Their names pass through the driver, as those of any scan do.
    """
    bounds = spark.read.parquet(f"{path}/{BOUNDS}")
    tests, of_files = [], []
    for name, ends, test in ((host, "):", lambda h: filters.on_host(h, True)), (domain, ",):", filters.in_domain)):
        if name is not None:
            tests.append(test(name))
            of_files.append(_may_begin([f"{key}{end}" for key in surt_hosts(name) for end in ends]))
    if since is not None:
        of_files.append(filters.time_range(bounds, since=since, column="time_to"))
    if until is not None:
        of_files.append(filters.time_range(bounds, until=until, column="time_from"))
    if crawl_id is not None:
        tests.append(F.col("crawl_id") == crawl_id)
        of_files.append(F.col("crawl_id") == crawl_id)
    wanted = [r.file for r in bounds.filter(filters.all_of(of_files)).select("file").collect()]
    none = spark.read.parquet(f"{path}/{COLUMNS}")
    read = spark.read.schema(none.schema).option("basePath", path)
    table = read.parquet(*wanted).select(none.columns) if wanted else none
    return table.filter(filters.all_of([*tests, filters.time_range(table, since, until)]))


def _may_begin(prefixes: list[str]) -> Column:
    """Whether a file may hold keys with one of these beginnings."""
    tests = [(F.left("key_from", F.lit(len(p))) <= p) & (F.col("key_to") >= p) for p in prefixes]
    return reduce(Column.__or__, tests)


def _interleaved(one: Column, other: Column, bits: int) -> Column:
    """The bits of two cell numbers in turn, from the lowest on."""
    parts = []
    for bit in range(bits):
        for place, cell in ((2 * bit, one), (2 * bit + 1, other)):
            parts.append(F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1)).cast("long"), place))
    return reduce(Column.__add__, parts)
