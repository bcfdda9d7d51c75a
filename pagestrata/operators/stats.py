"""Summaries of an index, calendar and status columns, and unions of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagestrata.functions.urls import host_of
from pagestrata.operators.dedup import distinct_on
from pagestrata.operators.ordered import with_neighbour
from pagestrata.plans.ranges import ROWS_PER_RANGE
from pagestrata.schema import tie_breakers


def with_calendar(df: DataFrame) -> DataFrame:
    """Add ``year`` and ``month`` from the capture time."""
    return df.withColumn("year", F.year("timestamp")).withColumn("month", F.month("timestamp"))


def status_class(column: str = "statuscode"):
    """Success for 200, Error from 400 up, Other else."""
    code = F.col(column)
    return F.when(code == 200, "Success").when(code >= 400, "Error").otherwise("Other")


def count_by(df: DataFrame, *columns: str, name: str = "captures") -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(name))


def snapshots_per_year(df: DataFrame) -> DataFrame:
    years = df.withColumn("year", F.year("timestamp"))
    return count_by(years, "year", name="snapshot_count").orderBy("year")


def body_size_stats(df: DataFrame, *by: str) -> DataFrame:
    """Average, smallest and largest body in bytes."""
    size = F.octet_length("response.body")
    return df.groupBy(*by).agg(
        F.avg(size).alias("avg_size"),
        F.min(size).alias("min_size"),
        F.max(size).alias("max_size"),
    )


def change_history(df: DataFrame) -> DataFrame:
    """One capture per URL and year: when, how long, and the content hash."""
    first = distinct_on(df, ["url", "year"], ["timestamp", *tie_breakers(df)])
    return first.select("url", "timestamp", "length", "digest").orderBy("url", "timestamp")


def domains(df: DataFrame) -> DataFrame:
    return df.select(host_of(F.col("url")).alias("domain")).distinct()


def capture_gaps(df: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``next_ts``: when the same URL was captured next, NULL for its last capture."""
    order = ["url", "timestamp", *[c for c in tie_breakers(df) if c != "url"]]
    ahead = F.struct(F.col("url").alias("u"), F.col("timestamp").alias("t"))
    near = with_neighbour(df, order, ahead, "_next", 1, rows_per_range)
    same = F.col("_next.v.u") == F.col("url")
    return near.withColumn("next_ts", F.when(same, F.col("_next.v.t"))).drop("_next")


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of several indexes; a column one of them lacks is NULL there."""
    whole, *rest = sources
    for other in rest:
        whole = whole.unionByName(other, allowMissingColumns=True)
    return whole
