"""Limits, pages and the latest captures, exact and deterministic.

Small limits use Spark's top-k and rank-limit plans, where every map task sends up to
the limit to one of a few hundred tasks, and each of these up to the limit to one task.
Larger limits are answered by counting rows range by range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagestrata.operators.ordered import directed, rows_between, with_rank
from pagestrata.plans.ranges import ROWS_PER_RANGE
from pagestrata.schema import index_order, tie_breakers

# Rows every map task may send to the one task that merges a top-k.
TOP_K_ROWS = 200
# Rows of one group every map task may send to the task that ranks the group. Spark
# prunes such a rank filter before the shuffle (windowGroupLimitThreshold is 1000).
PRUNED_RANK = 100
# Tasks that merge what the map tasks send, before one task merges the rest.
MERGERS = 512


def take_ordered(
    df: DataFrame,
    order: list[str],
    n: int,
    offset: int = 0,
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + n`` along ``order``, in that order."""
    _check(n, offset)
    if offset + n <= TOP_K_ROWS:
        merged = _merged(df, [], directed(order, descending), offset + n)
        return merged.orderBy(*directed(order, descending)).offset(offset).limit(n)
    return rows_between(df, order, offset + 1, offset + n, descending, rows_per_range)


def first_captures(df: DataFrame, n: int) -> DataFrame:
    return take_ordered(df, index_order(df), n)


def page(df: DataFrame, n: int, offset: int) -> DataFrame:
    """``n`` captures after skipping ``offset``, in index order."""
    return take_ordered(df, index_order(df), n, offset)


def latest(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` most recent captures, newest first."""
    return take_ordered(df, ["timestamp", *_after_time(df)], n, descending=True)


def top_k(df: DataFrame, by: list[str], n: int, descending: bool = False) -> DataFrame:
    """First ``n`` captures by any columns; ties follow index order."""
    ties = [c for c in index_order(df) if c not in by]
    return take_ordered(df, [*by, *ties], n, descending=descending)


def rank_at_most(
    df: DataFrame,
    group: list[str],
    order: list[str],
    n: int,
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """The first ``n`` rows of every group, with their ``_rank``."""
    _check(n, 0)
    if n > PRUNED_RANK:
        return with_rank(df, group, order, "_rank", descending, n, rows_per_range)
    by = Window.partitionBy(*group).orderBy(*directed(order, descending))
    merged = _merged(df, group, directed(order, descending), n)
    return merged.withColumn("_rank", F.row_number().over(by)).filter(F.col("_rank") <= n)


def _merged(df: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    """Rows that can be among the first ``n`` of their group, at most ``n`` from a merger."""
    merger = F.pmod(F.spark_partition_id(), F.lit(MERGERS))
    by = Window.partitionBy(*group, "_merger").orderBy(*order)
    found = df.withColumn("_merger", merger).withColumn("_r", F.row_number().over(by))
    return found.filter(F.col("_r") <= n).drop("_merger", "_r")


def latest_per_url(df: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` most recent captures of every URL."""
    order = ["timestamp", *[c for c in _after_time(df) if c != "url"]]
    return rank_at_most(df, ["url"], order, n, descending=True).drop("_rank")


def cap_per_crawl(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` captures of every crawl, the first ones in index order."""
    order = [c for c in index_order(df) if c != "crawl_id"]
    return rank_at_most(df, ["crawl_id"], order, n).drop("_rank")


def balanced_sample(df: DataFrame, n: int) -> DataFrame:
    """``n`` captures spread over the crawls present: ceil(n / crawls) of each, then n."""
    order = [c for c in index_order(df) if c != "crawl_id"]
    crawls = df.agg(F.count_distinct("crawl_id")).first()[0]
    share = -(-n // max(crawls, 1))
    spread = rank_at_most(df, ["crawl_id"], order, share)
    return take_ordered(spread.drop("_rank"), [*order, "crawl_id"], n)


def _after_time(df: DataFrame) -> list[str]:
    ties = tie_breakers(df)
    return ties if ties == ["capture_id"] else ["url", *[c for c in ties if c != "url"]]


def _check(n: int, offset: int) -> None:
    if n < 0 or offset < 0:
        raise ValueError("limit and offset must not be negative")
