"""Neighbours, ranks and carried values along one total order, without hot groups.

Each operator works range by range (see ``plans.ranges``) and passes what crosses a
range border through a summary with one row per range. The summary is the only
thing sorted in one task and the only thing broadcast; its size is bounded by the
number of ranges. Values of any length that are carried on are shuffled instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagestrata.plans.ranges import RANGE, ROWS_PER_RANGE, with_range


def with_neighbour(
    df: DataFrame,
    order: list[str],
    value: Column,
    name: str,
    step: int = -1,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add struct ``name`` with field ``v``: ``value`` on the row before (-1) or
    after (+1). The struct itself is NULL where there is no such row."""
    ranged = with_range(df, order, rows_per_range)
    return neighbour_in_ranges(ranged, order, value, name, step).drop(RANGE)


def neighbour_in_ranges(
    ranged: DataFrame, order: list[str], value: Column, name: str, step: int
) -> DataFrame:
    """``with_neighbour`` over rows that already carry their range."""

    def shift(column: str) -> Column:
        return F.lag(column) if step < 0 else F.lead(column)

    ranged = ranged.withColumn("_v", F.struct(value.alias("v")))
    inner = Window.partitionBy(RANGE).orderBy(*order)
    edge = F.max_by if step < 0 else F.min_by
    borders = ranged.groupBy(RANGE).agg(edge("_v", F.struct(*order)).alias("_edge"))
    across = borders.select(RANGE, shift("_edge").over(Window.orderBy(RANGE)).alias("_edge"))
    return (
        ranged.withColumn("_n", shift("_v").over(inner))
        .join(F.broadcast(across), RANGE, "left")
        .withColumn(name, F.coalesce("_n", "_edge"))
        .drop("_v", "_n", "_edge")
    )


def with_last_seen(
    df: DataFrame,
    order: list[str],
    value: Column,
    where: Column,
    name: str,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``name``: ``value`` of the last row at or before this one that meets
    ``where``. ``value`` must not be NULL on those rows (use a struct)."""
    ranged = with_range(df.withColumn("_v", F.when(where, value)), order, rows_per_range)
    upto = (
        Window.partitionBy(RANGE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = ranged.withColumn("_n", F.last("_v", ignorenulls=True).over(upto))
    key = F.when(F.col("_v").isNotNull(), F.struct(*order))
    borders = ranged.groupBy(RANGE).agg(F.max_by("_v", key).alias("_edge"))
    # Values may be long texts, so one task only sees the number of the range that a range takes
    # its value from. The values are shuffled to the ranges, which are shuffled by range already.
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("_edge").isNotNull(), F.col(RANGE))
    source = borders.select(RANGE, own.alias("_own"))
    source = source.select(RANGE, F.last("_own", ignorenulls=True).over(before).alias("_from"))
    edges = borders.select(F.col(RANGE).alias("_from"), "_edge")
    across = source.filter("_from IS NOT NULL").join(edges, "_from").drop("_from")
    return (
        found.join(across, RANGE, "left")
        .withColumn(name, F.coalesce("_n", "_edge"))
        .drop("_v", "_n", "_edge", RANGE)
    )


def with_rank(
    df: DataFrame,
    group: list[str],
    order: list[str],
    name: str = "rank",
    descending: bool = False,
    at_most: int | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add a 1-based row number within ``group`` along ``order``; with ``at_most``, keep
    only the rows up to that number.

    For ranks too large for a pruned window. A group that spans ranges is numbered in
    pieces; at most one carried count per range border is broadcast. Pieces that start
    beyond ``at_most`` are dropped before the rows are shuffled.
    """
    ranged = _with_rows_before(with_range(df, [*group, *order], rows_per_range), group, descending)
    if at_most is not None:
        ranged = ranged.filter(F.col("_before") < at_most)
    inner = Window.partitionBy(RANGE, *group).orderBy(*directed(order, descending))
    ranked = ranged.withColumn(name, F.row_number().over(inner) + F.col("_before"))
    if at_most is not None:
        ranked = ranked.filter(F.col(name) <= at_most)
    return ranked.drop("_before", RANGE)


def _with_rows_before(ranged: DataFrame, group: list[str], descending: bool) -> DataFrame:
    """Add ``_before``, the rows of the same group in the ranges ahead of this one."""
    # Only the first and the last group of a range can go on in another one.
    own = F.struct(*group)
    edges = ranged.groupBy(RANGE).agg(F.min(own).alias("_first"), F.max(own).alias("_last"))
    at_edge = own.eqNullSafe(F.col("_first")) | own.eqNullSafe(F.col("_last"))
    counts = (
        ranged.select(RANGE, *group).join(F.broadcast(edges), RANGE).filter(at_edge)
        .groupBy(RANGE, *group).agg(F.count("*").alias("_rows"))
    )
    ahead = (
        Window.partitionBy(*group)
        .orderBy(*directed([RANGE], descending))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = counts.select(
        F.col(RANGE).alias("_r"),
        *[F.col(c).alias(f"_g_{c}") for c in group],
        F.sum("_rows").over(ahead).alias("_carry"),
    ).filter("_carry > 0")
    same = [F.col(RANGE) == F.col("_r")]
    same += [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group]
    joined = ranged.join(F.broadcast(carried), reduce(Column.__and__, same), "left")
    return joined.withColumn("_before", F.coalesce("_carry", F.lit(0))).drop(*carried.columns)


def rows_between(
    df: DataFrame,
    order: list[str],
    first: int,
    last: int,
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Rows number ``first`` to ``last`` (1-based) along ``order``, in that order.

    Counting the rows per range tells which ranges can hold them; only those ranges are
    shuffled and sorted.
    """
    ranged = with_range(df, order, rows_per_range)
    counts = ranged.groupBy(RANGE).agg(F.count("*").alias("_rows"))
    # One row per range, so one task may order them.
    ahead = Window.orderBy(*directed([RANGE], descending)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    needed = counts.withColumn(
        "_before", F.coalesce(F.sum("_rows").over(ahead), F.lit(0))
    ).filter((F.col("_before") < last) & (F.col("_before") + F.col("_rows") >= first))
    inner = Window.partitionBy(RANGE).orderBy(*directed(order, descending))
    ranked = ranged.join(F.broadcast(needed), RANGE).withColumn(
        "_rank", F.row_number().over(inner) + F.col("_before")
    )
    wanted = ranked.filter(F.col("_rank").between(first, last))
    return wanted.orderBy("_rank").drop("_rank", "_before", "_rows", RANGE)


def directed(columns: list[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in columns]
