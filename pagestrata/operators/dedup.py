"""One capture per key, and dropping adjacent repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagestrata.functions.urls import compact_time
from pagestrata.operators.ordered import neighbour_in_ranges
from pagestrata.plans.ranges import RANGE, ROWS_PER_RANGE, with_range
from pagestrata.schema import index_order
from pagestrata.session import written


def key_expression(spec: str) -> Column:
    """The value named by ``field`` or ``field:n`` (its first n characters).

    Timestamps are cut in their 14-digit form, so ``timestamp:4`` is the year.
    """
    field, _, n = spec.partition(":")
    if not n:
        return F.col(field)
    if not n.isdigit() or int(n) < 1:
        raise ValueError(f"not a prefix length: {spec!r}")
    text = compact_time(F.col(field)) if field == "timestamp" else F.col(field).cast("string")
    return F.substring(text, 1, int(n))


def distinct_on(
    df: DataFrame, keys: list[str], order: list | None = None
) -> DataFrame:
    """The first capture in ``order`` (index order by default) for every key tuple.

    The rank-limit runs on each map task before the shuffle, so a hot key sends one
    row per task, not all its captures.
    """
    if [k for k in keys if k == "month"] and "year" not in keys:
        raise ValueError("month alone does not name a period; use year and month")
    if not keys:
        raise ValueError("name at least one key")
    by = Window.partitionBy(*[key_expression(k) for k in keys]).orderBy(
        *(order or index_order(df))
    )
    return df.withColumn("_rn", F.row_number().over(by)).filter("_rn = 1").drop("_rn")


def collapse_adjacent(
    df: DataFrame,
    fields: str | list[str],
    order: list[str] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Drop a capture whose field equals that of the capture before it in index order.

    ``fields`` are collapse specs (``digest``, ``timestamp:8``). Several are applied
    one after the other, each to what the one before it left.
    """
    specs = [fields] if isinstance(fields, str) else list(fields)
    order = order or index_order(df)
    kept = with_range(df, order, rows_per_range)
    for i, spec in enumerate(specs):
        if i:
            # Each pass reads its input twice, so what the pass before left is written out.
            kept = written(kept)
        value = key_expression(spec)
        seen = neighbour_in_ranges(kept, order, value, "_before", -1)
        repeat = F.col("_before").isNotNull() & F.col("_before.v").eqNullSafe(value)
        kept = seen.filter(~repeat).drop("_before")
    return kept.drop(RANGE)
