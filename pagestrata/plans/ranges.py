"""Split a total order into ranges of bounded size.

Operators that look at the previous or next capture need the whole index in one
order. Grouping by URL or host does not bound the work: one site may hold a third
of all captures. Here the order itself is cut at sampled keys, so a range holds
about the same number of rows whatever the keys are. The range of a row is a pure
function of its key, hence a wrong guess by the sample costs balance, never rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_RANGE = 100_000
# Bytes of wide rows in a range, and the rows that tell how wide they are.
BYTES_PER_RANGE = 128 << 20
MEASURED_ROWS = 1000
# Split points travel in the plan, so there are no more than this. Beyond it (6.5 billion
# rows) a range grows in proportion; its task sorts on disk.
MAX_RANGES = 1 << 16
SAMPLES_PER_RANGE = 16
# Characters of a text that a split point keeps; a cut costs balance only.
SPLIT_CHARS = 200
# Split points are searched in two stages: the block, then the place in the block.
BLOCK = 128

RANGE = "_range"


def with_range(
    df: DataFrame,
    order: list[str],
    rows_per_range: int = ROWS_PER_RANGE,
    max_ranges: int = MAX_RANGES,
    bytes_per_range: int = BYTES_PER_RANGE,
) -> DataFrame:
    """Add ``_range``, an int that never falls along ``order``.

    Reads the key columns twice (count, sample) before the plan is returned. Rows that
    hold binary or nested values are measured on the first ``MEASURED_ROWS``, so that fewer
    of them share a range. The sample and the split points are bounded by ``max_ranges``,
    not by the data.
    """
    keys = df.select(*order)
    rows = keys.count()
    fitting = max(1, bytes_per_range // max(_width(df), 1))
    ranges = max(1, min(max_ranges, -(-rows // min(rows_per_range, fitting))))

    n_splits, firsts, blocks, none = _split_points(keys, order, ranges / max(rows, 1))
    found = df.withColumn("_key", F.struct(*order))
    found = _count_at_most(found, "_block", firsts, -(-n_splits // BLOCK))
    # Not a bare element of the literal, which would be copied into every step.
    block = F.coalesce(F.get(blocks, F.col("_block") - 1), none)
    found = found.withColumn("_splits", block)
    found = _count_at_most(found, "_place", F.col("_splits"), min(BLOCK, n_splits))
    place = F.greatest(F.col("_block") - 1, F.lit(0)) * BLOCK + F.col("_place")
    # The one-element explode makes _range a column of its own. Otherwise optimizer rules
    # that follow a join key to its source would write the search steps into one another.
    return found.select(*df.columns, F.explode(F.array(place)).alias(RANGE))


def _width(df: DataFrame) -> int:
    """Average bytes of a row's texts and bytes, 0 if all its columns are flat and short."""

    def sizes(field: T.StructField, value: Column) -> list[Column]:
        if isinstance(field.dataType, T.StructType):
            return [x for f in field.dataType.fields for x in sizes(f, value[f.name])]
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return [F.octet_length(value)]
        if isinstance(field.dataType, (T.ArrayType, T.MapType)):
            return [F.octet_length(F.to_json(value))]
        return []

    if all(not isinstance(f.dataType, (T.BinaryType, T.StructType, T.ArrayType, T.MapType)) for f in df.schema):
        return 0
    parts = [F.coalesce(x, F.lit(0)) for f in df.schema for x in sizes(f, F.col(f"`{f.name}`"))]
    total = reduce(Column.__add__, parts, F.lit(0))
    return int(df.limit(MEASURED_ROWS).agg(F.avg(total)).first()[0] or 0)


def _split_points(keys: DataFrame, order: list[str], density: float):
    """Sorted split points, ``density`` of the rows: how many there are, and as literals
    the first of each block, the blocks, and an empty block."""
    fraction = min(1.0, density * SAMPLES_PER_RANGE)
    short = [
        F.substring(c, 1, SPLIT_CHARS).alias(c) if keys.schema[c].dataType == T.StringType() else c
        for c in order
    ]
    picked = F.sort_array(F.collect_list(F.struct(*short)))
    every = F.filter("picked", lambda _, i: (i + 1) % SAMPLES_PER_RANGE == 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("splits"), F.lit(1)), F.lit(BLOCK))
    row = (
        keys.sample(fraction, seed=11)
        .agg(picked.alias("picked"))
        .select(every.alias("splits"))
        .select(
            F.size("splits"),
            F.to_json(F.filter("splits", lambda _, i: i % BLOCK == 0)),
            F.to_json(F.transform(starts, lambda s: F.slice("splits", s, F.lit(BLOCK)))),
        )
        .first()
    )
    key = T.ArrayType(T.StructType([keys.schema[c] for c in order]))
    # Parsed once by the optimizer, so rows only see the arrays.
    firsts, blocks = F.from_json(F.lit(row[1]), key), F.from_json(F.lit(row[2]), T.ArrayType(key))
    return row[0], firsts, blocks, F.from_json(F.lit("[]"), key)


def _count_at_most(df: DataFrame, name: str, splits: Column, most: int) -> DataFrame:
    """Add ``name``, how many of at most ``most`` sorted ``splits`` are <= ``_key``.

    A binary search written out step by step, which compiles to plain code. A place
    beyond the end is NULL and so never counted. Two keys part at the first split
    between them, so the count follows the keys even where splits lost precision.
    """
    df = df.withColumn(name, F.lit(0))
    at = F.col(name)
    for bit in reversed(range(most.bit_length())):
        step = 1 << bit
        beyond = F.get(splits, at + (step - 1)) <= F.col("_key")
        df = df.withColumn(name, F.when(beyond, at + step).otherwise(at))
    return df
