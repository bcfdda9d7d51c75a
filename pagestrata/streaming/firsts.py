"""The first or latest captures of every key, kept up to date as index files arrive.

The stream adds a capture to a table when it belongs among the ``n`` best of its key so far. Later
arrivals only push captures out, so the table always holds the true ones, in whatever order and
batches lines came: ``first_of`` ranks what is left. Order is by event time, hence late lines need no
watermark and none is dropped.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagestrata.operators.dedup import key_expression
from pagestrata.operators.topk import rank_at_most
from pagestrata.schema import index_order
from pagestrata.streaming.tail import append_to_table

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_ORDERED = (*_WHOLE, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_STATE = "asked INT, best STRING"
#: Groups that the parts of keys are dealt to. A call costs a group about 2 ms, and reads and writes its whole state.
BUCKETS = 4096


def keep_firsts(
    stream: DataFrame,
    keys: list[str],
    n: int = 1,
    order: list[str] | None = None,
    descending: bool = False,
    parts: int = 16,
    idle_hours: float = 24 * 7,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Captures that are among the first ``n`` of their key when they arrive.

    ``keys`` are specs as in ``distinct_on`` (``url``, ``year``, ``urlkey:6``); ``order`` is index order by default.
    Write the result with ``append_firsts`` and read it through ``first_of`` with the same arguments. Each key has
    ``n`` places of its order as state, in up to ``parts`` parts, so that a URL with a third of all captures is not one task. The
    parts of all keys are dealt to ``buckets`` groups, each with the places of its keys as state: a batch costs no call per
    key, but reads and writes the buckets it meets; take more of them where small batches meet very many keys. A key
    that nothing arrives for in ``idle_hours`` is forgotten; its next captures are added anew, which costs rows
    of the table and changes no result. A checkpoint that was begun with another ``n`` is an error.

    NULL keys are a key, NULLs are the smallest places, equal rows count each. Nested columns are not taken: write
    them as JSON before. An empty stream gives an empty table.
    """
    order = order or index_order(stream)
    if n < 1 or parts < 1 or buckets < 1 or not keys:
        raise ValueError("name at least one key, and n, parts and buckets of at least 1")
    flat = [_as_text(f) for f in stream.schema]
    place = F.to_json(F.struct(*[_comparable(stream.schema[c]).alias(f"p{i}") for i, c in enumerate(order)]))
    part = F.pmod(F.xxhash64("_place"), F.lit(parts)).alias("part")
    named = [key_expression(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)]
    # Keys are made of the columns as they were, so before these are text.
    keyed = stream.withColumn("_place", place).withColumn("_key", F.to_json(F.struct(*named, part)))
    sent = keyed.select(*flat, "_place", "_key", F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int").alias("_bucket"))
    columns, width = list(stream.columns), len(order)
    milliseconds = max(1, int(idle_hours * 3_600_000))

    def update(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        asked, kept = state.get if state.exists else (n, "{}")
        if asked != n:
            raise ValueError(f"this checkpoint keeps {asked} captures of a key, not {n}")
        now = state.getCurrentProcessingTimeMs()
        # By key: when its last captures came, and its places as JSON.
        held = {k: x for k, x in json.loads(kept).items() if now - x[0] <= milliseconds}
        best: dict[str, list[tuple]] = {}
        for frame in frames:
            found: dict[str, list[tuple]] = {}
            places = [_rank([p.get(f"p{i}") for i in range(width)]) for p in map(json.loads, frame["_place"])]
            for k, p in zip(frame["_key"], places):
                found.setdefault(k, []).append(p)
            for k, some in found.items():
                before = best[k] if k in best else [_rank(p) for p in held[k][1]] if k in held else []
                best[k] = sorted([*before, *some], reverse=descending)[:n]
            good = [p >= best[k][-1] if descending else p <= best[k][-1] for k, p in zip(frame["_key"], places)]
            if any(good):
                yield frame.loc[good, columns]
        held |= {k: (now, [[value if known else None for known, value in p] for p in some]) for k, some in best.items()}
        state.update((n, json.dumps(held, separators=(",", ":"))))
        state.setTimeoutDuration(milliseconds)

    # The timeout is one of processing time: one of event time would drop late lines.
    found = sent.groupBy("_bucket").applyInPandasWithState(
        update, T.StructType([T.StructField(c, T.StringType()) for c in columns]), _STATE, "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )
    return found.select(*[_from_text(f) for f in stream.schema])


def append_firsts(kept: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add what ``keep_firsts`` keeps of the files that have arrived to a Parquet table, then stop."""
    conf, name = kept.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name)
    # Timeouts ask for another batch for ever, also without files. The query copies its settings as it starts.
    conf.set(name, "false")
    try:
        return append_to_table(kept, path, checkpoint)
    finally:
        conf.set(name, before)


def first_of(
    table: DataFrame, keys: list[str], n: int = 1, order: list[str] | None = None, descending: bool = False
) -> DataFrame:
    """The first ``n`` captures of every key among those that ``keep_firsts`` added."""
    names = [f"_key{i}" for i in range(len(keys))]
    keyed = table.withColumns({name: key_expression(k) for name, k in zip(names, keys)})
    return rank_at_most(keyed, names, order or index_order(table), n, descending).drop(*names, "_rank")


def _rank(place: list) -> tuple:
    """Comparable as Spark compares: NULL is below everything."""
    return tuple((value is not None, 0 if value is None else value) for value in place)


def _comparable(field: T.StructField) -> Column:
    """A form of a column that JSON keeps exactly and Python orders as Spark does."""
    value = F.col(f"`{field.name}`")
    if not isinstance(field.dataType, _ORDERED):
        raise ValueError(f"captures are not ordered by {field.name}: {field.dataType.simpleString()}")
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(field.dataType, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), value)
    return F.unix_date(value) if isinstance(field.dataType, T.DateType) else value


def _as_text(field: T.StructField) -> Column:
    """A column as text, since pandas would turn whole numbers with NULLs into doubles."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        raise ValueError(f"write nested column {field.name} as JSON before")
    if isinstance(field.dataType, T.TimestampType):
        value = F.unix_micros(value)
    if isinstance(field.dataType, T.BinaryType):
        value = F.hex(value)
    return value.cast("string").alias(field.name)


def _from_text(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.TimestampType):
        return F.timestamp_micros(value.cast("long")).alias(field.name)
    if isinstance(field.dataType, T.BinaryType):
        return F.unhex(value).alias(field.name)
    return value.cast(field.dataType).alias(field.name)
