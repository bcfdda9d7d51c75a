"""Groups that are compared pair by pair: split into blocks, read whole, linked up.

A group of any size is cut into parts of bounded size by a hash of its members, and every
two parts (and every part with itself) are compared as one block in some task. So no task
holds more than two parts, and no pair becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagestrata.llm.common import stored, with_lookup


def blocks(members: DataFrame, member: str, parts: Column) -> DataFrame:
    """Repeat each row of ``members`` for each block that its part belongs to.

    ``parts`` is the number of parts of the row's group. Adds ``part`` and the block's
    two parts, ``low`` <= ``high``.
    """
    split = members.withColumn("_parts", parts.cast("int")).withColumn(
        "part", F.pmod(F.xxhash64(member), F.col("_parts")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    return (
        split.withColumn("_other", other)
        .withColumn("low", F.least("part", "_other").cast("long"))
        .withColumn("high", F.greatest("part", "_other").cast("long"))
        .withColumn("part", F.col("part").cast("long"))
        .drop("_parts", "_other")
    )


def in_blocks(members: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (``key``, ``low``, ``high``, then ``columns``) with every block whole and together."""
    block = ["key", "low", "high"]
    return members.select(*block, *columns).repartition(*block).sortWithinPartitions(*block)


def whole_groups(
    batches: Iterator[pa.RecordBatch], n_keys: int = 3
) -> Iterator[tuple[pa.RecordBatch, list[int], list[int]]]:
    """Batches that end with the end of a group, with the starts and stops of their groups."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        keys = np.stack([np.asarray(batch.column(i)) for i in range(n_keys)])
        turns = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        if not len(turns):
            held = batch
            continue
        yield batch.slice(0, turns[-1]), [0, *turns[:-1].tolist()], turns.tolist()
        held = batch.slice(turns[-1])
    if held is not None and held.num_rows:
        yield held, [0], [held.num_rows]


def comparable(part: np.ndarray, low: int, high: int) -> np.ndarray:
    """Which pairs of a block's members this block compares: between its two parts, or all
    within its only one; the upper half of the matrix."""
    pairs = np.triu(np.ones((len(part), len(part)), bool), 1)
    if low != high:
        pairs &= part[:, None] != part[None, :]
    return pairs


def forest(ids: np.ndarray, links: np.ndarray) -> list[tuple[int, int]]:
    """As few links as hold the block's linked members together: each to its smallest."""
    order = np.argsort(ids, kind="stable")
    links = (links | links.T)[np.ix_(order, order)]
    np.fill_diagonal(links, True)
    label = np.arange(len(ids))
    while True:
        smaller = np.where(links, label[None, :], len(ids)).min(1)
        if (smaller == label).all():
            break
        label = smaller
    ids = ids[order]
    far = np.flatnonzero(ids[label] != ids)
    return list(zip(ids[far].tolist(), ids[label[far]].tolist(), strict=True))


def components(edges: DataFrame) -> DataFrame:
    """The smallest id that each end of ``edges`` (``u``, ``v``) can reach: ``id``, ``component``.

    Large-star and small-star steps in turn (Kiveris et al., Connected Components in
    MapReduce and Beyond) until nothing changes, each step's edges written to the shared
    folder. An id with very many edges is pre-aggregated to its smallest neighbour, which
    is then joined to them.
    """
    pair = F.struct(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stored(edges.filter("u <> v").select(pair.alias("e")).select("e.*").distinct())
    before = None
    while (state := _state(now)) != before:
        before = state
        if not state[0]:
            break
        now = stored(_small_star(_large_star(now)))
    own = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(own)


def with_components(nodes: DataFrame, links: DataFrame, least: Column) -> DataFrame:
    """``nodes`` (``node`` and others) that ``links`` (``u``, ``v``) reach, with ``component``: the
    smallest value of ``least`` among all nodes that their links reach."""
    of = nodes.join(components(links).withColumnsRenamed({"id": "node", "component": "_root"}), "node")
    of = stored(of)
    smallest = of.groupBy("_root").agg(F.min(least).alias("component"), F.count("*").alias("_weight"))
    return with_lookup(of, smallest, "_root", "_weight").drop("_root")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each id to the smallest of it and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each id and its smaller neighbours to the smallest of them; all have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
