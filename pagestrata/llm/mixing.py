"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagestrata.llm.common import n_words, stored

#: Documents that are ranked together in one window; a larger stratum is split by hash.
CHUNK = 1_000
#: Offsets are multiples of this, so that adding one to a whole number is exact.
GRAIN = 1 << 20


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Add ``weight``: ``weights`` dealt out in turn to the sources by code point, NULL last.

    ``sources`` has one row per source, which is what the one ordered task sees.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("weight", F.get(cycle, place % len(weights)))


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Add ``target`` to rows (``source``, ``source_size``, ``weight``): ``share`` of all
    sizes split by weight, none above ``most`` times its source, the excess reshared.

    Filling stops at sources in the order of ``most * source_size / weight``. With the
    ``i`` first of them full, the others get ``level_i`` per weight; this rises as long
    as the next one overflows and falls after it, so the final level is the greatest.
    """
    by_room = Window.orderBy(F.col("_room") / F.col("weight"), F.col("source").asc_nulls_last())
    ahead = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    filled = sources.withColumn("_room", F.col("source_size") * F.lit(float(most)))
    left = F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(
        F.sum("_room").over(ahead), F.lit(0.0)
    )
    filled = filled.withColumn("_level", left / F.sum("weight").over(onward))
    level = F.max("_level").over(whole)
    return filled.withColumn("target", F.least(F.col("_room"), F.col("weight") * level)).drop(
        "_room", "_level"
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] | DataFrame = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """How often each document of ``docs`` (``doc_id``, ``text``, ``source``) is taken.

    Returns ``doc_id``, ``source``, ``size`` (words), ``source_size``, ``target``,
    ``copies``, ``taken`` (= copies * size), and struct ``row`` of the ``carry`` columns
    if any are named. ``weights`` is dealt out in turn, or is a table (``source``,
    ``weight`` > 0) with one row per source.

    Every document of a source expects ``target / source_size`` copies. Within the source
    documents stand from long to short, so that the words lost and won by rounding
    nearly cancel. The prefix sum of the expected copies plus one random offset (from
    ``seed``) passes whole numbers; a document is taken once for each that it passes.

    The prefix sum is not one ordered task: a source is cut into strata by the bit
    length of the size, a stratum into chunks of about ``CHUNK`` documents by a hash of
    the id. Chunks are summed by count, documents are ranked within their chunk.

    NULL texts and texts without words have size 0 and take 0 words. A NULL source is a
    source like any other, NULL ids hash as 0. Repeated rows are separate documents. A
    source without words has target 0 and takes nothing. No rows give no rows.
    """
    kept = [F.struct(*[F.col(c) for c in carry]).alias("row")] if carry else []
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *kept)
    sized = sized.withColumn("_bits", F.length(F.bin("size")))
    if not carry:
        sized = stored(sized)

    strata = stored(
        sized.groupBy("source", "_bits").agg(F.count("*").alias("_docs"), F.sum("size").alias("_size"))
    )
    sources = strata.groupBy("source").agg(F.sum("_size").alias("source_size"))
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double"))
        sources = sources.join(given, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    else:
        sources = cyclic_weights(sources, weights)
    plan = stored(targets(sources, share, most).drop("weight"))

    hashed = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id"), F.lit(0)).cast("string")), 1, 8), 16, 10)
    split = strata.select("source", "_bits", F.ceil(F.col("_docs") / CHUNK).alias("_chunks"))
    chunked = _join(sized, split, "source", "_bits").withColumn(
        "_chunk", hashed.cast("long") % F.col("_chunks")
    )
    counts = chunked.groupBy("source", "_bits", "_chunk").agg(F.count("*").alias("_docs"))
    ahead = (
        Window.partitionBy("source")
        .orderBy(F.desc("_bits"), "_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = _join(counts, plan, "source").select(
        "source", "_bits", "_chunk", "source_size", "target",
        F.coalesce(F.sum("_docs").over(ahead), F.lit(0)).alias("_before"),
    )
    inner = Window.partitionBy("source", "_bits", "_chunk").orderBy(F.desc("size"), "doc_id")
    rank = F.row_number().over(inner) + F.col("_before")
    found = _join(chunked, before, "source", "_bits", "_chunk").withColumn("_rank", rank)

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = F.lit(random.Random(seed).randrange(GRAIN) / GRAIN)
    copies = passed(F.col("_rank"), rate, offset) - passed(F.col("_rank") - 1, rate, offset)
    # Rounding must not take a document once more than its expected copies, rounded up.
    found = found.withColumn("copies", F.least(copies, F.ceil(rate)).cast("int"))
    return found.select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
        *(["row"] if carry else []),
    )


def passed(rank: Column, rate: Column, offset: Column) -> Column:
    """The whole numbers passed by the expected copies of the first ``rank`` documents."""
    return F.floor(rank * rate + offset)


def take(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    mixed = mix(docs, carry=tuple(docs.columns), **settings).filter("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def _join(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join on ``keys`` where NULL equals NULL."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns]
    )
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return left.join(renamed, on).drop(*[f"_r_{k}" for k in keys])
