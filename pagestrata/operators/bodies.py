"""Joining captures to stored page bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagestrata.session import written

# Error texts of a body that cannot be had.
MISSING_KEY = "Missing timestamp or URL"
NOT_STORED = "No stored body"

# Snapshots whose hashes (8 bytes each) are broadcast to the store; with more, it is read whole.
FEW_SNAPSHOTS = 1_000_000
# Snapshots whose bodies are shuffled as they are; of more, each different body is shuffled once.
FEW_BODIES = 100_000

_SNAPSHOT = ["_stored_url", "_stored_ts"]


def attach_bodies(df: DataFrame, store: DataFrame) -> DataFrame:
    """Add ``response`` (``body``, ``error``) from ``store`` (``url``, ``timestamp``,
    ``body``). Of several rows for one snapshot, the smallest body is taken.

    Filter the captures first: only what is left is joined. Captures without a complete
    key are spread by a hash of the row, so many of them do not meet in one task; a
    snapshot or body that very many captures point at is split by the skew handling of the join.
    For more than ``FEW_BODIES`` snapshots the store is read when this is called.
    """
    known = F.coalesce((F.length("url") > 0) & F.col("timestamp").isNotNull(), F.lit(False))
    flat = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    # NUL occurs in no URL, so such a key meets no stored body.
    spread = F.concat(F.lit("\0"), F.hex(F.xxhash64(*flat)))
    keyed = df.withColumn("_url", F.when(known, F.col("url")).otherwise(spread))
    # Which snapshots are asked for is settled by their keys; other bodies stay where they are.
    wanted = written(keyed.filter(known).select(F.xxhash64("url", "timestamp").alias("_wanted")).distinct())
    n_wanted = wanted.count()
    held = store
    if n_wanted <= FEW_SNAPSHOTS:
        asked = F.xxhash64(F.col("url"), F.col("timestamp").cast(df.schema["timestamp"].dataType))
        held = store.withColumn("_wanted", asked).join(F.broadcast(wanted), "_wanted", "left_semi")
    held = held.select(F.col("url").alias("_stored_url"), F.col("timestamp").alias("_stored_ts"), F.col("body").cast("binary").alias("_body"))
    same = (F.col("_url") == F.col("_stored_url")) & (F.col("timestamp") == F.col("_stored_ts"))
    if n_wanted <= FEW_BODIES:
        joined = keyed.join(held.groupBy(*_SNAPSHOT).agg(F.min("_body").alias("_body")), same, "left")
    else:
        snapshots, bodies = _by_content(held)
        # Captures without a body are spread too; no content hash has 8 bytes.
        place = F.coalesce("_id", F.unhex(F.hex(F.xxhash64(*flat))))
        joined = keyed.join(snapshots, same, "left").withColumn("_place", place)
        joined = joined.join(bodies.withColumnRenamed("_id", "_place"), "_place", "left").drop("_place", "_id")
    error = F.when(F.col("_url").startswith("\0"), MISSING_KEY).when(
        F.col("_stored_url").isNull(), NOT_STORED
    )
    response = F.struct(F.col("_body").alias("body"), error.alias("error"))
    return joined.withColumn("response", response).drop("_url", *_SNAPSHOT, "_body")


def _by_content(held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The hash (``_id``) of the smallest body of every snapshot, and every different body once, with its hash."""
    hashed = held.dropna(subset=_SNAPSHOT).withColumn("_id", F.unhex(F.sha2("_body", 256)))
    none = [F.lit(None).cast(hashed.schema[c].dataType).alias(c) for c in [*_SNAPSHOT, "_body"]]
    of_snapshot = F.struct(F.lit(False).alias("_is_body"), *_SNAPSHOT, "_id", none[2])
    of_body = F.struct(F.lit(True).alias("_is_body"), *none[:2], "_id", "_body")
    # Both come from one pass, so that they agree whatever the store gives the next time.
    rows = written(hashed.select(F.inline(F.array(of_snapshot, of_body))).distinct())
    snapshots = rows.filter("NOT _is_body").select(*_SNAPSHOT, "_id")
    bodies = rows.filter("_is_body AND _id IS NOT NULL").select("_id", "_body")
    several = written(snapshots.groupBy(*_SNAPSHOT).count().filter("count > 1").select(*_SNAPSHOT))
    if several.isEmpty():
        return snapshots, bodies
    contested = snapshots.join(several, _SNAPSHOT, "left_semi")
    ordered = bodies.join(contested.select("_id").distinct(), "_id", "left_semi").repartitionByRange("_body").sortWithinPartitions("_body")
    ranks = written(ordered.select("_id", F.monotonically_increasing_id().alias("_rank")))
    least = contested.join(ranks, "_id").groupBy(*_SNAPSHOT).agg(F.min("_rank").alias("_rank")).join(ranks, "_rank")
    return snapshots.join(several, _SNAPSHOT, "left_anti").unionByName(least.select(*_SNAPSHOT, "_id")), bodies
