"""When to fetch what, so that no host is asked too often."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagestrata.functions.urls import host_of
from pagestrata.operators.ordered import with_rank
from pagestrata.plans.ranges import ROWS_PER_RANGE
from pagestrata.session import written

#: Hosts that have at least one row in so many; their numbers are broadcast, at most this many.
HOT_SHARE = 1000


def polite_slots(
    df: DataFrame, per_slot: int = 1, url: str = "url", order: list[str] | None = None, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Add ``slot``, a whole number from 0: the turn in which a row is to be fetched.

    A host has at most ``per_slot`` rows in a slot, in the order of ``order`` (default: ``url``; name enough columns
    to have no ties, which may fall either way). There are as many slots as the host with most rows needs, the
    fewest possible. Smaller hosts begin at a slot that their name's hash chooses among
    those from which they still finish in time, so the first slots are not the fullest.

    URLs without a host, and NULL ones, are one host. Rows are ranked in ranges, so a host with a third of all
    rows is not one task. A column ``slot`` is replaced.
    """
    if per_slot < 1:
        raise ValueError("per_slot must be at least 1")
    order = order or [url]
    rows = written(df.drop("slot").withColumn("_host", F.coalesce(host_of(F.col(url)), F.lit(""))))
    sizes = written(rows.groupBy("_host").agg(F.count("*").alias("_n")))
    total, most = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    slots = -(-most // per_slot)
    needed = F.ceil(F.col("_n") / per_slot)
    starts = sizes.select("_host", "_n", F.pmod(F.xxhash64("_host"), slots - needed + 1).alias("_start"))
    hot = F.col("_n") * HOT_SHARE >= total
    ranked = with_rank(rows, ["_host"], order, "_rank", rows_per_range=rows_per_range)
    # Hot hosts are few by their share; all others are small enough for a shuffle by host.
    known = ranked.join(F.broadcast(starts.filter(hot).drop("_n")), "_host", "left")
    cold = known.filter("_start IS NULL").drop("_start").join(starts.filter(~hot).drop("_n"), "_host")
    both = known.filter("_start IS NOT NULL").unionByName(cold)
    slot = F.col("_start") + F.floor((F.col("_rank") - 1) / per_slot)
    return both.withColumn("slot", slot.cast("long")).drop("_host", "_rank", "_start")
