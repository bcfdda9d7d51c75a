"""Choosing crawls: by id, by time span, or the latest one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagestrata.operators.filters import instant
from pagestrata.plans.ranges import RANGE, ROWS_PER_RANGE, with_range
from pagestrata.session import written

# Starts of a bucket of an overlap join, and spans that one part of a bucket takes.
BUCKET = 64
HOT_BUCKET = 25_000
# Buckets that are dealt out in parts at most, those that most spans touch.
HOT_BUCKETS = 10_000


def in_crawls(df: DataFrame, *crawl_ids: str) -> DataFrame:
    """Captures of the named crawls; a partition filter on an index table."""
    return df.filter(F.col("crawl_id").isin(list(crawl_ids)))


def overlapping_crawls(catalog: DataFrame, since=None, until=None) -> DataFrame:
    """Catalog rows whose span overlaps [since, until]; an open end does not restrict."""
    found = catalog
    if since is not None:
        found = found.filter(F.col("to_ts") >= instant(catalog, since, "to_ts"))
    if until is not None:
        found = found.filter(F.col("from_ts") <= instant(catalog, until, "from_ts"))
    return found


def select_crawls(df: DataFrame, catalog: DataFrame, since=None, until=None) -> DataFrame:
    """Captures of the crawls whose span overlaps [since, until].

    A semi join on the partition column: with a catalog file, which is small, Spark
    prunes the other crawls' partitions before reading them.
    """
    ids = overlapping_crawls(catalog, since, until).select(F.col("id").alias("crawl_id"))
    return df.join(ids, "crawl_id", "left_semi")


def latest_crawl(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Captures of the crawl that ends last. The id is one scalar, so the filter on
    the partition column is known before files are listed."""
    newest = catalog.agg(F.max_by("id", F.struct("to_ts", "id"))).scalar()
    return df.filter(F.col("crawl_id") == newest)


def overlap_join(left: DataFrame, right: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Pair rows of ``left`` (``lo``, ``hi``) with rows of ``right`` (``from_ts``, ``to_ts``) where
    ``to_ts >= lo`` and ``from_ts <= hi``. Rows without one of their bounds pair with nothing; spans
    that end before they start pair by the same comparison.

    All bounds are put into one order, along which the starts of each side are counted. So a row knows
    which of the other side's starts, by their numbers, lie within its span, and of each pair the later
    start lies in the other's span. Starts are dealt out to buckets of ``BUCKET`` numbers, and a span
    goes to the buckets that it touches: all but the two at its ends it fills with pairs. What is
    shuffled is so bounded by both inputs and the result, however long spans are. Buckets
    that very many spans touch are dealt out in parts.
    """
    l = _numbered(left, "lo", "hi")
    r = _numbered(right, "from_ts", "to_ts")
    sides = [("lo", 0, l), ("from_ts", 1, r), ("hi", 2, l), ("to_ts", 3, r)]
    bounds = reduce(
        DataFrame.unionByName, [s.select(F.col(f"_row.{c}").alias("t"), F.lit(kind).alias("kind"), "_id") for c, kind, s in sides]
    )
    # Of equal bounds, starts of the left side come first, then those of the right side, then ends.
    order = ["t", F.least("kind", F.lit(2)).alias("rank"), "kind", "_id"]
    counted = _starts_so_far(bounds.select(*order), ["t", "rank", "kind", "_id"], rows_per_range)
    own = F.when(F.col("kind") == 0, F.col("n_left") - 1).when(F.col("kind") == 1, F.col("n_right") - 1)
    other = F.when(F.col("kind") % 2 == 0, F.col("n_right")).otherwise(F.col("n_left"))
    start = F.col("kind") < 2
    of_row = counted.groupBy((F.col("kind") % 2).alias("side"), "_id").agg(
        F.max(own).alias("own"), F.max(F.when(start, other)).alias("first"), F.max(F.when(~start, other)).alias("behind")
    )
    of_row = written(of_row)
    l = l.join(of_row.filter("side = 0").drop("side"), "_id")
    r = r.join(of_row.filter("side = 1").drop("side"), "_id")
    touch = (F.col("r.to_ts") >= F.col("l.lo")) & (F.col("r.from_ts") <= F.col("l.hi"))
    both = [_starts_in(l, r, "l", "r"), _starts_in(r, l, "r", "l")]
    return both[0].unionByName(both[1]).filter(touch).select("l.*", "r.*")


def _numbered(df: DataFrame, start: str, end: str) -> DataFrame:
    """The rows with both bounds as ``_row``, and a number for each, ``_id``."""
    rows = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull()).select(F.struct(*df.columns).alias("_row"))
    return written(rows.withColumn("_id", F.monotonically_increasing_id()))


def _starts_so_far(bounds: DataFrame, order: list[str], rows_per_range: int) -> DataFrame:
    """``bounds`` with the starts of each side up to and with each of them: ``n_left``, ``n_right``."""
    ranged = with_range(bounds, order, rows_per_range)
    starts = {"n_left": F.col("kind") == 0, "n_right": F.col("kind") == 1}
    upto = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ranged.withColumns({n: F.sum(c.cast("long")).over(upto) for n, c in starts.items()})
    totals = ranged.groupBy(RANGE).agg(*[F.sum(c.cast("long")).alias(n) for n, c in starts.items()])
    # One row per range.
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select(RANGE, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in starts])
    found = inside.join(F.broadcast(ahead), RANGE)
    return found.select("kind", "_id", *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in starts])


def _starts_in(spans: DataFrame, points: DataFrame, name: str, other: str) -> DataFrame:
    """Pairs of ``spans`` and those of ``points`` that start within them, as structs ``name`` and ``other``."""
    buckets = F.sequence(F.floor(F.col("first") / BUCKET), F.floor((F.col("behind") - 1) / BUCKET))
    spread = spans.filter("first < behind").select(
        F.col("_row").alias(name), "_id", "first", "behind", F.explode(buckets).alias("_bucket")
    )
    touched = spread.groupBy("_bucket").agg(F.count("*").alias("n")).filter(F.col("n") > HOT_BUCKET)
    hottest = touched.orderBy(F.desc("n"), "_bucket").limit(HOT_BUCKETS)
    hot = F.broadcast(hottest.select("_bucket", F.ceil(F.col("n") / HOT_BUCKET).alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    spread = spread.join(hot, "_bucket", "left").withColumn("_part", F.pmod(F.xxhash64("_id"), parts)).drop("_parts", "_id")
    dealt = points.select(F.col("_row").alias(other), "own", F.floor(F.col("own") / BUCKET).alias("_bucket"))
    dealt = dealt.join(hot, "_bucket", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    inside = (F.col("own") >= F.col("first")) & (F.col("own") < F.col("behind"))
    return spread.join(dealt.drop("_parts"), ["_bucket", "_part"]).filter(inside).select(name, other)
