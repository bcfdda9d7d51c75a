"""Summaries that are kept with an index and merged at query time.

One row per crawl, host and year holds exact sums and sketches of its URLs and bodies. Any
coarser summary, and the overlap of two crawls, comes from these rows alone, so a new crawl is
summarised by itself and the old ones are not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagestrata.functions.urls import host_of

#: Powers of two of the sketches' entries. The URL sketch is exact up to about 4,096 URLs and beyond
#: has a standard error of 1.6 %; that of bodies has 1.3 %. They take at most 32 kB and 4 kB.
URL_ENTRIES = 12
BODY_ENTRIES = 12

KEYS = ("crawl_id", "host", "year")


def roll_up(df: DataFrame) -> DataFrame:
    """One row per ``crawl_id``, ``host`` and ``year`` of the captures ``df``.

    Holds ``captures``, ``bytes`` (of ``length``; NULL counts 0), ``first_ts`` and ``last_ts``, and the
    sketches ``url_sketch`` (theta, of ``url``) and ``body_sketch`` (HLL, of ``digest``), to which NULLs
    add nothing. NULL keys are groups of their own. Tasks sketch before they shuffle, so a
    host with a third of all captures sends one row per task and year.
    """
    keyed = df.withColumn("host", host_of(F.col("url"))).withColumn("year", F.year("timestamp"))
    return keyed.groupBy(*KEYS).agg(
        F.count("*").alias("captures"),
        F.coalesce(F.sum(F.col("length").cast("long")), F.lit(0)).alias("bytes"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        F.theta_sketch_agg("url", URL_ENTRIES).alias("url_sketch"),
        F.hll_sketch_agg("digest", BODY_ENTRIES).alias("body_sketch"),
    )


def write_rollups(rollups: DataFrame, path: str) -> None:
    """Put ``rollups`` of whole crawls into the table at ``path``, one folder per crawl. Crawls that are
    there already are replaced, all others are neither read nor written."""
    rows = rollups.repartition("crawl_id", F.pmod(F.xxhash64("host"), F.lit(16)))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("crawl_id").parquet(path)


def merge_rollups(rollups: DataFrame, *by: str) -> DataFrame:
    """``rollups`` by fewer keys (or none): the exact columns, and about how many URLs (``n_urls``) and
    bodies (``n_bodies``) there are."""
    merged = _merged(rollups, *by)
    return merged.select(
        *by, "captures", "bytes", "first_ts", "last_ts",
        F.coalesce(F.theta_sketch_estimate("url_sketch"), F.lit(0)).alias("n_urls"),
        F.coalesce(F.hll_sketch_estimate("body_sketch"), F.lit(0)).alias("n_bodies"),
    )


def url_overlaps(rollups: DataFrame, pairs: DataFrame, key: str = "crawl_id") -> DataFrame:
    """For each row of ``pairs`` (``left``, ``right``: values of ``key``, any others) about how many URLs each has
    (``n_left``, ``n_right``), both have (``n_both``) and either has (``n_either``).

    A value that is not there has no URLs. The error of all four is a share of ``n_either``, so a
    small overlap of large sets is only known to be small. Only the pairs asked for are made.
    """
    sketches = _merged(rollups, key).select(F.col(key).alias("_key"), F.col("url_sketch").alias("_s"))
    sides = pairs
    for side in ("left", "right"):
        own = sketches.withColumnsRenamed({"_key": f"_{side}_key", "_s": f"_{side}"})
        sides = sides.join(own, sides[side] == own[f"_{side}_key"], "left").drop(f"_{side}_key")

    def size(sketch: Column) -> Column:
        return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0))

    n_left, n_right = size(F.col("_left")), size(F.col("_right"))
    both = F.theta_intersection(F.col("_left"), F.col("_right"))
    either = F.theta_union(F.col("_left"), F.col("_right"), F.lit(URL_ENTRIES))
    return sides.select(
        *pairs.columns,
        n_left.alias("n_left"),
        n_right.alias("n_right"),
        size(both).alias("n_both"),
        F.coalesce(F.theta_sketch_estimate(either), n_left + n_right).alias("n_either"),
    )


def _merged(rollups: DataFrame, *by: str) -> DataFrame:
    return rollups.groupBy(*by).agg(
        F.coalesce(F.sum("captures"), F.lit(0)).alias("captures"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.theta_union_agg("url_sketch", URL_ENTRIES).alias("url_sketch"),
        F.hll_union_agg("body_sketch").alias("body_sketch"),
    )
