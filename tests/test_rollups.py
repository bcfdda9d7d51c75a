"""Mergeable summaries against exact ones."""

import os

import pytest
from pyspark.sql import functions as F

from data import SCHEMA, captures_with_hot_keys
from pagestrata import merge_rollups, roll_up, url_overlaps, write_rollups
from pagestrata.session import shared_folder

ROWS = captures_with_hot_keys(900)


@pytest.fixture(scope="module")
def index(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4).cache()


def wide(spark, start, stop, crawl):
    """Captures of the URLs ``start`` to ``stop``, twice each."""
    n = F.col("id").cast("string")
    ids = spark.range(start, stop)
    return ids.union(ids).select(
        F.concat(F.lit("http://h"), F.col("id") % 7, F.lit(".example.org/"), n).alias("url"), F.lit("2024-01-01").cast("timestamp_ntz").alias("timestamp"),
        F.lit(crawl).alias("crawl_id"), F.md5(n).alias("digest"), F.lit(3).alias("length"),
    )


@pytest.mark.parametrize("by", [("crawl_id",), ("host",), ("host", "year"), ()])
def test_small_sets_are_counted_exactly(index, by):
    keyed = index.withColumn("host", F.regexp_extract("url", "//([^/]+)", 1)).withColumn("year", F.year("timestamp"))
    wanted = keyed.groupBy(*by).agg(
        F.count("*"), F.sum("length"), F.min("timestamp"), F.max("timestamp"), F.count_distinct("url"), F.count_distinct("digest")
    )
    assert sorted(map(str, merge_rollups(roll_up(index), *by).collect())) != []
    assert sorted(map(tuple, merge_rollups(roll_up(index), *by).collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)


def test_large_sets_are_within_the_bound(spark):
    df = wide(spark, 0, 60_000, "a").union(wide(spark, 40_000, 140_000, "b"))
    rollups = roll_up(df)
    whole = merge_rollups(rollups).first()
    assert whole.captures == 320_000 and whole.bytes == 960_000
    assert abs(whole.n_urls - 140_000) < 0.05 * 140_000
    assert abs(whole.n_bodies - 140_000) < 0.05 * 140_000
    pairs = spark.createDataFrame([("a", "b", 1), ("b", "a", 2), ("a", "a", 3), ("a", "none", 4), ("none", "no", 5), (None, "a", 6)], "left string, right string, q int")
    found = {r.q: r for r in url_overlaps(rollups, pairs).collect()}
    assert len(found) == 6
    near = 0.05 * 140_000
    for q in (1, 2):
        assert abs(found[q].n_both - 20_000) < near and abs(found[q].n_either - 140_000) < near
    assert found[1].n_left == found[2].n_right and found[1].n_right == found[2].n_left
    assert found[3].n_both == found[3].n_either == found[3].n_left
    assert found[4].n_both == found[4].n_right == 0 and found[4].n_either == found[4].n_left > 0
    assert tuple(found[5])[3:] == (0, 0, 0, 0)
    assert found[6].n_left == 0 and found[6].n_both == 0


def test_a_new_crawl_is_added_without_the_old_ones(spark):
    path = shared_folder(spark)
    write_rollups(roll_up(wide(spark, 0, 500, "a")), path)
    old = {p: os.stat(f"{path}/crawl_id=a/{p}").st_mtime_ns for p in os.listdir(f"{path}/crawl_id=a")}
    for _ in range(2):  # written again, it is there once
        write_rollups(roll_up(wide(spark, 300, 900, "b")), path)
    assert old == {p: os.stat(f"{path}/crawl_id=a/{p}").st_mtime_ns for p in os.listdir(f"{path}/crawl_id=a")}
    kept = spark.read.parquet(path)
    assert merge_rollups(kept).select("captures", "n_urls").first() == (2200, 900)
    pairs = spark.createDataFrame([("a", "b")], "left string, right string")
    assert tuple(url_overlaps(kept, pairs).first()) == ("a", "b", 500, 600, 200, 900)


def test_sketches_are_made_before_the_shuffle(index):
    plan = roll_up(index)._jdf.queryExecution().executedPlan().toString()
    assert "partial_theta_sketch_agg" in plan and "partial_hll_sketch" in plan


def test_nulls_and_no_rows(spark, index):
    nothing = index.limit(0)
    assert roll_up(nothing).count() == 0
    assert merge_rollups(roll_up(nothing), "host").count() == 0
    assert tuple(merge_rollups(roll_up(nothing)).first()) == (0, 0, None, None, 0, 0)
    bare = spark.createDataFrame([(1, None, None, None, None, None, None, None, None)] * 3, SCHEMA)
    assert tuple(merge_rollups(roll_up(bare), "host").first()) == (None, 3, 0, None, None, 0, 0)
