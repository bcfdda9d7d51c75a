"""A table clustered by key and time: equal rows, few files."""

import pytest
from pyspark.sql import functions as F

from pagestrata.operators import filters
from pagestrata.session import shared_folder
from pagestrata.sources.clustered import BOUNDS, find_clustered, write_clustered

CRAWL = "C 1:x+y"


@pytest.fixture(scope="module")
def index(spark):
    n = F.col("capture_id")
    # A third of all rows is one URL; hosts and times are independent of each other.
    host = F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("h"), F.pmod(F.xxhash64(n), F.lit(40)).cast("string")))
    df = spark.range(20_000).select(
        F.col("id").alias("capture_id"), F.lit(CRAWL).alias("crawl_id"),
    ).withColumn("url", F.concat(F.lit("http://"), host, F.lit(".test/a")))
    df = df.withColumn("urlkey", F.concat(F.lit("test,"), host, F.lit(")/a")))
    second = F.pmod(F.xxhash64(n, F.lit(7)), F.lit(300 * 86400))
    df = df.withColumn("timestamp", F.timestamp_seconds(second + 1_600_000_000))
    nulls = df.limit(3).select(n, "crawl_id", F.lit(None).cast("string").alias("url"),
                               F.lit(None).cast("string").alias("urlkey"), F.lit(None).cast("timestamp").alias("timestamp"))
    df = df.unionByName(nulls)
    path = shared_folder(spark)
    write_clustered(df, path, files=36)
    return df, path


def ids(df):
    return sorted(r.capture_id for r in df.select("capture_id").collect())


@pytest.mark.parametrize("asked, share", [
    # A narrow stripe of keys crosses two or three of the six columns that 36 files make, 14 to 16 files as sampled.
    ({"host": "h7.test"}, 0.5), ({"domain": "h7.test"}, 0.5), ({"since": "2020-10-01", "until": "2020-10-05"}, 0.4),
    ({"host": "hot.test", "since": "2020-10-01", "until": "2020-10-05"}, 0.15), ({"host": "none.test"}, 0.4),
    ({"since": "2030-01-01"}, 0.0), ({"crawl_id": "other"}, 0.0), ({"crawl_id": CRAWL}, 1.0), ({}, 1.0),
])
def test_conditions_read_a_share_of_the_files(spark, index, asked, share):
    df, path = index
    found = find_clustered(spark, path, **asked)
    tests = [filters.time_range(df, asked.get("since"), asked.get("until"))]
    tests += [filters.on_host(asked["host"])] if "host" in asked else []
    tests += [filters.in_domain(asked["domain"])] if "domain" in asked else []
    tests += [df.crawl_id == asked["crawl_id"]] if "crawl_id" in asked else []
    assert ids(found) == ids(df.filter(filters.all_of(tests)))
    files = spark.read.parquet(f"{path}/{BOUNDS}").count()
    assert files >= 30
    if share:
        assert len(found.inputFiles()) <= share * files


def test_files_are_even_and_the_hot_url_is_spread(spark, index):
    bounds = spark.read.parquet(f"{index[1]}/{BOUNDS}")
    most, rows = bounds.agg(F.max("rows"), F.sum("rows")).first()
    assert rows == 20_003 and most < 4 * rows / 36


def test_an_empty_index(spark, index):
    path = shared_folder(spark)
    write_clustered(index[0].limit(0), path)
    assert find_clustered(spark, path, since="2020-01-01").count() == 0
