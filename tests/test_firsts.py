"""Captures kept per key on a stream, against the batch operators."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pagestrata import distinct_on, latest_per_url
from pagestrata.session import shared_folder
from pagestrata.streaming.firsts import append_firsts, first_of, keep_firsts

SCHEMA = "capture_id long, url string, urlkey string, timestamp timestamp, statuscode int, share double, raw binary, year int"
TIE = dt.datetime(2020, 5, 1)


def some(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = rng.choice([TIE, None, dt.datetime(2019, 1, 1) + dt.timedelta(seconds=rng.randrange(10**8), microseconds=rng.randrange(9))])
        url = None if rng.random() < 0.05 else "hot" if rng.random() < 0.4 else f"u{rng.randrange(9)}"
        rows.append((
            (1 << 60) + 1000 * seed + i, url, url, at, rng.choice([200, 404, None]), rng.choice([0.1, float("nan"), None]),
            rng.choice([b"\\x00\\xff", b"", None]), at and at.year,
        ))
    return rows


class Feed:
    def __init__(self, spark):
        self.spark, self.folder = spark, shared_folder(spark)
        spark.createDataFrame([], SCHEMA).coalesce(1).write.parquet(f"{self.folder}/in")

    def add(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def step(self, keys, n, **options):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/in")
        append_firsts(keep_firsts(stream, keys, n, **options), f"{self.folder}/table", f"{self.folder}/progress").awaitTermination()
        return self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/table")


def texts(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("n, idle_hours", [(1, 100), (3, 1e-9)])
def test_any_split_and_restarts_give_the_latest(spark, n, idle_hours):
    feed, rows = Feed(spark), some(1) + some(2)
    random.Random(n).shuffle(rows)
    by = {"order": ["timestamp", "capture_id"], "descending": True}
    table = feed.step(["url"], n, idle_hours=idle_hours, **by)
    assert table.count() == 0
    for first, last in ((0, 1), (1, 90), (90, 240)):
        # Every step is a query of its own, begun from the checkpoint.
        feed.add(rows[first:last])
        table = feed.step(["url"], n, idle_hours=idle_hours, **by)
        whole = spark.createDataFrame(rows[:last], SCHEMA)
        assert texts(first_of(table, ["url"], n, **by)) == texts(latest_per_url(whole, n))
    assert table.count() < len(rows)
    assert table.dtypes == spark.createDataFrame([], SCHEMA).dtypes


def test_distinct_by_year_and_prefix(spark):
    feed, rows = Feed(spark), some(3)
    feed.add(rows[:50])
    feed.add(rows[50:])
    keys = ["urlkey:1", "year"]
    table = feed.step(keys, 1, parts=3)
    assert texts(first_of(table, keys)) == texts(distinct_on(spark.createDataFrame(rows, SCHEMA), keys))


def test_repeated_rows_count_each(spark):
    feed, rows = Feed(spark), [(1, "a", "a", TIE, 200, None, None, 2020)] * 3 + [(0, "a", "a", TIE, 200, None, None, 2020)]
    feed.add(rows[:2])
    feed.add(rows[2:])
    by = {"order": ["timestamp", "capture_id"], "descending": True}
    assert [r.capture_id for r in first_of(feed.step(["url"], 3, **by), ["url"], 3, **by).collect()] == [1, 1, 1]


def test_a_hot_key_is_spread(spark):
    feed = Feed(spark)
    feed.add([(i, "hot", "hot", TIE, 200, None, None, 2020) for i in range(400)])
    table = feed.step(["url"], 2, order=["capture_id"], parts=8)
    assert 8 < table.count() <= 16
    assert sorted(r.capture_id for r in first_of(table, ["url"], 2, ["capture_id"]).collect()) == [0, 1]


def test_many_keys_are_few_groups(spark):
    folder, n = shared_folder(spark), 9000
    rows = spark.range(0, 2 * n, 1, 2).select(F.col("id").alias("capture_id"), F.concat(F.lit("u"), F.col("id") % n).alias("url"))
    rows.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    run = append_firsts(keep_firsts(stream, ["url"], 1, ["capture_id"], True, parts=1), f"{folder}/table", f"{folder}/progress")
    run.awaitTermination()
    # A call per key takes a thousand times what its rows take.
    assert run.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4096
    found = first_of(spark.read.schema(rows.schema).parquet(f"{folder}/table"), ["url"], 1, ["capture_id"], True)
    assert sorted(r.capture_id for r in found.collect()) == list(range(n, 2 * n))


@pytest.mark.parametrize("buckets", [1, 3])
def test_keys_share_a_bucket(spark, buckets):
    feed, rows = Feed(spark), some(5) + some(6)
    feed.add(rows[:100])
    feed.add(rows[100:])
    by = {"order": ["timestamp", "capture_id"], "descending": True}
    table = feed.step(["url"], 2, buckets=buckets, parts=2, **by)
    assert texts(first_of(table, ["url"], 2, **by)) == texts(latest_per_url(spark.createDataFrame(rows, SCHEMA), 2))
    kept = table.count()
    # What comes late and is not among the best is known from the state.
    feed.add([(0, f"u{i}", None, dt.datetime(1970, 1, 2), 200, None, None, 1970) for i in range(9)] * 3)
    assert feed.step(["url"], 2, buckets=buckets, parts=2, **by).count() <= kept + 9


def test_errors(spark):
    feed = Feed(spark)
    feed.add(some(4, 5))
    feed.step(["url"], 1)
    feed.add(some(4, 5))
    with pytest.raises(PySparkException, match="keeps 1 captures"):
        feed.step(["url"], 2)
    stream = spark.readStream.schema(SCHEMA).parquet(f"{feed.folder}/in")
    for wrong in (dict(keys=[]), dict(keys=["url"], n=0), dict(keys=["url"], order=["share"])):
        with pytest.raises(ValueError):
            keep_firsts(stream, **wrong)
    with pytest.raises(ValueError, match="nested"):
        keep_firsts(stream.withColumn("response", F.struct("raw")), ["url"])
