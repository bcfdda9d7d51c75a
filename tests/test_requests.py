"""Planned requests, against the request parts a user relies on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pagestrata import overlap_join, plan_crawl_requests, plan_fetches, plan_requests

TARGET = (
    "url string, match string, since timestamp, until timestamp, "
    "filters array<struct<field:string,op:string,values:array<string>>>, collapse array<string>, "
    "max_rows long, skip long, newest boolean"
)


def plan(spark, url="example.com", match=None, since=None, until=None, filters=None, collapse=None, max_rows=10,
         skip=None, newest=None):
    row = (url, match, since, until, filters, collapse, max_rows, skip, newest)
    return plan_requests(spark.createDataFrame([row], TARGET)).first().cdx_url


def test_shape(spark):
    assert plan(spark) == (
        "https://web.archive.org/cdx/search/cdx?url=example.com&output=csv"
        "&fl=urlkey,timestamp,original,mimetype,statuscode,digest,length&limit=10"
    )


@pytest.mark.parametrize(
    "options, parts",
    [
        ({"url": "example.com/%", "match": "like"}, ["url=example.com/*&"]),
        ({"url": "%.example.com", "match": "like"}, ["url=*.example.com&"]),
        ({"url": "https://x.org/foo_bar", "match": "like"}, ["url=https://x.org/foo_bar&"]),
        ({"url": "https://x.org/foo_bar"}, ["url=https://x.org/foo_bar&"]),
        ({"url": "https://x.org/a%20b"}, ["url=https://x.org/a%2520b&"]),
        ({"url": "https://x.org/a", "match": "prefix"}, ["url=https://x.org/a*&"]),
        ({"url": "https://x.org/?a=1&limit=9#x +"}, ["url=https://x.org/?a=1%26limit=9%23x%20%2B&output"]),
        ({"filters": [("digest", "eq", ["a\\b&c"])]}, ["&filter=digest:a%5C%5Cb%26c"]),
        ({"filters": [("urlkey", "like", ["a\\_b\\%_\\\\%"])]}, ["&filter=urlkey:^a_b%25.%5C%5C.*"]),
        ({"max_rows": 5}, ["&limit=5"]),
        ({"skip": 50}, ["&limit=10&offset=50"]),
        ({"newest": True}, ["&fastLatest=true&limit=-10"]),
        ({"filters": [("statuscode", "eq", ["200"])]}, ["&filter=statuscode:200"]),
        ({"filters": [("statuscode", "ne", ["404"])]}, ["&filter=!statuscode:404"]),
        ({"filters": [("mimetype", "eq", ["text/html"])]}, ["&filter=mimetype:text/html"]),
        ({"filters": [("mimetype", "eq", ["application/xhtml+xml"])]}, ["mimetype:application/xhtml%5C+xml"]),
        ({"filters": [("statuscode", "in", ["200", "301", "302"])]}, ["&filter=statuscode:(200|301|302)"]),
        ({"filters": [("mimetype", "in", ["text/html", "text/plain"])]}, ["&filter=mimetype:(text/html|text/plain)"]),
        ({"filters": [("url", "not_like", ["%test%"])]}, ["&filter=!original:.*test.*"]),
        ({"filters": [("urlkey", "like", ["%apply"])]}, ["&filter=urlkey:.*apply$"]),
        ({"filters": [("urlkey", "not_like", ["%?%"])]}, ["&filter=!urlkey:.*%5C?.*"]),
        ({"filters": [("urlkey", "not_like", ["com,example)/%/%"])]}, ["&filter=!urlkey:^com,example)/.*/.*"]),
        ({"filters": [("urlkey", "regex", [".*test.*"])]}, ["&filter=urlkey:.*test.*"]),
        ({"filters": [("urlkey", "not_regex", [".*spam.*"])]}, ["&filter=!urlkey:.*spam.*"]),
        ({"collapse": ["digest", "timestamp:8"]}, ["&collapse=digest&collapse=timestamp:8"]),
        (
            {"since": dt.datetime(2024, 10, 10), "until": dt.datetime(2025, 1, 20, 20, 30)},
            ["&from=20241010000000&to=20250120203000"],
        ),
    ],
)
def test_parts(spark, options, parts):
    request = plan(spark, **options)
    assert all(part in request for part in parts), request


def test_no_offset_unless_positive(spark):
    assert "offset" not in plan(spark, skip=0)
    assert "fastLatest" not in plan(spark, newest=False)


CRAWLS = [
    ("C1", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 20)),
    ("C2", dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 20)),
    ("C3", dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 20)),
]


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame(CRAWLS, "id string, from_ts timestamp, to_ts timestamp")


@pytest.mark.parametrize(
    "since, until, crawls",
    [
        (None, None, ["C3"]),
        (dt.datetime(2024, 1, 15), dt.datetime(2024, 2, 1), ["C1", "C2"]),
        (dt.datetime(2024, 3, 1), None, ["C2", "C3"]),
        (None, dt.datetime(2024, 1, 31), ["C1"]),
        (dt.datetime(2024, 4, 1), dt.datetime(2024, 5, 1), []),
        (dt.datetime(2020, 1, 1), dt.datetime(2030, 1, 1), ["C1", "C2", "C3"]),
    ],
)
def test_crawls_of_a_target(spark, catalog, since, until, crawls):
    row = ("example.com/%", "like", since, until, [("statuscode", "eq", ["200"]), ("mimetype", "ne", ["a+b"])],
           None, 7, None, None)
    got = plan_crawl_requests(spark.createDataFrame([row], TARGET), catalog).orderBy("crawl_id").collect()
    assert [r.crawl_id for r in got] == crawls
    for r in got:
        assert r.cdx_url.startswith(
            f"https://index.commoncrawl.org/{r.crawl_id}-index?url=example.com/*&output=json"
        )
        assert r.cdx_url.endswith("&filter==status:200&filter=!=mime:a+b") and "&limit=7" in r.cdx_url


def test_named_crawls_and_ties(spark):
    day = dt.datetime(2024, 1, 1)
    catalog = spark.createDataFrame([("A", day, day), ("C", day, day), ("B", day, day)], "id string, from_ts timestamp, to_ts timestamp")
    rows = [("e.com/_", None, None, None, ["A", "B", "A"]), ("e.com/x", None, None, None, None), ("e.com/y", day, None, None, None)]
    df = spark.createDataFrame(rows, "url string, since timestamp, until timestamp, match string, crawls array<string>")
    df = df.selectExpr("*", "CAST(NULL AS array<struct<field:string,op:string,values:array<string>>>) AS filters", "1 AS max_rows")
    got = sorted((r.url, r.crawl_id) for r in plan_crawl_requests(df, catalog).collect())
    assert got == [("e.com/_", "A"), ("e.com/_", "B"), ("e.com/x", "C"), ("e.com/y", "A"), ("e.com/y", "B"), ("e.com/y", "C")]
    like = df.limit(1).withColumn("match", F.lit("like"))
    assert "url=e.com/?&" in plan_crawl_requests(like, catalog).first().cdx_url


def test_spans_of_one_month_use_many_partitions(spark):
    spans = spark.range(200_000).selectExpr("id", "timestamp'2024-01-05' AS lo", "timestamp'2024-01-06' AS hi")
    catalog = spark.createDataFrame(CRAWLS, "id string, from_ts timestamp, to_ts timestamp").withColumnRenamed("id", "crawl")
    # Partitions as small as these would be put together again, so that is turned off.
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        joined = overlap_join(spans, catalog).withColumn("p", F.spark_partition_id())
        counts = [r["count"] for r in joined.groupBy("p").count().collect()]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sum(counts) == 200_000 and len(counts) >= 4 and max(counts) < 120_000


def test_overlap_join_gives_each_pair_once(spark, catalog):
    import random

    rng = random.Random(5)
    spans = []
    for i in range(200):
        lo = dt.datetime(2023, 11, 1) + dt.timedelta(days=rng.randrange(300), hours=rng.randrange(24))
        spans.append((i, lo, lo + dt.timedelta(days=rng.randrange(120))))
    left = spark.createDataFrame(spans, "n int, lo timestamp, hi timestamp")
    got = sorted((r.n, r.id) for r in overlap_join(left, catalog).collect())
    want = sorted((n, c) for n, lo, hi in spans for c, a, b in CRAWLS if b >= lo and a <= hi)
    assert got == want
    plan = overlap_join(left, catalog)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_overlap_join_of_any_spans(spark, monkeypatch):
    import random

    from pagestrata.operators import crawls

    monkeypatch.setattr(crawls, "BUCKET", 4)
    monkeypatch.setattr(crawls, "HOT_BUCKET", 20)
    rng = random.Random(8)
    day = lambda n: dt.datetime(2000, 1, 1) + dt.timedelta(days=n)

    def spans(n):
        out = []
        for _ in range(n):
            kind, a = rng.randrange(6), rng.randrange(300)
            length = (0, 3, 40, 9000, -5, rng.randrange(300))[kind]
            out.append((day(a), day(a + length)))
        return out + [out[0]] * 5 + [(None, day(3)), (day(3), None), (day(0), day(9999)), (day(9999), day(0))]

    left = [(i, *s) for i, s in enumerate(spans(120))]
    right = [(i, *s) for i, s in enumerate(spans(90))]
    l = spark.createDataFrame(left, "n int, lo timestamp, hi timestamp").repartition(3)
    r = spark.createDataFrame(right, "m int, from_ts timestamp, to_ts timestamp").repartition(2)
    want = sorted((n, m) for n, lo, hi in left for m, a, b in right if None not in (lo, hi, a, b) and b >= lo and a <= hi)
    for rows_per_range in (100_000, 37):
        assert sorted((x.n, x.m) for x in overlap_join(l, r, rows_per_range).collect()) == want
    assert overlap_join(l.filter("n < 0"), r).count() == overlap_join(l, r.filter("m < 0")).count() == 0
    assert overlap_join(l, r).columns == ["n", "lo", "hi", "m", "from_ts", "to_ts"]


def test_overlap_join_shuffles_no_more_than_input_and_pairs(spark):
    from pagestrata.operators.crawls import BUCKET, _numbered, _starts_in

    # Long spans that hold no start of the other side go nowhere, however many months they have.
    left = spark.range(500).selectExpr("id", "timestamp'1990-01-01' AS lo", "timestamp'2020-01-01' AS hi")
    right = spark.range(3000).selectExpr("id AS m", "timestamp'2021-01-01' + make_interval(0, 0, 0, id) AS from_ts", "timestamp'2031-01-01' AS to_ts")
    assert overlap_join(left, right).count() == 0
    rows = _numbered(left, "lo", "hi").selectExpr("_row", "_id", "0L AS own", "0L AS first", "3000L AS behind")
    points = _numbered(right, "from_ts", "to_ts").selectExpr("_row", "_id", "_row.m AS own", "0L AS first", "0L AS behind")
    spread = 500 * -(-3000 // BUCKET)
    assert _starts_in(rows, points, "l", "r").count() == 500 * 3000 and spread < 500 * 3000 / 50


def test_fetch_plan(spark):
    at = dt.datetime(2024, 10, 20, 10, 30)
    df = spark.createDataFrame([("http://e.com/", at), ("", at), ("x", None)], "url string, timestamp timestamp")
    got = [r.address for r in plan_fetches(df).collect()]
    assert got == ["https://web.archive.org/web/20241020103000id_/http://e.com/", None, None]
    spots = spark.createDataFrame([("f", 0, 10), ("f", 5, 0), (None, 1, 1)], "filename string, offset long, length long")
    got = [(r.address, r.byte_range) for r in plan_fetches(spots).collect()]
    assert got == [("https://data.commoncrawl.org/f", "bytes=0-9"), (None, None), (None, None)]
