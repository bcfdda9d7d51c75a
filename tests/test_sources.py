"""Index, catalog and table files, exports, and joins to stored bodies."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pagestrata import (
    attach_bodies, export_bodies, parse_cdx, read_cdx, read_cdxj, read_crawl_catalog, register_index,
    to_index_table, union_sources, write_captures,
)
from pagestrata.operators.bodies import MISSING_KEY, NOT_STORED, _by_content
from pagestrata.session import shared_folder
from pagestrata.streaming.tail import append_to_table, tail_cdxj

EPOCH = dt.datetime(1970, 1, 1)


def put(spark, text, name="part.txt"):
    folder = shared_folder(spark)
    os.makedirs(os.path.dirname(f"{folder}/{name}"))
    with open(f"{folder}/{name}", "w") as out:
        out.write(text)
    return folder


CDX = """ CDX N b a m s k S
com,e)/ 20240102030405 http://e.com/ text/html 200 AAA 123
com,e)/b 20240102030405 http://e.com/b warc/revisit - BBB -
com,e)/c 2024 http://e.com/c text/html 2x CCC 12

too short
com,e)/d 20241399000000   http://e.com/d text/html 404 DDD 7
"""


def test_cdx(spark):
    rows = {r.url: r for r in read_cdx(spark, put(spark, CDX), count_bad_fields=True).collect()}
    assert len(rows) == 4
    good = rows["http://e.com/"]
    assert (good.timestamp, good.statuscode, good.length) == (dt.datetime(2024, 1, 2, 3, 4, 5), 200, 123)
    assert (good.year, good.month, good.urlkey, good.digest) == (2024, 1, "com,e)/", "AAA")
    revisit = rows["http://e.com/b"]
    assert (revisit.statuscode, revisit.length, revisit.bad_fields) == (0, 0, 0)
    odd = rows["http://e.com/c"]
    assert (odd.timestamp, odd.year, odd.month, odd.statuscode, odd.bad_fields) == (EPOCH, 2024, None, 0, 1)
    assert rows["http://e.com/d"].timestamp == EPOCH


def test_cdx_other_layout(spark):
    fields = ["urlkey", "timestamp", "original", "mimetype", "statuscode", "digest", "redirect",
              "flags", "length", "offset", "filename"]
    lines = spark.createDataFrame([("k 20240102030405 http://u/ t 200 D - - 10 20 f.warc.gz",)], "value string")
    row = parse_cdx(lines, fields).first()
    assert (row.length, row.offset, row.filename) == (10, 20, "f.warc.gz")
    with pytest.raises(ValueError):
        parse_cdx(lines, ["urlkey"])


CDXJ = r"""{"url": "http://e.com/", "timestamp": "20240102030405", "mime": "text/html", "status": "200", "digest": "A", "length": "10", "offset": "0", "filename": "f"}
{"url":"http://e.com/\"q\"é","timestamp":"20240102030405","status":404,"length":12}
{"timestamp": "20240102030405"}
no object
{"url": "http://e.com/x", "status": "-", "offset": "1z"}
"""


def test_cdxj(spark):
    folder = put(spark, CDXJ, "crawl_id=CC-1/a.json")
    rows = {r.url: r for r in read_cdxj(spark, folder, count_bad_fields=True).collect()}
    assert set(rows) == {"http://e.com/", 'http://e.com/"q"é', "http://e.com/x"}
    assert {r.crawl_id for r in rows.values()} == {"CC-1"}
    quoted = rows['http://e.com/"q"é']
    assert (quoted.statuscode, quoted.length, quoted.offset, quoted.mimetype) == (404, 12, 0, None)
    odd = rows["http://e.com/x"]
    assert (odd.timestamp, odd.statuscode, odd.offset, odd.bad_fields) == (EPOCH, 0, 0, 1)
    assert read_cdxj(spark, folder, "other").first().crawl_id == "other"


def test_cdxj_with_keys_in_front(spark):
    line = 'com,e)/ 20240102030405 {"url": "http://e.com/", "status": "200"}\n' + CDXJ
    rows = read_cdxj(spark, put(spark, line), "CC-1", keyed=True).filter("urlkey is not null").collect()
    assert [(r.urlkey, r.timestamp) for r in rows] == [("com,e)/", dt.datetime(2024, 1, 2, 3, 4, 5))]


def test_catalog(spark):
    text = """[{"id": "B", "name": "b", "from": "2024-02-01T00:00:00", "to": "2024-03-01T00:00:00"},
      {"id": "A", "name": "a", "from": "2024-01-01T00:00:00Z", "to": "bad"}]"""
    rows = {r.id: r for r in read_crawl_catalog(spark, put(spark, text)).collect()}
    assert rows["B"].to_ts == dt.datetime(2024, 3, 1) and rows["A"].to_ts == EPOCH
    with pytest.raises(ValueError, match="no crawls"):
        read_crawl_catalog(spark, put(spark, "[]"))


def test_stream_adds_each_file_once(spark):
    folder = put(spark, CDXJ, "in/a.json")

    def step():
        stream = tail_cdxj(spark, f"{folder}/in", "CC-1").filter("statuscode = 200")
        append_to_table(stream, f"{folder}/table", f"{folder}/state").awaitTermination()
        return spark.read.parquet(f"{folder}/table").count()

    assert step() == 1
    with open(f"{folder}/in/b.json", "w") as out:
        out.write(CDXJ)
    assert step() == 2
    assert step() == 2


def test_index_table_spreads_a_large_crawl(spark):
    folder = shared_folder(spark)
    df = spark.range(4000).select(
        F.col("id").alias("capture_id"), F.format_string("com,e)/%05d", "id").alias("urlkey"),
        F.lit(EPOCH).alias("timestamp"), F.when(F.col("id") < 3500, "big").otherwise("small").alias("crawl_id"),
    )
    to_index_table(df, folder, files=8)
    index = spark.read.parquet(folder)
    assert index.count() == 4000
    by_file = index.filter("crawl_id = 'big'").groupBy(F.input_file_name()).agg(
        F.min("urlkey").alias("lo"), F.max("urlkey").alias("hi"), F.count("*").alias("n")).orderBy("lo").collect()
    assert len(by_file) >= 6
    assert all(a.hi < b.lo for a, b in zip(by_file, by_file[1:]))


def test_sql_over_a_registered_index(spark):
    register_index(read_cdx(spark, put(spark, CDX)), "snapshots")
    got = spark.sql("SELECT url[0], statuscode FROM (SELECT split(url, ':') url, statuscode FROM snapshots) LIMIT 1")
    assert got.first()[0] == "http"
    assert spark.sql("SELECT count(*) FROM snapshots WHERE URL LIKE '%/b'").first()[0] == 1


BODY = "url string, timestamp timestamp, n int"


def test_bodies(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("u1", at, 1), ("u1", at, 2), ("u2", at, 3), ("", at, 4), (None, at, 5), ("u1", None, 6)]
    df = spark.createDataFrame(rows, BODY)
    store = spark.createDataFrame([("u1", at, "x\0é"), (None, at, "y"), ("", at, "z")], "url string, timestamp timestamp, body string")
    got = {r.n: r.response for r in attach_bodies(df, store).collect()}
    assert len(got) == 6
    assert {n: r.error for n, r in got.items()} == {
        1: None, 2: None, 3: NOT_STORED, 4: MISSING_KEY, 5: MISSING_KEY, 6: MISSING_KEY}
    assert bytes(got[1].body) == "x\0é".encode() and got[4].body is None


def test_one_body_for_each_snapshot_and_only_those_asked_for(spark):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("u1", at, 1), ("u2", at, 2)], BODY)
    rows = [("u1", at, "b"), ("u1", at, "a"), ("u2", at, "c")] + [(f"x{i}", at, "no") for i in range(500)]
    folder = shared_folder(spark)
    spark.createDataFrame(rows, "url string, timestamp timestamp, body string").write.parquet(folder)
    joined = attach_bodies(df, spark.read.parquet(folder))
    got = {r.n: bytes(r.response.body) for r in joined.collect()}
    assert got == {1: b"a", 2: b"c"}
    # The join on the wanted keys stands below the first shuffle of the store.
    plan = joined._jdf.queryExecution().executedPlan().toString()
    store = plan[: plan.index(folder.rsplit("/", 1)[-1])]
    assert store.rindex("LeftSemi") > store.rindex("Exchange hashpartitioning")


@pytest.mark.parametrize("few", [0, 100])
def test_smallest_body_of_a_snapshot_whether_few_or_many(spark, monkeypatch, few):
    monkeypatch.setattr("pagestrata.operators.bodies.FEW_BODIES", few)
    at = dt.datetime(2024, 1, 1)
    urls = ["a", "b", "c", "d", "e", "", None, "a"]
    df = spark.createDataFrame([(u, at, i) for i, u in enumerate(urls)], BODY)
    stored = [("a", "y"), ("a", "x"), ("a", "x"), ("b", "x"), ("c", None), ("c", "y"), ("d", None), (None, "x"), ("z", "x")]
    for rows in (stored, stored[3:4] + stored[6:]):
        store = spark.createDataFrame([(u, at, b) for u, b in rows], "url string, timestamp timestamp, body string")
        bodies = {u: min((b for v, b in rows if v == u and b is not None), default=None) for u, _ in rows}
        want = {
            i: (None, MISSING_KEY) if not u else (bodies[u], None) if u in bodies else (None, NOT_STORED)
            for i, u in enumerate(urls)
        }
        got = attach_bodies(df, store).collect()
        assert {r.n: (r.response.body and r.response.body.decode(), r.response.error) for r in got} == want
        assert len(got) == len(urls)


def test_a_body_of_many_snapshots_is_held_once(spark, monkeypatch):
    at = F.lit(dt.datetime(2024, 1, 1))
    df = spark.range(0, 1000, 1, 4).select(F.concat(F.lit("u"), "id").alias("url"), at.alias("timestamp"), F.col("id").alias("n"))
    store = df.select("url", "timestamp", F.repeat((F.col("n") % 3).cast("string"), 2000).alias("body"))
    moved = []

    def by_content(held):
        moved.extend(_by_content(held))
        return moved

    monkeypatch.setattr("pagestrata.operators.bodies.FEW_BODIES", 999)
    monkeypatch.setattr("pagestrata.operators.bodies._by_content", by_content)
    got = attach_bodies(df, store).collect()
    assert all(bytes(r.response.body) == str(r.n % 3).encode() * 2000 for r in got) and len(got) == 1000
    snapshots, bodies = moved
    assert (snapshots.count(), bodies.count()) == (1000, 3) and "_body" not in snapshots.columns


def test_exports(spark):
    folder = shared_folder(spark)
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("u1", at, 1), ("u2", at, 2)], BODY)
    write_captures(df.select("url", "timestamp"), f"{folder}/csv")
    assert spark.read.csv(f"{folder}/csv", header=True).count() == 2
    write_captures(df, f"{folder}/parquet", "parquet")
    store = spark.createDataFrame([("u1", at, "<p>")], "url string, timestamp timestamp, body string")
    manifest = export_bodies(attach_bodies(df, store), f"{folder}/bodies").collect()
    assert [(r.url, r.timestamp, r.bytes) for r in manifest] == [("u1", at, 3)]
    with open(f"{folder}/bodies/objects/{manifest[0].path}", "rb") as one:
        assert one.read() == b"<p>"


def test_rows_with_equal_bodies_share_an_object(spark):
    folder, body = shared_folder(spark), F.struct(F.concat(F.lit("<p>"), F.col("n") % 3, F.repeat(F.lit("x"), 500)).cast("binary").alias("body"))
    df = spark.range(0, 300, 1, 6).withColumnRenamed("id", "n").select(
        F.concat(F.lit("u"), "n").alias("url"), F.lit(dt.datetime(2024, 1, 1)).alias("timestamp"), "n", body.alias("response")
    )
    manifest = export_bodies(df, folder, suffix=".gz").collect()
    assert sorted(r.url for r in manifest) == sorted(f"u{n}" for n in range(300))
    held = [f"{shard}/{name}" for shard in os.listdir(f"{folder}/objects") for name in os.listdir(f"{folder}/objects/{shard}")]
    assert sorted(held) == sorted({r.path for r in manifest}) and len({r.path for r in manifest}) == 3
    for r in manifest:
        with open(f"{folder}/objects/{r.path}", "rb") as one:
            assert one.read() == b"<p>%d" % (int(r.url[1:]) % 3) + b"x" * 500 and r.bytes == 504


def test_union_fills_what_a_source_lacks(spark):
    a = spark.createDataFrame([("u", 1)], "url string, x int")
    b = spark.createDataFrame([("v", "C")], "url string, crawl_id string")
    assert {tuple(r) for r in union_sources(a, b).collect()} == {("u", 1, None), ("v", None, "C")}
