"""Field parsing, header blocks and record reads."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from pagestrata import fetch_records
from pagestrata.functions import records as r
from pagestrata.session import shared_folder
from pagestrata.sources import warc

EPOCH = dt.datetime(1970, 1, 1)


def evaluate(spark, build, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", build(F.col("v")).alias("x"))
    return [row.x for row in df.orderBy("i").collect()]


def test_compact_time(spark):
    texts = ["20241020103050", "202410201030", "20241320103050", "2024102010305x", "", None,
             "20240229000000", "20230229000000"]
    assert evaluate(spark, r.parse_compact_time, texts) == [
        dt.datetime(2024, 10, 20, 10, 30, 50), EPOCH, EPOCH, EPOCH, EPOCH, EPOCH,
        dt.datetime(2024, 2, 29), EPOCH,
    ]


def test_iso_time(spark):
    at = dt.datetime(2025, 11, 6, 20, 7, 18)
    texts = ["2025-11-06T20:07:18", "2025-11-06T20:07:18.123Z", "2025-11-06T22:07:18+02:00",
             "2025-11-06T18:37:18.5-0130", "2025-11-06T21:07:18+01", "2025-11-06", "x", None]
    assert evaluate(spark, r.parse_iso_time, texts) == [at, at, at, at, at, EPOCH, EPOCH, EPOCH]


def test_numbers(spark):
    texts = ["200", "-", "", None, "2x", "99999999999999"]
    assert evaluate(spark, lambda c: r.number_or_zero(c, "int"), texts) == [200, 0, 0, 0, 0, 0]
    assert evaluate(spark, lambda c: r.is_bad_number(c, "int"), texts) == [
        False, False, False, False, True, True,
    ]


def test_utf8_repair(spark):
    raw = [b"plain", "é€😀".encode(), b"a\xffb", b"cut\xe2\x82", "kept �".encode(), b"\x80\x80"]
    assert evaluate(spark, r.repair_utf8, raw, "binary") == [
        "plain", "é€😀", "a?b", "cut?", "kept �", "??",
    ]


def test_header_map(spark):
    block = "HTTP/1.1 200 OK\r\nA: 1\r\na: 2\r\nA: 3\r\nno colon\r\nB: x: y\r\nEmpty: \r\nLast: z"
    lf = "HTTP/1.1 200\nA: 1\nB: 2"
    assert evaluate(spark, r.header_map, [block, lf, "HTTP/1.1 200", None]) == [
        {"A": "1, 3", "a": "2", "B": "x: y", "Empty": "", "Last": "z"}, {"A": "1", "B": "2"}, {}, None,
    ]


def test_status_lines(spark):
    heads = ["HTTP/1.1 404 Not Found\r\nA: 1", "HTTP/2 200", "HTTP/1.0 x", "junk"]
    assert evaluate(spark, r.http_version, heads) == ["1.1", "2", "1.0", ""]
    assert evaluate(spark, r.http_status, heads) == [404, 200, 0, 0]
    assert evaluate(spark, r.record_version, ["WARC/1.1\r\nA: b", "x"]) == ["1.1", ""]


def record(body, head=b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nSet-Cookie: a\r\nSet-Cookie: b",
           gap=b"\r\n", length=True):
    block = head + gap * 2 + body
    lines = [b"WARC/1.0", b"WARC-Type: response", b"WARC-Record-ID: <urn:x>"]
    if length:
        lines.append(b"Content-Length: %d" % len(block))
    return gzip.compress(gap.join(lines) + gap * 2 + block + b"\r\n\r\n")


BINARY = bytes(range(256)) * 40 + b"\r\n\r\n\n\n tail"


@pytest.fixture(scope="module")
def stored(spark):
    """Pointers by name, and the folder their files are in."""
    folder = shared_folder(spark)
    os.makedirs(f"{folder}/deep")
    members = {
        "first": record(b"at offset zero"),
        "binary": record(BINARY),
        "newlines": record(b"one\n\ntwo", gap=b"\n"),
        "no_length": record(b"text", length=False),
        "empty": record(b""),
        "short": gzip.compress(gzip.decompress(record(b"all of it"))[:-10]),
        "no_http": gzip.compress(b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
        "no_head": gzip.compress(b"nothing here"),
        "not_gzip": b"WARC/1.0 plain bytes, not a gzip member",
    }
    spots, data = {}, b""
    for name, member in members.items():
        spots[name] = ("deep/a.warc.gz", len(data), len(member))
        data += member
    with open(f"{folder}/deep/a.warc.gz", "wb") as out:
        out.write(data)
    spots["truncated"] = ("deep/a.warc.gz", 0, 40)
    spots["missing_file"] = ("gone.warc.gz", 0, 10)
    spots["beyond_end"] = ("deep/a.warc.gz", len(data) + 5, 10)
    spots["no_name"] = (None, 0, 10)
    spots["zero_length"] = ("deep/a.warc.gz", 0, 0)
    return spots, folder


def fetched(spark, spots, folder, **options):
    rows = [(name, f"http://e.com/{name}", None, *spot) for name, spot in spots.items()]
    schema = "name string, url string, timestamp timestamp, filename string, offset long, length long"
    df = fetch_records(spark.createDataFrame(rows, schema), folder, **options)
    return {row.name: row for row in df.collect()}


def test_fetch(spark, stored):
    rows = fetched(spark, *stored)
    first = rows["first"]
    assert bytes(first.response.body) == b"at offset zero" and first.response.error is None
    assert first.warc.version == "1.0" and first.warc.headers["WARC-Record-ID"] == "<urn:x>"
    assert first.response.headers == {"Content-Type": "text/html", "Set-Cookie": "a, b"}
    assert (first.response.http_version, first.response.http_status) == ("1.1", 200)
    assert bytes(rows["binary"].response.body) == BINARY
    assert bytes(rows["empty"].response.body) == b""


def test_fetch_other_line_ends_and_no_length(spark, stored):
    rows = fetched(spark, *stored)
    # The line feeds of the head decide where it ends, not those of the body.
    assert bytes(rows["no_length"].response.body) == b"text\r\n\r\n"
    newlines = rows["newlines"].response
    assert bytes(newlines.body) == b"one\n\ntwo"


def test_fetch_errors_stay_with_their_row(spark, stored):
    rows = fetched(spark, *stored)
    errors = {name: row.response.error for name, row in rows.items()}
    bad = {"short", "no_http", "no_head", "not_gzip", "truncated", "missing_file", "beyond_end", "no_name", "zero_length"}
    assert {name for name, error in errors.items() if error} == bad
    assert "truncated" in errors["truncated"] and "gone.warc.gz" in errors["missing_file"]
    assert all(rows[name].response.body is None for name in bad)
    assert rows["no_http"].warc.headers["WARC-Type"] == "metadata"


def test_small_pointers_are_read_by_many_tasks(spark, stored):
    spots, folder = stored
    name, offset, length = spots["first"]
    df = spark.range(2500).select("id", F.lit(name).alias("filename"), F.lit(offset).alias("offset"), F.lit(length).alias("length"))
    read = fetch_records(df, folder).withColumn("task", F.spark_partition_id())
    counts = [r["count"] for r in read.filter("response.error IS NULL").groupBy("task").count().collect()]
    assert sum(counts) == 2500 and len(counts) >= 8


def test_fetch_many_pointers_to_one_record(spark, stored):
    spots, folder = stored
    many = {f"copy{i}": spots["first"] for i in range(500)} | {"binary": spots["binary"]}
    rows = fetched(spark, many, folder, partitions=4)
    assert len(rows) == 501
    assert all(bytes(rows[f"copy{i}"].response.body) == b"at offset zero" for i in range(500))


def test_fetch_large_payloads_come_back_in_pieces(stored, monkeypatch):
    import pyarrow as pa

    spots, folder = stored
    monkeypatch.setattr(warc, "BATCH_BYTES", 20_000)
    spot = spots["binary"]
    batch = pa.RecordBatch.from_pydict(
        {"n": list(range(10)), "filename": [spot[0]] * 10, "offset": [spot[1]] * 10, "length": [spot[2]] * 10}
    )
    out = list(warc._reader(folder, 1, 1)(iter([batch])))
    assert len(out) == 5 and [n for b in out for n in b.column(0).to_pylist()] == list(range(10))


def test_retry_and_budget(stored, monkeypatch):
    spots, folder = stored
    calls = []

    def failing(self, name):
        calls.append(name)
        raise OSError("connection lost")

    monkeypatch.setattr(warc._Files, "_open", failing)
    monkeypatch.setattr(warc, "FIRST_DELAY_SECONDS", 0.001)
    error = warc._Files(folder, 3, 60).record(*spots["first"])[3]
    assert len(calls) == 3 and error == "Not read in 3 attempts: connection lost"
    assert warc._Files(folder, 3, 0).record(*spots["first"])[3] == "No time left: 0 of 0 seconds used"


def test_retry_recovers(stored, monkeypatch):
    spots, folder = stored
    real, failures = warc._Files._open, [OSError("once"), OSError("twice")]

    def flaky(self, name):
        if failures:
            raise failures.pop()
        real(self, name)

    monkeypatch.setattr(warc._Files, "_open", flaky)
    monkeypatch.setattr(warc, "FIRST_DELAY_SECONDS", 0.001)
    assert warc._Files(folder, 5, 60).record(*spots["first"])[2] == b"at offset zero"


def test_failures_of_a_batch_share_a_budget(stored, monkeypatch):
    """A store that is down costs a bounded time, and what can be read is read."""
    spots, folder = stored
    real, now, tries = warc._Files._open, [0.0], []

    def failing(self, name):
        if name == "gone":
            now[0] += 0.5
            tries.append(name)
            raise OSError("connection lost")
        real(self, name)

    def sleep(seconds):
        now[0] += seconds

    monkeypatch.setattr(warc._Files, "_open", failing)
    monkeypatch.setattr(warc.time, "sleep", sleep)
    monkeypatch.setattr(warc.time, "monotonic", lambda: now[0])
    files = warc._Files(folder, 5, 60, 20)
    errors, read = [], 0
    for i in range(2 * warc.RECORDS_PER_TASK):
        good = i % 50 == 49
        parts = files.record(*spots["first"]) if good else files.record("gone", i, 5)
        read += good and parts[2] == b"at offset zero"
        errors += [parts[3]] if not good else []
    assert read == 10
    assert errors[0] == "Not read in 5 attempts: connection lost"
    assert errors[200] == "Not read in 1 attempts: connection lost"
    # The next batch has time of its own.
    assert errors[245] == "Not read in 5 attempts: connection lost"
    assert now[0] <= 2 * (20 + 0.5 * 245)
    assert len(tries) < 2 * 245 + 100
