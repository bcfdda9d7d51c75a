"""Range-by-range operators against brute force, with hot and NULL keys."""

import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from data import SCHEMA, captures_with_hot_keys, sort_key
from pagestrata import as_of, capture_gaps, collapse_adjacent
from pagestrata.operators.ordered import rows_between, with_neighbour, with_rank
from pagestrata.plans.ranges import RANGE, with_range

ROWS = captures_with_hot_keys()
ORDER = ["urlkey", "timestamp", "capture_id"]
SIZES = [3, 50, 10_000]


@pytest.fixture(scope="module")
def index(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).cache()


def in_order(rows=ROWS):
    return sorted(rows, key=lambda r: sort_key(r[2], r[3], r[0]))


@pytest.mark.parametrize("size", [1, 3, 50])
def test_ranges_follow_the_order_and_split_hot_keys(index, size):
    ranged = with_range(index, ORDER, size)
    found = {r.capture_id: r[RANGE] for r in ranged.select("capture_id", RANGE).collect()}
    ids = [found[r[0]] for r in in_order()]
    assert ids == sorted(ids)
    largest = max(ids.count(i) for i in set(ids))
    assert largest < max(60, 6 * size)


def test_wide_rows_share_a_range_with_fewer_others(spark):
    df = spark.range(600).select(F.col("id").alias("k"), F.struct(F.repeat(F.lit("x"), 20_000).cast("binary").alias("body")).alias("response"))
    ranges = with_range(df, ["k"], bytes_per_range=1 << 20).select(RANGE).distinct().count()
    assert 6 <= ranges <= 24
    assert with_range(df.select("k"), ["k"]).select(RANGE).distinct().count() == 1


def test_empty_and_one_row(spark):
    for n in (0, 1):
        df = spark.range(n).select(F.col("id").alias("k"))
        assert with_range(df, ["k"]).count() == n
        assert with_neighbour(df, ["k"], F.col("k"), "near").count() == n


def test_collapse_plans_grow_with_the_number_of_passes(index):
    def windows(fields):
        plan = collapse_adjacent(index, fields)._jdf.queryExecution().executedPlan().toString()
        return plan.count("Window [")

    assert windows(["digest", "statuscode", "mimetype", "timestamp:8"]) == windows(["digest"])


def test_as_of_carries_long_texts_without_a_broadcast_hint(spark, index):
    text = F.concat(F.col("capture_id").cast("string"), F.repeat(F.lit("x"), 5000))
    asked = index.select("url", F.col("timestamp").alias("at"), F.col("capture_id").alias("q")).filter("url IS NOT NULL")
    found = as_of(index.withColumn("page", text), asked, rows_per_range=50)
    assert "broadcast" not in found._jdf.queryExecution().analyzed().toString().lower()
    rows = found.collect()
    assert len(rows) == asked.count()
    assert all(r.capture.page == f"{r.capture.capture_id}" + "x" * 5000 for r in rows if r.capture)
    assert sum(r.capture is not None for r in rows) > 400


def test_as_of_joins_wide_columns_afterwards(spark, index):
    body = F.struct(F.concat(F.lit("body "), "capture_id").cast("binary").alias("body"))
    df = index.withColumn("response", body)
    asked = index.filter("url IS NOT NULL AND timestamp IS NOT NULL").select("url", F.col("timestamp").alias("at"), F.col("capture_id").alias("q"))
    slim = {r.q: r.capture.capture_id for r in as_of(index, asked, rows_per_range=50).collect()}
    wide = {r.q: (r.capture.capture_id, bytes(r.capture.response.body)) for r in as_of(df, asked, rows_per_range=50).collect()}
    assert wide == {q: (c, f"body {c}".encode()) for q, c in slim.items()}


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("step", [-1, 1])
def test_neighbour(index, size, step):
    got = with_neighbour(index, ORDER, F.col("digest"), "near", step, size)
    got = {r.capture_id: r.near for r in got.collect()}
    rows = in_order()
    for i, row in enumerate(rows):
        j = i + step
        near = got[row[0]]
        if 0 <= j < len(rows):
            assert near is not None and near.v == rows[j][7]
        else:
            assert near is None


def collapsed(rows, value):
    kept, before = [], object()
    for row in rows:
        if value(row) != before:
            kept.append(row)
        before = value(row)
    return kept


FIELDS = {
    "digest": lambda r: r[7],
    "statuscode": lambda r: r[5],
    "urlkey:15": lambda r: r[2] and r[2][:15],
    "timestamp:12": lambda r: r[3] and r[3].strftime("%Y%m%d%H%M"),
}


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize(
    "fields",
    [["digest"], ["statuscode"], ["urlkey:15"], ["timestamp:12"], ["statuscode", "digest"],
     ["digest", "statuscode"]],
)
def test_collapse(index, size, fields):
    rows = in_order()
    for field in fields:
        rows = collapsed(rows, FIELDS[field])
    got = collapse_adjacent(index, fields, rows_per_range=size)
    assert sorted(r.capture_id for r in got.collect()) == sorted(r[0] for r in rows)


def test_collapse_keeps_the_first_capture_even_if_all_values_are_null(index):
    blank = index.withColumn("digest", F.lit(None).cast("string"))
    assert collapse_adjacent(blank, "digest", rows_per_range=40).count() == 1


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("at_most", [None, 7])
def test_rank(index, size, descending, at_most):
    got = with_rank(index, ["crawl_id"], ORDER, "n", descending, at_most, size)
    got = {r.capture_id: r.n for r in got.collect()}
    groups = defaultdict(list)
    for row in in_order():
        groups[row[4]].append(row[0])
    want = {}
    for ids in groups.values():
        ids = ids[::-1] if descending else ids
        want.update({c: n for n, c in enumerate(ids, 1) if at_most is None or n <= at_most})
    assert got == want


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("descending", [False, True])
def test_rows_between(index, size, descending):
    got = rows_between(index, ORDER, 201, 260, descending, size).collect()
    rows = in_order()[::-1] if descending else in_order()
    assert [r.capture_id for r in got] == [r[0] for r in rows[200:260]]


@pytest.mark.parametrize("size", SIZES)
def test_gaps(index, size):
    got = {r.capture_id: r.next_ts for r in capture_gaps(index, size).collect()}
    rows = sorted(ROWS, key=lambda r: sort_key(r[1], r[3], r[0]))
    for row, after in zip(rows, [*rows[1:], None]):
        same = after is not None and row[1] is not None and after[1] == row[1]
        assert got[row[0]] == (after[3] if same else None)


@pytest.mark.parametrize("size", SIZES)
def test_as_of(spark, index, size):
    known = index.filter("url is not null and timestamp is not null")
    urls = sorted({r[1] for r in ROWS if r[1]}) + ["http://never.example.com/"]
    asked = [
        (i, urls[i % len(urls)] if i % 3 else urls[0],
         dt.datetime(2020, 1, 1) + dt.timedelta(seconds=37 * i - 50))
        for i in range(300)
    ]
    requests = spark.createDataFrame(asked, "n int, url string, at timestamp_ntz")
    got = as_of(known, requests, ["capture_id"], size).collect()
    assert len(got) == len(asked)
    for row in got:
        seen = [(r[3], r[0]) for r in ROWS if r[1] == row.url and r[3] and r[3] <= row.at]
        want = max(seen)[1] if seen else None
        assert (row.capture and row.capture.capture_id) == want
