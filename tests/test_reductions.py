"""Distinct, limits and whole queries: meaning that a rewrite could lose."""

import pytest
from pyspark.sql import functions as F

from data import SCHEMA, captures_with_hot_keys, sort_key
from pagestrata import (
    balanced_sample, cap_per_crawl, distinct_on, find_captures, latest, latest_per_url, page,
    take_ordered, top_k,
)
from pagestrata.operators import topk
from pagestrata.operators.filters import UrlFilterRequired

ROWS = captures_with_hot_keys(400, seed=3)


@pytest.fixture(scope="module")
def index(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4).cache()


def ids(df):
    return [r.capture_id for r in df.collect()]


def in_order(rows):
    return sorted(rows, key=lambda r: sort_key(r[2], r[3], r[0]))


def test_distinct_on_is_exact_on_the_tuple(index):
    first = {}
    for row in in_order(ROWS):
        first.setdefault((row[7], row[5]), row[0])
    assert sorted(ids(distinct_on(index, ["digest", "statuscode"]))) == sorted(first.values())


def test_month_alone_is_no_key(index):
    with pytest.raises(ValueError, match="month"):
        distinct_on(index.withColumn("month", F.lit(1)), ["month"])
    with pytest.raises(ValueError):
        distinct_on(index, [])


def test_bad_prefix(index):
    with pytest.raises(ValueError, match="prefix"):
        distinct_on(index, ["urlkey:x"])


def test_limit_counts_after_filter_and_distinct(index):
    got = find_captures(
        index, statuscode=200, distinct_on=["digest"], limit=3, allow_full_scan=True
    )
    first = {}
    for row in in_order([r for r in ROWS if r[5] == 200]):
        first.setdefault(row[7], row)
    want = [r[0] for r in in_order(first.values())][:3]
    assert ids(got) == want


def test_top_k_sees_all_rows(index):
    want = sorted(ROWS, key=lambda r: (r[8], sort_key(r[2], r[3], r[0])))[:5]
    assert ids(top_k(index, ["length"], 5)) == [r[0] for r in want]


def test_offset_is_applied_once(index):
    assert ids(page(index, 10, 25)) == [r[0] for r in in_order(ROWS)[25:35]]
    assert ids(page(index, 10, len(ROWS) - 4)) == [r[0] for r in in_order(ROWS)[-4:]]


def test_large_pages_agree_with_small_ones(index, monkeypatch):
    order = ["urlkey", "timestamp", "capture_id"]
    small = ids(take_ordered(index, order, 90, 30))
    monkeypatch.setattr(topk, "TOP_K_ROWS", 10)
    assert ids(take_ordered(index, order, 90, 30, rows_per_range=25)) == small


@pytest.mark.parametrize("n", [topk.TOP_K_ROWS, topk.TOP_K_ROWS + 1])
def test_limits_agree_at_the_border(index, n):
    assert ids(page(index, n - 3, 3)) == [r[0] for r in in_order(ROWS)][3:n]


@pytest.mark.parametrize("n", [topk.PRUNED_RANK, topk.PRUNED_RANK + 1])
def test_caps_agree_at_the_border(index, n):
    want = []
    for crawl in {r[4] for r in ROWS}:
        want += [r[0] for r in in_order([r for r in ROWS if r[4] == crawl])][:n]
    assert sorted(ids(cap_per_crawl(index, n))) == sorted(want)


def test_latest_takes_the_newest(index):
    want = sorted(ROWS, key=lambda r: sort_key(r[3], r[0]), reverse=True)[:6]
    assert ids(latest(index, 6)) == [r[0] for r in want]


def test_latest_per_url_large_n_agrees(index, monkeypatch):
    few = sorted(ids(latest_per_url(index, 20)))
    monkeypatch.setattr(topk, "PRUNED_RANK", 5)
    assert sorted(ids(latest_per_url(index, 20))) == few


def test_cap_is_per_crawl_and_absent_by_default(index):
    counts = cap_per_crawl(index, 4).groupBy("crawl_id").count().collect()
    assert {r["count"] for r in counts} == {4}
    assert find_captures(index, allow_full_scan=True).count() == len(ROWS)
    assert find_captures(index, max_results=4, allow_full_scan=True).count() == 4 * len(counts)


def test_balanced_sample_never_exceeds_n(index):
    crawls = len({r[4] for r in ROWS})
    got = balanced_sample(index, 2 * crawls + 1).collect()
    assert len(got) == 2 * crawls + 1
    assert max(sum(1 for r in got if r.crawl_id == c) for c in {r.crawl_id for r in got}) <= 3


def test_limit_zero_and_negative(index):
    assert find_captures(index, limit=0, allow_full_scan=True).count() == 0
    with pytest.raises(ValueError):
        page(index, -1, 0)
    with pytest.raises(ValueError):
        find_captures(index, limit=1, newest=1, allow_full_scan=True)


def test_url_filter_is_required(index):
    with pytest.raises(UrlFilterRequired):
        find_captures(index, statuscode=200)
    assert find_captures(index, "http://hot.example.com/").count() > 0


def test_any_projection_works(index):
    # Neither the filtered nor the ordering columns need to be selected.
    got = find_captures(index, "http://hot.example.com/", limit=5).select("statuscode")
    assert got.count() == 5


def test_unknown_argument(index):
    with pytest.raises(TypeError):
        find_captures(index, "x", no_such_argument=1)
