"""Fetch slots: the rate holds, nothing is lost, and the whole takes no longer than it must."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pagestrata import polite_slots


@pytest.fixture(scope="module")
def wanted(spark):
    n = F.col("id")
    host = F.when(n % 3 == 0, "hot.example.com").otherwise(F.concat(F.lit("h"), n % 41, F.lit(".example.org")))
    return spark.range(1200).select(n, F.concat(F.lit("http://"), host, F.lit("/"), n).alias("url")).union(
        spark.createDataFrame([(2000, None), (2001, ""), (2002, None)], "id long, url string")
    )


def host(url):
    return (url or "").removeprefix("http://").partition("/")[0]


@pytest.mark.parametrize("per_slot, size, share", [(1, 50, 1000), (3, 10_000, 1000), (7, 50, 2)])
def test_rate_and_length(wanted, monkeypatch, per_slot, size, share):
    monkeypatch.setattr("pagestrata.plans.polite.HOT_SHARE", share)
    rows = polite_slots(wanted, per_slot, order=["url", "id"], rows_per_range=size).collect()
    assert sorted(r.id for r in rows) == sorted(r.id for r in wanted.collect())
    assert max(Counter((host(r.url), r.slot) for r in rows).values()) <= per_slot
    assert min(r.slot for r in rows) >= 0
    assert max(r.slot for r in rows) + 1 == -(-400 // per_slot)
    by_host = defaultdict(list)
    for r in rows:
        by_host[host(r.url)].append((r.url is not None, r.url or "", r.id, r.slot))
    for own in by_host.values():
        turns = [slot for *_, slot in sorted(own)]
        # Without gaps, in order.
        assert turns == [turns[0] + i // per_slot for i in range(len(turns))]
    # Small hosts do not all begin at once.
    assert len({min(s for *_, s in own) for own in by_host.values()}) > 10


def test_no_rows_one_row_and_a_column_of_that_name(spark, wanted):
    assert polite_slots(wanted.limit(0)).count() == 0
    one = spark.createDataFrame([("http://a/", "x")], "url string, slot string")
    assert [tuple(r) for r in polite_slots(one).collect()] == [("http://a/", 0)]
    with pytest.raises(ValueError):
        polite_slots(one, 0)
