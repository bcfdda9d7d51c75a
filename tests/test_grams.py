"""Lookups by three bytes in a row against scans."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagestrata import find_by_grams, read_index_table, to_index_table, write_grams
from pagestrata.operators import filters
from pagestrata.session import shared_folder
from pagestrata.sources import grams
from pagestrata.sources.grams import grams_needed, like_literals, packed, regex_literals, unpacked

LIKES = ["%needle%", "%/en/p1_%.html", "http://h3.%", "%ab%", "%\\%20%", "nothing like it at all", "%", "%münch%", "%needle%z9%", ""]
REGEXES = [
    "needle", r"/en/p1\d\.html$", "(needle|other)", "needle|utm_source", "nee(d)?le", "needx?le", "need{1,2}le", "h[37]\\.example",
    "(?i)NEEDLE", r"\Qneedle\E", "a|needle", r"example\.(com|org)/en", "[a-z&&[^b]]+needle", "münch.*html", "^$", "needle*", "ne+dle",
]


@pytest.fixture(scope="module")
def index(spark):
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        url = f"http://h{rng.randrange(9)}.example.{rng.choice(['com', 'org'])}/en/p{rng.randrange(3000)}.html"
        if i % 700 == 3:
            url += "?needle=%20" + "z" * (i // 700)
        if i % 900 == 5:
            url += "?utm_source=münchen.html"
        rows.append((i, None if i % 50 == 7 else "" if i % 50 == 8 else "ab" if i % 50 == 9 else url, f"k{i:05d}", f"C{i % 3}"))
    rows.append((6000, "x" * 300_000 + "needle" + "y" * 300_000, "k9", "C0"))
    rows += rows[:20]
    df = spark.createDataFrame(rows, "capture_id long, url string, urlkey string, crawl_id string")
    df = df.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))
    folder = shared_folder(spark)
    to_index_table(df, f"{folder}/table", files=24, number_rows=True)
    table = read_index_table(spark, f"{folder}/table")
    write_grams(table, f"{folder}/grams")
    return table, f"{folder}/grams"


def ids(df):
    return sorted(r[0] for r in df.select("row_id").collect())


def test_row_ids_are_unique_and_follow_the_files(index):
    table, _ = index
    rows = table.select("row_id", "crawl_id", "urlkey").collect()
    assert len({r.row_id for r in rows}) == len(rows) == 6021
    keys = [(r.crawl_id, r.urlkey) for r in sorted(rows)]
    assert keys == sorted(keys)


def test_like_and_contains_find_what_a_scan_finds(index):
    table, path = index
    for pattern in LIKES:
        assert ids(find_by_grams(table, path, like=pattern)) == ids(table.filter(filters.like("url", pattern))), pattern
    for part in ("needle", "%20", "ab", "", "not there"):
        assert ids(find_by_grams(table, path, contains=part)) == ids(table.filter(F.col("url").contains(part))), part
    assert len(ids(find_by_grams(table, path, contains="needle"))) > 5


def test_regexes_find_what_a_scan_finds(index):
    table, path = index
    for pattern in REGEXES:
        assert ids(find_by_grams(table, path, matches=pattern)) == ids(table.filter(filters.matches("url", pattern))), pattern
    for pattern in (r"http://h3\..*needle.*", "a|.*needle.*", "x)|(?:.*needle.*"):
        wanted = ids(table.filter(filters.matches_whole("url", pattern)))
        assert ids(find_by_grams(table, path, matches_whole=pattern)) == wanted, pattern


def rows_scanned(df):
    query = df._jdf.queryExecution()
    query.toRdd().count()
    scan = query.executedPlan().collectLeaves().apply(0)
    return scan.metrics().apply("numOutputRows").value(), query.executedPlan().toString()


def test_only_hit_row_groups_are_read(index):
    table, path = index
    found = find_by_grams(table, path, contains="münchen")
    read, plan = rows_scanned(found)
    assert 0 < found.count() < 10
    assert read < 6021 / 2
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(row_id", plan)
    # Of the postings, only row groups that may hold the grams.
    postings = table.sparkSession.read.parquet(f"{path}/postings")
    read, _ = rows_scanned(postings.filter(grams._any_of("gram", grams_needed([["mün"]])[0])))
    assert read < postings.count() / 2


def test_very_many_hits_become_few_ranges(spark, monkeypatch):
    monkeypatch.setattr(grams, "MOST_RANGES", 5)
    n = 40_000
    hits = spark.range(n).select(F.col("id").alias("place"), (F.col("id") * 1024).alias("low"), (F.col("id") * 1024 + 9).alias("high"))
    ranges = grams._ranges_of(hits)
    assert 1 <= len(ranges) <= 5
    assert ranges[0][0] == 0 and ranges[-1][1] == (n - 1) * 1024 + 9
    assert grams._ranges_of(hits.filter("place IN (3, 30000)")) == [(3072, 3081), (30_720_000, 30_720_009)]
    far = hits.selectExpr("low << 10 AS place", "low << 20 AS low", "high << 20 AS high")
    assert len(grams._ranges_of(far)) <= 5
    assert grams._ranges_of(hits.limit(0)) == []


def test_an_empty_table(spark, index):
    table, _ = index
    folder = shared_folder(spark)
    write_grams(table.limit(0), folder)
    assert ids(find_by_grams(table.limit(0), folder, contains="needle")) == []


def test_one_condition_is_asked_for(index):
    with pytest.raises(ValueError):
        find_by_grams(*index)
    with pytest.raises(ValueError):
        find_by_grams(*index, like="%abc%", matches="abc")


@given(st.sets(st.integers(0, 65535), min_size=1, max_size=600))
@settings(max_examples=40, deadline=None)
def test_places_come_back(places):
    places = np.array(sorted(places), np.uint16)
    assert np.flatnonzero(unpacked(packed(places))).tolist() == places.tolist()


def test_blocks_of_common_grams_are_small():
    assert len(packed(np.arange(65536, dtype=np.uint16))) < 100
    assert len(packed(np.sort(np.random.default_rng(1).permutation(65536)[:30000]).astype(np.uint16))) <= 8300


def test_literals_of_patterns():
    assert like_literals(r"%a\%b_c%") == [["", "a%b", "c", ""]]

    def words(pattern):
        found = regex_literals(pattern)
        return found and [[p for p in parts if p] for parts in found]

    assert words(r"/en/[0-9]+\.html") == [["/en/", ".html"]]
    assert words("abc|def?g") == [["abc"], ["de", "g"]]
    assert words("ab(c|d(e)f)gh") == [["ab", "gh"]]
    assert words("abc{2,3}d") == [["ab", "d"]]
    for unsure in ("(?i)abc", r"\Qabc\E", "[a[b]]c", "(?x: a b)c", r"ab\x41", "a)|(b", "(abc", r"\p{L}abc"):
        assert regex_literals(unsure) is None
    assert grams_needed([["ab", "cd"]]) is None
    assert grams_needed([["abc"], [""]]) is None
    assert grams_needed([["a�bc"]]) is None


@pytest.mark.filterwarnings("ignore::FutureWarning")
@given(st.text(alphabet="abc|()?*+.[]^{}1,\\d-", max_size=12), st.text(alphabet="abc1d", max_size=10))
@settings(max_examples=2000, deadline=None)
def test_what_a_match_must_hold_is_there(pattern, text):
    found = regex_literals(pattern)
    try:
        hit = re.search(pattern, text)
    except re.error:
        return
    if found is not None and hit:
        assert any(all(p in hit[0] for p in parts) for parts in found)


def test_memory_of_a_full_chunk_follows_its_grams():
    import tracemalloc

    n = 1 << 16
    texts = [f"https://h{i % 999}.example.net/en/{i * 37 % 250_000}?page=2" for i in range(n)]
    table = pa.table({"chunk": np.zeros(n, np.int64), "row_id": np.arange(n), "text": texts})
    tracemalloc.start()
    found = grams._postings_of(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    pairs = sum(len({t[i : i + 3] for i in range(len(t) - 2)}) for t in texts)
    assert sum(found.column("n").to_pylist()) == pairs
    # Some numbers of eight bytes for each gram of each text, whatever is in work at a time.
    assert peak < 40 * pairs + (48 << 20)
