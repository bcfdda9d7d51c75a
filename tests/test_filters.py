"""Predicates keep their SQL meaning and reach the scan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pagestrata import distinct_on, find_captures, in_crawls, latest, latest_crawl, select_crawls
from pagestrata import to_index_table
from pagestrata.functions.urls import host_of, port_of, surt, surt_host
from pagestrata.operators import filters as f
from pagestrata.session import shared_folder

URLS = [
    "http://example.com/", "http://example.com/a", "https://www.example.com/a_b", "http://example.com:8080/p?q=1",
    "http://notexample.com/", "https://example.com.evil.org/", "http://example.com", "http://x.org/a*b", "http://x.org/aXb",
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u) for i, u in enumerate(URLS)]
    df = spark.createDataFrame(rows, "capture_id long, url string")
    return df.withColumn("urlkey", surt(F.col("url"))).cache()


def urls(df):
    return {r.url for r in df.collect()}


@pytest.mark.parametrize(
    "pattern, wanted",
    [
        ("http://example.com/a", {URLS[1]}),
        ("http://example.com/*", {URLS[0], URLS[1]}),
        ("example.com", {URLS[0], URLS[6]}),
        ("example.com/a", {URLS[1]}),
        ("example.com/*", {URLS[0], URLS[1], URLS[3]}),
        ("*.example.com", {URLS[0], URLS[1], URLS[2], URLS[3], URLS[6]}),
        ("www.example.com/*", {URLS[0], URLS[1], URLS[2], URLS[3]}),
        ("example.com:8080/p*", {URLS[3]}),
        ("example.com:81/p*", set()),
        ("*.example.com/a*", {URLS[1], URLS[2]}),
        ("*.example.com/a", {URLS[1]}),
    ],
)
@pytest.mark.parametrize("keyed", [False, True])
def test_url_pattern(pages, pattern, wanted, keyed):
    assert urls(pages.filter(f.url_pattern(pattern, keyed))) == wanted


@pytest.mark.parametrize(
    "pattern, wanted",
    [
        ("%.example.com/%", {URLS[2]}),
        ("%a*b", {URLS[7]}),
        ("%a_b", {URLS[2], URLS[7], URLS[8]}),
        ("example.com/a%", {URLS[1]}),
        ("http://example.com/%", {URLS[0], URLS[1]}),
        ("example.com%", {URLS[0], URLS[1], URLS[3], URLS[5], URLS[6]}),
    ],
)
@pytest.mark.parametrize("keyed", [False, True])
def test_url_like(pages, pattern, wanted, keyed):
    assert urls(pages.filter(f.url_like(pattern, keyed))) == wanted


# Keys as an index with canonical keys writes them, by hand.
CANONICAL = [
    ("http://www.example.com/a", "com,example)/a"), ("http://example.com:8080/a", "com,example:8080)/a"),
    ("http://u:p@example.com/a", "com,example)/a"), ("http://example.com/a%20b", "com,example)/a%20b"),
    ("http://example.com/aZZ20b", "com,example)/azz20b"), ("http://m.example.com/a", "com,example,m)/a"),
]


@pytest.mark.parametrize(
    "condition, wanted",
    [
        (lambda: f.url_pattern("http://example.com/a%20b", True), [3]),
        (lambda: f.url_pattern("http://example.com/a*", True), [3, 4]),
        (lambda: f.url_pattern("http://www.example.com/*", True), [0]),
        (lambda: f.url_pattern("www.example.com/*"), [0, 1, 2, 3, 4]),
        (lambda: f.url_pattern("example.com/a"), [0, 1, 2]),
        (lambda: f.url_pattern("example.com:8080/a"), [1]),
        (lambda: f.in_domain("example.com"), [0, 1, 2, 3, 4, 5]),
        (lambda: f.on_host("example.com", True), [1, 2, 3, 4]),
        (lambda: f.url_like("example.com/a\\%20b", True), [3]),
        (lambda: f.url_pattern("http://exam*", True), [1, 3, 4]),
    ],
)
def test_canonical_keys(spark, condition, wanted):
    rows = [(i, *r) for i, r in enumerate(CANONICAL)]
    df = spark.createDataFrame(rows, "i int, url string, urlkey string")
    assert sorted(r.i for r in df.filter(condition()).collect()) == wanted


def test_hosts_with_users_ports_and_addresses(spark):
    cases = {
        "http://u:p@Example.com/x": ("example.com", ""), "http://[::1]:81/x": ("[::1]", "81"),
        "https://e.com:8080": ("e.com", "8080"), "e.com/a:1": ("e.com", ""),
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    got = df.select("u", host_of(F.col("u")).alias("h"), port_of(F.col("u")).alias("p")).collect()
    assert {r.u: (r.h, r.p) for r in got} == cases
    assert df.filter("u LIKE '%Example%'").select(surt(F.col("u"))).first()[0] == "com,example)/x"


def test_inner_star_is_refused():
    with pytest.raises(ValueError):
        f.url_pattern("example.com/*/x*")


def test_host_and_domain(pages):
    assert urls(pages.filter(f.on_host("example.com"))) == {URLS[0], URLS[1], URLS[3], URLS[6]}
    assert URLS[4] not in urls(pages.filter(f.in_domain("example.com")))
    assert URLS[5] not in urls(pages.filter(f.in_domain("example.com")))


def test_surt(pages):
    keys = {r.url: r.urlkey for r in pages.collect()}
    assert keys[URLS[2]] == "com,example,www)/a_b"
    assert keys[URLS[3]] == "com,example)/p?q=1"
    row = pages.filter(F.col("url") == URLS[3]).select(host_of(F.col("url")), surt_host(F.col("urlkey")))
    assert tuple(row.first()) == ("example.com", "com,example")


SCHEMA = "capture_id long, url string, urlkey string, timestamp timestamp, statuscode int, mimetype string, crawl_id string"


@pytest.fixture(scope="module")
def index(spark):
    rows = []
    for i in range(60):
        day = dt.datetime(2024, 10, 1 + i % 30, 10, 30, tzinfo=dt.timezone.utc)
        kind = ["text/html", "application/xhtml+xml", "application/xhtmlXxml"][i % 3]
        rows.append((i, f"http://e.com/{i}", f"com,e)/{i}", day, [200, 301, 404][i % 3], kind, f"C{i % 4}"))
    folder = shared_folder(spark)
    to_index_table(spark.createDataFrame(rows, SCHEMA), folder)
    return spark.read.parquet(folder)


def test_inequality_and_not_in(index):
    assert index.filter(F.col("url") != "http://e.com/1").count() == 59
    assert index.filter(~f.one_of("statuscode", [200, 301])).count() == 20
    assert index.filter(~f.one_of("crawl_id", ["C0"])).count() == 45


def test_plus_in_a_media_type_is_literal(index):
    assert index.filter(F.col("mimetype") == "application/xhtml+xml").count() == 20


def test_time_bounds_are_exact_strict_and_all_applied(index):
    day = lambda n: f"2024-10-{n:02d} 10:30:00"
    assert index.filter(f.time_range(index, since=day(10), until=day(20))).count() == 22
    assert index.filter(f.time_range(index, after=day(10), before=day(20))).count() == 18
    both = f.time_range(index, since=day(5), after=day(29))
    assert index.filter(both).count() == 2
    assert index.filter(f.year_range(index, 2024, 2024)).count() == 60
    assert index.filter(f.year_range(index, last=2023)).count() == 0


def test_time_zone_of_a_bound(index):
    zone = dt.timezone(dt.timedelta(hours=2))
    at = dt.datetime(2024, 10, 30, 12, 30, tzinfo=zone)
    assert index.filter(f.time_range(index, since=at)).count() == 2
    assert index.filter(f.time_range(index, after=at)).count() == 0
    assert index.filter(f.time_range(index, since="2024-10-30T12:30:00+02:00")).count() == 2
    assert index.filter(f.time_range(index, since="2024-10-30T10:30:00Z")).count() == 2
    with pytest.raises(ValueError):
        f.time_range(index, since="last week")


def test_time_bounds_without_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-10-30 10:30:00' AS timestamp")
    assert df.filter(f.time_range(df, since="2024-10-30T12:30:00+02:00")).count() == 1
    assert df.filter(f.time_range(df, until=dt.date(2024, 10, 30))).count() == 0
    assert df.filter(f.time_range(df, "2024-10-30", dt.datetime(2024, 10, 31))).count() == 1


def test_partial_and_whole_regex(index):
    assert index.filter(f.matches("url", r"com/5$")).count() == 1
    assert index.filter(f.matches_whole("url", r"com/5")).count() == 0
    assert index.filter(f.matches_whole("statuscode", "2..|3..")).count() == 40


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 4000)
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(index):
    df = find_captures(index, "http://e.com/*", statuscode=200, years=(2024, 2024), crawl_id="C1")
    plan = plan_of(df.select("url"))
    assert "PartitionFilters: [isnotnull(crawl_id" in plan and "(crawl_id#" in plan
    for pushed in ("StringStartsWith(url,http://e.com/)", "StringStartsWith(urlkey,com,e))"):
        assert pushed in plan
    assert "mimetype" not in plan.split("ReadSchema: ")[1]
    for bounded in (f.url_pattern("http://e.com/1", True), f.on_host("e.com", True), f.url_like("e.com/1%", True)):
        assert "StringStartsWith(urlkey,com,e))" in plan_of(index.filter(bounded))


def test_domain_filter_reaches_the_scan(index):
    plan = plan_of(index.filter(f.in_domain("e.com")))
    assert all(f"StringStartsWith(urlkey,com,e{end})" in plan for end in ",):")


def test_rank_limit_before_the_shuffle(index):
    plan = plan_of(distinct_on(index, ["mimetype"]))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert "TakeOrderedAndProject" in plan_of(latest(index, 5))


def test_crawl_selection_prunes_partitions(spark, index):
    folder = shared_folder(spark)
    entries = [("C0", "2024-01-01", "2024-02-01"), ("C1", "2024-03-01", "2024-04-01")]
    catalog = spark.createDataFrame(entries, "id string, a string, b string").selectExpr(
        "id", "cast(a as timestamp) from_ts", "cast(b as timestamp) to_ts"
    )
    catalog.write.parquet(folder)
    catalog = spark.read.parquet(folder)
    chosen = select_crawls(index, catalog, "2024-03-10", "2024-03-11")
    assert "dynamicpruning" in plan_of(chosen)
    assert {r.crawl_id for r in chosen.collect()} == {"C1"}
    assert select_crawls(index, catalog, "2025-01-01").count() == 0
    assert {r.crawl_id for r in latest_crawl(index, catalog).collect()} == {"C1"}
    assert in_crawls(index, "C2", "C3").count() == 30


def test_header_filter_and_missing_key(spark):
    df = spark.createDataFrame([(1, {"Content-Type": "text/html"}), (2, {})], "n int, h map<string,string>")
    assert [r.n for r in df.filter(f.header_like("h", "Content-Type", "%html%")).collect()] == [1]
    assert [r.n for r in df.filter(~f.header_like("h", "Content-Type", "%html%")).collect()] == [2]


def test_a_stored_body_is_only_read_if_selected(spark):
    folder = shared_folder(spark)
    spark.range(5).selectExpr(
        "concat('http://e.com/', id) url",
        "named_struct('body', cast('x' as binary), 'headers', map('A', '1'), 'error', 'e') response",
    ).write.parquet(folder)
    stored = spark.read.parquet(folder)
    without = plan_of(stored.filter(F.col("url").startswith("http")).select("url"))
    assert "response" not in without.split("ReadSchema")[1]
    error_only = plan_of(stored.select("url", "response.error"))
    assert "body" not in error_only.split("ReadSchema")[1]
    assert stored.select(F.col("response.headers")["B"]).first()[0] is None
