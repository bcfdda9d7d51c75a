"""An index as a function of SQL, against the same conditions given in Python."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pagestrata import cap_per_crawl, find_captures, register_function, to_index_table
from pagestrata.functions.urls import surt
from pagestrata.session import shared_folder

URLS = [
    "http://example.com/", "http://example.com", "http://www.example.com/", "https://example.com/a", "https://example.com/a/b",
    "http://example.com:8080/a", "http://example.com:80/a", "http://news.example.com/A_b", "http://news.example.com/a%b",
    "http://news.example.com/axb", "http://example.community/a", "http://user@example.com/a", "http://a.b.example.com/",
    "http://notexample.com/a", None, "",
]


@pytest.fixture(scope="module")
def index(spark):
    rows = [
        (i, u, f"C{(i + j) % 3}", 200 if i % 2 else 404, "text/html" if i % 3 else "application/pdf", j)
        for j in range(4) for i, u in enumerate(URLS)
    ]
    df = spark.createDataFrame(rows, "n long, url string, crawl_id string, statuscode int, mimetype string, j int")
    df = df.withColumn("timestamp", F.make_timestamp_ntz(2020 + F.col("j"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    df = df.withColumn("urlkey", surt(F.col("url"))).withColumn("capture_id", F.col("n") + 100 * F.col("j"))
    path = shared_folder(spark)
    to_index_table(df, path, files=2)
    return register_function(spark.read.parquet(path), "caps")


def ids(df):
    return sorted(r.capture_id for r in df.collect())


PATTERNS = [
    "http://example.com/", "http://example.com/*", "https://example.com/a*", "*.example.com", "*.example.com/*",
    "*.example.com/a*", "*.example.com/a", "example.com", "example.com/", "example.com/a", "example.com/a*", "example.com/*",
    "example.com:8080/a", "example.com:8080/*", "www.example.com", "WWW.Example.com/*", "news.example.com/a_b",
    "news.example.com/a%b", "news.example.com/a_*", "example.com*", "nowhere.test/*", "*.com",
]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_url_patterns(spark, index, pattern):
    found = spark.sql("SELECT * FROM caps(url => :p)", {"p": pattern})
    assert ids(found) == ids(find_captures(index, pattern))


@pytest.mark.parametrize("host", ["example.com", "WWW.example.com", "news.example.com", "x.test"])
def test_hosts_and_domains(spark, index, host):
    assert ids(spark.sql("SELECT * FROM caps(host => :h)", {"h": host})) == ids(find_captures(index, host=host))
    assert ids(spark.sql("SELECT * FROM caps(domain => :h)", {"h": host})) == ids(find_captures(index, domain=host))


def test_conditions_come_before_the_cap_and_where_after(spark, index):
    found = spark.sql("""SELECT * FROM caps(url_like => '%example%', statuscode => 200, mimetype => 'text/html',
        since => TIMESTAMP_NTZ '2021-01-01', until => TIMESTAMP_NTZ '2022-12-31', crawl_id => 'C1', max_results => 2)""")
    same = find_captures(
        index, url_like="%example%", statuscode=200, mimetype="text/html", since="2021-01-01", until="2022-12-31",
        crawl_id="C1", max_results=2,
    )
    assert len(ids(found)) == 2 and ids(found) == ids(same)
    capped = spark.sql("SELECT * FROM caps(allow_full_scan => true, max_results => 3) WHERE statuscode = 404")
    assert ids(capped) == ids(cap_per_crawl(index, 3).filter("statuscode = 404"))
    for n in (0, 5, 1_000_000):
        every = spark.sql(f"SELECT * FROM caps(allow_full_scan => true, max_results => {n})")
        assert ids(every) == ids(cap_per_crawl(index, n))


def test_columns_and_nulls(spark, index):
    every = spark.sql("SELECT * FROM caps(allow_full_scan => true, url => NULL, statuscode => NULL, max_results => NULL)")
    assert every.columns == index.columns and every.dtypes == index.dtypes and every.count() == index.count()


@pytest.mark.parametrize("call, message", [
    ("caps(nothing => 1)", "UNRECOGNIZED_PARAMETER_NAME"),
    ("caps(max_results => 'many', host => 'example.com')", "CAST_INVALID_INPUT"),
    ("caps()", "needs url"),
    ("caps(max_results => 5) WHERE url = 'http://example.com/'", "needs url"),
    ("caps(host => 'example.com', max_results => -1)", "negative"),
    ("caps(url => 'http://*/a')", "may only start or end"),
])
def test_errors(spark, index, call, message):
    with pytest.raises(PySparkException, match=message):
        spark.sql(f"SELECT * FROM {call}").collect()


def test_parameters_reach_the_scan(spark, index):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)

    def plan(text):
        return spark.sql(text)._jdf.queryExecution().executedPlan().toString()

    found = plan("SELECT capture_id FROM caps(url => 'news.example.com/a*', crawl_id => 'C1') WHERE statuscode = 200")
    assert "Window" not in found and "Exchange" not in found and "CASE" not in found
    assert "StringStartsWith(urlkey,com,example,news)/a)" in found and "EqualTo(statuscode,200)" in found
    assert "PartitionFilters: [isnotnull(crawl_id" in found and "mimetype" not in found
    assert "StringStartsWith(url,http://e)" in plan("SELECT url FROM caps(url => 'http://e*')")
    capped = plan("SELECT url FROM caps(host => 'example.com', max_results => 10)")
    assert capped.count("WindowGroupLimit") >= 3
    same = find_captures(index, "news.example.com/a*")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(urlkey,com,example,news)/a)" in same
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_without_keys_crawls_and_times(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    register_function(df, "plain")
    assert spark.sql("SELECT * FROM plain(domain => 'example.com')").count() == 12
    assert spark.sql("SELECT * FROM plain(allow_full_scan => true, max_results => 4)").count() == 4
    register_function(df.limit(0), "plain")
    assert spark.sql("SELECT * FROM plain(domain => 'example.com', max_results => 4)").count() == 0
    with pytest.raises(ValueError, match="column url"):
        register_function(spark.range(1), "plain")
