"""Filters over the whole capture index."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagestrata.operators import filters as f
from pagestrata.plans.capture_query import find_captures
from pagestrata.plans.sql_function import register_function
from workload.derived import captures, table, with_captures
from workload.registry import query

SHOWN = ("capture_id", "url", "statuscode", "mimetype")
_COLUMNS = ", ".join(SHOWN)


def _filtered(name: str, build, sql: str):
    """Register the captures that meet ``build(captures)``, checked by a WHERE clause."""

    @query(name, with_captures(f"SELECT {_COLUMNS} FROM captures WHERE {sql}"))
    def run(spark, sf_dir):
        df = captures(spark, sf_dir)
        return df.filter(build(df)).select(*SHOWN)


@query(
    "url_exact",
    with_captures(f"SELECT {_COLUMNS} FROM captures WHERE url = (SELECT max(url) FROM pages)"),
)
def url_exact(spark, sf_dir):
    wanted = table(spark, sf_dir, "pages").agg(F.max("url")).scalar()
    return captures(spark, sf_dir).filter(F.col("url") == wanted).select(*SHOWN)


_filtered("url_prefix", lambda d: f.url_pattern("https://blog.*"), "url LIKE 'https://blog.%'")
_filtered("url_suffix", lambda d: f.url_like("%.html"), "url LIKE '%.html'")
_filtered("url_contains", lambda d: f.url_like("%/en/%"), "url LIKE '%/en/%'")
_filtered("url_like", lambda d: f.like("url", "http_://%.example.___/en/%"),
          "url LIKE 'http_://%.example.___/en/%'")
_filtered("url_on_host", lambda d: f.on_host("blog.tionsh.example.net"),
          "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) = 'blog.tionsh.example.net'")
_filtered("url_in_domain", lambda d: f.in_domain("tionsh.example.net"),
          r"regexp_matches(url, '^[a-z]+://([^/?#:]+\.)?tionsh\.example\.net([/?#:]|$)')")
_filtered("url_domain_pattern", lambda d: f.url_pattern("*.example.org"),
          r"regexp_matches(url, '^[a-z]+://([^/?#:]+\.)?example\.org([/?#:]|$)')")
_filtered("url_without_scheme", lambda d: f.url_pattern("therha.example.com/en/676"),
          "urlkey = 'com,example,therha)/en/676'")
_filtered("url_path_wildcard", lambda d: f.url_pattern("blog.tionsh.example.net/e*"),
          r"regexp_matches(url, '^[a-z]+://blog\.tionsh\.example\.net/e')")
_filtered("url_not_like", lambda d: ~f.like("url", "%.example.com/%"),
          "url NOT LIKE '%.example.com/%'")
_filtered("url_matches", lambda d: f.matches("url", r"/en/[0-9]+\.html"),
          r"regexp_matches(url, '/en/[0-9]+\.html')")
_filtered("url_similar", lambda d: f.matches_whole("url", r"https?://www\..*/en/[0-9]+"),
          r"url SIMILAR TO 'https?://www\..*/en/[0-9]+'")
_filtered("url_not_similar", lambda d: ~f.matches_whole("url", r"https?://[^/]*/en/.*"),
          "url NOT SIMILAR TO 'https?://[^/]*/en/.*'")
_filtered("url_not_matches", lambda d: ~f.matches("url", "utm_source"),
          "NOT regexp_matches(url, 'utm_source')")
_filtered("url_not_contains", lambda d: ~d.url.contains("example.org"),
          "NOT contains(url, 'example.org')")
_filtered("url_like_without_scheme", lambda d: f.url_like("blog.tionsh.example.net/en/%", keyed=True),
          "url LIKE 'http://blog.tionsh.example.net/en/%' "
          "OR url LIKE 'https://blog.tionsh.example.net/en/%'")


@query(
    "url_not_equal",
    with_captures(f"SELECT {_COLUMNS} FROM captures WHERE url <> (SELECT max(url) FROM pages)"),
)
def url_not_equal(spark, sf_dir):
    other = table(spark, sf_dir, "pages").agg(F.max("url")).scalar()
    return captures(spark, sf_dir).filter(F.col("url") != other).select(*SHOWN)



_filtered("urlkey_like", lambda d: f.like("urlkey", "net,example,%)/en%"),
          "urlkey LIKE 'net,example,%)/en%'")
_filtered("statuscode_like", lambda d: f.like("statuscode", "_01"),
          "CAST(statuscode AS VARCHAR) LIKE '_01'")
_filtered("mimetype_not_like", lambda d: ~f.like("mimetype", "text/%"),
          "mimetype NOT LIKE 'text/%'")
_filtered("urlkey_prefix", lambda d: d.urlkey.startswith("com,example,"),
          "starts_with(urlkey, 'com,example,')")
_filtered("urlkey_suffix", lambda d: d.urlkey.endswith(".html"), "urlkey LIKE '%.html'")
_filtered("mimetype_contains", lambda d: d.mimetype.contains("xhtml+"), "contains(mimetype, 'xhtml+')")
_filtered("urlkey_matches", lambda d: f.matches("urlkey", r"\)/(en|de)/[0-9]+$"),
          r"regexp_matches(urlkey, '\)/(en|de)/[0-9]+$')")
_filtered("mimetype_similar", lambda d: f.matches_whole("mimetype", r"application/.*"),
          "mimetype SIMILAR TO 'application/.*'")
_filtered("urlkey_not_matches", lambda d: ~f.matches("urlkey", "spam|casino"),
          "NOT regexp_matches(urlkey, 'spam|casino')")
_filtered("urlkey_not_similar", lambda d: ~f.matches_whole("urlkey", r"com,.*\)/en/.*"),
          r"urlkey NOT SIMILAR TO 'com,.*\)/en/.*'")
_filtered("urlkey_not_prefix", lambda d: ~d.urlkey.startswith("org,"), "urlkey NOT LIKE 'org,%'")
_filtered("urlkey_not_suffix", lambda d: ~d.urlkey.endswith("=feed"), "urlkey NOT LIKE '%=feed'")
_filtered("urlkey_not_contains", lambda d: ~d.urlkey.contains("?"), "urlkey NOT LIKE '%?%'")

_filtered("status_equal", lambda d: d.statuscode == 404, "statuscode = 404")
_filtered("status_not_equal", lambda d: d.statuscode != 200, "statuscode <> 200")
_filtered("mimetype_equal", lambda d: d.mimetype == "application/xhtml+xml",
          "mimetype = 'application/xhtml+xml'")
_filtered("mimetype_not_equal", lambda d: d.mimetype != "application/pdf",
          "mimetype <> 'application/pdf'")
_filtered("status_in", lambda d: f.one_of("statuscode", [301, 404]), "statuscode IN (301, 404)")
_filtered("status_not_in", lambda d: ~f.one_of("statuscode", [200, 301]),
          "statuscode NOT IN (200, 301)")
_filtered("mimetype_in",
          lambda d: f.one_of("mimetype", ["application/pdf", "application/xhtml+xml"]),
          "mimetype IN ('application/pdf', 'application/xhtml+xml')")
_filtered("time_strict", lambda d: f.time_range(d, after="2020-10-10", before="2023-10-20"),
          "\"timestamp\" > TIMESTAMP '2020-10-10' AND \"timestamp\" < TIMESTAMP '2023-10-20'")
_filtered("time_between", lambda d: f.time_range(d, "2021-01-10 10:00:00", "2022-12-20 20:30:00"),
          "\"timestamp\" BETWEEN TIMESTAMP '2021-01-10 10:00:00' "
          "AND TIMESTAMP '2022-12-20 20:30:00'")
_filtered("year_equal", lambda d: f.year_range(d, 2021, 2021), "\"year\" = 2021")
_filtered("year_from", lambda d: f.year_range(d, first=2023), "\"year\" >= 2023")
_filtered("year_below", lambda d: f.year_range(d, last=2019), "\"year\" < 2020")


@query(
    "null_tests",
    with_captures("""
SELECT capture_id, nullif(mimetype, 'application/pdf') IS NULL AS no_type,
  nullif(statuscode, 404) IS NOT NULL AS has_status FROM captures
WHERE nullif(mimetype, 'application/pdf') IS NULL OR nullif(statuscode, 404) IS NOT NULL"""),
)
def null_tests(spark, sf_dir):
    """Media types and statuses that are really missing."""
    df = captures(spark, sf_dir).select(
        "capture_id",
        F.nullif("mimetype", F.lit("application/pdf")).alias("mimetype"),
        F.nullif("statuscode", F.lit(404)).alias("statuscode"),
    )
    no_type, has_status = F.col("mimetype").isNull(), F.col("statuscode").isNotNull()
    return df.filter(no_type | has_status).select(
        "capture_id", no_type.alias("no_type"), has_status.alias("has_status")
    )


_filtered("crawl_in", lambda d: f.one_of("crawl_id", ["CC-MAIN-2020-18", "CC-MAIN-2023-50"]),
          "crawl_id IN ('CC-MAIN-2020-18', 'CC-MAIN-2023-50')")


@query(
    "conditions_combined",
    with_captures(f"""
SELECT {_COLUMNS} FROM captures
WHERE url LIKE 'https://%' AND statuscode = 200 AND mimetype <> 'application/pdf'
  AND "timestamp" >= TIMESTAMP '2020-01-01' AND "year" <= 2023
  AND crawl_id IN ('CC-MAIN-2021-18', 'CC-MAIN-2022-34')"""),
)
def conditions_combined(spark, sf_dir):
    return find_captures(
        captures(spark, sf_dir),
        "https://*",
        statuscode=200,
        crawl_id=["CC-MAIN-2021-18", "CC-MAIN-2022-34"],
        since="2020-01-01",
        years=(None, 2023),
        where=F.col("mimetype") != "application/pdf",
    ).select(*SHOWN)


def _by_function(name: str, arguments: str, sql: str):
    """Captures that the SQL function gives for ``arguments``, checked by plain SQL."""

    @query(f"function_{name}", with_captures(f"SELECT {_COLUMNS} FROM {sql}"))
    def run(spark, sf_dir):
        register_function(captures(spark, sf_dir), f"captures_{name}")
        return spark.sql(f"SELECT {_COLUMNS} FROM captures_{name}({arguments})")


_by_function(
    "domain", "domain => 'example.org', since => TIMESTAMP_NTZ '2021-03-01', statuscode => 200",
    r"""captures WHERE regexp_matches(url, '^[a-z]+://([^/?#:]+\.)?example\.org([/?#:]|$)')
        AND "timestamp" >= TIMESTAMP '2021-03-01' AND statuscode = 200""",
)
_by_function(
    "path", "url => 'blog.tionsh.example.net/e*', mimetype => 'text/html'",
    r"captures WHERE regexp_matches(url, '^[a-z]+://blog\.tionsh\.example\.net/e') AND mimetype = 'text/html'",
)
_by_function(
    "capped", "url_like => '%/en/%', max_results => 40",
    """(SELECT *, row_number() OVER (PARTITION BY crawl_id ORDER BY urlkey, "timestamp", capture_id) AS rn
        FROM captures WHERE url LIKE '%/en/%') WHERE rn <= 40""",
)
