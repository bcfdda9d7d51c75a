"""Groupings, windows, unions, crawl selection and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagestrata import (
    body_size_stats,
    capture_gaps,
    change_history,
    count_by,
    domains,
    in_crawls,
    latest_crawl,
    merge_rollups,
    overlap_join,
    polite_slots,
    registrable_domains,
    roll_up,
    select_crawls,
    snapshots_per_year,
    status_class,
    union_sources,
    url_overlaps,
    with_calendar,
    write_rollups,
)
from pagestrata.functions import records
from pagestrata.functions.urls import compact_time, host_of, surt
from pagestrata.operators.bodies import attach_bodies
from pagestrata.plans.requests import plan_crawl_requests, plan_fetches, plan_requests
from pagestrata.session import shared_folder, written
from workload.derived import CATALOG, captures, crawl_catalog, table, with_captures
from workload.registry import query


@query(
    "count_filtered",
    with_captures("""SELECT count(*) AS total FROM captures
                     WHERE statuscode = 200 AND url LIKE '%.example.com/%'"""),
)
def count_filtered(spark, sf_dir):
    found = captures(spark, sf_dir).filter("statuscode = 200 AND url LIKE '%.example.com/%'")
    return found.agg(F.count("*").alias("total"))


def _counts(*columns: str):
    name = "count_by_" + "_".join(columns)
    by = ", ".join(columns)
    sql = f"SELECT {by}, count(*) AS captures FROM captures GROUP BY {by}"

    @query(name, with_captures(sql))
    def run(spark, sf_dir):
        return count_by(captures(spark, sf_dir), *columns)


_counts("statuscode")
_counts("mimetype")
_counts("crawl_id")
_counts("crawl_id", "statuscode")


@query(
    "snapshots_per_year",
    with_captures("""SELECT CAST(year("timestamp") AS INT) AS "year", count(*) AS snapshot_count
                     FROM captures GROUP BY 1"""),
)
def yearly_counts(spark, sf_dir):
    return snapshots_per_year(captures(spark, sf_dir).drop("year"))


@query(
    "change_history",
    with_captures("""
SELECT url, "timestamp", length, digest FROM (
  SELECT *, row_number() OVER (PARTITION BY url, "year" ORDER BY "timestamp", capture_id) AS rn
  FROM captures WHERE statuscode = 200) WHERE rn = 1"""),
)
def yearly_changes(spark, sf_dir):
    return change_history(captures(spark, sf_dir).filter("statuscode = 200"))


@query(
    "domains",
    with_captures("""SELECT DISTINCT regexp_extract(url, 'https?://([^/?#:]+)', 1) AS domain
                     FROM captures WHERE url LIKE '%.org/%' AND statuscode = 200"""),
)
def org_domains(spark, sf_dir):
    return domains(captures(spark, sf_dir).filter("url LIKE '%.org/%' AND statuscode = 200"))


_GAPS = with_captures("""
SELECT capture_id, url, "timestamp",
  lead("timestamp") OVER (PARTITION BY url ORDER BY "timestamp", capture_id) AS next_ts
FROM captures""")


@query("capture_gaps", _GAPS)
def gaps(spark, sf_dir):
    found = capture_gaps(captures(spark, sf_dir))
    return found.select("capture_id", "url", "timestamp", "next_ts")


@query("capture_gaps_in_ranges", _GAPS)
def gaps_in_ranges(spark, sf_dir):
    found = capture_gaps(captures(spark, sf_dir), rows_per_range=3000)
    return found.select("capture_id", "url", "timestamp", "next_ts")


@query(
    "ordered_by_time",
    with_captures("""SELECT url, "timestamp", statuscode FROM captures WHERE statuscode = 404"""),
)
def ordered_by_time(spark, sf_dir):
    found = captures(spark, sf_dir).filter("statuscode = 404")
    return found.select("url", "timestamp", "statuscode").orderBy(F.desc("timestamp"), "url")


@query(
    "union_of_filters",
    with_captures("""SELECT url FROM captures WHERE statuscode = 200
                     UNION ALL SELECT url FROM captures WHERE statuscode = 404"""),
)
def union_of_filters(spark, sf_dir):
    df = captures(spark, sf_dir)
    good, gone = df.filter("statuscode = 200"), df.filter("statuscode = 404")
    return union_sources(good.select("url"), gone.select("url"))


@query(
    "union_of_sources",
    with_captures("""
SELECT url, "timestamp", statuscode, urlkey, NULL AS crawl_id FROM captures WHERE "year" < 2021
UNION ALL
SELECT url, "timestamp", statuscode, NULL AS urlkey, crawl_id FROM captures
WHERE crawl_id = 'CC-MAIN-2024-18'"""),
)
def union_of_sources(spark, sf_dir):
    df = captures(spark, sf_dir)
    snapshots = df.filter("year < 2021").select("url", "timestamp", "statuscode", "urlkey")
    crawl = in_crawls(df, "CC-MAIN-2024-18").select("url", "timestamp", "statuscode", "crawl_id")
    return union_sources(snapshots, crawl)


@query(
    "grouped_subquery",
    with_captures("""
SELECT mimetype, count(*) AS captures FROM (
  SELECT url, statuscode, mimetype FROM captures WHERE statuscode = 200)
WHERE url LIKE '%.com/%' GROUP BY mimetype"""),
)
def grouped_subquery(spark, sf_dir):
    """The same index queried in SQL, through a view."""
    return spark.sql(
        """WITH good AS (SELECT url, mimetype FROM {captures} WHERE statuscode = 200)
           SELECT mimetype, count(*) AS captures FROM good
           WHERE url LIKE '%.com/%' GROUP BY mimetype""",
        captures=captures(spark, sf_dir),
    )


@query(
    "good_and_gone",
    with_captures("""SELECT DISTINCT a.url FROM captures a JOIN captures b ON a.url = b.url
                     WHERE a.statuscode = 200 AND b.statuscode = 404"""),
)
def good_and_gone(spark, sf_dir):
    """URLs captured both with and without success, joined after both sides are distinct."""
    df = captures(spark, sf_dir)
    good = df.filter("statuscode = 200").select("url").distinct()
    gone = df.filter("statuscode = 404").select("url").distinct()
    return good.join(gone, "url")


@query(
    "status_class",
    with_captures("""
SELECT capture_id, url, CASE WHEN statuscode = 200 THEN 'Success'
  WHEN statuscode >= 400 THEN 'Error' ELSE 'Other' END AS status_category FROM captures"""),
)
def status_classes(spark, sf_dir):
    df = captures(spark, sf_dir)
    return df.select("capture_id", "url", status_class().alias("status_category"))


@query(
    "calendar",
    with_captures('SELECT capture_id, "year", "month" FROM captures'),
)
def calendar(spark, sf_dir):
    df = with_calendar(captures(spark, sf_dir).drop("year", "month"))
    return df.select("capture_id", "year", "month")


@query(
    "prefixes_and_dates",
    with_captures("""
SELECT capture_id, substring(url, 9) AS rest, substring(urlkey, 1, 6) AS key_start,
  strftime("timestamp", '%Y-%m-%d') AS day, strftime("timestamp", '%Y%m%d%H%M%S') AS digits
FROM captures"""),
)
def prefixes_and_dates(spark, sf_dir):
    df = captures(spark, sf_dir)
    return df.select(
        "capture_id",
        F.expr("substring(url, 9)").alias("rest"),
        F.substring("urlkey", 1, 6).alias("key_start"),
        F.date_format("timestamp", "yyyy-MM-dd").alias("day"),
        compact_time(F.col("timestamp")).alias("digits"),
    )


@query(
    "surt_keys",
    r"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host,
  concat(array_to_string(list_reverse(string_split(
    regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), '.')), ','), ')',
    lower(regexp_extract(url, '^[a-z]+://[^/?#]+([^#]*)', 1))) AS urlkey FROM pages""",
)
def surt_keys(spark, sf_dir):
    url = F.col("url")
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", host_of(url).alias("host"), surt(url).alias("urlkey"))


@query(
    "crawls_overlapping",
    with_captures(
        """
SELECT capture_id, crawl_id FROM captures WHERE crawl_id IN (
  SELECT id FROM crawls WHERE to_ts >= TIMESTAMP '2021-03-10' AND from_ts <= TIMESTAMP '2022-06-20')
  AND "timestamp" BETWEEN TIMESTAMP '2021-03-10' AND TIMESTAMP '2022-06-20'""",
        CATALOG,
    ),
)
def crawls_overlapping(spark, sf_dir):
    df = captures(spark, sf_dir)
    found = select_crawls(df, crawl_catalog(df), "2021-03-10", "2022-06-20")
    inside = F.col("timestamp").between(
        F.lit("2021-03-10").cast("timestamp_ntz"), F.lit("2022-06-20").cast("timestamp_ntz")
    )
    return found.filter(inside).select("capture_id", "crawl_id")


@query(
    "latest_crawl",
    with_captures(
        """SELECT capture_id, crawl_id FROM captures
           WHERE crawl_id = (SELECT id FROM crawls ORDER BY to_ts DESC, id DESC LIMIT 1)""",
        CATALOG,
    ),
)
def newest_crawl(spark, sf_dir):
    df = captures(spark, sf_dir)
    return latest_crawl(df, crawl_catalog(df)).select("capture_id", "crawl_id")


@query(
    "crawl_overlap_join",
    with_captures(
        """
SELECT u.url, c.id AS crawl_id FROM (
  SELECT url, min("timestamp") AS lo, min("timestamp") + INTERVAL 100 DAY AS hi
  FROM captures GROUP BY url) u
JOIN crawls c ON c.to_ts >= u.lo AND c.from_ts <= u.hi""",
        CATALOG,
    ),
)
def crawl_overlap_join(spark, sf_dir):
    """For every URL, the crawls that ran in the 100 days from its first capture."""
    df = captures(spark, sf_dir)
    first = df.groupBy("url").agg(F.min("timestamp").alias("lo"))
    spans = first.withColumn("hi", F.col("lo") + F.expr("INTERVAL 100 DAY"))
    return overlap_join(spans, crawl_catalog(df)).select("url", F.col("id").alias("crawl_id"))


def _bodies(spark, sf_dir):
    """Captures with the page text as body; every tenth page has none stored."""
    df = captures(spark, sf_dir)
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("body"))
    store = (
        df.filter("page_id % 10 <> 3")
        .dropDuplicates(["url", "timestamp"])
        .join(pages, "page_id")
        .select("url", "timestamp", "body")
    )
    return attach_bodies(df, store)


@query(
    "bodies_attached",
    with_captures("""
SELECT c.capture_id, CASE WHEN c.page_id % 10 <> 3 THEN octet_length(encode(p.html)) END AS size,
  CASE WHEN c.page_id % 10 <> 3 THEN md5(p.html) END AS hash,
  CASE WHEN c.page_id % 10 = 3 THEN 'No stored body' END AS error
FROM captures c JOIN pages p USING (page_id)"""),
)
def bodies_attached(spark, sf_dir):
    body = F.col("response.body")
    return _bodies(spark, sf_dir).select(
        "capture_id",
        F.octet_length(body).cast("long").alias("size"),
        F.md5(body).alias("hash"),
        "response.error",
    )


@query(
    "body_sizes",
    with_captures("""
SELECT mimetype, round(avg(octet_length(encode(p.html))), 6) AS avg_size,
  min(octet_length(encode(p.html))) AS min_size, max(octet_length(encode(p.html))) AS max_size
FROM captures c JOIN pages p USING (page_id)
WHERE c.page_id % 10 <> 3 AND statuscode = 200 GROUP BY mimetype"""),
)
def body_sizes(spark, sf_dir):
    stats = body_size_stats(_bodies(spark, sf_dir).filter("statuscode = 200"), "mimetype")
    return stats.select(
        "mimetype",
        F.round("avg_size", 6).alias("avg_size"),
        F.col("min_size").cast("long").alias("min_size"),
        F.col("max_size").cast("long").alias("max_size"),
    )


@query(
    "large_bodies",
    with_captures("""
SELECT c.url, c.capture_id FROM captures c JOIN pages p USING (page_id)
WHERE c.page_id % 10 <> 3 AND octet_length(encode(p.html)) > 3000 AND statuscode = 200"""),
)
def large_bodies(spark, sf_dir):
    found = _bodies(spark, sf_dir).filter("statuscode = 200")
    return found.filter(F.octet_length("response.body") > 3000).select("url", "capture_id")


def _targets(spark, sf_dir):
    """One request target per page, with conditions that differ from page to page."""
    condition = "struct<field:string,op:string,values:array<string>>"
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    n = F.col("page_id")
    by_kind = (
        F.when(n % 4 == 0, F.expr("array(('statuscode', 'eq', array('200')))"))
        .when(
            n % 4 == 1,
            F.expr("""array(('statuscode', 'in', array('200', '301')),
                            ('mimetype', 'ne', array('application/xhtml+xml')))"""),
        )
        .when(n % 4 == 2, F.expr("array(('url', 'not_like', array('%/en/%')))"))
        .cast(f"array<{condition}>")
    )
    start = F.when(n % 3 > 0, F.make_timestamp_ntz(
        2019 + (n % 6).cast("int"), F.lit(10), F.lit(10), F.lit(0), F.lit(0), F.lit(0)))
    return pages.select(
        "page_id",
        F.concat("url", F.when(n % 5 == 0, "%").otherwise("")).alias("url"),
        F.when(n % 5 == 0, "like").when(n % 5 == 1, "prefix").when(n % 5 == 2, "exact").alias("match"),
        start.alias("since"),
        F.when(n % 3 > 1, start + F.expr("INTERVAL 200 DAY")).alias("until"),
        by_kind.alias("filters"),
        F.when(n % 7 == 0, F.array(F.lit("digest"), F.lit("timestamp:8"))).alias("collapse"),
        (10 + n % 90).alias("max_rows"),
        (n % 2 * 50).alias("skip"),
        (n % 11 == 0).alias("newest"),
    )


# Wildcard, time bounds and conditions of the targets, per page.
_TARGETS = """
targets AS (
  SELECT page_id, CASE WHEN page_id % 5 = 0
      THEN replace(replace(replace(url, '%', '*'), '&', '%26'), '#', '%23') || '*'
      ELSE replace(replace(replace(replace(replace(
        url, '%', '%25'), '&', '%26'), '#', '%23'), '+', '%2B'), ' ', '%20')
        || CASE WHEN page_id % 5 = 1 THEN '*' ELSE '' END END AS asked,
    CASE WHEN page_id % 5 = 0 THEN replace(asked, '_', '?') ELSE asked END AS crawl_asked,
    CASE WHEN page_id % 3 > 0 THEN make_timestamp(2019 + page_id % 6, 10, 10, 0, 0, 0.0) END AS since,
    10 + page_id % 90 AS max_rows FROM pages
),
bounded AS (
  SELECT *, CASE WHEN page_id % 3 > 1 THEN since + INTERVAL 200 DAY END AS until,
    coalesce('&from=' || strftime(since, '%Y%m%d%H%M%S'), '') ||
    CASE WHEN page_id % 3 > 1
      THEN '&to=' || strftime(since + INTERVAL 200 DAY, '%Y%m%d%H%M%S') ELSE '' END AS bounds
  FROM targets
)"""


@query(
    "request_plan",
    f"""WITH {_TARGETS}
SELECT page_id, 'https://web.archive.org/cdx/search/cdx?url=' || asked ||
  '&output=csv&fl=urlkey,timestamp,original,mimetype,statuscode,digest,length' || bounds ||
  CASE WHEN page_id % 11 = 0 THEN '&fastLatest=true&limit=-' ELSE '&limit=' END || max_rows ||
  CASE WHEN page_id % 2 = 1 THEN '&offset=50' ELSE '' END ||
  CASE page_id % 4 WHEN 0 THEN '&filter=statuscode:200'
    WHEN 1 THEN '&filter=statuscode:(200|301)&filter=!mimetype:application/xhtml%5C+xml'
    WHEN 2 THEN '&filter=!original:.*/en/.*' ELSE '' END ||
  CASE WHEN page_id % 7 = 0 THEN '&collapse=digest&collapse=timestamp:8' ELSE '' END AS cdx_url
FROM bounded""",
)
def request_plan(spark, sf_dir):
    return plan_requests(_targets(spark, sf_dir)).select("page_id", "cdx_url")


@query(
    "crawl_request_plan",
    with_captures(
        """
SELECT page_id, c.id AS crawl_id, 'https://index.commoncrawl.org/' || c.id || '-index?url=' ||
  crawl_asked || '&output=json&fl=url,timestamp,mime,status,digest,filename,offset,length&limit=' ||
  max_rows || bounds ||
  CASE page_id % 4 WHEN 0 THEN '&filter==status:200'
    WHEN 1 THEN '&filter=~status:(200|301)&filter=!=mime:application/xhtml+xml'
    WHEN 2 THEN '&filter=!~url:.*/en/.*' ELSE '' END AS cdx_url
FROM bounded b JOIN crawls c
  ON (since IS NULL AND c.id = (SELECT id FROM crawls ORDER BY to_ts DESC, id DESC LIMIT 1))
  OR (since IS NOT NULL AND c.to_ts >= since AND (until IS NULL OR c.from_ts <= until))""",
        CATALOG,
        _TARGETS,
    ),
)
def crawl_request_plan(spark, sf_dir):
    catalog = crawl_catalog(captures(spark, sf_dir))
    plan = plan_crawl_requests(_targets(spark, sf_dir), catalog)
    return plan.select("page_id", "crawl_id", "cdx_url")


@query(
    "fetch_plan",
    with_captures("""
SELECT capture_id, 'https://web.archive.org/web/' || strftime("timestamp", '%Y%m%d%H%M%S') ||
  'id_/' || url AS address FROM captures"""),
)
def fetch_plan(spark, sf_dir):
    return plan_fetches(captures(spark, sf_dir)).select("capture_id", "address")


@query(
    "record_fetch_plan",
    with_captures("""
SELECT capture_id, 'https://data.commoncrawl.org/crawl/' || crawl_id || '.warc.gz' AS address,
  'bytes=' || capture_id || '-' || (capture_id + length - 1) AS byte_range FROM captures"""),
)
def record_fetch_plan(spark, sf_dir):
    df = captures(spark, sf_dir).withColumn("offset", F.col("capture_id"))
    named = F.concat(F.lit("crawl/"), F.col("crawl_id"), F.lit(".warc.gz"))
    plan = plan_fetches(df.withColumn("filename", named))
    return plan.select("capture_id", "address", "byte_range")


@query(
    "compact_times_parsed",
    with_captures("""
SELECT capture_id, CASE WHEN capture_id % 9 = 0 THEN TIMESTAMP '1970-01-01'
  ELSE "timestamp" END AS parsed FROM captures"""),
)
def compact_times_parsed(spark, sf_dir):
    """Time digits read back; every ninth is cut to 12 digits and reads as the epoch."""
    digits = compact_time(F.col("timestamp"))
    text = F.when(F.col("capture_id") % 9 == 0, F.substring(digits, 1, 12)).otherwise(digits)
    df = captures(spark, sf_dir)
    utc = records.parse_compact_time(text)
    return df.select("capture_id", _naive(utc).alias("parsed"))


def _naive(ts):
    """A UTC instant as a timestamp without zone, whatever the session zone is."""
    return F.to_utc_timestamp(ts, F.current_timezone()).cast("timestamp_ntz")


@query(
    "iso_times_parsed",
    with_captures('SELECT capture_id, "timestamp" AS parsed FROM captures'),
)
def iso_times_parsed(spark, sf_dir):
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    df = captures(spark, sf_dir)
    return df.select("capture_id", _naive(records.parse_iso_time(text)).alias("parsed"))


@query(
    "headers_parsed",
    with_captures("""
SELECT capture_id, mimetype AS content_type, concat('a=', statuscode, ', b=', length) AS cookies,
  CAST(3 AS INT) AS n_headers, '1.1' AS version, statuscode AS status FROM captures"""),
)
def headers_parsed(spark, sf_dir):
    block = F.concat(
        F.lit("HTTP/1.1 "), F.col("statuscode").cast("string"), F.lit(" Ok\r\nContent-Type: "),
        F.col("mimetype"), F.lit("\r\nSet-Cookie: a="), F.col("statuscode").cast("string"),
        F.lit("\r\nServer: x: y\r\nbroken line\r\nSet-Cookie: b="),
        F.col("length").cast("string"),
    )
    df = captures(spark, sf_dir).withColumn("block", block)
    df = df.withColumn("headers", records.header_map(F.col("block")))
    headers = F.col("headers")
    return df.select(
        "capture_id",
        F.try_element_at(headers, F.lit("Content-Type")).alias("content_type"),
        F.try_element_at(headers, F.lit("Set-Cookie")).alias("cookies"),
        F.cardinality(headers).alias("n_headers"),
        records.http_version(F.col("block")).alias("version"),
        records.http_status(F.col("block")).alias("status"),
    )


@query(
    "utf8_repaired",
    """SELECT page_id, concat(substring(url, 1, 8), '?', substring(url, 9), '?') AS text FROM pages""",
)
def utf8_repaired(spark, sf_dir):
    """Page addresses with a stray byte inside and a character cut off at the end."""
    pages = table(spark, sf_dir, "pages")
    parts = (
        F.substring("url", 1, 8).cast("binary"),
        F.unhex(F.lit("FF")),
        F.expr("CAST(substring(url, 9) AS BINARY)"),
        F.unhex(F.lit("E282")),
    )
    return pages.select("page_id", records.repair_utf8(F.concat(*parts)).alias("text"))


_MERGED = """
SELECT {key}, count(*) AS captures, CAST(sum(length) AS BIGINT) AS bytes, min("timestamp") AS first_ts, max("timestamp") AS last_ts,
  count(DISTINCT url) AS exact_urls, count(DISTINCT digest) AS exact_bodies, TRUE AS near
FROM captures GROUP BY {key}"""


def _rollup(name: str, key: str):
    @query(name, with_captures(_MERGED.format(key=key)))
    def run(spark, sf_dir):
        """Stored summaries merged by one key; their estimates are near the exact counts beside them."""
        df, folder = captures(spark, sf_dir), shared_folder(spark)
        write_rollups(roll_up(df), folder)
        merged = merge_rollups(spark.read.parquet(folder), key)
        exact = df.groupBy(F.col(key).alias("_key")).agg(
            F.count_distinct("url").alias("exact_urls"), F.count_distinct("digest").alias("exact_bodies")
        )
        near = (F.abs(F.col("n_urls") - F.col("exact_urls")) <= 0.06 * F.col("exact_urls")) & (
            F.abs(F.col("n_bodies") - F.col("exact_bodies")) <= 0.06 * F.col("exact_bodies")
        )
        return merged.join(exact, merged[key].eqNullSafe(exact["_key"])).select(
            key, "captures", "bytes", "first_ts", "last_ts", "exact_urls", "exact_bodies", near.alias("near")
        )


_rollup("rollup_by_crawl", "crawl_id")
_rollup("rollup_by_year", "year")


@query(
    "crawl_url_overlap",
    with_captures("""
SELECT a.crawl_id AS "left", b.crawl_id AS "right", a.n AS exact_left, b.n AS exact_right, coalesce(c.n, 0) AS exact_both, TRUE AS near
FROM (SELECT crawl_id, count(DISTINCT url) AS n FROM captures GROUP BY crawl_id) a
JOIN (SELECT crawl_id, count(DISTINCT url) AS n FROM captures GROUP BY crawl_id) b
  ON b.crawl_id = (SELECT max(crawl_id) FROM captures)
LEFT JOIN (
  SELECT x.crawl_id, count(*) AS n FROM (SELECT DISTINCT crawl_id, url FROM captures) x
  JOIN (SELECT DISTINCT url FROM captures WHERE crawl_id = (SELECT max(crawl_id) FROM captures)) y ON x.url = y.url
  GROUP BY x.crawl_id) c ON c.crawl_id = a.crawl_id"""),
)
def crawl_url_overlap(spark, sf_dir):
    """URLs that each crawl shares with the newest one, from summaries, near the exact ones beside them."""
    df, folder = captures(spark, sf_dir), shared_folder(spark)
    write_rollups(roll_up(df), folder)
    stored = spark.read.parquet(folder)
    newest = stored.agg(F.max("crawl_id")).scalar()
    pairs = stored.select(F.col("crawl_id").alias("left")).distinct().withColumn("right", newest)
    found = url_overlaps(stored, pairs)
    urls = df.select("crawl_id", "url").distinct()
    last = urls.filter(F.col("crawl_id") == df.agg(F.max("crawl_id")).scalar()).select("url", F.lit(1).alias("_both"))
    exact = urls.join(last, "url", "left").groupBy("crawl_id").agg(
        F.count("url").alias("exact_left"), F.count("_both").alias("exact_both")
    )
    right = exact.select(F.col("crawl_id").alias("_right"), F.col("exact_left").alias("exact_right"))
    either = F.col("exact_left") + F.col("exact_right") - F.col("exact_both")
    near = [F.abs(F.col(f"n_{x}") - F.col(f"exact_{x}")) <= 0.06 * either for x in ("left", "right", "both")]
    near.append(F.abs(F.col("n_either") - either) <= 0.06 * either)
    both = found.join(exact, F.col("left") == F.col("crawl_id")).join(right, F.col("right") == F.col("_right"))
    return both.select("left", "right", "exact_left", "exact_right", "exact_both", (near[0] & near[1] & near[2] & near[3]).alias("near"))


#: Rules under which hosts of the tables have suffixes of one to three labels.
SUFFIXES = ("com", "net", "org", "example.org", "*.example.net", "!tionsh.example.net")


@query(
    "registrable_domains",
    with_captures(r"""
SELECT domain AS registrable_domain, CAST(count(*) AS BIGINT) AS captures, count(DISTINCT host) AS hosts
FROM (
  SELECT host, CASE
    WHEN regexp_matches(host, '(^|\.)tionsh\.example\.net$') THEN 'tionsh.example.net'
    WHEN host LIKE '%.example.net' THEN nullif(regexp_extract(host, '([^.]+\.[^.]+\.example\.net)$', 1), '')
    WHEN host LIKE '%.example.org' THEN regexp_extract(host, '([^.]+\.example\.org)$', 1)
    ELSE regexp_extract(host, '([^.]+\.[^.]+)$', 1) END AS domain
  FROM (SELECT regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host FROM captures))
WHERE domain IS NOT NULL GROUP BY domain"""),
)
def registrable_domain_counts(spark, sf_dir):
    rules = spark.createDataFrame([(s,) for s in SUFFIXES], "rule string")
    return registrable_domains(captures(spark, sf_dir), rules)


#: Captures of a host that are fetched in one turn.
PER_SLOT = 3


@query(
    "fetch_slots",
    with_captures(f"""
SELECT capture_id, CAST((row_number() OVER (PARTITION BY host ORDER BY url, capture_id) - 1) // {PER_SLOT} AS BIGINT) AS turn,
  (SELECT CAST(max((n + {PER_SLOT - 1}) // {PER_SLOT}) AS BIGINT) FROM (
    SELECT count(*) AS n FROM captures GROUP BY regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1))) AS slots
FROM (SELECT *, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host FROM captures)"""),
)
def fetch_slots(spark, sf_dir):
    """The turn of each capture among its host's, and how many slots all take."""
    found = written(polite_slots(captures(spark, sf_dir), PER_SLOT, order=["url", "capture_id"]))
    hosts = found.groupBy(host_of(F.col("url")).alias("_host")).agg(F.min("slot").alias("_first"))
    slots = found.agg((F.max("slot") + 1)).scalar()
    placed = found.withColumn("_of", host_of(F.col("url"))).join(hosts, F.col("_of") == F.col("_host"))
    return placed.select("capture_id", (F.col("slot") - F.col("_first")).alias("turn"), slots.alias("slots"))
