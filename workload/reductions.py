"""Deduplication, limits, pages and as-of lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagestrata import (
    as_of,
    balanced_sample,
    cap_per_crawl,
    collapse_adjacent,
    distinct_on,
    find_captures,
    first_captures,
    latest,
    latest_per_url,
    page,
    take_ordered,
    top_k,
)
from pagestrata.operators.topk import rank_at_most
from pagestrata.plans.ranges import ROWS_PER_RANGE
from pagestrata.schema import index_order
from workload.derived import captures, table, with_captures
from workload.registry import query

_ORDER = 'urlkey, "timestamp", capture_id'


def _first_per(keys: str, where: str = "TRUE") -> str:
    return f"""
SELECT capture_id, url, "timestamp", digest FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {_ORDER}) AS rn
  FROM captures WHERE {where}) WHERE rn = 1"""


def _collapsed(value: str, source: str = "captures") -> str:
    return f"""
SELECT * FROM (
  SELECT *, lag({value}) OVER (ORDER BY {_ORDER}) AS before_v,
         row_number() OVER (ORDER BY {_ORDER}) AS before_n FROM {source})
WHERE before_n = 1 OR before_v IS DISTINCT FROM {value}"""


SHOWN = ("capture_id", "url", "timestamp", "digest")
_COLUMNS = 'capture_id, url, "timestamp", digest'


def _distinct(name: str, keys: list[str], sql_keys: str):
    @query(name, with_captures(_first_per(sql_keys)))
    def run(spark, sf_dir):
        return distinct_on(captures(spark, sf_dir), keys).select(*SHOWN)


_distinct("distinct_on_digest", ["digest"], "digest")
_distinct("distinct_on_url", ["url"], "url")
_distinct("distinct_on_url_year_month", ["url", "year", "month"], 'url, "year", "month"')
_distinct("distinct_on_digest_status", ["digest", "statuscode"], "digest, statuscode")
_distinct("distinct_on_length", ["length"], "length")
_distinct("distinct_on_timestamp", ["timestamp:12"], "strftime(\"timestamp\", '%Y%m%d%H%M')")
_distinct("distinct_on_mimetype", ["mimetype"], "mimetype")
_distinct("distinct_on_urlkey_prefix", ["urlkey:18"], "substring(urlkey, 1, 18)")
_distinct("distinct_on_day", ["timestamp:8"], "strftime(\"timestamp\", '%Y%m%d')")


@query(
    "yearly_pages",
    with_captures(f"""
SELECT url, "timestamp", statuscode, digest FROM ({_first_per(
    'url, "year"', "url LIKE 'https://%' AND statuscode = 200 AND mimetype = 'text/html'"
).replace("SELECT capture_id, url,", "SELECT statuscode, capture_id, url,")})"""),
)
def yearly_pages(spark, sf_dir):
    """One good HTML snapshot per page and year."""
    found = find_captures(
        captures(spark, sf_dir),
        "https://*",
        statuscode=200,
        mimetype="text/html",
        distinct_on=["url", "year"],
    )
    return found.select("url", "timestamp", "statuscode", "digest").orderBy("url", "timestamp")


# A range size far below the default, to see range borders in small tables too.
SMALL_RANGE = 3000


def _collapse(name: str, fields: list[str], *values: str, rows_per_range: int = ROWS_PER_RANGE):
    ctes, source = [], "captures"
    for i, value in enumerate(values[:-1]):
        # The helper columns of one pass are not wanted in the next.
        inner = _collapsed(value, source).replace(
            "SELECT * FROM (", "SELECT * EXCLUDE (before_v, before_n) FROM (", 1
        )
        ctes.append(f"\npass{i} AS ({inner})")
        source = f"pass{i}"
    body = _collapsed(values[-1], source)

    @query(name, with_captures(f"SELECT {_COLUMNS} FROM ({body})", *ctes))
    def run(spark, sf_dir):
        df = captures(spark, sf_dir)
        return collapse_adjacent(df, fields, rows_per_range=rows_per_range).select(*SHOWN)


_collapse("collapse_digest", ["digest"], "digest")
_collapse("collapse_status", ["statuscode"], "statuscode")
_collapse("collapse_urlkey", ["urlkey"], "urlkey")
_collapse("collapse_urlkey_prefix", ["urlkey:18"], "substring(urlkey, 1, 18)")
_collapse("collapse_year", ["timestamp:4"], "strftime(\"timestamp\", '%Y')")
_collapse("collapse_status_then_digest", ["statuscode", "digest"], "statuscode", "digest")
_collapse("collapse_digest_in_ranges", ["digest"], "digest", rows_per_range=SMALL_RANGE)
_collapse("collapse_status_then_digest_in_ranges", ["statuscode", "digest"], "statuscode", "digest",
          rows_per_range=SMALL_RANGE)


def _top(name: str, build, sql: str, shown=SHOWN):
    columns = ", ".join(f'"{c}"' for c in shown)

    @query(name, with_captures(f"SELECT {columns} FROM ({sql})"))
    def run(spark, sf_dir):
        return build(captures(spark, sf_dir)).select(*shown)


_top("first_captures", lambda d: first_captures(d, 50),
     f"SELECT * FROM captures ORDER BY {_ORDER} LIMIT 50")
_top("page_far_in", lambda d: page(d, 700, 300),
     f"SELECT * FROM captures ORDER BY {_ORDER} LIMIT 700 OFFSET 300")
_top("page_far_in_by_ranges",
     lambda d: take_ordered(d, index_order(d), 3000, 5000, rows_per_range=SMALL_RANGE),
     f"SELECT * FROM captures ORDER BY {_ORDER} LIMIT 3000 OFFSET 5000")
_top("page_of_captures", lambda d: page(d, 40, 120),
     f"SELECT * FROM captures ORDER BY {_ORDER} LIMIT 40 OFFSET 120")
_top("latest_captures", lambda d: latest(d, 25),
     'SELECT * FROM captures ORDER BY "timestamp" DESC, capture_id DESC LIMIT 25')
_top("latest_of_pattern", lambda d: find_captures(d, "*.example.org", statuscode=200, newest=10),
     r"""SELECT * FROM captures WHERE statuscode = 200
         AND regexp_matches(url, '^[a-z]+://([^/?#:]+\.)?example\.org([/?#:]|$)')
         ORDER BY "timestamp" DESC, capture_id DESC LIMIT 10""")
_top("latest_per_url", lambda d: latest_per_url(d),
     """SELECT *, row_number() OVER (PARTITION BY url ORDER BY "timestamp" DESC, capture_id DESC)
        AS rn FROM captures QUALIFY rn = 1""")
_top("latest_three_per_url", lambda d: latest_per_url(d, 3),
     """SELECT *, row_number() OVER (PARTITION BY url ORDER BY "timestamp" DESC, capture_id DESC)
        AS rn FROM captures QUALIFY rn <= 3""")
_top("longest_captures", lambda d: top_k(d, ["length"], 30, descending=True),
     """SELECT * FROM captures
        ORDER BY length DESC, urlkey DESC, "timestamp" DESC, capture_id DESC LIMIT 30""",
     ("capture_id", "url", "length"))
_top("capped_query",
     lambda d: find_captures(d, "*.example.com", statuscode=[200, 301], years=(2020, 2023),
                             distinct_on=["urlkey", "year"], max_results=15),
     f"""SELECT *, row_number() OVER (PARTITION BY crawl_id ORDER BY {_ORDER}) AS cap FROM (
           SELECT *, row_number() OVER (PARTITION BY urlkey, "year" ORDER BY {_ORDER}) AS rn
           FROM captures
           WHERE urlkey LIKE 'com,example,%' AND statuscode IN (200, 301)
             AND "year" BETWEEN 2020 AND 2023 QUALIFY rn = 1)
         QUALIFY cap <= 15""", ("capture_id", "url", "crawl_id"))
_top("collapsed_page",
     lambda d: find_captures(d, "https://*", statuscode=200, collapse="timestamp:8", limit=40,
                             offset=20),
     f"""SELECT * FROM (
           SELECT *, strftime("timestamp", '%Y%m%d') AS day,
             lag(strftime("timestamp", '%Y%m%d')) OVER (ORDER BY {_ORDER}) AS before_day
           FROM captures WHERE statuscode = 200 AND url LIKE 'https://%')
         WHERE before_day IS DISTINCT FROM day ORDER BY {_ORDER} LIMIT 40 OFFSET 20""")
_top("cap_per_crawl", lambda d: cap_per_crawl(d, 20),
     f"""SELECT *, row_number() OVER (PARTITION BY crawl_id ORDER BY {_ORDER}) AS rn
         FROM captures QUALIFY rn <= 20""", ("capture_id", "url", "crawl_id"))
_top("cap_per_crawl_large", lambda d: cap_per_crawl(d, 300),
     f"""SELECT *, row_number() OVER (PARTITION BY crawl_id ORDER BY {_ORDER}) AS rn
         FROM captures QUALIFY rn <= 300""", ("capture_id", "url", "crawl_id"))
_top("cap_per_crawl_by_ranges",
     lambda d: rank_at_most(d, ["crawl_id"], index_order(d), 250, rows_per_range=SMALL_RANGE),
     f"""SELECT *, row_number() OVER (PARTITION BY crawl_id ORDER BY {_ORDER}) AS rn
         FROM captures QUALIFY rn <= 250""", ("capture_id", "url", "crawl_id"))
_top("balanced_sample", lambda d: balanced_sample(d, 100),
     f"""SELECT * EXCLUDE (rn) FROM (
           SELECT *, row_number() OVER (PARTITION BY crawl_id ORDER BY {_ORDER}) AS rn
           FROM captures)
         WHERE rn <= ceil(100.0 / (SELECT count(DISTINCT crawl_id) FROM captures))
         ORDER BY {_ORDER} LIMIT 100""", ("capture_id", "url", "crawl_id"))


@query(
    "limit_after_distinct",
    with_captures(f"SELECT {_COLUMNS} FROM ({_first_per('digest')}) ORDER BY capture_id LIMIT 15"),
)
def limit_after_distinct(spark, sf_dir):
    kept = distinct_on(captures(spark, sf_dir), ["digest"])
    return take_ordered(kept, ["capture_id"], 15).select(*SHOWN)


@query("distinct_mimetypes", with_captures("SELECT DISTINCT mimetype FROM captures"))
def distinct_mimetypes(spark, sf_dir):
    return captures(spark, sf_dir).select("mimetype").distinct()


@query("distinct_urls", with_captures("SELECT DISTINCT url FROM captures WHERE statuscode = 200"))
def distinct_urls(spark, sf_dir):
    return captures(spark, sf_dir).filter("statuscode = 200").select("url").distinct()


_AS_OF = with_captures("""
SELECT r.event_id, r.url, r.at, c.capture_id AS found_id, c."timestamp" AS found_at
FROM (SELECT e.event_id, p.url, e.ts - INTERVAL 900 DAY AS at FROM events e, np
      JOIN pages p ON p.page_id = (e.event_id * 7) % np.n) r
ASOF LEFT JOIN (
  SELECT url, "timestamp", max(capture_id) AS capture_id FROM captures GROUP BY ALL
) c ON r.url = c.url AND r.at >= c."timestamp" """)


@query("page_as_of", _AS_OF)
def page_as_of(spark, sf_dir, rows_per_range=ROWS_PER_RANGE):
    """For every event, the page as archived some years earlier."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    n_pages = pages.agg(F.count("*")).scalar()
    requests = (
        table(spark, sf_dir, "events")
        .select(
            "event_id",
            ((F.col("event_id") * 7) % n_pages).alias("page_id"),
            (F.col("ts") - F.expr("INTERVAL 900 DAY")).alias("at"),
        )
        .join(pages, "page_id")
        .select("event_id", "url", "at")
    )
    df = captures(spark, sf_dir)
    found = as_of(df, requests, ["capture_id", "timestamp"], rows_per_range)
    return found.select(
        "event_id",
        "url",
        "at",
        F.col("capture.capture_id").alias("found_id"),
        F.col("capture.timestamp").alias("found_at"),
    )


@query("page_as_of_in_ranges", _AS_OF)
def page_as_of_in_ranges(spark, sf_dir):
    return page_as_of(spark, sf_dir, SMALL_RANGE)
