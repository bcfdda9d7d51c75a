"""A capture index derived from the given ``events`` and ``pages`` tables.

Every event is one capture of one page. ``CAPTURES`` is the same view in SQL, for
the check queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata.functions.urls import surt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Keys are made once per page, not once per capture.
    pages = table(spark, sf_dir, "pages").select("page_id", "url", surt(F.col("url")).alias("urlkey"))
    events = table(spark, sf_dir, "events")
    n_pages = pages.agg(F.count("*")).scalar()
    event = F.col("event_id")
    month = 1 + event % 11
    year = 2019 + event % 6
    taken = F.make_timestamp_ntz(
        year.cast("int"),
        month.cast("int"),
        F.least(F.day("ts"), F.lit(28)),
        F.hour("ts"),
        F.minute("ts"),
        F.second("ts"),
    )
    third = F.when(month <= 4, "-18").when(month <= 8, "-34").otherwise("-50")
    status = (
        F.when((F.col("event_type") == "error") & (event % 2 == 0), 404)
        .when(F.col("event_type") == "error", 500)
        .when(F.col("event_type") == "signup", 301)
        .otherwise(200)
    )
    mime = (
        F.when(event % 5 == 0, "application/pdf")
        .when(event % 7 == 0, "application/xhtml+xml")
        .otherwise("text/html")
    )
    who = (F.col("user_id") % 3).cast("string")
    return (
        events.withColumn("page_id", event % n_pages)
        .join(pages, "page_id")
        .select(
            event.alias("capture_id"),
            "page_id",
            "url",
            "urlkey",
            taken.alias("timestamp"),
            year.cast("int").alias("year"),
            month.cast("int").alias("month"),
            F.concat(F.lit("CC-MAIN-"), year.cast("string"), third).alias("crawl_id"),
            status.alias("statuscode"),
            mime.alias("mimetype"),
            F.upper(F.md5(F.concat_ws("|", "url", who))).alias("digest"),
            (event % 4000 + 100).alias("length"),
        )
    )


def crawl_catalog(df: DataFrame) -> DataFrame:
    """One row per crawl with the span of its captures."""
    return df.groupBy(F.col("crawl_id").alias("id")).agg(
        F.min("timestamp").alias("from_ts"), F.max("timestamp").alias("to_ts")
    )


CAPTURES = r"""
np AS (SELECT count(*) AS n FROM pages),
raw_captures AS (
  SELECT e.event_id AS capture_id, p.page_id, p.url, e.event_type, e.user_id,
    make_timestamp(2019 + e.event_id % 6, 1 + e.event_id % 11, least(day(e.ts), 28),
                   hour(e.ts), minute(e.ts), CAST(second(e.ts) AS DOUBLE)) AS ts,
    regexp_extract(p.url, '^[a-z]+://([^/?#:]+)', 1) AS host,
    regexp_extract(p.url, '^[a-z]+://[^/?#]+([^#]*)', 1) AS path_q
  FROM events e CROSS JOIN np JOIN pages p ON p.page_id = e.event_id % np.n
),
captures AS (
  SELECT capture_id, page_id, url,
    concat(array_to_string(list_reverse(string_split(host, '.')), ','), ')', lower(path_q)) AS urlkey,
    CAST(ts AS TIMESTAMP) AS "timestamp",
    CAST(year(ts) AS INT) AS "year", CAST(month(ts) AS INT) AS "month",
    concat('CC-MAIN-', CAST(year(ts) AS VARCHAR),
           CASE WHEN month(ts) <= 4 THEN '-18' WHEN month(ts) <= 8 THEN '-34' ELSE '-50' END) AS crawl_id,
    CASE WHEN event_type = 'error' AND capture_id % 2 = 0 THEN 404
         WHEN event_type = 'error' THEN 500
         WHEN event_type = 'signup' THEN 301 ELSE 200 END AS statuscode,
    CASE WHEN capture_id % 5 = 0 THEN 'application/pdf'
         WHEN capture_id % 7 = 0 THEN 'application/xhtml+xml' ELSE 'text/html' END AS mimetype,
    upper(md5(concat(url, '|', CAST(user_id % 3 AS VARCHAR)))) AS digest,
    CAST(capture_id % 4000 + 100 AS BIGINT) AS length
  FROM raw_captures
)"""

CATALOG = """
crawls AS (
  SELECT crawl_id AS id, min("timestamp") AS from_ts, max("timestamp") AS to_ts
  FROM captures GROUP BY crawl_id
)"""


def with_captures(select: str, *ctes: str) -> str:
    """``select`` over the captures view and further common table expressions."""
    return "WITH " + ",".join([CAPTURES, *ctes]) + "\n" + select.strip()
