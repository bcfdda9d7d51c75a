"""Crawl index files of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagestrata.functions.records import is_bad_number, number_or_zero, parse_compact_time

# The members of an index line that are read.
JSON_FIELDS = (
    "url", "timestamp", "mime", "status", "digest", "filename", "offset", "length", "urlkey",
)
_LINE = T.StructType([T.StructField(name, T.StringType()) for name in JSON_FIELDS])


def read_cdxj(
    spark: SparkSession, path: str, crawl_id: str | None = None, keyed: bool = False,
    count_bad_fields: bool = False,
) -> DataFrame:
    """Captures in the JSON-line index files under ``path``.

    ``crawl_id`` is taken from ``crawl_id=...`` directories unless given. ``keyed``
    files have the SURT key and the time in front of the JSON object.
    """
    return parse_cdxj(spark.read.text(path), crawl_id, keyed, count_bad_fields)


def parse_cdxj(
    lines: DataFrame, crawl_id: str | None = None, keyed: bool = False,
    count_bad_fields: bool = False,
) -> DataFrame:
    """Captures in a ``value`` column of lines, batch or streaming. Lines that are not
    JSON objects and objects without a url are dropped."""
    if keyed:
        head = F.regexp_extract("value", r"^(\S+) (\d{14}) \{", 1)
        time = F.regexp_extract("value", r"^(\S+) (\d{14}) \{", 2)
        lines = lines.select(
            F.regexp_replace("value", r"^\S+ \d{14} (?=\{)", "").alias("value"),
            head.alias("_key"),
            time.alias("_time"),
            *[c for c in lines.columns if c != "value"],
        )
    rows = (
        lines.filter(F.col("value").startswith("{"))
        .withColumn("_j", F.from_json("value", _LINE))
        .filter(F.length("_j.url") > 0)
    )
    time, key = F.col("_j.timestamp"), F.col("_j.urlkey")
    if keyed:
        time = F.coalesce(time, F.nullif("_time", F.lit("")))
        key = F.coalesce(key, F.nullif("_key", F.lit("")))
    if crawl_id is not None:
        crawl = F.lit(crawl_id)
    elif "crawl_id" in lines.columns:
        crawl = F.col("crawl_id")
    else:
        crawl = F.lit(None).cast("string")
    out = rows.select(
        F.col("_j.url").alias("url"),
        parse_compact_time(time).alias("timestamp"),
        F.col("_j.mime").alias("mimetype"),
        number_or_zero(F.col("_j.status"), "int").alias("statuscode"),
        F.col("_j.digest").alias("digest"),
        F.col("_j.filename").alias("filename"),
        number_or_zero(F.col("_j.offset"), "bigint").alias("offset"),
        number_or_zero(F.col("_j.length"), "bigint").alias("length"),
        crawl.cast("string").alias("crawl_id"),
        key.alias("urlkey"),
        F.year(parse_compact_time(time)).alias("year"),
        F.month(parse_compact_time(time)).alias("month"),
        (
            is_bad_number(F.col("_j.status"), "int").cast("int")
            + is_bad_number(F.col("_j.offset"), "bigint").cast("int")
            + is_bad_number(F.col("_j.length"), "bigint").cast("int")
        ).alias("bad_fields"),
    )
    return out if count_bad_fields else out.drop("bad_fields")
