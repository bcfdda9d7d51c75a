"""Column names, types and the index order shared by every operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RESPONSE = T.StructType(
    [T.StructField("body", T.BinaryType()), T.StructField("error", T.StringType())]
)

SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("urlkey", T.StringType()),
        T.StructField("mimetype", T.StringType()),
        T.StructField("statuscode", T.IntegerType()),
        T.StructField("digest", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

CRAWL_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("mimetype", T.StringType()),
        T.StructField("statuscode", T.IntegerType()),
        T.StructField("digest", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("crawl_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

# A capture index is sorted by SURT key, then time. The remaining names only
# break ties, so that "first" and "previous" mean one row.
INDEX_ORDER = ("urlkey", "timestamp")
TIE_BREAKERS = ("capture_id", "crawl_id", "filename", "offset", "url", "digest")


def tie_breakers(df: DataFrame) -> list[str]:
    """The columns of ``df`` that separate captures made in the same second."""
    if "capture_id" in df.columns:
        return ["capture_id"]
    return [c for c in TIE_BREAKERS if c in df.columns]


def index_order(df: DataFrame) -> list[str]:
    """Index order of ``df``: urlkey (url where there is none), timestamp, ties."""
    lead = [c for c in INDEX_ORDER if c in df.columns]
    if "urlkey" not in df.columns:
        lead = ["url", *lead]
    return lead + [c for c in tie_breakers(df) if c not in lead]
