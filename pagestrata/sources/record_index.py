"""A capture index made from the record files themselves."""

from __future__ import annotations

import base64
import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata.functions.records import http_status, number_or_zero, parse_iso_time, repair_utf8
from pagestrata.functions.urls import surt
from pagestrata.sources.members import SPLIT_BYTES, gzip_members

#: Bytes within which a head has to end.
MOST_HEAD = 4 << 20

_HEAD_END = re.compile(rb"\r\n\r\n|\n\n")
_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*([0-9]+)")
_DESCRIBED = (
    "record_head binary, http_head binary, n_bytes long, payload_sha1 string, record_error string"
)


class RecordHeads:
    """Both heads of a record, and the size and SHA-1 of its payload, which is not held."""

    def __init__(self):
        self.held = b""
        self.record = self.http = self.error = None
        self.left: int | None = None
        self.plain = False
        self.size, self.sha = 0, hashlib.sha1()

    def take(self, data: bytes) -> None:
        if self.error or not data:
            return
        if self.record is None:
            data = self.head(data)
            if data is None:
                return
            self.record = data[: self.end.start()]
            length = _LENGTH.search(self.record)
            self.left = int(length.group(1)) if length else None
            data = data[self.end.end() :]
        if self.left is not None:
            # Blank lines follow what the record's own length ends.
            data = data[: self.left]
            self.left -= len(data)
        if self.http is None and not self.plain:
            start = self.held + data
            if len(start) < 5 and b"HTTP/".startswith(start) and self.left != 0:
                self.held = start
                return
            if not start.startswith(b"HTTP/"):
                self.plain, self.held, data = True, b"", start
            else:
                data = self.head(data)
                if data is None:
                    return
                self.http, data = data[: self.end.start()], data[self.end.end() :]
        self.size += len(data)
        self.sha.update(data)

    def head(self, data: bytes) -> bytes | None:
        """What is held and ``data``, if a head ends in it."""
        before = max(0, len(self.held) - 3)
        self.held += data
        self.end = _HEAD_END.search(self.held, before)
        if self.end is None:
            if len(self.held) > MOST_HEAD:
                self.error = "No end of a header"
            return None
        data, self.held = self.held, b""
        return data

    def row(self) -> tuple:
        error = self.error
        if self.record is None:
            error = error or "No record header"
        elif self.left:
            error = error or "Record shorter than its Content-Length"
        elif self.held:
            error = error or "No HTTP header"
        digest = "sha1:" + base64.b32encode(self.sha.digest()).decode()
        return self.record, self.http, self.size, digest, error


def index_records(spark: SparkSession, root: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the gzip-member record files under ``root``, each file read by many tasks.

    Returns a row per record: ``filename``, ``offset``, ``length`` (what ``fetch_records`` takes), ``kind``,
    ``url``, ``urlkey``, ``timestamp``, ``year``, ``month``, ``statuscode`` and ``mimetype`` (of the HTTP
    response; 0 and NULL for other records), ``digest`` (the record's own, else SHA-1 of the payload),
    ``payload_bytes`` and ``error``. Whatever is no record, or is cut short, is a row with an error.
    Bodies are hashed as they are inflated and not held.
    """
    found = gzip_members(spark, root, RecordHeads, _DESCRIBED, split_bytes=split_bytes)
    found = found.withColumns({c: repair_utf8(F.col(c)) for c in ("record_head", "http_head")})
    url, time = header(F.col("record_head"), "WARC-Target-URI"), header(F.col("record_head"), "WARC-Date")
    # Some writers put the address in angle brackets.
    url = F.regexp_replace(url, "^<|>$", "")
    taken = F.when(time.isNotNull(), parse_iso_time(time))
    own = header(F.col("record_head"), "WARC-Payload-Digest")
    media = F.lower(F.trim(F.split_part(header(F.col("http_head"), "Content-Type"), F.lit(";"), F.lit(1))))
    rows = found.select(
        "filename", "offset", "length",
        header(F.col("record_head"), "WARC-Type").alias("kind"),
        url.alias("url"), surt(url).alias("urlkey"), taken.alias("timestamp"),
        F.when(F.col("http_head").isNotNull(), http_status(F.col("http_head"))).otherwise(F.lit(0)).alias("statuscode"),
        media.alias("mimetype"), F.coalesce(own, "payload_sha1").alias("digest"),
        F.col("n_bytes").alias("payload_bytes"), F.coalesce("error", "record_error").alias("error"),
    )
    return rows.withColumns({"year": F.year("timestamp"), "month": F.month("timestamp")})


def header(head: Column, name: str) -> Column:
    """The first value of a header, whatever the case of its name; NULL if it is not there."""
    line = rf"(?im)^{re.escape(name)}:[ \t]*([^\r\n]*)"
    return F.when(head.rlike(line), F.rtrim(F.regexp_extract(head, line, 1)))


def captures_of(records: DataFrame) -> DataFrame:
    """The rows of ``index_records`` that a capture index holds: responses without an error."""
    return records.filter((F.col("kind") == "response") & F.col("error").isNull()).select(
        "url", "urlkey", "timestamp", "year", "month", "mimetype", number_or_zero(F.col("statuscode").cast("string"), "int").alias("statuscode"),
        "digest", "filename", "offset", "length",
    )
