"""Hosts, SURT keys and the addresses archived content is fetched from."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The public endpoints requests are addressed to.
SNAPSHOT_INDEX = "https://web.archive.org/cdx/search/cdx"
SNAPSHOT_BODY = "https://web.archive.org/web/"
CRAWL_INDEX = "https://index.commoncrawl.org/"
CRAWL_BODY = "https://data.commoncrawl.org/"

_START = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://)?(?:[^/?#@]*@)?"
_HOST = _START + r"(\[[^\]]*\]|[^/?#:]+)"
_PORT = _HOST + r":([0-9]+)"
_PATH = _START + r"[^/?#]+([^#]*)"


def host_of(url: Column) -> Column:
    """Host of a URL, lower case, without user and port; an IPv6 address in its brackets."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def port_of(url: Column) -> Column:
    """Port of a URL as text, empty if it names none."""
    return F.regexp_extract(url, _PORT, 2)


def surt(url: Column) -> Column:
    """SURT key: host labels reversed, then ``)`` and the lower-case path and query."""
    labels = F.reverse(F.split(host_of(url), r"\."))
    return F.concat(F.array_join(labels, ","), F.lit(")"), F.lower(F.regexp_extract(url, _PATH, 1)))


def surt_host(urlkey: Column) -> Column:
    """The reversed host of a SURT key."""
    return F.split_part(urlkey, F.lit(")"), F.lit(1))


def surt_of_host(host: str) -> str:
    """Reversed form of a host given as a plain string."""
    return ",".join(reversed(host.lower().split(".")))


def surt_hosts(host: str) -> list[str]:
    """The reversed forms a key may have for ``host``: as it is, and without ``www``, which
    indexes with canonical keys leave out."""
    bare = re.sub(r"^www\d*\.", "", host.lower())
    return list(dict.fromkeys(surt_of_host(h) for h in (host, bare)))


def compact_time(ts: Column) -> Column:
    """14-digit form of a timestamp, as index files and requests write it."""
    return F.date_format(ts, "yyyyMMddHHmmss")


def snapshot_address(ts: Column, url: Column) -> Column:
    """Where the unaltered body of one snapshot is served; NULL if a part is missing."""
    known = (F.length(url) > 0) & ts.isNotNull()
    address = F.concat(F.lit(SNAPSHOT_BODY), compact_time(ts), F.lit("id_/"), url)
    return F.when(known, address)


def record_address(filename: Column) -> Column:
    return F.concat(F.lit(CRAWL_BODY), filename)


def byte_range(offset: Column, length: Column) -> Column:
    """Inclusive byte range of one record, in the form of a Range header value."""
    last = (offset + length - 1).cast("string")
    return F.concat(F.lit("bytes="), offset.cast("string"), F.lit("-"), last)
