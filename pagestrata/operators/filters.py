"""Predicates over a capture index, as plain column expressions.

Each one is what Spark can push to the scan where a pushed form exists; negations
are written with ``~``. Conjunctions are ``&``.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagestrata.functions.urls import host_of, port_of, surt_hosts


class UrlFilterRequired(ValueError):
    """A whole index was about to be read without naming a URL pattern."""


def like(column: str, pattern: str) -> Column:
    """SQL LIKE on any index column; numbers are compared by their digits."""
    return F.col(column).cast("string").like(pattern)


def matches(column: str, pattern: str) -> Column:
    """Regular expression found anywhere in the value."""
    return F.col(column).cast("string").rlike(pattern)


def matches_whole(column: str, pattern: str) -> Column:
    """Regular expression over the whole value (SQL SIMILAR TO)."""
    return F.col(column).cast("string").rlike(rf"\A(?:{pattern})\z")


def on_host(host: str, keyed: bool = False) -> Column:
    """Captures of exactly this host, without its subdomains."""
    return _bounded(host_of(F.col("url")) == host.lower(), host, keyed)


def in_domain(host: str) -> Column:
    """Captures of this host and its subdomains, by SURT key, whatever their port.

    The prefixes reach the scan, so an index sorted by urlkey skips row groups.
    """
    return _starts(*[f"{key}{end}" for key in surt_hosts(host) for end in ",):"])


def url_pattern(pattern: str, keyed: bool = False) -> Column:
    """The forms a URL filter takes. ``%`` and ``_`` are ordinary characters here.

    * ``*.example.com`` is a host with its subdomains, ``*.example.com/a*`` their paths.
    * With a scheme, it is the URL itself, or its beginning if it ends in ``*``.
    * Without a scheme, ``example.com/a`` and ``example.com/a*`` are looked up in the
      SURT key, which knows no scheme. A port is compared if the pattern names one.

    ``keyed`` says that there is a SURT key: a URL with a scheme is then bounded by it too.
    """
    start = pattern.removesuffix("*")
    if pattern.startswith("*."):
        host, slash, path = pattern[2:].partition("/")
        if path in ("", "*"):
            return in_domain(host)
        return in_domain(host) & _path_of_key(f"{slash}{path}")
    if "*" in start:
        raise ValueError(f"* may only start or end a URL pattern: {pattern!r}; use LIKE or a regex")
    if "://" in pattern:
        url = F.col("url")
        found = url.startswith(start) if pattern.endswith("*") else url == start
        rest = start.partition("://")[2]
        host = re.match(r"(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", rest)
        # A beginning that ends within the host says nothing about the whole host.
        whole = not pattern.endswith("*") or host.end() < len(rest)
        return _bounded(found, host[1], keyed and whole)
    host, slash, path = start.partition("/")
    host, _, port = host.partition(":")
    path = f"{slash}{path.lower()}"
    keys = [f"{key}){path}" for key in surt_hosts(host)]
    ports = [f"{key}:{port or '%'}){path}" for key in surt_hosts(host)]
    key = F.col("urlkey")
    if pattern.endswith("*"):
        plain = _any([F.left(key, F.lit(len(k))) == k for k in keys])
        named = _any([key.like(_as_like(p) + "%") for p in ports])
    else:
        ends = [""] if path else ["", "/"]
        plain = key.isin([k + e for k in keys for e in ends])
        named = _any([key.like(_as_like(p + e)) for p in ports for e in ends])
    if port:
        plain = plain & (port_of(F.col("url")) == port)
    # LIKE with a wildcard inside is not pushed to the scan, the beginnings of keys are. The plain test
    # is written in another way, else the optimizer would draw both together again.
    bounds = _starts(*keys, *[f"{k}:" for k in surt_hosts(host)])
    return bounds & (plain | named)


def url_like(pattern: str, keyed: bool = False) -> Column:
    """SQL LIKE on the URL. A pattern that begins with a host, as ``example.com/news%``, is
    compared without the scheme."""
    url = F.col("url")
    if "://" in pattern or pattern.startswith("%"):
        return url.like(pattern)
    found = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "").like(pattern)
    host, slash, _ = pattern.partition("/")
    return _bounded(found, host, keyed and bool(slash) and not re.search(r"[%_:@\\]", host))


def _bounded(found: Column, host: str, keyed: bool) -> Column:
    """``found``, with the prefixes that the key of a URL on ``host`` has."""
    if not keyed:
        return found
    return found & _starts(*[f"{key}{end}" for key in surt_hosts(host) for end in "):"])


def _starts(*prefixes: str) -> Column:
    return _any([F.col("urlkey").startswith(p) for p in prefixes])


def _any(tests: list[Column]) -> Column:
    return reduce(Column.__or__, tests)


def _as_like(text: str) -> str:
    """``text`` for LIKE, where only a ``%`` for any port stays a wildcard."""
    before, wildcard, after = text.partition(":%)")
    literal = [re.sub(r"([%_\\])", r"\\\1", t) for t in (before, after)]
    return wildcard.join(literal) if wildcard else literal[0]


def _path_of_key(path: str) -> Column:
    """Whether the path in the SURT key is ``path``, or begins with it if it ends in ``*``."""
    own = F.substring(F.col("urlkey"), F.instr("urlkey", ")") + 1, F.length("urlkey"))
    start = path.removesuffix("*").lower()
    return own.startswith(start) if path.endswith("*") else own == start


def instant(df: DataFrame, value: str | dt.date | dt.datetime, column: str = "timestamp") -> Column:
    """``value`` as a literal of the column's own type, so the comparison is pushed.

    Strings are ISO-8601; what names no zone is UTC.
    """
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    target = df.schema[column].dataType
    zone = "+00:00" if isinstance(target, T.TimestampType) else ""
    return F.lit(f"{value}{zone}").cast(target)


def time_range(
    df: DataFrame, since=None, until=None, *, after=None, before=None, column: str = "timestamp"
) -> Column:
    """Inclusive (``since``, ``until``) and strict (``after``, ``before``) bounds, ANDed."""
    c = F.col(column)
    tests = []
    if since is not None:
        tests.append(c >= instant(df, since, column))
    if after is not None:
        tests.append(c > instant(df, after, column))
    if until is not None:
        tests.append(c <= instant(df, until, column))
    if before is not None:
        tests.append(c < instant(df, before, column))
    return all_of(tests)


def year_range(
    df: DataFrame, first: int | None = None, last: int | None = None, column: str = "timestamp"
) -> Column:
    """Years ``first`` to ``last`` inclusive, as a timestamp range the scan can use."""
    since = None if first is None else dt.date(first, 1, 1)
    before = None if last is None else dt.date(last + 1, 1, 1)
    return time_range(df, since=since, before=before, column=column)


def one_of(column: str, values) -> Column:
    return F.col(column).isin(list(values))


def header_like(headers: str, name: str, pattern: str) -> Column:
    """LIKE on one header; captures without the header do not match."""
    return F.coalesce(F.try_element_at(headers, F.lit(name)).like(pattern), F.lit(False))


def all_of(tests: list[Column]) -> Column:
    return reduce(Column.__and__, tests) if tests else F.lit(True)


def require_url_filter(given: bool, allow_full_scan: bool) -> None:
    if not given and not allow_full_scan:
        raise UrlFilterRequired(
            "give a url, host or domain filter, or pass allow_full_scan=True"
        )
