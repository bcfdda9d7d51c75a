"""Index requests and body fetches for many targets, planned as columns.

A fetching job elsewhere takes the planned rows; nothing here opens a connection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagestrata.functions.urls import (
    CRAWL_INDEX,
    SNAPSHOT_INDEX,
    byte_range,
    compact_time,
    record_address,
    snapshot_address,
)
from pagestrata.operators.crawls import overlap_join

# The fields of a request, in the order the index returns them.
SNAPSHOT_FIELDS = (
    "urlkey", "timestamp", "original", "mimetype", "statuscode", "digest", "length",
)
CRAWL_FIELDS = ("url", "timestamp", "mime", "status", "digest", "filename", "offset", "length")

# What a value must not hold as it is, since it would end or split it.
RESERVED = {"%": "%25", "&": "%26", "#": "%23", "+": "%2B", " ": "%20"}
# The characters with a meaning in the index's regular expressions.
_REGEX_CHARS = r"([.\[\]{}+?^$|*])"
_BACKSLASH = "%5C"


def encoded(value: Column) -> Column:
    """A literal value as part of a request."""
    for char, code in RESERVED.items():
        value = F.replace(value, F.lit(char), F.lit(code))
    return value


def requested_url(url: Column, match: Column, single: str) -> Column:
    """What is asked for: an ``exact`` URL (also without a match kind), a ``prefix``, or a
    ``like`` pattern, whose ``%`` becomes ``*`` and whose ``_`` becomes ``single``."""
    wildcards = F.translate(url, "%_", f"*{single}")
    like = F.replace(F.replace(wildcards, F.lit("&"), F.lit("%26")), F.lit("#"), F.lit("%23"))
    return (
        F.when(match == "like", F.replace(like, F.lit(" "), F.lit("%20")))
        .when(match == "prefix", F.concat(encoded(url), F.lit("*")))
        .otherwise(encoded(url))
    )


def _separate(value: Column) -> Column:
    """Keep what would end a filter within it."""
    return F.replace(F.replace(value, F.lit("&"), F.lit("%26")), F.lit("#"), F.lit("%23"))


def literal_regex(value: Column) -> Column:
    """A value as a regular expression that finds it literally. Backslashes are
    percent-encoded, parentheses stay as they are."""
    doubled = F.replace(value, F.lit("\\"), F.lit(_BACKSLASH * 2))
    return _separate(F.regexp_replace(doubled, _REGEX_CHARS, f"{_BACKSLASH}$1"))


def like_regex(pattern: Column) -> Column:
    """A LIKE pattern as a regular expression, anchored where it has no outer ``%``. A
    backslash takes the meaning from the character behind it."""
    # Stand-ins: for a literal backslash, percent sign and underscore, and for an escape, since
    # the encoded backslash has a percent sign itself.
    literal = {"\\\\": "\u0002", "\\%": "\u0003", "\\_": "\u0004"}
    body = pattern
    for text, stand_in in literal.items():
        body = F.replace(body, F.lit(text), F.lit(stand_in))
    open_start, open_end = body.startswith("%"), body.endswith("%")
    body = F.regexp_replace(body, _REGEX_CHARS, "\u0001$1")
    body = F.replace(F.replace(body, F.lit("%"), F.lit(".*")), F.lit("_"), F.lit("."))
    for stand_in, code in (
        ("\u0001", _BACKSLASH), ("\u0002", _BACKSLASH * 2), ("\u0003", "%25"), ("\u0004", "_"),
    ):
        body = F.replace(body, F.lit(stand_in), F.lit(code))
    start = F.when(open_start, "").otherwise("^")
    end = F.when(open_end, "").otherwise("$")
    return _separate(F.concat(start, body, end))


def snapshot_filter(f: Column) -> Column:
    """One condition (struct ``field``, ``op``, ``values``) for the snapshot index."""
    field = F.when(f["field"] == "url", "original").otherwise(f["field"])
    sign = F.when(f["op"].isin("ne", "not_like", "not_regex"), "!").otherwise("")
    return F.concat(sign, field, F.lit(":"), _filter_value(f))


def crawl_filter(f: Column) -> Column:
    """One condition for the crawl index, which marks equality and regex apart."""
    field = (
        F.when(f["field"] == "mimetype", "mime")
        .when(f["field"] == "statuscode", "status")
        .otherwise(f["field"])
    )
    sign = (
        F.when(f["op"] == "eq", "=")
        .when(f["op"] == "ne", "!=")
        .when(f["op"].isin("not_like", "not_regex"), "!~")
        .otherwise("~")
    )
    plain = f["op"].isin("eq", "ne")
    value = F.when(plain, f["values"][0]).otherwise(_filter_value(f))
    return F.concat(sign, field, F.lit(":"), value)


def _filter_value(f: Column) -> Column:
    only = f["values"][0]
    choice = F.array_join(F.transform(f["values"], literal_regex), "|")
    return (
        F.when(f["op"] == "in", F.concat(F.lit("("), choice, F.lit(")")))
        .when(f["op"].isin("like", "not_like"), like_regex(only))
        .when(f["op"].isin("regex", "not_regex"), only)
        .otherwise(literal_regex(only))
    )


def plan_requests(targets: DataFrame, fields=SNAPSHOT_FIELDS) -> DataFrame:
    """Add ``cdx_url``, the snapshot-index request of every target.

    Target columns: ``url``, ``match`` (``exact``, ``prefix`` or ``like``), ``since`` and ``until`` (timestamps), ``filters``
    (array of ``field``, ``op``, ``values``), ``collapse`` (array of specs), ``max_rows``,
    ``skip`` and ``newest`` (boolean: the last rows instead of the first). All but
    ``url`` and ``max_rows`` may be NULL, and ``match`` may be missing, which is exact.
    """
    wanted = ",".join(f for f in SNAPSHOT_FIELDS if f in set(fields) | {"original"})
    rows = F.col("max_rows").cast("string")
    limit = F.when(
        F.col("newest"), F.concat(F.lit("&fastLatest=true&limit=-"), rows)
    ).otherwise(F.concat(F.lit("&limit="), rows))
    skip = F.when(F.col("skip") > 0, F.concat(F.lit("&offset="), F.col("skip").cast("string")))
    request = F.concat_ws(
        "",
        F.lit(f"{SNAPSHOT_INDEX}?url="),
        requested_url(F.col("url"), _optional(targets, "match", "string"), "_"),
        F.lit(f"&output=csv&fl={wanted}"),
        _time_bounds(),
        limit,
        skip,
        _repeated("&filter=", F.transform("filters", snapshot_filter)),
        _repeated("&collapse=", F.col("collapse")),
    )
    return targets.withColumn("cdx_url", request)


def plan_crawl_requests(targets: DataFrame, catalog: DataFrame, fields=CRAWL_FIELDS) -> DataFrame:
    """One row per target and crawl it touches, with ``crawl_id`` and ``cdx_url``.

    A target that names crawls in ``crawls`` (an array of ids, which may be missing or
    NULL) goes to those. Others go to the crawls overlapping [``since``, ``until``], where an
    open end reaches as far as the catalog does, or without either to the latest crawl.
    """
    ends = catalog.agg(
        F.struct(
            F.min("from_ts").alias("first"),
            F.max("to_ts").alias("last"),
            F.max_by("id", F.struct("to_ts", "id")).alias("newest"),
        )
    ).scalar()
    named = _optional(targets, "crawls", "array<string>")
    by_name = targets.filter(named.isNotNull()).withColumn("id", F.explode(F.array_distinct(named)))
    spans = targets.filter(named.isNull()).withColumn("_ends", ends)
    open_ended = F.col("since").isNull() & F.col("until").isNull()
    latest = spans.filter(open_ended).withColumn("id", F.col("_ends.newest"))
    spans = spans.filter(~open_ended).select(
        "*",
        F.coalesce("since", "_ends.first").alias("lo"),
        F.coalesce("until", "_ends.last").alias("hi"),
    )
    touched = overlap_join(spans, catalog.select("id", "from_ts", "to_ts"))
    columns = [*targets.columns, "id"]
    touched = touched.select(*columns).union(latest.select(*columns)).union(by_name.select(*columns))
    wanted = ",".join(f for f in CRAWL_FIELDS if f in set(fields) | {"url"})
    request = F.concat_ws(
        "",
        F.lit(CRAWL_INDEX),
        F.col("id"),
        F.lit("-index?url="),
        requested_url(F.col("url"), _optional(targets, "match", "string"), "?"),
        F.lit(f"&output=json&fl={wanted}&limit="),
        F.col("max_rows").cast("string"),
        _time_bounds(),
        _repeated("&filter=", F.transform("filters", crawl_filter)),
    )
    return touched.withColumn("cdx_url", request).withColumnRenamed("id", "crawl_id")


def _optional(df: DataFrame, column: str, kind: str) -> Column:
    return F.col(column) if column in df.columns else F.lit(None).cast(kind)


def plan_fetches(df: DataFrame) -> DataFrame:
    """Add where each body is to be had: ``address``, and ``byte_range`` for rows that
    point into a record file."""
    if "filename" not in df.columns:
        return df.withColumn("address", snapshot_address(F.col("timestamp"), F.col("url")))
    valid = (F.length("filename") > 0) & (F.col("offset") >= 0) & (F.col("length") > 0)
    return df.withColumn("address", F.when(valid, record_address(F.col("filename")))).withColumn(
        "byte_range", F.when(valid, byte_range(F.col("offset"), F.col("length")))
    )


def _time_bounds() -> Column:
    since = F.concat(F.lit("&from="), compact_time(F.col("since")))
    until = F.concat(F.lit("&to="), compact_time(F.col("until")))
    return F.concat_ws("", since, until)


def _repeated(prefix: str, values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: F.concat(F.lit(prefix), v)), "")
