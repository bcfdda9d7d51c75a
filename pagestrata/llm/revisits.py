"""Revisit records that say "not modified", resolved to the response they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagestrata.llm.common import stored
from pagestrata.operators.ordered import with_last_seen

#: Header fields that a 304 does not update in the stored response (fixed values, RFC 9110 and
#: 9111): those of one connection, and those that describe the body.
NOT_UPDATED = (
    "connection", "keep-alive", "proxy-authenticate", "proxy-authentication-info",
    "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
    "content-encoding", "content-type", "content-range", "content-length",
)
RESOLVED, NONE_EARLIER, NO_VALIDATOR, DIFFERENT = (
    "resolved", "no earlier response", "no validator", "validators differ",
)
#: Rows of a range of the order by URL and time.
ROWS_PER_RANGE = 20_000
DEFAULT_PORTS = {"http": "80", "https": "443"}


def canonical_url(url: Column) -> Column:
    """Host in lower case without user and default port, path (``/`` if empty) and query.

    The scheme and the fragment are left out, escapes are in upper case. What is no URL
    with a scheme and a host stays as it is.
    """
    parts = r"^\s*([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]+)(?::(\d*))?([^?#]*)(\?[^#]*)?(?:#.*)?$"
    scheme = F.lower(F.regexp_extract(url, parts, 1))
    host = F.lower(F.regexp_extract(url, parts, 2))
    port = F.regexp_extract(url, parts, 3)
    usual = (port == "") | F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for p in DEFAULT_PORTS.items() for x in p]), scheme) == port,
        F.lit(False),
    )
    path = F.regexp_extract(url, parts, 4)
    rest = F.concat(F.when(path == "", "/").otherwise(path), F.regexp_extract(url, parts, 5))
    # The pieces after each percent sign begin with the digits of an escape, if it is one.
    pieces = F.split(rest, "%")
    rest = F.array_join(
        F.transform(
            pieces,
            lambda p, i: F.when(
                (i > 0) & p.rlike("^[0-9A-Fa-f]{2}"),
                F.concat(F.upper(F.substring(p, 1, 2)), F.substring(p, F.lit(3), F.length(p))),
            ).otherwise(p),
        ),
        "%",
    )
    whole = F.concat(host, F.when(usual, "").otherwise(F.concat(F.lit(":"), port)), rest)
    return F.when(host != "", whole).otherwise(url)


def fields_of(block: Column) -> Column:
    """The header fields of an HTTP header block as structs (``name``, ``value``) in order."""
    unfolded = F.regexp_replace(block, "\r?\n[ \t]+", " ")
    head = F.split(unfolded, "\r?\n\r?\n", 2)
    lines = F.split(F.get(head, F.lit(0)), "\r?\n")
    return F.transform(
        F.filter(lines, lambda x, i: (i > 0) & (F.instr(x, ":") > 1)),
        lambda x: F.struct(
            F.trim(F.substring_index(x, ":", 1)).alias("name"),
            F.trim(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("value"),
        ),
    )


def field(fields: Column, name: str) -> Column:
    """The first value of a header field, NULL without one."""
    return F.get(F.filter(fields, lambda f: F.lower(f["name"]) == name), F.lit(0))["value"]


def status_of(block: Column) -> Column:
    return F.regexp_extract(block, r"^HTTP/\S+ +(\d{3})", 1)


def merged(response: Column, revisit: Column) -> Column:
    """The block of ``response`` updated by that of ``revisit``: fields that it may update
    are replaced by all of the revisit's of that name, behind the others."""
    new = F.filter(fields_of(revisit), lambda f: ~F.lower(f["name"]).isin(*NOT_UPDATED))
    names = F.transform(new, lambda f: F.lower(f["name"]))
    old = F.filter(fields_of(response), lambda f: ~F.array_contains(names, F.lower(f["name"])))
    lines = F.transform(F.concat(old, new), lambda f: F.concat(f["name"], F.lit(": "), f["value"], F.lit("\r\n")))
    first = F.get(F.split(response, "\r?\n", 2), F.lit(0))
    return F.concat(first, F.lit("\r\n"), F.array_join(lines, ""), F.lit("\r\n"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """The revisits among ``records`` with the response that each stands for.

    ``records`` has ``record_id``, ``kind`` (``response`` or ``revisit``), ``uri``, ``date`` and
    ``http``, the header block as text; payloads are not read. Returns a row per revisit:
    ``record_id``, ``url`` (canonical), ``date``, ``state``, ``refers_to``, ``http`` (updated
    block); the last two are NULL unless ``state`` is ``resolved``.

    A revisit stands for the latest full response (status 200) to the same canonical URL not
    after it; of responses at one time, that with the greatest id. The response must have
    the revisit's ``ETag`` (compared weakly) or, if it names none, its ``Last-Modified``.

    Responses and revisits are put into one order by URL and time, cut into ranges of
    bounded size, and the last response is carried along; nothing is grouped by URL. Only its
    id and validators are carried. Blocks are joined by id afterwards.

    Records of other kinds and other responses are not looked at. A NULL URL, date or block
    gives ``no earlier response`` or ``no validator``. Repeated revisits are resolved each; of
    responses that repeat an id, one block is taken. No rows give no rows.
    """
    fields = fields_of(F.col("http"))
    slim = stored(
        records.filter("kind IN ('response', 'revisit')").select(
            "record_id", "kind", "date", "http",
            canonical_url(F.col("uri")).alias("url"),
            F.regexp_replace(field(fields, "etag"), "^W/", "").alias("etag"),
            field(fields, "last-modified").alias("modified"),
        )
        .filter((F.col("kind") == "revisit") | (status_of(F.col("http")) == "200"))
        .withColumn("later", (F.col("kind") == "revisit").cast("int"))
    )
    keys = slim.select("record_id", "url", "date", "later", "etag", "modified")
    keys = keys.withColumn("id", F.when(F.col("later") == 0, F.col("record_id")))
    carried = with_last_seen(
        keys,
        ["url", "date", "later", "record_id"],
        F.struct("url", "id", "etag", "modified", "date"),
        (F.col("later") == 0) & F.col("url").isNotNull() & F.col("date").isNotNull(),
        "last",
        ROWS_PER_RANGE,
    ).filter("later = 1")
    there = F.coalesce(F.col("last.url") == F.col("url"), F.lit(False)) & F.col("date").isNotNull()
    validator = F.when(F.col("etag").isNotNull(), F.col("etag") == F.col("last.etag")).otherwise(
        F.col("modified") == F.col("last.modified")
    )
    state = (
        F.when(~there, NONE_EARLIER)
        .when(F.col("etag").isNull() & F.col("modified").isNull(), NO_VALIDATOR)
        .when(F.coalesce(validator, F.lit(False)), RESOLVED)
        .otherwise(DIFFERENT)
    )
    states = carried.select(
        "record_id", "url", "date", state.alias("state"),
        F.when(state == RESOLVED, F.col("last.id")).alias("refers_to"),
    )
    own = slim.filter("later = 1").groupBy("record_id").agg(F.min("http").alias("_own"))
    of_response = (
        slim.filter("later = 0").groupBy("record_id").agg(F.min("http").alias("_stored"))
        .withColumnRenamed("record_id", "refers_to")
    )
    joined = states.join(own, "record_id", "left").join(of_response, "refers_to", "left")
    return joined.select(
        "record_id", "url", "date", "state", "refers_to",
        F.when(F.col("refers_to").isNotNull(), merged(F.col("_stored"), F.col("_own"))).alias("http"),
    )


def with_payload(resolved: DataFrame, records: DataFrame, payload: str = "payload") -> DataFrame:
    """``resolved`` with column ``payload`` of the responses referred to, NULL without one."""
    bodies = records.filter("kind = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col(payload).alias("payload")
    )
    return resolved.join(bodies.dropDuplicates(["refers_to"]), "refers_to", "left")
