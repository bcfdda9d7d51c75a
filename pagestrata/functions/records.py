"""Index-field parsing and archived-record headers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS14 = r"^[0-9]{14}$"


def parse_compact_time(text: Column) -> Column:
    """14 digits, in UTC, to a timestamp; anything else is the epoch."""
    utc = F.when(text.rlike(_DIGITS14), F.concat(text, F.lit("Z")))
    return _or_epoch(F.try_to_timestamp(utc, F.lit("yyyyMMddHHmmssX")))


def parse_iso_time(text: Column) -> Column:
    """An ISO-8601 date-time with seconds; else the epoch. A fraction of a second is left out,
    an offset is applied, and without one the time is UTC."""
    parts = r"^(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d)(?:[.,]\d+)?(Z|[+-]\d\d(?::?\d\d)?)?$"
    zone = F.regexp_replace(F.regexp_extract(text, parts, 2), r"^([+-]\d\d):?(\d\d)?$", "$1:$2")
    # An offset of hours alone is written with its minutes, as the parser wants it.
    zone = F.when(zone.endswith(":"), F.concat(zone, F.lit("00"))).otherwise(zone)
    utc = F.concat(F.regexp_extract(text, parts, 1), F.when(zone == "", "Z").otherwise(zone))
    return _or_epoch(F.try_to_timestamp(utc, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))


def _or_epoch(parsed: Column) -> Column:
    return F.coalesce(parsed, F.timestamp_seconds(F.lit(0)))


def number_or_zero(text: Column, kind: str) -> Column:
    """A number field; ``-``, empty, missing or malformed counts as 0."""
    return F.coalesce(text.try_cast(kind), F.lit(0).cast(kind))


def is_bad_number(text: Column, kind: str) -> Column:
    """Whether a number field holds something that is neither a number nor absent."""
    absent = text.isNull() | text.isin("", "-")
    return ~absent & text.try_cast(kind).isNull()


def repair_utf8(raw: Column) -> Column:
    """Bytes as text, with ``?`` for every invalid sequence."""
    text = raw.cast("string")
    repaired = F.translate(F.make_valid_utf8(text), "�", "?")
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)


def first_line(block: Column) -> Column:
    return F.split(block, r"\r?\n", 2)[0]


def header_map(block: Column) -> Column:
    """Headers below the first line of a block. A repeated name keeps its place once,
    with its values joined by ``", "``; names are case-sensitive."""
    lines = F.filter(F.split(block, r"\r?\n"), lambda line, i: (i > 0) & line.contains(": "))
    pairs = F.transform(
        lines,
        lambda line: F.struct(
            F.substring_index(line, ": ", 1).alias("name"),
            F.substring(line, F.instr(line, ": ") + 2, F.length(line)).alias("value"),
        ),
    )
    return _once(
        pairs, lambda p: _once(F.array_distinct(p["name"]), lambda names: _joined(p, names))
    )


def _joined(pairs: Column, names: Column) -> Column:
    def values(name: Column) -> Column:
        return F.array_join(F.filter(pairs, lambda p: p["name"] == name)["value"], ", ")

    # Most blocks repeat no name and need no search for equal ones.
    repeated = F.size(names) < F.size(pairs)
    values_in_place = F.when(repeated, F.transform(names, values)).otherwise(pairs["value"])
    return F.map_from_arrays(names, values_in_place)


def _once(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def record_version(head: Column) -> Column:
    """Version in the first line of a record head (``WARC/1.0``), empty if there is none."""
    return F.regexp_extract(first_line(head), r"^WARC/(.*)$", 1)


def http_version(head: Column) -> Column:
    return F.regexp_extract(first_line(head), r"^HTTP/([^ ]*) ", 1)


def http_status(head: Column) -> Column:
    code = F.regexp_extract(first_line(head), r"^HTTP/[^ ]* +([0-9]+)", 1)
    return number_or_zero(code, "int")
