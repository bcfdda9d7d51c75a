"""Stored bodies as readable text: transfer and content codings undone, charset found out."""

from __future__ import annotations

import codecs
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that a body may grow to; one that would be larger has an error instead.
MOST_BYTES = 512 << 20
#: Bytes at the start of a body in which it may name its charset.
LOOKED_AT = 4096
#: Bytes of text handed back to Spark at a time.
BATCH_BYTES = 16 << 20

# Byte order marks, the longest first.
_MARKS = (
    (codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be"), (codecs.BOM_UTF8, "utf-8"),
    (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"),
)
# Labels that browsers read as a larger charset.
_READ_AS = {
    "iso8859-1": "cp1252", "ascii": "cp1252", "gb2312": "gb18030", "gbk": "gb18030", "iso8859-9": "cp1254",
    "iso8859-11": "cp874", "tis-620": "cp874", "shift_jis": "cp932", "euc_kr": "cp949", "utf-16": "utf-16-le",
}
_IN_HEADER = re.compile(r"""charset\s*=\s*["']?\s*([^\s"';,]+)""", re.IGNORECASE)
_IN_META = re.compile(rb"""<meta\s[^>]*?charset\s*=\s*["']?\s*([^\s"'/>;]+)""", re.IGNORECASE)
_IN_XML = re.compile(rb"""\A\s*<\?xml\s[^>]*?encoding\s*=\s*["']([^"']+)["']""", re.IGNORECASE)
_CHUNK = re.compile(rb"[ \t]*([0-9A-Fa-f]+)[ \t]*(?:;[^\r\n]*)?\r?\n")

_ADDED = T.StructType([T.StructField(c, T.StringType()) for c in ("_text", "_charset", "_source", "_error")])
_NEEDED = ("_body", "_transfer", "_coding", "_type")


def decode_bodies(df: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``df`` with ``response`` (``body``, ``headers``) and, added, ``decoded_body``, ``charset``,
    ``charset_source`` (mark, header, document, guess) and ``decode_error``.

    Chunks are joined and the content codings undone, the last one first (gzip, deflate with or
    without its wrapper, identity; a body without chunks or gzip under such a header
    is taken as already undone). The charset is that of a byte order mark, else of the ``Content-Type``,
    else named in the document's first bytes, else UTF-8 if the bytes are that, else Windows-1252;
    labels that nobody knows are passed over. Bytes that the charset lacks become U+FFFD.

    A body that cannot be undone, or grows beyond ``most_bytes``, has no text and a ``decode_error``;
    a NULL body has neither. Rows are decoded where they are, so filter first.
    """
    headers = F.col("response.headers")
    prepared = df.withColumns(
        {
            "_body": F.col("response.body"), "_transfer": _header(headers, "transfer-encoding"),
            "_coding": _header(headers, "content-encoding"), "_type": _header(headers, "content-type"),
        }
    )
    schema = T.StructType([*prepared.schema.fields, *_ADDED.fields])
    read = prepared.mapInArrow(lambda batches: _decoded(batches, most_bytes), schema)
    names = {"_text": "decoded_body", "_charset": "charset", "_source": "charset_source", "_error": "decode_error"}
    return read.drop(*_NEEDED, *names.values()).withColumnsRenamed(names)


def _header(headers: Column, name: str) -> Column:
    """The value of a header, whatever the case of its name."""
    found = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name)
    return F.get(found, F.lit(0))["value"]


def _decoded(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)) for c in _NEEDED]
        rows, size, start = [], 0, 0
        for i in range(batch.num_rows):
            rows.append(decoded(*(c[i].as_py() for c in columns), most_bytes))
            size += len(rows[-1][0] or "")
            if size >= BATCH_BYTES or i + 1 == batch.num_rows:
                some = batch.slice(start, len(rows))
                added = [pa.array(c, pa.string()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([*some.columns, *added], names=[*batch.schema.names, *_ADDED.names])
                start, rows, size = i + 1, [], 0


def decoded(
    body: bytes | None, transfer: str | None, coding: str | None, media: str | None, most_bytes: int = MOST_BYTES
) -> tuple[str | None, str | None, str | None, str | None]:
    """Text, charset, where it was found, and error of one body."""
    if body is None:
        return None, None, None, None
    try:
        if "chunked" in (transfer or "").lower():
            body = joined_chunks(body)
        for name in reversed([c.strip().lower() for c in (coding or "").split(",")]):
            body = undone(body, name, most_bytes)
    except (ValueError, zlib.error) as error:
        return None, None, None, str(error)
    charset, source, skip = charset_of(body, media)
    return body[skip:].decode(charset, "replace"), charset, source, None


def joined_chunks(body: bytes) -> bytes:
    """The bytes of all chunks; ``body`` itself if it does not begin with a chunk's size."""
    parts, at = [], 0
    while True:
        head = _CHUNK.match(body, at)
        if head is None:
            if not parts and not at:
                return body
            raise ValueError(f"Chunks: no size at byte {at}")
        size = int(head[1], 16)
        if not size:
            return b"".join(parts)
        at = head.end() + size
        if at > len(body):
            raise ValueError("Chunks: cut short")
        parts.append(body[head.end() : at])
        at += 2 if body[at : at + 2] == b"\r\n" else body[at : at + 1] == b"\n"


def undone(body: bytes, coding: str, most_bytes: int = MOST_BYTES) -> bytes:
    """``body`` without one content coding."""
    if coding in ("", "identity") or not body:
        return body
    if coding in ("gzip", "x-gzip"):
        return body if body[:2] != b"\x1f\x8b" else _inflated(body, 31, most_bytes)
    if coding == "deflate":
        try:
            return _inflated(body, 15, most_bytes)
        except zlib.error:
            return _inflated(body, -15, most_bytes)
    raise ValueError(f"Content-Encoding {coding} is not known")


def _inflated(body: bytes, wbits: int, most_bytes: int) -> bytes:
    parts, size = [], 0
    while body:
        member = zlib.decompressobj(wbits)
        parts.append(member.decompress(body, most_bytes - size + 1))
        size += len(parts[-1])
        if size > most_bytes:
            raise ValueError(f"Larger than {most_bytes} bytes")
        if not member.eof:
            raise ValueError("Content-Encoding: cut short")
        # Further members follow at once; anything else behind the last one is no content.
        body = member.unused_data if wbits == 31 and member.unused_data[:2] == b"\x1f\x8b" else b""
    return b"".join(parts)


def charset_of(body: bytes, media: str | None) -> tuple[str, str, int]:
    """Charset, where it was found, and the bytes of its mark."""
    for mark, name in _MARKS:
        if body.startswith(mark):
            return name, "mark", len(mark)
    named = _IN_HEADER.search(media or "")
    if named and (known := _known(named[1])):
        return known, "header", 0
    start = body[:LOOKED_AT]
    for pattern in (_IN_XML, _IN_META):
        named = pattern.search(start)
        if named and (known := _known(named[1].decode("latin-1"))):
            # What can be read as ASCII so far is not UTF-16, whatever it says.
            return ("utf-8" if known.startswith("utf-16") else known), "document", 0
    try:
        body.decode("utf-8")
    except UnicodeDecodeError:
        return "cp1252", "guess", 0
    return "utf-8", "guess", 0


def _known(label: str) -> str | None:
    try:
        info = codecs.lookup(label.strip())
    except (LookupError, ValueError):
        return None
    # Some of Python's codecs are none of text.
    return _READ_AS.get(info.name, info.name) if info._is_text_encoding else None
