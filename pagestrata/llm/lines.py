"""Dropping lines that many documents share, as keep bitmaps."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagestrata.llm.common import BLANKS, stored

MIN_CHARS = 20
MIN_DOCS = 3
#: Stands for a NULL id, so that it sorts behind all others.
NO_ID = -(1 << 63)

# What a streaming task hands on: a line to drop, a line of a group that may go on in
# another task, and the summary of such a group.
DROP, BORDER, SUMMARY = 0, 1, 2
_KEYS = "hi long, lo long, doc_id long, row_hash long, places binary"
_FOUND = "kind int, hi long, lo long, doc_id long, row_hash long, places binary, n_docs long"


def keep_bitmaps(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """A keep bitmap for each document of ``docs`` (``doc_id``, ``text``) that loses lines.

    Returns ``doc_id``, ``row_hash`` (``xxhash64`` of the text) and ``keep`` (see
    ``pack``). A line's key is the line without ASCII blanks at its ends and with A-Z
    lower-cased. Keys of ``min_chars`` code points found in ``min_docs`` documents lose
    all their lines but those in the largest ``doc_id``.

    One row per key and document, holding the key's 128-bit hash and the line numbers,
    is range-partitioned by hash and document and sorted within; tasks stream over the
    groups and remember no more than ``min_docs`` rows. A frequent key is spread over
    many ranges by its documents. What a task cannot decide alone, its first and its last
    group, it hands on with one summary row; those rows are decided by a second, small step.

    NULL and empty texts are one empty line and have no keys. Rows with NULL ids count as
    one document, the smallest. Rows that repeat an id count as one document; each loses
    its own lines. No documents give no rows.
    """
    keys = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("row_hash"))
        .filter(F.length("text") >= min_chars)
        .mapInArrow(lambda batches: _line_keys(batches, min_chars), _KEYS)
    )
    order = ["hi", "lo", F.desc("doc_id")]
    found = stored(
        keys.repartitionByRange(*order)
        .sortWithinPartitions(*order, "row_hash")
        .mapInArrow(lambda batches: _stream(batches, min_docs), _FOUND)
    )
    # Two groups a task at most, so the broadcast has no more than twice as many rows as tasks.
    decided = (
        found.filter(F.col("kind") == SUMMARY)
        .groupBy("hi", "lo")
        .agg(F.sum("n_docs").alias("n"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n") >= min_docs)
    )
    late = (
        found.filter(F.col("kind") == BORDER)
        .join(F.broadcast(decided), ["hi", "lo"])
        .filter("doc_id <> keeper")
    )
    lost = ["doc_id", "row_hash", "places"]
    dropped = found.filter(F.col("kind") == DROP).select(*lost).union(late.select(*lost))
    of_document = dropped.groupBy("doc_id", "row_hash").agg(F.collect_list("places").alias("places"))
    return of_document.mapInArrow(_packed, "doc_id long, row_hash long, keep binary")


def pack(lost: np.ndarray) -> bytes:
    """Line numbers to drop, as a deflated bitmap with 1 for keep. Lines behind its end stay."""
    bits = np.ones((int(lost.max()) // 8 + 1) * 8, np.uint8)
    bits[lost] = 0
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 6)


def unpack(keep: bytes | None, n_lines: int) -> np.ndarray:
    """The bitmap as one bool per line."""
    kept = np.ones(n_lines, bool)
    if keep is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
        kept[: min(len(bits), n_lines)] = bits[:n_lines]
    return kept


def kept_text(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with their bitmaps applied: ``doc_id``, ``text`` (kept lines), ``n_lines``
    (before), ``n_dropped`` and ``kept_sha256`` for every row."""
    wide = docs.select("doc_id", "text", F.xxhash64("text").alias("row_hash"))
    maps = bitmaps.select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_row"), "keep")
    key = F.coalesce(F.col("doc_id"), F.lit(NO_ID))
    joined = wide.join(maps, (key == F.col("_id")) & (F.col("row_hash") == F.col("_row")), "left")
    return joined.select("doc_id", "text", "keep").mapInArrow(
        _applied, "doc_id long, text string, n_lines long, n_dropped long, kept_sha256 string"
    )


def _line_keys(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    blanks = BLANKS.encode()
    schema = pa.schema(
        [(n, pa.int64()) for n in ("hi", "lo", "doc_id", "row_hash")] + [("places", pa.binary())]
    )
    for batch in batches:
        rows = zip(*(batch.column(i) for i in range(3)), strict=True)
        out: list[tuple] = []
        for doc, text, row in rows:
            places: dict[bytes, list[int]] = {}
            for i, line in enumerate(text.as_buffer().to_pybytes().lower().split(b"\n")):
                line = line.strip(blanks)
                if len(line) >= min_chars and (line.isascii() or len(line.decode()) >= min_chars):
                    places.setdefault(line, []).append(i)
            doc_id = NO_ID if doc.as_py() is None else doc.as_py()
            for line, at in places.items():
                digest = hashlib.blake2b(line, digest_size=16).digest()
                hi, lo = np.frombuffer(digest, "<i8").tolist()
                out.append((hi, lo, doc_id, row.as_py(), np.array(at, "<u4").tobytes()))
            if len(out) >= 20_000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)


def _stream(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Walk over sorted rows (hi, lo, doc_id descending); see ``keep_bitmaps``."""
    schema = pa.schema(
        [("kind", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64()), ("doc_id", pa.int64()),
         ("row_hash", pa.int64()), ("places", pa.binary()), ("n_docs", pa.int64())]
    )
    out: list[tuple] = []
    key, first, keeper, last, n, held = None, True, None, None, 0, []
    for batch in batches:
        for hi, lo, doc, row, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (hi, lo) != key:
                if key is not None and first:
                    out.append((SUMMARY, *key, keeper, None, None, n))
                first = key is None
                key, keeper, last, n, held = (hi, lo), doc, doc, 1, []
            elif doc != last:
                last, n = doc, n + 1
            if first:
                out.append((BORDER, hi, lo, doc, row, places, None))
                continue
            # The group's rows wait until it has documents enough to be dropped. While it
            # has not, it may turn out to be the last group, whose rows are handed on.
            held.append((hi, lo, doc, row, places, None))
            if n >= min_docs:
                out += [(DROP, *x) for x in held if x[2] != keeper]
                held = []
        if len(out) >= 5_000:
            yield _batch(out, schema)
            out = []
    if key is not None:
        # Of the last group, what is dropped already stays dropped: its keeper is the group's
        # first document if the group began here. Later ranges hold smaller ids.
        out += [(BORDER, *x) for x in held]
        out.append((SUMMARY, *key, keeper, None, None, n))
    if out:
        yield _batch(out, schema)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [
            pack(np.concatenate([np.frombuffer(p, "<u4") for p in places]))
            for places in batch.column(2).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keep, pa.binary())],
            names=["doc_id", "row_hash", "keep"],
        )


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text", "n_lines", "n_dropped", "kept_sha256"]
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            some = batch.slice(start, 500)
            texts, n_lines, n_dropped, digests = [], [], [], []
            for text, keep in zip(some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                if keep is None:
                    left = lines
                else:
                    left = [x for x, k in zip(lines, unpack(keep, len(lines)), strict=True) if k]
                texts.append("\n".join(left))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
                digests.append(hashlib.sha256(texts[-1].encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64()), pa.array(digests, pa.string())], names=names,
            )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)
