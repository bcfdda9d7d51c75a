"""Substring and regex searches over an index table without reading every row.

An inverted index says which rows hold which three bytes in a row. The rows of a table have a
``row_id``; 65,536 ids are a chunk, and a posting block is the places of one gram in one
chunk. So no block outgrows 8 kB however common its gram, a lookup brings the blocks of a
chunk together and no more, and rows that hold all grams of a pattern are read and tested
with the pattern itself. Postings can only say where not to look.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagestrata.operators import filters
from pagestrata.session import written

ROW_ID = "row_id"
#: Rows of a chunk, as a power of two; places in it are 16 bits.
CHUNK_BITS = 16
#: Places up to this many are stored as they are, more as a deflated bitmap.
LISTED = 256
#: Posting blocks of a Parquet page, whose bounds tell a lookup whether to read it.
PAGE_ROWS = 2000
#: Grams of a pattern that are looked up, the rarest; the exact test does the rest.
MOST_GRAMS = 8
#: Bytes of text whose grams are sorted at a time; each takes about 80 bytes of memory meanwhile.
SLICE = 1 << 18
#: Row ranges that a scan is narrowed to, and the powers of two that hits are joined by until
#: there are no more of them than that. The last one holds 128 writing tasks.
MOST_RANGES = 100
WIDTHS = (10, 13, 16, 20, 24, 33, 40)

_POSTINGS = "gram int, chunk long, n int, places binary"
_PLACES = "place long, low long, high long"


def write_grams(table: DataFrame, path: str, column: str = "url") -> None:
    """Index ``column`` (text) of ``table``, as ``to_index_table(..., number_rows=True)`` wrote it, below
    ``path``: ``postings`` sorted by gram, and ``counts`` with the rows of each gram.

    Texts are shuffled once, by chunk; a task holds the texts of one chunk. NULL texts and
    those below three bytes have no grams and can meet no pattern that is looked up. Rows
    added to the table later are not in it: write the index anew.
    """
    texts = table.select((F.shiftright(ROW_ID, CHUNK_BITS)).alias("chunk"), ROW_ID, F.col(column).alias("text"))
    found = texts.filter("text IS NOT NULL").groupBy("chunk").applyInArrow(_postings_of, _POSTINGS)
    found = written(found)
    spread = found.repartitionByRange("gram", "chunk").sortWithinPartitions("gram", "chunk")
    spread.write.option("parquet.page.row.count.limit", PAGE_ROWS).parquet(f"{path}/postings")
    counts = found.groupBy("gram").agg(F.sum("n").alias("n_rows"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/counts")


def find_by_grams(
    table: DataFrame,
    path: str,
    *,
    contains: str | None = None,
    like: str | None = None,
    matches: str | None = None,
    matches_whole: str | None = None,
    column: str = "url",
) -> DataFrame:
    """The rows of ``table`` whose ``column`` meets one condition: a part, a LIKE pattern, or a regex found
    anywhere or over the whole value. The same rows as from the predicates of
    ``operators.filters``, by the index at ``path``.

    A pattern that says no three bytes in a row of what it matches is a plain filter over the
    table. The lookup runs when this is called; the result reads the row ranges found.
    """
    given = [x for x in (contains, like, matches, matches_whole) if x is not None]
    if len(given) != 1:
        raise ValueError("give one of contains, like, matches and matches_whole")
    if contains is not None:
        test, literals = F.col(column).contains(contains), [[contains]]
    elif like is not None:
        test, literals = filters.like(column, like), like_literals(like)
    elif matches is not None:
        test, literals = filters.matches(column, matches), regex_literals(matches)
    else:
        test, literals = filters.matches_whole(column, matches_whole), regex_literals(matches_whole)
    needs = grams_needed(literals)
    if needs is None:
        return table.filter(test)
    ranges = _ranges_of(_hits(table.sparkSession, path, needs))
    return table.filter(_within(ranges) & test) if ranges else table.filter(F.lit(False))


def like_literals(pattern: str) -> list[list[str]] | None:
    """What every match of a LIKE pattern holds, as one alternative of literals."""
    parts, at = [""], 0
    while at < len(pattern):
        if pattern[at] in "%_":
            parts.append("")
        else:
            at += pattern[at] == "\\"
            parts[-1] += pattern[at : at + 1]
        at += 1
    return [parts]


def regex_literals(pattern: str) -> list[list[str]] | None:
    """What every match of a regular expression holds: alternatives, each of literals that all are there.

    Only plain characters outside of groups count; classes, groups and what may be absent
    end a literal. None where flags, quotations or unknown escapes may change what
    characters mean.
    """
    alternatives, depth, at = [[""]], 0, 0
    plain = False  # whether the item before is a character of the last literal
    while at < len(pattern):
        c, parts = pattern[at], alternatives[-1]
        at += 1
        literal = None
        if c == "\\":
            c = pattern[at : at + 1]
            at += 1
            if c.isascii() and c and not c.isalnum():
                literal = c
            elif c not in tuple("dDwWsSbBAzZ"):
                return None
        elif c == "[":
            end = _end_of_class(pattern, at)
            if end is None:
                return None
            at = end
        elif c == "(":
            if pattern[at : at + 1] == "?" and pattern[at + 1 : at + 2] not in tuple(":=!<>"):
                return None
            depth += 1
        elif c == ")":
            depth -= 1
            if depth < 0:
                return None
        elif c == "|" and not depth:
            alternatives.append([""])
        elif c in "*?{" and plain and not depth:
            parts[-1] = parts[-1][:-1]
        elif c not in ".^$|*?+{}]":
            literal = c
        if c == "{" and literal is None:
            close = pattern.find("}", at)
            if close < 0:
                return None
            at = close + 1
        plain = literal is not None and not depth
        if plain:
            parts[-1] += literal
        else:
            alternatives[-1].append("")
    return alternatives if not depth else None


def _end_of_class(pattern: str, at: int) -> int | None:
    """The place after the class that begins before ``at``; None for classes of classes."""
    at += pattern[at : at + 1] == "^"
    first = at
    while at < len(pattern):
        if pattern[at] == "\\":
            if pattern[at + 1 : at + 2] in ("Q", "E", ""):
                return None
            at += 1
        elif pattern[at] == "[" or pattern[at : at + 2] == "&&" or (pattern[at] == "]" and at == first):
            return None
        elif pattern[at] == "]":
            return at + 1
        at += 1
    return None


def grams_needed(literals: list[list[str]] | None) -> list[list[int]] | None:
    """The grams that all must be there, by alternative; None if one alternative has none."""
    if literals is None:
        return None
    # A replacement character may stand for bytes that are no text.
    parts = [[p for literal in parts for p in literal.split("�")] for parts in literals]
    needs = []
    for alternative in parts:
        codes = [p.encode("utf-8", "surrogatepass") for p in alternative]
        grams = {int.from_bytes(b[i : i + 3]) for b in codes for i in range(len(b) - 2)}
        if not grams:
            return None
        needs.append(sorted(grams))
    return needs


def _postings_of(texts: pa.Table) -> pa.Table:
    """The posting blocks of the texts of one chunk."""
    chunk = texts.column("chunk")[0].as_py()
    pairs = [np.zeros(0, np.int64)]
    for batch in texts.select([ROW_ID, "text"]).to_batches():
        pairs += _pairs(batch)
    pairs = np.concatenate(pairs)
    pairs.sort()
    again = np.flatnonzero(pairs[1:] == pairs[:-1])
    pairs = np.delete(pairs, again) if len(again) else pairs
    grams, places = (pairs >> CHUNK_BITS).astype(np.int32), (pairs & ((1 << CHUNK_BITS) - 1)).astype(np.uint16)
    del pairs
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    stops = np.append(starts[1:], len(grams))
    blocks = [packed(places[a:b]) for a, b in zip(starts, stops, strict=True)] if len(grams) else []
    n = (stops - starts) if len(grams) else starts
    return pa.table({
        "gram": pa.array(grams[starts], pa.int32()),
        "chunk": pa.array(np.full(len(blocks), chunk), pa.int64()),
        "n": pa.array(n, pa.int32()),
        "places": pa.array(blocks, pa.binary()),
    })


def _pairs(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Distinct (gram, place in the chunk) of the texts, in one number each, a slice of bytes at a time."""
    codes = np.frombuffer(b"".join(batch.column(1).cast(pa.binary()).to_pylist()), np.uint8)
    ends = np.cumsum(np.asarray(pc.binary_length(batch.column(1)), np.int64))
    places = np.asarray(batch.column(0), np.int64) & ((1 << CHUNK_BITS) - 1)
    for at in range(0, len(codes) - 2, SLICE):
        piece = codes[at : at + SLICE + 2].astype(np.int64)
        grams = (piece[:-2] << 16) | (piece[1:-1] << 8) | piece[2:]
        first = np.arange(at, at + len(grams))
        owner = np.searchsorted(ends, first, side="right")
        # The last two bytes of a text begin no gram.
        inside = first + 3 <= ends[owner]
        yield np.unique((grams[inside] << CHUNK_BITS) | places[owner[inside]])


def packed(places: np.ndarray) -> bytes:
    """Sorted places in a chunk as bytes."""
    if len(places) <= LISTED:
        return b"\0" + places.astype("<u2").tobytes()
    bits = np.zeros(1 << CHUNK_BITS, bool)
    bits[places] = True
    return b"\1" + zlib.compress(np.packbits(bits).tobytes(), 6)


def unpacked(block: bytes) -> np.ndarray:
    """Which places of the chunk a block holds, as booleans."""
    if block[0]:
        return np.unpackbits(np.frombuffer(zlib.decompress(block[1:]), np.uint8)).astype(bool)
    bits = np.zeros(1 << CHUNK_BITS, bool)
    bits[np.frombuffer(block, "<u2", offset=1)] = True
    return bits


def _hits(spark, path: str, needs: list[list[int]]) -> DataFrame:
    """Where rows have all grams of an alternative: per 1,024 rows the first and last such id."""
    asked = sorted({g for grams in needs for g in grams})
    counts = spark.read.parquet(f"{path}/counts").filter(F.col("gram").isin(asked))
    known = dict(counts.select("gram", "n_rows").toLocalIterator())
    # A gram that no row has ends its alternative.
    rarest = [sorted(grams, key=lambda g: (known[g], g))[:MOST_GRAMS] for grams in needs if all(g in known for g in grams)]
    taken = sorted({g for grams in rarest for g in grams})

    def meet(blocks: pa.Table) -> pa.Table:
        held = dict(zip(blocks.column("gram").to_pylist(), blocks.column("places").to_pylist(), strict=True))
        rows = np.zeros(1 << CHUNK_BITS, bool)
        for grams in rarest:
            if all(g in held for g in grams):
                rows |= np.logical_and.reduce([unpacked(held[g]) for g in grams])
        ids = np.flatnonzero(rows) + (blocks.column("chunk")[0].as_py() << CHUNK_BITS)
        places = ids >> WIDTHS[0]
        starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]])) if len(ids) else ids
        stops = np.append(starts[1:], len(ids)) if len(ids) else ids
        return pa.table({"place": places[starts], "low": ids[starts], "high": ids[stops - 1]})

    postings = spark.read.parquet(f"{path}/postings").filter(_any_of("gram", taken))
    return written(postings.select("chunk", "gram", "places").groupBy("chunk").applyInArrow(meet, _PLACES))


def _any_of(column: str, values: list[int]) -> Column:
    """``column`` is one of ``values``, as equalities: long IN lists reach the scan as one wide range."""
    return _either([F.col(column) == v for v in values]) if values else F.lit(False)


def _either(tests: list[Column]) -> Column:
    """OR in halves, so that the expression stays shallow."""
    if len(tests) == 1:
        return tests[0]
    half = len(tests) // 2
    return _either(tests[:half]) | _either(tests[half:])


def _ranges_of(hits: DataFrame) -> list[tuple[int, int]]:
    """At most ``MOST_RANGES`` ranges of ids that hold all hits."""
    groups = [F.shiftright("place", w - WIDTHS[0]) for w in WIDTHS]
    counts = hits.agg(*[F.count_distinct(g).alias(f"w{i}") for i, g in enumerate(groups)]).first()
    width = next((i for i, n in enumerate(counts) if n <= MOST_RANGES), None)
    if width is None:
        return [tuple(hits.agg(F.min("low"), F.max("high")).first())]
    found = hits.groupBy(groups[width].alias("g")).agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return sorted((r.low, r.high) for r in found.collect())


def _within(ranges: list[tuple[int, int]]) -> Column:
    return _either([F.col(ROW_ID).between(low, high) for low, high in ranges])
