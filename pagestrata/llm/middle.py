"""Fill-in-the-middle forms of whole texts by piece tables.

A document is a list of descriptors (buffer, start, stop) over two immutable buffers: the bytes
of the batch's texts, and the sentinels. Cutting splits a descriptor, arranging permutes
descriptors, restoring applies the inverse permutation, and hashes stream over them; bytes are
copied only where an output text is wanted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pagestrata.llm.minhash import chunks

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
#: Documents in a hundred that are cut, and of these the ones whose suffix comes first.
RATE = 90
SUFFIX_FIRST = 20
#: Bytes that are counted or hashed at a time.
STEP = 1 << 20

#: Buffers: the texts, and the sentinels.
TEXT, MARK = 0, 1
Piece = tuple[int, int, int]
_P, _S, _M = (MARK, 0, 3), (MARK, 3, 6), (MARK, 6, 9)
#: What stands where: a sentinel, or the number of a part (prefix 0, middle 1, suffix 2).
ARRANGED = {"plain": (0,), "psm": (_P, 0, _S, 2, _M, 1), "spm": (_S, 2, _P, 0, _M, 1)}

_COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def fill_in_middle(docs: DataFrame, seed: int = 1, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Whole texts of ``docs`` (``doc_id``, ``text``) cut in three and put in another order.

    Returns a row per row: ``doc_id``, ``n`` (code points), ``form``, ``prefix_chars``,
    ``middle_chars`` (code points, NULL if plain) and ``output``. The first four groups of eight
    digits of the hex sha256 of ``seed``, a colon and the id decide, in this order: both cuts
    (modulo n + 1), whether the text is cut at all (``rate`` in a hundred are), and whether the form
    is ``spm`` (``suffix_first`` in a hundred) or ``psm``. Empty texts and texts that
    hold a sentinel stay ``plain``.

    NULL texts are empty; a NULL id hashes as no digits. Rows that repeat an id have the same
    numbers, and each its own text. Bytes that are no UTF-8 stay as they are. Extra
    columns are not read. No rows give no rows. A task holds one batch of texts.
    """
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _forms(batches, seed, rate, suffix_first, True), f"{_COLUMNS}, output string"
    )


def middle_digests(docs: DataFrame, seed: int = 1, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """As ``fill_in_middle``, with ``output_sha256`` in place of the output, and ``restored_sha256`` of
    the text that the output's pieces and the form give back; no output is built."""
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _forms(batches, seed, rate, suffix_first, False),
        f"{_COLUMNS}, output_sha256 string, restored_sha256 string",
    )


def restore_texts(outputs: DataFrame) -> DataFrame:
    """``outputs`` (``output``, ``form``, others stay) with ``text``: the text that was cut.

    The sentinels are looked for from left to right. NULL outputs give NULL; an output without
    the sentinels of its form is an error.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema.fields if f.name != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _binary(batch.column(batch.schema.get_field_index("output")))
            forms = batch.column(batch.schema.get_field_index("form")).to_pylist()
            buffers, spans = _spans(texts)
            built = [
                None if valid is False else _built(restored(parsed(buffers[TEXT], a, b, form), form), buffers)
                for (a, b), form, valid in zip(spans, forms, texts.is_valid().to_pylist(), strict=True)
            ]
            text = pa.array(built, pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, "text"])

    return outputs.drop("text").mapInArrow(run, f"{schema}, text string")


def cut(pieces: list[Piece], at: int) -> list[Piece]:
    """``pieces`` with a border at byte ``at`` of what they stand for: one descriptor is split."""
    out: list[Piece] = []
    for buffer, start, stop in pieces:
        size = stop - start
        if 0 <= at <= size:
            out += [(buffer, start, start + at), (buffer, start + at, stop)]
            at = -1
        else:
            out.append((buffer, start, stop))
            at -= size if at >= 0 else 0
    return out


def arranged(parts: list[Piece], form: str) -> list[Piece]:
    """The output's pieces: the parts of a text in the order of ``form``, sentinels between."""
    return [parts[x] if isinstance(x, int) else x for x in ARRANGED[form]]


def restored(pieces: list[Piece], form: str) -> list[Piece]:
    """The text's pieces: what stands at each part's place in an output of ``form``."""
    places = {x: i for i, x in enumerate(ARRANGED[form]) if isinstance(x, int)}
    return [pieces[places[part]] for part in sorted(places)]


def parsed(text: memoryview, start: int, stop: int, form: str) -> list[Piece]:
    """The pieces of an output of ``form`` that is written out in ``text``."""
    if form == "plain":
        return [(TEXT, start, stop)]
    whole, at = bytes(text[start:stop]), 0
    out: list[Piece] = []
    for x in ARRANGED[form]:
        if isinstance(x, int):
            continue
        mark = SENTINELS[x[1] : x[2]]
        found = whole.find(mark, at)
        if found < 0 or (not out and found):
            raise ValueError(f"no {mark.decode()} where {form} has it")
        if out:
            out.append((TEXT, start + at, start + found))
        out.append((TEXT, start + found, start + found + len(mark)))
        at = found + len(mark)
    return [*out, (TEXT, start + at, stop)]


def digest(pieces: list[Piece], buffers: list[memoryview]) -> str:
    sha = hashlib.sha256()
    for buffer, start, stop in pieces:
        for at in range(start, stop, STEP):
            sha.update(buffers[buffer][at : min(at + STEP, stop)])
    return sha.hexdigest()


def numbers(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits from a document's id."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    found = hashlib.sha256(name.encode()).hexdigest()
    return [int(found[i : i + 8], 16) for i in range(0, 32, 8)]


def _forms(
    batches: Iterator[pa.RecordBatch], seed: int, rate: int, suffix_first: int, whole: bool
) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    names += ["output"] if whole else ["output_sha256", "restored_sha256"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    types += [pa.binary()] if whole else [pa.string()] * 2
    for batch in batches:
        for some in chunks(batch, 1):
            buffers, spans = _spans(_binary(some.column(1)))
            rows = []
            for doc_id, (start, stop) in zip(some.column(0).to_pylist(), spans, strict=True):
                n, form, first, second, pieces = _pieces(
                    buffers[TEXT], start, stop, numbers(doc_id, seed), rate, suffix_first
                )
                output = arranged(pieces, form)
                if whole:
                    result = (_built(output, buffers),)
                else:
                    result = digest(output, buffers), digest(restored(output, form), buffers)
                plain = form == "plain"
                rows.append((doc_id, n, form, None if plain else first, None if plain else second - first, *result))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            if whole:
                columns[-1] = columns[-1].view(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _pieces(text: memoryview, start: int, stop: int, h: list[int], rate: int, suffix_first: int) -> tuple:
    """Code points, form, both cuts in code points, and the pieces of the text at ``start``."""
    own = np.frombuffer(text, np.uint8)[start:stop]
    counts = np.array([np.count_nonzero(_leads(own[a : a + STEP])) for a in range(0, len(own), STEP)], np.int64)
    n = int(counts.sum())
    pieces = [(TEXT, start, stop)]
    if not n or h[2] % 100 >= rate or _holds_sentinel(text, start, stop):
        return n, "plain", 0, 0, pieces
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    for at in (second, first):
        pieces = cut(pieces, _place(own, counts, at))
    return n, "spm" if h[3] % 100 < suffix_first else "psm", first, second, pieces


def _leads(some: np.ndarray) -> np.ndarray:
    """Which bytes begin a code point."""
    return (some & 0xC0) != 0x80


def _place(own: np.ndarray, counts: np.ndarray, at: int) -> int:
    """The byte at which code point ``at`` begins."""
    before = np.cumsum(counts)
    step = int(np.searchsorted(before, at, side="right"))
    if step == len(counts) or not at:
        return len(own) if at else 0
    inside = at - int(before[step] - counts[step])
    return step * STEP + int(np.flatnonzero(_leads(own[step * STEP : (step + 1) * STEP]))[inside])


def _holds_sentinel(text: memoryview, start: int, stop: int) -> bool:
    # Steps overlap by what a sentinel may stick out.
    for at in range(start, stop, STEP):
        some = bytes(text[at : min(at + STEP + 2, stop)])
        if PREFIX in some or SUFFIX in some or MIDDLE in some:
            return True
    return False


def _binary(texts: pa.Array) -> pa.Array:
    return texts.cast(pa.large_binary()) if pa.types.is_large_string(texts.type) else texts.view(pa.binary()).cast(pa.large_binary())


def _spans(texts: pa.Array) -> tuple[list[memoryview], list[tuple[int, int]]]:
    """The buffers, and where each text starts and stops in the first; NULL is empty."""
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    valid = np.asarray(texts.is_valid())
    starts, stops = ends[:-1], np.where(valid, ends[1:], ends[:-1])
    return [memoryview(data or b""), memoryview(SENTINELS)], list(zip(starts.tolist(), stops.tolist(), strict=True))


def _built(pieces: list[Piece], buffers: list[memoryview]) -> bytes:
    return b"".join(buffers[buffer][start:stop] for buffer, start, stop in pieces)
