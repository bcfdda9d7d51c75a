"""Token ids of whole texts in binary files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents::

    magic | blocks | block starts (u64) | doc ids (i64) | NULL flags (u8) | lengths (i64)
          | footer: ids, blocks, documents, place of the block starts (u64 each) | magic

A block holds up to ``BLOCK`` ids: their minimum (u32), the width in bits (u8), the number of
ids (u32) and of exceptions (u32); the low bits of each id minus the minimum, packed; then the
places (u32) and the values minus the minimum (u32) of the ids that need more bits. The width
is the one that the ``PERCENTILE`` smallest need.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagestrata.llm.common import small_batches, stored
from pagestrata.session import shared_folder
from pagestrata.sources.files import file_system, qualified

MAGIC = b"PFORIDS1"
FOOTER = "<QQQQ"
HEAD = "<IBII"
HEAD_SIZE = struct.calcsize(HEAD)
BLOCK = 4096
PERCENTILE = 99
#: Text bytes of one file, and so of one task; a longer document is a file of its own size.
SHARD_BYTES = 64 << 20
#: Tasks that write or read; beyond that, each has several files.
MOST_TASKS = 20_000
#: Ranges of ids of a writing task, which fetches and sorts one after the other.
RANGES = 4
#: Bytes of text that a task gets and encodes at a time, and pieces of text whose ids it remembers.
CHUNK_CHARS = 1 << 20
REMEMBERED = 1 << 21
#: Bytes of a piece that is remembered, and pieces that are encoded as one text.
LONGEST = 64
JOINED = 512
END_ID = 0


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    root: str | None = None,
    shard_bytes: int = SHARD_BYTES,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """Write the ids of ``docs`` (``doc_id``, ``text``) below ``root`` by ascending ``doc_id``.

    ``tokenizer_path`` is read on the driver and sent to the tasks (some megabytes), each of
    which remembers the ids of ``remembered`` pieces of text (some 40 bytes each) until it
    ends. Every document ends with id 0. Documents are range-partitioned by id; a task encodes its
    ranges one after the other, and begins a new file after every ``shard_bytes`` of text and for a range
    that does not follow on the one before. Files have the attempt in their names, so that no attempt
    touches those of another; only those in the manifest count. Returns the manifest (``shard``, which
    orders the files, ``path``, ``n_docs``, ``n_ids``, ``start``: the ids in all files before).

    NULL texts are empty, NULL ids come first, rows that repeat an id stand by text. Extra
    columns are not read. No documents give no files and no rows.
    """
    spark = docs.sparkSession
    root = qualified(spark, root or shared_folder(spark))
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    texts = docs.select("doc_id", text)
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = min(MOST_TASKS, max(1, -(-total // shard_bytes)))
    ranges = max(tasks, min(MOST_TASKS, RANGES * tasks))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer.value, remembered)
        task = TaskContext.get()
        files, folder = file_system(root)
        files.create_dir(folder, recursive=True)
        out = writer = None
        shard = size = 0
        last = -1

        def closed() -> pa.RecordBatch:
            writer.close()
            out.close()
            row = {"shard": [shard], "path": [path], "n_docs": [writer.n_docs], "n_ids": [writer.n_ids]}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for part, rows in _by_range(batch):
                # The ranges of a task need not be neighbours.
                if writer is not None and part not in (last, last + 1):
                    yield closed()
                    writer, size = None, 0
                if writer is None and part != last:
                    shard = part << 32
                last = part
                for some in _chunks(rows):
                    if writer is None:
                        path = f"{root}/{shard:016x}-{task.taskAttemptId()}.pfor"
                        out = files.open_output_stream(f"{folder}/{path.rpartition('/')[2]}")
                        writer = Writer(out)
                    ids, lengths = encode(some.column(1))
                    writer.add(some.column(0), ids, lengths)
                    pa.default_memory_pool().release_unused()
                    size += some.column(1).nbytes
                    # The last task of a small corpus has somewhat more than its share.
                    if size >= 2 * shard_bytes:
                        yield closed()
                        writer, shard, size = None, shard + 1, 0
        if writer is not None:
            yield closed()

    key = ["doc_id", F.xxhash64("text")]
    ordered = texts.repartitionByRange(ranges, *key).sortWithinPartitions(*key)
    # A task holds one range at a time, fetched and sorted, and remembers pieces over all of its ranges.
    ordered = ordered.withColumn("part", F.spark_partition_id()).coalesce(tasks)
    with small_batches(spark, CHUNK_CHARS):
        written = stored(ordered.mapInArrow(write, "shard long, path string, n_docs long, n_ids long"))
    # One row per file.
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """The documents in the files of ``manifest``: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids`` (little-endian u32), a file per task."""
    schema = "doc_id long, start long, n_tokens long, ids binary"
    return _spread(manifest).mapInArrow(lambda batches: _read(batches, True), schema)


def token_digests(manifest: DataFrame) -> DataFrame:
    """As ``read_token_files``, with the unsigned ``ids_crc32`` in place of the ids."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return _spread(manifest).mapInArrow(lambda batches: _read(batches, False), schema)


def _spread(manifest: DataFrame) -> DataFrame:
    n = min(max(manifest.count(), 1), MOST_TASKS)
    return manifest.select("shard", "path", "start").repartitionByRange(n, "shard")


def _read(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            files, place = file_system(path)
            with files.open_input_file(place) as source:
                reader = Reader(source)
                rows: list[tuple] = []
                size = 0
                for doc_id, ids in reader.documents():
                    data = ids.astype("<u4").tobytes()
                    rows.append((doc_id, start, len(ids), data if whole else zlib.crc32(data)))
                    start += len(ids)
                    size += len(data) if whole else 64
                    if size > 4 << 20:
                        yield _rows(rows, whole)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows, whole)


def _rows(rows: list[tuple], whole: bool) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary() if whole else pa.int64()]
    names = ["doc_id", "start", "n_tokens", "ids" if whole else "ids_crc32"]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _by_range(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of one range each, with its number."""
    parts = np.asarray(batch.column(2))
    turns = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
    for at, stop in zip(turns, turns[1:], strict=False):
        if at < stop:
            yield int(parts[at]), batch.slice(at, stop - at)


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``CHUNK_CHARS`` bytes of text, of one row at least."""
    ends = np.cumsum(np.asarray(pc.binary_length(batch.column(1)), np.int64))
    row = 0
    while row < batch.num_rows:
        done = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, done + CHUNK_CHARS)))
        yield batch.slice(row, stop - row)
        row = stop


class Encoder:
    """Encodes texts with the tokenizers library, each distinct piece of text once.

    The byte-level pattern starts a new token at every single blank or line end between two
    other characters, and the line end is one, so a text's ids are those of its pieces cut before them.
    A text with any other blank (at an end, or beside white space) is encoded as a whole, and so is
    every text if the definition has another pattern or changes texts first.
    """

    def __init__(self, definition: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        # Most vocabularies fit two bytes, which halves what is remembered.
        self.kind = np.uint16 if max(self.tokenizer.get_vocab().values(), default=0) < 1 << 16 else np.uint32
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 and cuts_at_blanks(json.loads(definition)) else None
        self.remembered = remembered
        self._forget()

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts with an end id after each, and the number of ids of each."""
        # Single line ends get a blank in front, at which the text is cut; runs of them stay.
        lines = pc.replace_substring(pc.replace_substring(texts, "\n", " \n"), " \n \n", "\n\n")
        pieces = pc.split_pattern(lines, " ")
        counts = np.asarray(pc.list_value_length(pieces), np.int64)
        coded = pieces.flatten().dictionary_encode()
        at = np.asarray(coded.indices, np.int64)
        words = coded.dictionary
        after_line = pc.and_not(pc.starts_with(words, "\n"), pc.starts_with(words, "\n\n"))
        words = pc.if_else(after_line, pc.utf8_slice_codeunits(words, 1), words)
        after_line = np.asarray(after_line).astype(bool)
        ends = np.cumsum(counts)
        first = np.zeros(len(at), bool)
        first[ends - counts] = True

        cut = first[1:] | (_solid(words, -1)[at[:-1]] & _solid(words, 0)[at[1:]])
        owner = np.repeat(np.arange(len(counts)), counts)
        odd = np.full(len(counts), self.line is None)
        odd[owner[1:][~cut]] = True

        usual = ~odd[owner]
        place = (at * 2 + (~first & ~after_line[at]))[usual]
        used = np.zeros(2 * len(words), bool)
        used[place] = True
        flat, begin, lengths = self._pieces(words, after_line, np.flatnonzero(used))
        whole = np.flatnonzero(odd)
        apart = [*self._encode(texts.take(pa.array(whole)).to_pylist()), np.array([END_ID], self.kind)]
        sizes = np.array([len(x) for x in apart], np.int64)
        begin = np.concatenate([begin, len(flat) + np.cumsum(sizes) - sizes])
        lengths = np.concatenate([lengths, sizes])
        flat = np.concatenate([flat, *apart])

        # The parts of all documents in order: pieces, or the one whole text, then the end.
        per_doc = np.where(odd, 1, counts) + 1
        starts = np.cumsum(per_doc) - per_doc
        order = np.full(int(per_doc.sum()), len(begin) - 1, np.int64)
        inside = np.arange(len(at)) - (ends - counts)[owner]
        order[(starts[owner] + inside)[usual]] = (np.cumsum(used) - 1)[place]
        order[starts[whole]] = len(begin) - len(apart) + np.arange(len(whole))

        sizes = lengths[order]
        stops = np.cumsum(sizes)
        ids = flat[np.repeat(begin[order] - (stops - sizes), sizes) + np.arange(stops[-1])]
        return ids, np.diff(stops[starts + per_doc - 1], prepend=0)

    def _forget(self) -> None:
        # By the first hash, in order; the ids of all pieces lie behind each other.
        self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int16)
        self.flat = np.zeros(0, self.kind)

    def _pieces(
        self, words: pa.Array, after_line: np.ndarray, keys: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each of ``keys`` where they begin and how many they are. A key is twice
        the number of a word, plus one for a blank before it."""
        first, second = (h[keys >> 1] + (keys & 1).astype(np.uint64) * _BLANK for h in _hashes(words))
        plain, line = _plain(words)[keys >> 1], after_line[keys >> 1]
        begin, length = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        known = np.zeros(len(keys), bool)
        if len(self.first):
            near = np.minimum(np.searchsorted(self.first, first), len(self.first) - 1)
            known = plain & (self.first[near] == first) & (self.second[near] == second)
            begin[known], length[known] = self.begin[near[known]], self.length[near[known]]

        # A word may come with and without a line end before it.
        new = np.flatnonzero(plain & ~known)
        _, one, same = np.unique(first[new], return_index=True, return_inverse=True)
        joined, starts, sizes = self._joined(_texts(words, keys[new[one]]))
        begin[new], length[new] = len(self.flat) + starts[same], sizes[same]
        odd = np.flatnonzero(~plain)
        texts = ["\n" + t if at else t for t, at in zip(_texts(words, keys[odd]), line[odd].tolist(), strict=True)]
        apart = self._encode(texts)
        sizes = np.array([len(x) for x in apart], np.int64)
        begin[odd], length[odd] = len(self.flat) + len(joined) + np.cumsum(sizes) - sizes, sizes
        kept = np.concatenate([self.flat, joined])
        flat = np.concatenate([kept, *apart])

        new = new[one]
        if len(self.first) + len(new) > self.remembered:
            self._forget()
        else:
            spot = np.searchsorted(self.first, first[new])
            self.first = np.insert(self.first, spot, first[new])
            self.second = np.insert(self.second, spot, second[new])
            self.begin = np.insert(self.begin, spot, begin[new])
            self.length = np.insert(self.length, spot, length[new])
            self.flat = kept
        # A line end's id stands before each of the plain ones.
        return flat, begin - (line & plain), length + (line & plain)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        # The library's results are much larger than the ids, so few are held at a time.
        found: list[np.ndarray] = []
        for at in range(0, len(texts), 4096):
            some = self.tokenizer.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False)
            found += [np.array(f.ids, self.kind) for f in some]
        return found

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of pieces without white space but for a blank in front, a line end's id before
        each; where they begin, and how many. A line end is a token of its own before such
        pieces, so that many of them are one text."""
        found = [np.zeros(0, self.kind)]
        for at in range(0, len(pieces), JOINED):
            some = pieces[at : at + JOINED]
            ids = self.tokenizer.encode("\n" + "\n".join(some), add_special_tokens=False).ids
            found.append(np.array(ids, self.kind))
            if np.count_nonzero(found[-1] == self.line) != len(some):
                raise ValueError("the tokenizer does not keep line ends apart")
        flat = np.concatenate(found)
        starts = np.flatnonzero(flat == self.line) + 1
        return flat, starts, np.diff(starts, append=len(flat) + 1) - 1


def _texts(words: pa.Array, keys: np.ndarray) -> list[str]:
    texts = words.take(pa.array(keys >> 1)).to_pylist()
    return [" " + w if k & 1 else w for w, k in zip(texts, keys.tolist(), strict=True)]


def cuts_at_blanks(rules: dict) -> bool:
    """Whether the tokenizer defined by ``rules`` leaves texts as they are and splits them by the
    byte-level pattern that ``Encoder`` knows."""
    split = rules.get("pre_tokenizer") or {}
    usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    added = [t for t in rules.get("added_tokens") or [] if t.get("lstrip") or t.get("rstrip") or " " in t["content"] or "\n" in t["content"]]
    return usual and not rules.get("normalizer") and not added


#: Random odd multipliers for the places of a word's bytes, two sets, and one for the length.
_PLACES = np.random.default_rng(17).integers(1, 1 << 63, (2, LONGEST + 1), np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.uint64(0x9E3779B97F4A7C15)


def _hashes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of 64 bits of each word; only the first ``LONGEST`` bytes are sure to count."""
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int64 if pa.types.is_large_string(words.type) else np.int32)
    ends = ends[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    lengths = np.diff(ends)
    inside = (np.arange(len(data)) - np.repeat(ends[:-1], lengths)) % LONGEST
    values = data.astype(np.uint64) + np.uint64(1)
    both = []
    for places in _PLACES:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(places[inside] * values)])
        both.append(sums[ends[1:]] - sums[ends[:-1]] + lengths.astype(np.uint64) * places[LONGEST])
    return both[0], both[1]


def _plain(words: pa.Array) -> np.ndarray:
    """Which words are not empty, at most ``LONGEST`` bytes and without white space."""
    blank = pc.match_substring_regex(words, r"[\s\x0b\x1c-\x1f\x85\pZ]")
    length = np.asarray(pc.binary_length(words))
    return (length > 0) & (length <= LONGEST) & ~np.asarray(blank).astype(bool)


def _solid(words: pa.Array, end: int) -> np.ndarray:
    """Whether the first (0) or the last (-1) character is there and no white space."""
    edge = pc.utf8_slice_codeunits(words, end, 1 if end == 0 else None)
    blank = pc.utf8_is_space(edge)
    return np.asarray(pc.and_(pc.not_equal(edge, ""), pc.invert(blank))).astype(bool)


class Writer:
    """Writes one file; holds the ids of one unfinished block and the document index."""

    def __init__(self, out, block: int = BLOCK, percentile: float = PERCENTILE):
        self.out, self.block, self.percentile = out, block, percentile
        self.left = np.zeros(0, np.uint32)
        self.starts: list[int] = []
        self.doc_ids: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.n_docs = self.n_ids = 0
        self.place = out.write(MAGIC) or len(MAGIC)

    def add(self, doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.doc_ids.append(np.asarray(doc_ids.fill_null(0), np.int64))
        self.nulls.append(np.asarray(doc_ids.is_null(), np.uint8))
        self.lengths.append(lengths.astype(np.int64))
        self.n_docs += len(lengths)
        self.n_ids += len(ids)
        ids = np.concatenate([self.left, ids.astype(np.uint32)])
        full = len(ids) - len(ids) % self.block
        for at in range(0, full, self.block):
            self._put(pack_block(ids[at : at + self.block], self.percentile))
        self.left = ids[full:]

    def _put(self, block: bytes) -> None:
        self.starts.append(self.place)
        self.out.write(block)
        self.place += len(block)

    def close(self) -> None:
        if len(self.left):
            self._put(pack_block(self.left, self.percentile))
        none = [np.zeros(0, np.int64)]
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(np.concatenate(none + self.doc_ids).astype("<i8").tobytes())
        self.out.write(np.concatenate([np.zeros(0, np.uint8), *self.nulls]).tobytes())
        self.out.write(np.concatenate(none + self.lengths).astype("<i8").tobytes())
        self.out.write(struct.pack(FOOTER, self.n_ids, len(self.starts), self.n_docs, self.place) + MAGIC)


class Reader:
    """Reads one file: whole documents in order, or single blocks by their starts."""

    def __init__(self, source):
        self.source = source
        tail = struct.calcsize(FOOTER) + len(MAGIC)
        source.seek(source.size() - tail)
        footer = source.read(tail)
        if footer[-len(MAGIC) :] != MAGIC:
            raise ValueError("not a token file, or cut short")
        self.n_ids, n_blocks, n_docs, self.end = struct.unpack(FOOTER, footer[: struct.calcsize(FOOTER)])
        source.seek(self.end)
        self.starts = np.frombuffer(source.read(8 * n_blocks), "<u8")
        self.doc_ids = np.frombuffer(source.read(8 * n_docs), "<i8")
        self.nulls = np.frombuffer(source.read(n_docs), np.uint8)
        self.lengths = np.frombuffer(source.read(8 * n_docs), "<i8")

    def block(self, i: int) -> np.ndarray:
        start = int(self.starts[i])
        stop = int(self.starts[i + 1]) if i + 1 < len(self.starts) else self.end
        self.source.seek(start)
        return unpack_block(self.source.read(stop - start))

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        have, n, block = [], 0, 0
        for doc_id, null, length in zip(self.doc_ids.tolist(), self.nulls.tolist(), self.lengths.tolist(), strict=True):
            while n < length:
                have.append(self.block(block))
                n, block = n + len(have[-1]), block + 1
            ids = np.concatenate(have) if len(have) > 1 else have[0]
            yield (None if null else doc_id), ids[:length]
            have, n = [ids[length:]], n - length


#: Widths that are whole numbers are packed by a cast, which gives the same bytes.
CASTS = {8: "<u1", 16: "<u2", 32: "<u4"}


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    low = int(ids.min())
    rest = ids - np.uint32(low)
    nth = max(0, -(-len(rest) * int(percentile) // 100) - 1)
    width = int(np.partition(rest, nth)[nth]).bit_length()
    places = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    if width in CASTS:
        packed = rest.astype(CASTS[width]).tobytes()
    else:
        bits = rest.astype("<u4").view(np.uint8).reshape(-1, 4)
        bits = np.unpackbits(bits, axis=1, bitorder="little")[:, :width]
        packed = np.packbits(bits, bitorder="little").tobytes()
    return (
        struct.pack(HEAD, low, width, len(ids), len(places))
        + packed
        + places.astype("<u4").tobytes()
        + rest[places].astype("<u4").tobytes()
    )


def unpack_block(data: bytes) -> np.ndarray:
    low, width, n, n_out = struct.unpack_from(HEAD, data)
    size = -(-n * width // 8)
    if width in CASTS:
        ids = np.frombuffer(data, CASTS[width], n, HEAD_SIZE).astype(np.uint32)
    else:
        bits = np.frombuffer(data, np.uint8, size, HEAD_SIZE)
        wide = np.zeros((n, 32), np.uint8)
        wide[:, :width] = np.unpackbits(bits, count=n * width, bitorder="little").reshape(n, width)
        ids = np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)
    places = np.frombuffer(data, "<u4", n_out, HEAD_SIZE + size)
    ids[places] = np.frombuffer(data, "<u4", n_out, HEAD_SIZE + size + 4 * n_out)
    return ids + np.uint32(low)
