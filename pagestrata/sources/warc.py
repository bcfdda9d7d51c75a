"""Archived records out of gzip-member WARC files, by (filename, offset, length).

Tasks only read, inflate and cut the record into head, head and body; the heads are
parsed into columns by Spark.
"""

from __future__ import annotations

import re
import time
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagestrata.functions.records import (
    header_map,
    http_status,
    http_version,
    record_version,
    repair_utf8,
)
from pagestrata.sources.files import file_system, qualified

# Retry schedule and time budget, of one record and of all failures of a batch.
ATTEMPTS = 5
FIRST_DELAY_SECONDS = 0.1
BUDGET_SECONDS = 180

# Reads of one task: a read over a network takes about as long whatever its length.
RECORDS_PER_TASK = 250
BYTES_PER_TASK = 256 << 20
# Tasks of one job; beyond, each has more to read.
MOST_TASKS = 50_000

# Payload bytes handed back to Spark at a time.
BATCH_BYTES = 32 << 20

_HEAD_END = re.compile(rb"\r\n\r\n|\n\n")
_CONTENT_LENGTH = re.compile(rb"(?im)^content-length:[ \t]*([0-9]+)")
_PARTS = T.StructType(
    [
        T.StructField("_record_head", T.BinaryType()),
        T.StructField("_http_head", T.BinaryType()),
        T.StructField("_body", T.BinaryType()),
        T.StructField("_error", T.StringType()),
    ]
)


def fetch_records(
    df: DataFrame,
    root: str,
    partitions: int | None = None,
    attempts: int = ATTEMPTS,
    budget_seconds: float = BUDGET_SECONDS,
    batch_seconds: float = BUDGET_SECONDS,
) -> DataFrame:
    """Add ``warc`` (``version``, ``headers``) and ``response`` (``body``, ``headers``,
    ``http_version``, ``http_status``, ``error``) to rows that point into files under
    ``root``. Filter first: every row left is read.

    Rows are spread by file and offset, so a task reads forward through few files, a
    very large file is shared by many tasks, and so are many pointers to one record. There
    is a task for every ``RECORDS_PER_TASK`` records and every ``BYTES_PER_TASK`` to read, up to
    ``MOST_TASKS``, which one aggregate over ``df`` tells, unless ``partitions`` says how many.

    A read that fails is tried again, up to ``attempts`` times and for ``budget_seconds``. Failed tries
    and the waits after them may cost ``batch_seconds`` in ``RECORDS_PER_TASK`` reads in a row;
    beyond, each of these reads is tried once. So a store that is down holds a task up for
    a bounded time, and no record that can be read is given up for others.
    """
    if partitions is None:
        n, size = df.agg(F.count("*"), F.sum(F.greatest("length", F.lit(0)))).first()
        partitions = max(1, -(-n // RECORDS_PER_TASK), -(-(size or 0) // BYTES_PER_TASK))
        partitions = min(partitions, MOST_TASKS)
    flat = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    spot = ["filename", "offset", F.xxhash64(*flat)]
    sorted_rows = df.repartitionByRange(partitions, *spot).sortWithinPartitions("filename", "offset")
    schema = T.StructType([*df.schema.fields, *_PARTS.fields])
    root = qualified(df.sparkSession, root)
    read = sorted_rows.mapInArrow(_reader(root, attempts, budget_seconds, batch_seconds), schema)
    return _with_parsed(read).drop(*_PARTS.names)


def _with_parsed(read: DataFrame) -> DataFrame:
    record_head, head = repair_utf8(F.col("_record_head")), repair_utf8(F.col("_http_head"))
    warc = F.struct(
        record_version(record_head).alias("version"), header_map(record_head).alias("headers")
    )
    response = F.struct(
        F.col("_body").alias("body"),
        header_map(head).alias("headers"),
        http_version(head).alias("http_version"),
        http_status(head).alias("http_status"),
        F.col("_error").alias("error"),
    )
    return read.withColumn("warc", warc).withColumn("response", response)



def _reader(root: str, attempts: int, budget_seconds: float, batch_seconds: float = BUDGET_SECONDS):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(root, attempts, budget_seconds, batch_seconds)
        for batch in batches:
            names, offsets, lengths = (
                batch.column(batch.schema.get_field_index(c)).to_pylist()
                for c in ("filename", "offset", "length")
            )
            parts, size, start = [], 0, 0
            for i, spot in enumerate(zip(names, offsets, lengths)):
                parts.append(files.record(*spot))
                size += len(parts[-1][2] or b"")
                if size >= BATCH_BYTES or i + 1 == batch.num_rows:
                    yield _joined(batch.slice(start, len(parts)), parts)
                    start, parts, size = i + 1, [], 0
        files.close()

    return run


def _joined(batch: pa.RecordBatch, parts: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*parts))
    added = [pa.array(c, pa.binary()) for c in columns[:3]] + [pa.array(columns[3], pa.string())]
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *added], names=[*batch.schema.names, *_PARTS.names]
    )


class _Files:
    """Reads records, keeping the current file open and the last record at hand."""

    def __init__(self, root: str, attempts: int, budget_seconds: float, batch_seconds: float = BUDGET_SECONDS):
        self.fs, self.base = file_system(root)
        self.attempts, self.budget, self.batch_budget = attempts, budget_seconds, batch_seconds
        # Reads so far, and the seconds that failed ones cost in the batch they are in.
        self.reads = self.lost = 0
        self.name = self.handle = self.spot = self.parts = None

    def record(self, name, offset, length) -> tuple:
        if not name or offset is None or offset < 0 or not length or length < 0:
            return None, None, None, "Missing filename, offset or length"
        if self.spot != (name, offset, length):
            self.spot, self.parts = (name, offset, length), self._load(name, offset, length)
        return self.parts

    def _load(self, name, offset, length) -> tuple:
        try:
            raw = self._read(name, offset, length)
        except (OSError, TimeoutError) as error:
            return None, None, None, str(error)
        try:
            member = zlib.decompressobj(31)
            record = member.decompress(raw) + member.flush()
        except zlib.error as error:
            return None, None, None, f"Gzip error: {error}"
        if not member.eof:
            return None, None, None, "Gzip error: truncated member"
        return cut_record(record)

    def _read(self, name, offset, length) -> bytes:
        if self.reads % RECORDS_PER_TASK == 0:
            self.lost = 0
        self.reads += 1
        started, delay = time.monotonic(), FIRST_DELAY_SECONDS
        for attempt in range(1, self.attempts + 1):
            tried = time.monotonic()
            if tried - started >= self.budget:
                raise TimeoutError(f"No time left: {int(tried - started)} of {int(self.budget)} seconds used")
            try:
                self._open(name)
                self.handle.seek(offset)
                return self.handle.read(length)
            except FileNotFoundError:
                raise
            except OSError as error:
                self.close()
                self.lost += time.monotonic() - tried
                if attempt == self.attempts or self.lost + delay > self.batch_budget:
                    raise OSError(f"Not read in {attempt} attempts: {error}") from error
                time.sleep(delay)
                self.lost += delay
                delay *= 2

    def _open(self, name) -> None:
        if self.name != name:
            self.close()
            self.handle = self.fs.open_input_file(f"{self.base}/{name}")
            self.name = name

    def close(self) -> None:
        if self.handle is not None:
            self.handle.close()
        self.name = self.handle = None


def cut_record(record: bytes) -> tuple:
    """(record head, HTTP head, body, error) of one inflated record.

    The record's own Content-Length ends the body, which leaves out the blank lines
    that follow a record.
    """
    first = _HEAD_END.search(record)
    if first is None:
        return None, None, None, "No record header"
    head, block = record[: first.start()], record[first.end() :]
    length = _CONTENT_LENGTH.search(head)
    if length is not None:
        if len(block) < int(length.group(1)):
            return head, None, None, "Record shorter than its Content-Length"
        block = block[: int(length.group(1))]
    second = _HEAD_END.search(block)
    if second is None:
        return head, None, None, "No HTTP header"
    return head, block[: second.start()], block[second.end() :], None
