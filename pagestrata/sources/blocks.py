"""Index lines in blocks that are compressed one by one, looked up by key without reading the rest."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagestrata.functions.urls import surt_hosts
from pagestrata.operators.filters import url_pattern
from pagestrata.session import written
from pagestrata.sources.cdx import parse_cdx
from pagestrata.sources.files import file_system, qualified
from pagestrata.sources.members import MOST_TASKS, SPLIT_BYTES, gzip_members

#: Lines of a block.
BLOCK_LINES = 3000
#: Blocks, and their compressed bytes, that a task reads.
BLOCKS_PER_TASK = 250
BYTES_PER_TASK = 64 << 20
#: Text bytes handed back to Spark at a time.
BATCH_BYTES = 16 << 20
#: Compares above everything that begins with the same characters.
_ABOVE = "\U0010ffff"

_BLOCK = "filename string, offset long, length long, n_lines long, min_key string, max_key string"


class LineBlock:
    """The number of index lines in a block and the least and largest of their keys, which
    are what stands before the first blank."""

    def __init__(self):
        self.n, self.least, self.largest, self.rest = 0, None, None, b""

    def take(self, data: bytes) -> None:
        *lines, self.rest = (self.rest + data).split(b"\n")
        for line in lines:
            self.add(line)

    def add(self, line: bytes) -> None:
        # The format line that a file may begin with has no key.
        if not line or line.startswith(b" CDX "):
            return
        key = line.partition(b" ")[0]
        self.n += 1
        if self.least is None or key < self.least:
            self.least = key
        if self.largest is None or key > self.largest:
            self.largest = key

    def row(self) -> tuple:
        self.add(self.rest)
        keys = [None if k is None else k.decode("utf-8", "replace") for k in (self.least, self.largest)]
        return (self.n, *keys)


def write_blocks(
    lines: DataFrame, root: str, block_lines: int = BLOCK_LINES, files: int | None = None
) -> DataFrame:
    """Write ``lines`` (``value``: key, blank, the rest) in order to files of gzip members of
    ``block_lines`` lines each below ``root``. Returns the blocks as ``scan_blocks`` does.

    Files have the attempt in their names; only those of the blocks that come back count.
    """
    root = qualified(lines.sparkSession, root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(root)
        fs.create_dir(folder, recursive=True)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.gz"
        held: list[str] = []
        blocks: list[tuple] = []
        with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:

            def put(some: list[str]) -> None:
                block, text = LineBlock(), "".join(f"{line}\n" for line in some).encode()
                block.take(text)
                packer = zlib.compressobj(wbits=31)
                data = packer.compress(text) + packer.flush()
                blocks.append((name, out.tell(), len(data), *block.row()))
                out.write(data)

            for batch in batches:
                held += batch.column(0).to_pylist()
                while len(held) >= block_lines:
                    put(held[:block_lines])
                    held = held[block_lines:]
            if held:
                put(held)
        if blocks:
            columns = zip(*blocks, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_names())

    spread = lines.select("value").filter("value IS NOT NULL")
    spread = spread.repartitionByRange(files, "value") if files else spread.repartitionByRange("value")
    return written(spread.sortWithinPartitions("value").mapInArrow(write, _BLOCK))


def _names() -> list[str]:
    return [f.split()[0] for f in _BLOCK.split(", ")]


def scan_blocks(spark: SparkSession, root: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The blocks (gzip members) of the index files under ``root``: ``filename``, ``offset``, ``length``,
    ``n_lines``, ``min_key``, ``max_key`` and ``error``. One file is read by many tasks, and
    the files need not be sorted. Write them with ``write_block_index`` to look up in them.
    """
    fields = "n_lines long, min_key string, max_key string"
    return gzip_members(spark, root, LineBlock, fields, split_bytes=split_bytes)


def read_cluster_index(spark: SparkSession, path: str) -> DataFrame:
    """The blocks that a sparse index of an index names: lines of key and time, then tab-separated file,
    offset, length. A block's last key is only known to be at most the next one's first."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).filter(F.size(parts) >= 4).select(
        parts[1].alias("filename"), parts[2].try_cast("long").alias("offset"), parts[3].try_cast("long").alias("length"),
        F.lit(None).cast("long").alias("n_lines"), F.split_part(parts[0], F.lit(" "), F.lit(1)).alias("min_key"),
    )
    along = Window.partitionBy("filename").orderBy("offset")
    return rows.withColumn("max_key", F.coalesce(F.lead("min_key").over(along), F.lit(_ABOVE)))


def write_block_index(blocks: DataFrame, path: str) -> None:
    """``blocks`` as Parquet in the order of their keys, so that a lookup reads few row groups of it."""
    order = ["min_key", "filename", "offset"]
    blocks.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)


def key_prefixes(pattern: str) -> list[str]:
    """What the SURT keys of URLs that ``url_pattern`` finds for ``pattern`` begin with."""
    start = pattern.removesuffix("*")
    if pattern.startswith("*."):
        host = pattern[2:].partition("/")[0]
        return [f"{key}{end}" for key in surt_hosts(host) for end in ",):"]
    whole = "://" in start
    host, slash, path = start.partition("://")[2 if whole else 0].partition("/")
    host = host.rpartition("@")[2].partition(":")[0]
    if whole and not slash and pattern.endswith("*"):
        raise ValueError(f"a URL that ends within its host has no key to look up: {pattern!r}")
    tail = slash.join(["", path.partition("#")[0].lower()]) if not whole else ""
    return [f"{key}{end}" for key in surt_hosts(host) for end in (f"){tail}", ":")]


def read_blocks(blocks: DataFrame, root: str, prefixes: Sequence[str]) -> DataFrame:
    """The lines (``value``) under ``root`` whose keys begin with one of ``prefixes``, out of those
    ``blocks`` alone that can hold them. Conditions on the keys reach the scan of ``blocks``."""
    prefixes = sorted(set(prefixes))
    if not prefixes:
        raise ValueError("a lookup needs a key, or its beginning")
    wanted = blocks_for(blocks, prefixes).select("filename", "offset", "length")
    n, size = wanted.agg(F.count("*"), F.sum("length")).first()
    tasks = min(MOST_TASKS, max(1, -(-n // BLOCKS_PER_TASK), -(-(size or 0) // BYTES_PER_TASK)))
    spread = wanted.repartitionByRange(tasks, "filename", "offset").sortWithinPartitions("filename", "offset")
    starts = tuple(p.encode() for p in prefixes)
    return spread.mapInArrow(_block_reader(qualified(blocks.sparkSession, root), starts), "value string")


def blocks_for(blocks: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """The ``blocks`` that can hold keys that begin with one of ``prefixes``."""
    found = None
    for p in prefixes:
        one = (F.col("max_key") >= p) & (F.col("min_key") < p + _ABOVE)
        found = one if found is None else found | one
    return blocks.filter(found & (F.col("length") > 0))


def find_in_blocks(
    blocks: DataFrame, root: str, url: str, parse: Callable[[DataFrame], DataFrame] = parse_cdx
) -> DataFrame:
    """Captures that ``url`` (a pattern of ``url_pattern``) finds in the index files under ``root``,
    whose lines ``parse`` makes captures of; only blocks that can hold them are read."""
    lines = read_blocks(blocks, root, key_prefixes(url))
    return parse(lines).filter(url_pattern(url, keyed=True))


def _block_reader(root: str, starts: tuple[bytes, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(root)
        held, size = [], 0
        name = file = None
        for batch in batches:
            for spot in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if spot[0] != name:
                    if file:
                        file.close()
                    name, file = spot[0], fs.open_input_file(f"{folder}/{spot[0]}")
                file.seek(spot[1])
                for line in zlib.decompress(file.read(spot[2]), 31).split(b"\n"):
                    if line.startswith(starts):
                        held.append(line.decode("utf-8", "replace"))
                        size += len(line)
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pydict({"value": held})
                    held, size = [], 0
        if file:
            file.close()
        if held:
            yield pa.RecordBatch.from_pydict({"value": held})

    return run
