"""The gzip members of large files, found by many tasks at once.

A file of gzip members is cut into byte ranges. A task looks for the first member that begins
in its range, then goes from member to member. Bytes inside a member may look like another one;
so each range also tells where its last member ends, and a range whose first member
is not there is read again from the place where the range before it ended.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagestrata.session import written
from pagestrata.sources.files import file_system, qualified

#: Bytes of a range. Tasks read small ranges one after the other, up to so many bytes once every core
#: has ``TASKS_PER_CORE``, and more beyond ``MOST_TASKS``.
SPLIT_BYTES = 64 << 20
TASK_BYTES = 16 << 20
TASKS_PER_CORE = 3
MOST_TASKS = 50_000
#: Bytes read, and inflated, at a time.
READ = 1 << 20
STEP = 1 << 16
#: Rows, and bytes of what they describe, handed back to Spark at a time.
BATCH_ROWS = 4096
BATCH_BYTES = 16 << 20

_MAGIC = b"\x1f\x8b\x08"
_RANGE = "filename string, size long, start long, stop long, at long"
_MEMBER = "filename string, start long, offset long, length long, error string"
_SUMMARY = "stop long, size long, first long, next long, broken boolean, is_range boolean"

#: Takes the inflated bytes of one member piece by piece; ``row`` describes it when it has ended.
Describer = Callable[[], object]


def list_files(spark: SparkSession, root: str, suffix: str = ".gz") -> DataFrame:
    """``filename`` (below ``root``) and ``size`` of the files under ``root``; no contents are read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    top = qualified(spark, root).rstrip("/").partition(":")[2].lstrip("/")
    place = F.regexp_replace("path", r"^[A-Za-z0-9]+:/*", "")
    return found.select(
        F.substring(place, len(top) + 2, 1 << 30).alias("filename"), F.col("length").alias("size")
    ).filter(F.col("filename").endswith(suffix))


def gzip_members(
    spark: SparkSession,
    root: str,
    describer: Describer,
    described: str,
    suffix: str = ".gz",
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """A row per gzip member of the files under ``root``: ``filename``, ``offset``, ``length`` (in the
    file), ``error`` and the fields of ``described``, which a ``describer()`` has for the inflated bytes.

    Every member is found exactly once, by the range it begins in, wherever ranges are cut.
    A member that the file ends in, and bytes that are no member, give a row with an
    ``error`` and nothing described; after such bytes the next member is looked for. Empty files
    give no rows.
    """
    files = list_files(spark, root, suffix).filter("size > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long")))
    ranges = written(
        files.withColumn("start", starts).select(
            "filename", "size", "start", F.least(F.col("start") + split_bytes, "size").alias("stop"),
            F.when(F.col("start") == 0, 0).cast("long").alias("at"),
        )
    )
    base = qualified(spark, root)
    schema = T.StructType.fromDDL(f"{_MEMBER}, {described}, {_SUMMARY}")
    n_described = len(T.StructType.fromDDL(described))
    task = _range_reader(base, describer, schema, n_described)

    def scanned(some: DataFrame) -> DataFrame:
        n, size = some.agg(F.count("*"), F.sum(F.col("stop") - F.col("start"))).first()
        enough = max(-(-(size or 0) // TASK_BYTES), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
        n = max(min(n, enough, MOST_TASKS), 1)
        spread = some.repartitionByRange(n, "filename", "start").sortWithinPartitions("filename", "start")
        return spread.mapInArrow(task, schema)

    found = written(scanned(ranges))
    while True:
        again = written(_misread(found.filter("is_range")))
        if again.isEmpty():
            break
        # The first of each file is right now; those behind it are looked at again, since it may end elsewhere.
        redo = scanned(again)
        found = written(found.join(again.select("filename", "start"), ["filename", "start"], "left_anti").unionByName(redo))
    names = T.StructType.fromDDL(f"filename string, offset long, length long, error string, {described}").names
    return found.filter("NOT is_range").select(*names)


def _misread(ranges: DataFrame) -> DataFrame:
    """The ranges whose first member is not where the members before them end. All at once, since a file
    may have many; where the end itself was wrong, they are found again."""
    before = Window.partitionBy("filename").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    told = F.when(F.col("next").isNotNull() | F.col("broken"), F.struct("next", "broken"))
    behind = ranges.withColumn("_end", F.last(told, ignorenulls=True).over(before))
    end = F.col("_end.next")
    inside = (end < F.col("stop")) & ~F.col("first").eqNullSafe(end)
    beyond = (end >= F.col("stop")) & F.col("first").isNotNull()
    wrong = behind.filter(~F.col("_end.broken") & (inside | beyond))
    return wrong.withColumn("at", end).select(*T.StructType.fromDDL(_RANGE).names)


def _range_reader(base: str, describer: Describer, schema: T.StructType, n_described: int):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = file_system(base)
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for name, total, start, stop, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with files.open_input_file(f"{folder}/{name}") as file:
                    source = Source(file, total)
                    for own in _members(source, start, stop, at, describer, n_described):
                        rows.append((name, start, *own))
                        size += sum(len(x) for x in own if isinstance(x, bytes | str))
                        if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                            yield _batch(rows, arrow)
                            rows, size = [], 0
        if rows:
            yield _batch(rows, arrow)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


class Source:
    """Bytes of a file from any place, a window of which is held."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.window, self.start = b"", 0

    def at(self, offset: int, least: int = STEP) -> memoryview:
        """The bytes from ``offset`` that are at hand, ``least`` of them unless the file ends before."""
        least = min(least, self.size - offset)
        inside = offset - self.start
        if not 0 <= inside <= len(self.window) - least:
            self.file.seek(offset)
            self.window, self.start, inside = self.file.read(max(READ, least)), offset, 0
        return memoryview(self.window)[inside:]

    def find(self, start: int, stop: int) -> int | None:
        """Where the next bytes stand that may begin a member."""
        while start < stop:
            some = bytes(self.at(start, STEP))
            place = some.find(_MAGIC)
            if place >= 0:
                return start + place if start + place < stop else None
            start += max(1, len(some) - len(_MAGIC) + 1)
        return None

    def inflate(self, offset: int, take: Callable[[bytes], None]) -> int | None:
        """Where the member at ``offset`` ends; None if the file ends first. Raises ``zlib.error``
        for what is no member or has another checksum."""
        member, place = zlib.decompressobj(31), offset
        while not member.eof:
            some = self.at(place, 1)[:STEP]
            if not len(some):
                return None
            place += len(some)
            take(member.decompress(some, READ))
            while member.unconsumed_tail and not member.eof:
                take(member.decompress(member.unconsumed_tail, READ))
        return place - len(member.unused_data) - len(member.unconsumed_tail)


def _members(
    source: Source, start: int, stop: int, at: int | None, describer: Describer, n_described: int
) -> Iterator[tuple]:
    """Members that begin from ``start`` to before ``stop``, the first at ``at`` if that is known; then
    the range's own row. Without ``at``, a member counts as found if all of it can be inflated."""
    nothing, no_range = (None,) * n_described, (None,) * 5 + (False,)
    first = after = None
    broken = False
    bad: int | None = None
    known, search = at is not None, start
    place = at if at is None or at < stop else None
    if known and place is None:
        search = stop
    while True:
        if place is None:
            place = source.find(search, stop)
            if place is None:
                break
            known = False
        described = describer()
        try:
            end = source.inflate(place, described.take)
        except zlib.error:
            if known:
                bad, broken, after = place, True, None
            search, place = place + 1, None
            continue
        if end is None and not known:
            # Perhaps the file's last member, cut short: the range before knows whether one begins here.
            search, place = place + 1, None
            continue
        if bad is not None:
            yield bad, place - bad, "no gzip member", *nothing, *no_range
            first = bad if first is None else first
            bad, broken = None, False
        first = place if first is None else first
        if end is None:
            after = source.size
            yield place, source.size - place, "truncated member", *nothing, *no_range
            break
        yield place, end - place, None, *described.row(), *no_range
        after = place = end
        known = True
        if end >= stop:
            break
    if bad is not None:
        yield bad, None, "no gzip member", *nothing, *no_range
        first = bad if first is None else first
    yield None, None, None, *nothing, stop, source.size, first, after, broken, True
