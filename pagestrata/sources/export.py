"""Writing captures as files and bodies as objects."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagestrata.sources.files import file_system, qualified


#: Objects that a task remembers having written (32 bytes each).
REMEMBERED = 100_000


def write_captures(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Flat export. Nested columns need a format that holds them, such as parquet."""
    writer = df.write.format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def export_bodies(df: DataFrame, folder: str, suffix: str = ".html") -> DataFrame:
    """Write ``response.body`` of every row as an object below ``folder`` and return
    the manifest, a row for each: ``url``, ``timestamp``, ``path`` and ``bytes``.

    Names follow from the content, so rows with equal bodies share one object, and a task
    that runs twice writes the same objects. Rows without a body are left out of both.
    """
    rows = df.select(
        "url", F.date_format("timestamp", "yyyyMMddHHmmss").alias("taken"), "response.body"
    ).filter(F.col("body").isNotNull())
    schema = "url string, taken string, path string, bytes long"
    folder = qualified(df.sparkSession, folder)
    written = rows.mapInArrow(_object_writer(f"{folder}/objects", suffix), schema)
    written.write.parquet(f"{folder}/manifest")
    manifest = df.sparkSession.read.parquet(f"{folder}/manifest")
    time = F.to_timestamp("taken", "yyyyMMddHHmmss").cast(df.schema["timestamp"].dataType)
    return manifest.select("url", time.alias("timestamp"), "path", "bytes")


def _object_writer(folder: str, suffix: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        shards, made = set(), set()
        for batch in batches:
            paths, sizes = [], []
            # One body at a time is held besides the batch.
            for body in batch.column("body"):
                body = body.as_py()
                tag = hashlib.sha256(body)
                name = tag.hexdigest()
                paths.append(f"{name[:2]}/{name}{suffix}")
                sizes.append(len(body))
                if tag.digest() in made:
                    continue
                if name[:2] not in shards:
                    fs.create_dir(f"{base}/{name[:2]}", recursive=True)
                    shards.add(name[:2])
                _put(fs, f"{base}/{name[:2]}", f"{name}{suffix}", body)
                if len(made) >= REMEMBERED:
                    made.clear()
                made.add(tag.digest())
            columns = [batch.column("url"), batch.column("taken"), pa.array(paths, pa.string()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["url", "taken", "path", "bytes"])

    return run


def _put(fs: FileSystem, folder: str, name: str, body: bytes) -> None:
    """Write an object that other tasks may be writing too: under its name it is always whole."""

    def there() -> bool:
        return fs.get_file_info(f"{folder}/{name}").size == len(body)

    if there():
        return
    # Spark's readers pass over names that begin with a dot.
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(body)
    try:
        fs.move(part, f"{folder}/{name}")
    except OSError:
        # Some stores move onto no file; there it has the same bytes.
        fs.delete_file(part)
        if not there():
            raise
