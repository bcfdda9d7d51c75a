"""Index, catalog and record files written from the given tables, then read back."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagestrata import (
    export_bodies,
    fetch_records,
    latest_crawl,
    read_cdx,
    read_cdxj,
    read_crawl_catalog,
    read_index_table,
    select_crawls,
    to_index_table,
    write_captures,
)
from pagestrata.functions.urls import compact_time
from pagestrata.operators.bodies import attach_bodies
from pagestrata.session import shared_folder
from pagestrata.sources.files import file_system, qualified
from pagestrata.streaming.firsts import append_firsts, first_of, keep_firsts
from pagestrata.streaming.tail import append_to_table, tail_cdx
from workload.derived import CATALOG, captures, crawl_catalog, table, with_captures
from workload.registry import query


def naive(column: str):
    """A UTC instant as a timestamp without zone, whatever the session zone is."""
    return F.to_utc_timestamp(column, F.current_timezone()).cast("timestamp_ntz").alias(column)


def write_cdx(df: DataFrame, folder: str) -> None:
    """Index lines. Every 50th has ``-`` for status and length, every 60th a status that
    is no number, and every 40th is followed by a line that is too short."""
    n = F.col("capture_id")
    status = (
        F.when(n % 50 == 0, "-").when(n % 60 == 0, "2x").otherwise(F.col("statuscode").cast("string"))
    )
    length = F.when(n % 50 == 0, "-").otherwise(F.col("length").cast("string"))
    line = F.concat_ws(
        " ", "urlkey", compact_time(F.col("timestamp")), "url", "mimetype", status, "digest", length
    )
    short = F.when(n % 40 == 0, F.concat_ws(" ", "urlkey", compact_time(F.col("timestamp"))))
    df.select(F.explode(F.array_compact(F.array(line, short)))).write.text(folder)


_CDX_ROWS = """
SELECT url, "timestamp", urlkey, mimetype,
  CAST(CASE WHEN capture_id % 50 = 0 OR capture_id % 60 = 0 THEN 0 ELSE statuscode END AS INT)
    AS statuscode,
  digest, CASE WHEN capture_id % 50 = 0 THEN 0 ELSE length END AS length, "year", "month"
"""


@query("cdx_files", with_captures(_CDX_ROWS + "FROM captures"))
def cdx_files(spark, sf_dir):
    folder = shared_folder(spark)
    write_cdx(captures(spark, sf_dir), folder)
    return read_cdx(spark, folder).withColumn("timestamp", naive("timestamp"))


@query(
    "cdx_bad_fields",
    with_captures("""SELECT count(*) AS rows, CAST(sum(
        CASE WHEN capture_id % 60 = 0 AND capture_id % 50 <> 0 THEN 1 ELSE 0 END) AS BIGINT)
        AS bad_fields FROM captures"""),
)
def cdx_bad_fields(spark, sf_dir):
    folder = shared_folder(spark)
    write_cdx(captures(spark, sf_dir), folder)
    found = read_cdx(spark, folder, count_bad_fields=True)
    return found.agg(F.count("*").alias("rows"), F.sum("bad_fields").alias("bad_fields"))


@query("cdx_stream", with_captures(_CDX_ROWS + "FROM captures"))
def cdx_stream(spark, sf_dir):
    folder = shared_folder(spark)
    write_cdx(captures(spark, sf_dir), f"{folder}/lines")
    stream = tail_cdx(spark, f"{folder}/lines")
    append_to_table(stream, f"{folder}/table", f"{folder}/progress").awaitTermination()
    return spark.read.parquet(f"{folder}/table").withColumn("timestamp", naive("timestamp"))


def _streamed(name: str, keys: list[str], n: int, descending: bool, sql: str):
    """Captures per key out of a stream of Parquet files, two a batch, checked by the batch form in SQL."""
    order = ["timestamp", "capture_id"]

    @query(f"stream_{name}", with_captures(sql))
    def run(spark, sf_dir):
        folder = shared_folder(spark)
        shown = captures(spark, sf_dir).select("capture_id", "url", "year", "timestamp", "statuscode")
        shown.repartition(4, "capture_id").write.parquet(f"{folder}/in")
        stream = spark.readStream.schema(shown.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
        kept = keep_firsts(stream, keys, n, order, descending)
        append_firsts(kept, f"{folder}/table", f"{folder}/progress").awaitTermination()
        found = spark.read.schema(shown.schema).parquet(f"{folder}/table")
        return first_of(found, keys, n, order, descending)


_streamed(
    "latest_per_url", ["url"], 3, True,
    """SELECT capture_id, url, "year", "timestamp", statuscode FROM (
         SELECT *, row_number() OVER (PARTITION BY url ORDER BY "timestamp" DESC, capture_id DESC) AS rn FROM captures)
       WHERE rn <= 3""",
)
_streamed(
    "first_per_year", ["url", "year"], 1, False,
    """SELECT capture_id, url, "year", "timestamp", statuscode FROM (
         SELECT *, row_number() OVER (PARTITION BY url, "year" ORDER BY "timestamp", capture_id) AS rn FROM captures)
       WHERE rn = 1""",
)


def write_cdxj(df: DataFrame, folder: str) -> None:
    """JSON index lines in one directory per crawl, with a stray line per 100 captures.
    Every 30th line lacks its status; every 20th mimetype holds a quote."""
    n = F.col("capture_id")
    text = {
        "url": F.col("url"),
        "timestamp": compact_time(F.col("timestamp")),
        "mime": F.when(n % 20 == 0, F.concat(F.lit('a"b/'), "mimetype")).otherwise(F.col("mimetype")),
        "status": F.when(n % 30 != 0, F.col("statuscode").cast("string")),
        "digest": F.col("digest"),
        "filename": F.concat(F.lit("crawl/"), "crawl_id", F.lit(".warc.gz")),
        "offset": n.cast("string"),
        "length": F.col("length").cast("string"),
    }
    line = F.to_json(F.struct(*[c.alias(k) for k, c in text.items()]))
    stray = F.when(n % 100 == 0, F.lit("not json"))
    lines = F.explode(F.array_compact(F.array(line, stray))).alias("value")
    df.select("crawl_id", lines).write.partitionBy("crawl_id").text(folder)


@query(
    "crawl_index_files",
    with_captures("""
SELECT url, "timestamp", concat(CASE WHEN capture_id % 20 = 0 THEN 'a"b/' ELSE '' END, mimetype)
    AS mimetype,
  CAST(CASE WHEN capture_id % 30 = 0 THEN 0 ELSE statuscode END AS INT) AS statuscode, digest,
  'crawl/' || crawl_id || '.warc.gz' AS filename, capture_id AS "offset", length, crawl_id,
  "year", "month"
FROM captures"""),
)
def crawl_index_files(spark, sf_dir):
    folder = shared_folder(spark)
    write_cdxj(captures(spark, sf_dir), folder)
    found = read_cdxj(spark, folder)
    return found.withColumn("timestamp", naive("timestamp")).drop("urlkey")


def write_catalog(catalog: DataFrame, folder: str) -> None:
    """The catalog as one JSON array; it has one short entry per crawl."""
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    entry = F.struct(
        "id",
        F.concat(F.lit("Crawl "), "id").alias("name"),
        F.date_format("from_ts", iso).alias("from"),
        F.date_format("to_ts", iso).alias("to"),
    )
    entries = F.sort_array(F.collect_list(entry), asc=False)
    catalog.agg(F.to_json(entries).alias("value")).write.text(folder)


@query(
    "crawl_catalog_file",
    with_captures("SELECT id, concat('Crawl ', id) AS name, from_ts, to_ts FROM crawls", CATALOG),
)
def crawl_catalog_file(spark, sf_dir):
    folder = shared_folder(spark)
    write_catalog(crawl_catalog(captures(spark, sf_dir)), folder)
    catalog = read_crawl_catalog(spark, folder)
    return catalog.select("id", "name", naive("from_ts"), naive("to_ts"))


@query(
    "index_table",
    with_captures("""
SELECT capture_id, url, urlkey, "timestamp", statuscode, crawl_id FROM captures"""),
)
def index_table(spark, sf_dir):
    folder = shared_folder(spark)
    to_index_table(captures(spark, sf_dir), folder)
    return read_index_table(spark, folder).select("capture_id", "url", "urlkey", "timestamp", "statuscode", "crawl_id")


@query(
    "index_table_crawl_selection",
    with_captures(
        """
SELECT capture_id, crawl_id FROM captures WHERE crawl_id IN (
    SELECT id FROM crawls WHERE to_ts >= TIMESTAMP '2022-01-01' AND from_ts < TIMESTAMP '2022-06-01')
  OR crawl_id = (SELECT id FROM crawls ORDER BY to_ts DESC, id DESC LIMIT 1)""",
        CATALOG,
    ),
)
def index_table_crawl_selection(spark, sf_dir):
    """Crawls chosen through a catalog file, read from the partitioned table."""
    folder = shared_folder(spark)
    df = captures(spark, sf_dir)
    to_index_table(df, f"{folder}/index")
    write_catalog(crawl_catalog(df), f"{folder}/catalog")
    index = read_index_table(spark, f"{folder}/index")
    catalog = read_crawl_catalog(spark, f"{folder}/catalog")
    spanned = select_crawls(index, catalog, "2022-01-01", "2022-05-31 23:59:59")
    both = spanned.unionByName(latest_crawl(index, catalog))
    return both.select("capture_id", "crawl_id").distinct()


@query(
    "csv_export",
    with_captures("""SELECT url, "timestamp" FROM captures
                     WHERE url LIKE '%.example.com/%' AND statuscode = 200"""),
)
def csv_export(spark, sf_dir):
    folder = shared_folder(spark)
    found = captures(spark, sf_dir).filter("url LIKE '%.example.com/%' AND statuscode = 200")
    write_captures(found.select("url", "timestamp"), folder)
    schema = "url string, timestamp timestamp_ntz"
    return spark.read.schema(schema).option("header", True).csv(folder)


@query(
    "body_export",
    with_captures("""
SELECT DISTINCT p.url, md5(p.html) AS hash, octet_length(encode(p.html)) AS bytes
FROM captures c JOIN pages p USING (page_id)"""),
)
def body_export(spark, sf_dir):
    """The body of every capture, written as objects and read back."""
    folder = shared_folder(spark)
    found = captures(spark, sf_dir)
    pages = table(spark, sf_dir, "pages")
    store = found.select("url", "timestamp", "page_id").distinct().join(
        pages.select("page_id", F.col("html").alias("body")), "page_id"
    )
    manifest = export_bodies(attach_bodies(found, store.drop("page_id")), folder)
    objects = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    named = objects.load(f"{folder}/objects").select(
        F.substring_index("path", "/", -1).alias("name"), F.md5("content").alias("hash")
    )
    written = manifest.withColumn("name", F.substring_index("path", "/", -1)).join(named, "name")
    return written.select("url", "hash", "bytes").distinct()


def write_records(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page as a gzip member of a record file, one file per task, and return
    the rows pointing at them: ``page_id``, ``url``, ``filename``, ``offset``, ``length``.
    """
    schema = "page_id long, url string, filename string, offset long, length long"
    written = pages.select("page_id", "url", "html").mapInArrow(
        _record_writer(qualified(pages.sparkSession, f"{folder}/records")), schema
    )
    # Written once, so that the pointers always match the files of the same attempt.
    written.write.parquet(f"{folder}/pointers")
    return pages.sparkSession.read.parquet(f"{folder}/pointers")


def _record_writer(folder: str):
    def member(content: bytes) -> bytes:
        packer = zlib.compressobj(wbits=31)
        return packer.compress(content) + packer.flush()

    def record(kind: bytes, block: bytes) -> bytes:
        head = b"WARC/1.0\r\nWARC-Type: %s\r\nContent-Length: %d\r\n\r\n" % (kind, len(block))
        return member(head + block + b"\r\n\r\n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.gz"
        with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
            out.write(record(b"warcinfo", b"software: none\r\n\r\n"))
            for batch in batches:
                rows = batch.to_pydict()
                offsets, lengths = [], []
                for page_id, html in zip(rows["page_id"], rows["html"]):
                    http = b"HTTP/1.1 %d Ok\r\nContent-Type: text/html\r\n" % (200 + page_id % 3)
                    http += b"Set-Cookie: p=%d\r\nSet-Cookie: q=1\r\n\r\n" % page_id
                    data = record(b"response", http + html.encode())
                    offsets.append(out.tell())
                    lengths.append(len(data))
                    out.write(data)
                yield pa.RecordBatch.from_pydict(
                    {
                        "page_id": rows["page_id"],
                        "url": rows["url"],
                        "filename": [name] * batch.num_rows,
                        "offset": offsets,
                        "length": lengths,
                    }
                )

    return run


def _pointers(spark: SparkSession, sf_dir: str):
    """Pointers to the record of every page; every 20th names a file that is missing and
    every 30th is cut short."""
    folder = shared_folder(spark)
    n = F.col("page_id")
    found = write_records(table(spark, sf_dir, "pages"), folder)
    name = F.when(n % 20 == 7, "gone.warc.gz").otherwise(F.col("filename"))
    length = F.col("length") - F.when(n % 30 == 4, 20).otherwise(0)
    found = found.withColumn("filename", name).withColumn("length", length)
    return found.withColumn("timestamp", F.lit(None).cast("timestamp_ntz")), f"{folder}/records"


@query(
    "records_fetched",
    """
SELECT page_id, CASE WHEN ok THEN '1.0' END AS version, CASE WHEN ok THEN 'response' END AS kind,
  CASE WHEN ok THEN '1.1' END AS http_version,
  CAST(CASE WHEN ok THEN 200 + page_id % 3 END AS INT) AS http_status,
  CASE WHEN ok THEN 'p=' || page_id || ', q=1' END AS cookies,
  CASE WHEN ok THEN md5(html) END AS hash, CASE WHEN ok THEN octet_length(encode(html)) END AS size,
  NOT ok AS failed
FROM (SELECT *, page_id % 20 <> 7 AND page_id % 30 <> 4 AS ok FROM pages)""",
)
def records_fetched(spark, sf_dir):
    pointers, root = _pointers(spark, sf_dir)
    found = fetch_records(pointers, root)
    ok = F.col("response.error").isNull()
    return found.select(
        "page_id",
        F.when(ok, F.col("warc.version")).alias("version"),
        F.try_element_at("warc.headers", F.lit("WARC-Type")).alias("kind"),
        F.when(ok, F.col("response.http_version")).alias("http_version"),
        F.when(ok, F.col("response.http_status")).alias("http_status"),
        F.try_element_at("response.headers", F.lit("Set-Cookie")).alias("cookies"),
        F.md5("response.body").alias("hash"),
        F.octet_length("response.body").cast("long").alias("size"),
        (~ok).alias("failed"),
    )


@query(
    "header_measures",
    """
SELECT page_id, CAST(2 AS INT) AS n_headers, 'Content-Type|Set-Cookie' AS names,
  'text/html|p=' || page_id || ', q=1' AS header_values
FROM pages WHERE page_id % 20 <> 7 AND page_id % 30 <> 4""",
)
def header_measures(spark, sf_dir):
    pointers, root = _pointers(spark, sf_dir)
    headers = F.col("response.headers")
    html = F.coalesce(
        F.try_element_at(headers, F.lit("Content-Type")).like("%text/html%"), F.lit(False)
    )
    found = fetch_records(pointers, root).filter(html & F.col("response.body").isNotNull())
    return found.select(
        "page_id",
        F.cardinality(headers).alias("n_headers"),
        F.array_join(F.map_keys(headers), "|").alias("names"),
        F.array_join(F.map_values(headers), "|").alias("header_values"),
    )
