"""Index lines in blocks, lookups by grams, indexes made from record files, and bodies as text, from the given tables."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagestrata import (
    captures_of,
    decode_bodies,
    fetch_records,
    find_by_grams,
    find_in_blocks,
    index_records,
    parse_cdxj,
    read_index_table,
    scan_blocks,
    to_index_table,
    write_block_index,
    write_blocks,
    write_grams,
)
from pagestrata.functions.urls import compact_time
from pagestrata.session import shared_folder, written
from pagestrata.sources.clustered import find_clustered, write_clustered
from pagestrata.sources.files import file_system, qualified
from workload.derived import captures, table, with_captures
from workload.files import naive
from workload.registry import query

#: Lines of a block, and bytes of a range, that suit the small tables given.
LINES = 100
SPLIT = 1 << 16


def blocks_of(df: DataFrame, folder: str, keyed: bool) -> DataFrame:
    """The index lines of ``df`` in blocks below ``folder``, and their block index read back."""
    taken = compact_time(F.col("timestamp"))
    if keyed:
        fields = F.struct(
            "url", F.col("mimetype").alias("mime"), F.col("statuscode").cast("string").alias("status"), "digest",
            F.col("length").cast("string").alias("length"),
        )
        line = F.concat_ws(" ", "urlkey", taken, F.to_json(fields))
    else:
        status = F.col("statuscode").cast("string")
        line = F.concat_ws(" ", "urlkey", taken, "url", "mimetype", status, "digest", F.col("length").cast("string"))
    blocks = write_blocks(df.select(line.alias("value")), f"{folder}/lines", LINES)
    write_block_index(blocks, f"{folder}/blocks")
    return df.sparkSession.read.parquet(f"{folder}/blocks")


_FOUND = """
SELECT url, "timestamp", urlkey, mimetype, CAST(statuscode AS INT) AS statuscode, digest, length FROM captures"""
_DOMAIN = " WHERE regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) LIKE '%.example.org'"


@query("block_lookup_domain", with_captures(_FOUND + _DOMAIN))
def block_lookup_domain(spark, sf_dir):
    folder = shared_folder(spark)
    blocks = blocks_of(captures(spark, sf_dir), folder, keyed=False)
    found = find_in_blocks(blocks, f"{folder}/lines", "*.example.org")
    return found.drop("year", "month").withColumn("timestamp", naive("timestamp"))


@query(
    "block_lookup_path",
    with_captures(_FOUND + " WHERE regexp_matches(url, '^[a-z]+://[^/]*example.net(:[0-9]+)?/en/1')"),
)
def block_lookup_path(spark, sf_dir):
    """Paths of all hosts of a domain, from keyed JSON lines."""
    folder = shared_folder(spark)
    blocks = blocks_of(captures(spark, sf_dir), folder, keyed=True)

    def parse(lines: DataFrame) -> DataFrame:
        return parse_cdxj(lines, crawl_id="one", keyed=True)

    found = find_in_blocks(blocks, f"{folder}/lines", "*.example.net/en/1*", parse)
    columns = ["url", "timestamp", "urlkey", "mimetype", "statuscode", "digest", "length"]
    return found.select(columns).withColumn("timestamp", naive("timestamp"))


@query(
    "blocks_scanned",
    with_captures("""
SELECT count(*) AS n_lines, min(urlkey) AS least, max(urlkey) AS largest, CAST(0 AS BIGINT) AS errors, TRUE AS alike
FROM captures"""),
)
def blocks_scanned(spark, sf_dir):
    """The blocks of files found again by ranges of bytes, against those that the writer tells of."""
    folder = shared_folder(spark)
    blocks = blocks_of(captures(spark, sf_dir), folder, keyed=False)
    found = written(scan_blocks(spark, f"{folder}/lines", SPLIT))
    places = ["filename", "offset", "length", "n_lines", "min_key", "max_key"]
    of_writer = blocks.select(*places, F.lit(1).alias("_told"))
    both = found.join(of_writer, places, "full_outer")
    return both.agg(
        F.sum(F.when(F.col("_told") == 1, F.col("n_lines"))).alias("n_lines"), F.min("min_key").alias("least"), F.max("max_key").alias("largest"),
        F.count("error").alias("errors"), F.min(F.coalesce(F.col("_told") == 1, F.lit(False))).alias("alike"),
    )


#: How the body of a page is stored, by ``page_id`` modulo 4.
CHARSETS = ("utf-8", "utf-16", "utf-16-le", "gb18030")


def write_archive(pages: DataFrame, folder: str) -> DataFrame:
    """Records of ``pages`` in gzip members, a file per task, each after a request. Bodies come in four
    charsets and under four codings; every second record has its own digest, and every 30th body
    is cut short. Returns ``page_id``, ``filename``, ``offset``, ``length``.
    """
    base = qualified(pages.sparkSession, folder)

    def member(content: bytes) -> bytes:
        packer = zlib.compressobj(wbits=31)
        return packer.compress(content) + packer.flush()

    def chunked(body: bytes) -> bytes:
        parts = [body[at : at + 1000] for at in range(0, len(body), 1000)]
        return b"".join(b"%x;a=b\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"

    def response(page_id: int, html: str) -> bytes:
        charset = CHARSETS[page_id % 4]
        media, text = b"text/html", html
        if charset == "gb18030":
            text = f'<meta charset="gb18030">{html}'
        elif charset != "utf-16":
            media += b"; charset=" + charset.encode()
        body, fields = text.encode(charset), b""
        if page_id % 4 == 0:
            body, fields = chunked(body), b"Transfer-Encoding: chunked\r\n"
        elif page_id % 4 == 1:
            body, fields = member(body), b"content-encoding: gzip\r\n"
        elif page_id % 4 == 2:
            body, fields = chunked(zlib.compress(body)), b"Content-Encoding: deflate\r\nTransfer-Encoding: chunked\r\n"
        if page_id % 30 == 1:
            body = body[:-5]
        return b"HTTP/1.1 %d X\r\nContent-Type: %s\r\n%s\r\n" % (200 + page_id % 3, media, fields) + body

    def record(kind: bytes, url: str, block: bytes, digest: str | None = None) -> bytes:
        head = b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Target-URI: %s\r\nWARC-Date: 2024-05-06T07:08:09Z\r\n" % (kind, url.encode())
        head += b"WARC-Payload-Digest: md5:%s\r\n" % digest.encode() if digest else b""
        return member(head + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = file_system(base)
        fs.create_dir(top, recursive=True)
        task = TaskContext.get()
        name = f"{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        with fs.open_output_stream(f"{top}/{name}", compression=None) as out:
            for batch in batches:
                rows = []
                for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out.write(record(b"request", url, b"GET / HTTP/1.1\r\n\r\n"))
                    digest = hashlib.md5(html.encode()).hexdigest() if page_id % 2 else None
                    data = record(b"response", url, response(page_id, html), digest)
                    rows.append((page_id, name, out.tell(), len(data)))
                    out.write(data)
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "filename", "offset", "length"])

    whole = pages.select("page_id", "url", "html").filter("url IS NOT NULL AND html IS NOT NULL")
    return written(whole.mapInArrow(run, "page_id long, filename string, offset long, length long"))


@query(
    "records_indexed",
    r"""
SELECT page_id, url, concat(array_to_string(list_reverse(string_split(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1), '.')), ','), ')',
    lower(regexp_extract(url, '^[a-z]+://[^/?#]+([^#]*)', 1))) AS urlkey,
  TIMESTAMP '2024-05-06 07:08:09' AS "timestamp", CAST(200 + page_id % 3 AS INT) AS statuscode, 'text/html' AS mimetype,
  CASE WHEN page_id % 2 = 1 THEN 'md5:' || md5(html) ELSE 'sha1:' END AS digest
FROM pages""",
)
def records_indexed(spark, sf_dir):
    """Captures made from record files; each has the place that its writer tells of."""
    folder = shared_folder(spark)
    told = write_archive(table(spark, sf_dir, "pages"), folder)
    found = captures_of(index_records(spark, folder, SPLIT))
    digest = F.when(F.col("digest").startswith("md5:"), F.col("digest")).otherwise(F.substring("digest", 1, 5))
    same = found.join(told, ["filename", "offset", "length"]).withColumn("digest", digest)
    return same.select("page_id", "url", "urlkey", naive("timestamp"), "statuscode", "mimetype", "digest")


@query(
    "bodies_decoded",
    """
SELECT page_id, CASE WHEN ok THEN md5(CASE WHEN page_id % 4 = 3 THEN '<meta charset="gb18030">' || html ELSE html END) END AS hash,
  CASE WHEN ok THEN CASE page_id % 4 WHEN 0 THEN 'utf-8' WHEN 3 THEN 'gb18030' ELSE 'utf-16-le' END END AS charset,
  CASE WHEN ok THEN CASE page_id % 4 WHEN 1 THEN 'mark' WHEN 3 THEN 'document' ELSE 'header' END END AS charset_source,
  NOT ok AS failed
FROM (SELECT *, page_id % 30 <> 1 OR page_id % 4 = 3 AS ok FROM pages) WHERE page_id % 30 <> 1 OR page_id % 4 <> 3""",
)
def bodies_decoded(spark, sf_dir):
    """Bodies of four charsets and codings as text, from an index made of their record files."""
    folder = shared_folder(spark)
    told = write_archive(table(spark, sf_dir, "pages"), folder)
    found = captures_of(index_records(spark, folder, SPLIT)).join(told, ["filename", "offset", "length"])
    # A plain body that is cut short is text all the same.
    found = found.filter("page_id % 30 <> 1 OR page_id % 4 <> 3")
    read = decode_bodies(fetch_records(found, folder))
    return read.select(
        "page_id", F.md5(F.col("decoded_body").cast("binary")).alias("hash"), "charset", "charset_source",
        F.col("decode_error").isNotNull().alias("failed"),
    )


def _by_grams(name: str, pattern: dict, sql: str, column: str = "url"):
    """Register the captures that meet ``pattern``, looked up by three bytes in a row of ``column``."""

    @query(name, with_captures(f"SELECT capture_id, url, statuscode, mimetype FROM captures WHERE {sql}"))
    def run(spark, sf_dir):
        folder = shared_folder(spark)
        to_index_table(captures(spark, sf_dir), f"{folder}/table", number_rows=True)
        index = read_index_table(spark, f"{folder}/table")
        write_grams(index, f"{folder}/grams", column)
        found = find_by_grams(index, f"{folder}/grams", column=column, **pattern)
        return found.select("capture_id", "url", "statuscode", "mimetype")


_by_grams("grams_contain", {"contains": "/en/12"}, "contains(url, '/en/12')")
_by_grams("grams_like", {"like": "%.example.net/%/4%"}, "url LIKE '%.example.net/%/4%'")
_by_grams("grams_match", {"matches": r"example\.org/[a-z]+/[0-9]*77|blog\..*/de/"},
          r"regexp_matches(url, 'example\.org/[a-z]+/[0-9]*77|blog\..*/de/')")
_by_grams("grams_match_key", {"matches_whole": r"org,example,[a-z]+\)/en/[0-9]+"},
          r"urlkey SIMILAR TO 'org,example,[a-z]+\)/en/[0-9]+'", "urlkey")


@query(
    "clustered_lookup",
    with_captures(r"""SELECT capture_id, url, "timestamp" FROM captures
        WHERE regexp_matches(url, '^[a-z]+://([^/?#:]+\.)?example\.org([/?#:]|$)')
          AND "timestamp" BETWEEN TIMESTAMP '2021-02-01' AND TIMESTAMP '2022-06-30'"""),
)
def clustered_lookup(spark, sf_dir):
    """A domain and a span of time out of a table clustered by both."""
    path = shared_folder(spark)
    write_clustered(captures(spark, sf_dir), path, files=8)
    found = find_clustered(spark, path, domain="example.org", since="2021-02-01", until="2022-06-30")
    return found.select("capture_id", "url", "timestamp")
