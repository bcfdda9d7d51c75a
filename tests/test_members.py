import gzip
import os
import random
import uuid
import zlib

import pytest

from pagestrata.session import shared_folder
from pagestrata.sources import blocks as blocks_module
from pagestrata.sources.blocks import (
    blocks_for, find_in_blocks, key_prefixes, read_blocks, read_cluster_index, scan_blocks, write_block_index, write_blocks,
)
from pagestrata.sources.members import Source, _members
from pagestrata.sources.record_index import RecordHeads, captures_of, index_records
from pyspark.sql import functions as F


class Whole:
    def __init__(self):
        self.data = b""

    def take(self, data):
        self.data += data

    def row(self):
        return (self.data,)


def member(data, level=6):
    packer = zlib.compressobj(level, wbits=31)
    return packer.compress(data) + packer.flush()


def scanned(data, cuts):
    """Rows of all ranges between ``cuts``, reading ranges again as the driver does."""
    import io

    edges = [0, *cuts, len(data)]
    known = {0: 0}
    for _ in range(len(edges) + 2):
        ranges, rows = [], []
        for start, stop in zip(edges, edges[1:]):
            source = Source(io.BytesIO(data), len(data))
            *own, (*_, first, after, broken, _) = _members(source, start, stop, known.get(start), Whole, 1)
            rows += [r[:4] for r in own]
            ranges.append((start, stop, first, after, broken))
        end, wrong = None, None
        for start, stop, first, after, broken in ranges:
            if end is not None and end != "broken":
                if (end < stop and first != end) or (end >= stop and first is not None):
                    wrong = start, end
                    break
            if after is not None or broken:
                end = "broken" if broken else after
        if wrong is None:
            return rows
        known[wrong[0]] = wrong[1]
    raise AssertionError("no end")


def places(members):
    at, out = 0, []
    for m, data in members:
        out.append((at, len(m), None, data))
        at += len(m)
    return out


def test_every_cut_finds_every_member_once():
    rng = random.Random(3)
    texts = [rng.randbytes(rng.randrange(80)) for _ in range(6)] + [b"", b"x" * 500]
    # Whole members within members, stored as they are: they look like members of the file.
    texts += [member(b"inner"), member(b"a") + member(b"b"), member(b"") * 3]
    members = [(member(t, 0 if i >= 8 else 6), t) for i, t in enumerate(texts)]
    data = b"".join(m for m, _ in members)
    want = places(members)
    assert scanned(data, []) == want
    for cut in range(1, len(data)):
        assert scanned(data, [cut]) == want, cut
    for step in (1, 7, 30, 100):
        assert scanned(data, list(range(step, len(data), step))) == want, step


def test_truncated_tail_and_bytes_that_are_no_member():
    good = [(member(t), t) for t in (b"one" * 50, b"two" * 70, b"three" * 9)]
    whole = b"".join(m for m, _ in good)
    for missing in range(1, len(good[-1][0])):
        data = whole[:-missing]
        start = len(whole) - len(good[-1][0])
        for cut in (start - 3, start, start + 1):
            got = scanned(data, [cut])
            assert got[:2] == places(good)[:2]
            assert got[2:] == [(start, len(data) - start, "truncated member", None)]
    junk = good[0][0] + b"junk that is no member" + good[1][0]
    for cut in range(1, len(junk)):
        got = scanned(junk, [cut])
        assert got[0] == places(good)[0] and got[-1] == (len(good[0][0]) + 22, len(good[1][0]), None, good[1][1])
        assert [g[2] for g in got].count("no gzip member") == 1
    assert [r[2] for r in scanned(b"no gzip at all", [5])] == ["no gzip member"]


def test_members_larger_than_windows():
    big = random.Random(1).randbytes(3_000_000)
    members = [(member(big, 1), big), (member(b"end"), b"end"), (member(b"a" * 40_000_000), b"a" * 40_000_000)]
    assert scanned(b"".join(m for m, _ in members), [1_000_000, 2_000_000, 2_999_999]) == places(members)


def test_records_are_described_however_they_come():
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    body = b"<html>\r\n\r\n</html>"
    block = http + body
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    want = None
    for step in (len(record), 1, 2, 3, 5, 50):
        heads = RecordHeads()
        for at in range(0, len(record), step):
            heads.take(record[at : at + step])
        want = want or heads.row()
        assert heads.row() == want
    assert want[1].endswith(b"text/html") and want[2] == len(body) and want[4] is None
    for data, error in ((b"", "No record header"), (record[:-20], "Record shorter than its Content-Length"),
                        (b"WARC/1.0\nContent-Length: 6\n\nHTTP/1", "No HTTP header")):
        heads = RecordHeads()
        heads.take(data)
        assert heads.row()[4] == error
    heads = RecordHeads()
    heads.take(b"WARC/1.0\r\n\r\nsoftware: x")
    assert heads.row()[1:3] == (None, 11)


def local(spark):
    folder = shared_folder(spark)
    return folder, lambda name, data: _put(spark, folder, name, data)


def _put(spark, folder, name, data):
    from pagestrata.sources.files import file_system, qualified

    fs, base = file_system(qualified(spark, folder))
    fs.create_dir(f"{base}/{name}".rpartition("/")[0], recursive=True)
    with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
        out.write(data)


def record(url, body, extra=b"", status=200):
    http = b"HTTP/1.1 %d X\r\nContent-Type: text/HTML; charset=x\r\n\r\n" % status + body
    return (
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: <%s>\r\nWARC-Date: 2024-05-06T07:08:09Z\r\n%sContent-Length: %d\r\n\r\n"
        % (url, extra, len(http)) + http + b"\r\n\r\n"
    )


def test_index_of_record_files(spark):
    folder, put = local(spark)
    rng = random.Random(7)
    bodies = [rng.randbytes(rng.randrange(3000)) for _ in range(60)]
    parts = [member(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n")]
    parts += [member(record(b"http://www.h%d.org/p?Q" % i, b, b"WARC-Payload-Digest: sha1:OWN\r\n" * (i % 2), 200 + i), i % 3) for i, b in enumerate(bodies)]
    put("a/one.warc.gz", b"".join(parts))
    put("b/two.warc.gz", parts[5] + parts[6][:-9])
    put("b/empty.warc.gz", b"")
    put("b/notes.txt", b"no records")
    found = index_records(spark, folder, split_bytes=701).collect()
    one = sorted((r for r in found if r.filename == "a/one.warc.gz"), key=lambda r: r.offset)
    at = 0
    for i, (r, part) in enumerate(zip(one, parts, strict=True)):
        assert (r.offset, r.length, r.error) == (at, len(part), None)
        at += len(part)
        if i:
            assert (r.kind, r.url, r.statuscode, r.mimetype) == ("response", f"http://www.h{i - 1}.org/p?Q", 199 + i, "text/html")
            assert r.urlkey == f"org,h{i - 1},www)/p?q" and r.payload_bytes == len(bodies[i - 1]) and r.year == 2024
            assert r.digest == "sha1:OWN" if (i - 1) % 2 else len(r.digest) == 37
    two = sorted((r for r in found if r.filename == "b/two.warc.gz"), key=lambda r: r.offset)
    assert [r.error for r in two] == [None, "truncated member"] and len(found) == len(parts) + 2
    captures = captures_of(index_records(spark, folder))
    assert captures.count() == 61

    from pagestrata import fetch_records

    got = {(r.url, bytes(r.response.body)) for r in fetch_records(captures, folder).collect()}
    assert got == {(f"http://www.h{i}.org/p?Q", b) for i, b in enumerate(bodies)}


def lines(n):
    rng = random.Random(4)
    hosts = ["org,example)", "org,example,www)", "org,example:8080)", "org,examples)", "com,a)", "net,z)"] + [f"com,h{i:04d})" for i in range(500)]
    out = []
    for i in range(n):
        key = f"{rng.choice(hosts)}/p{rng.randrange(50)}"
        host = ".".join(reversed(key.partition(")")[0].partition(":")[0].split(",")))
        port = ":8080" if ":" in key else ""
        out.append(f"{key} {20200101000000 + i} http://{host}{port}/p{key.rpartition('p')[2]} text/html 200 D{i} {i}")
    return out


def test_block_lookup_reads_few_bytes(spark):
    all_lines = lines(30_000)
    folder = shared_folder(spark)
    df = spark.createDataFrame([(x,) for x in all_lines], "value string")
    blocks = write_blocks(df, f"{folder}/lines", block_lines=30, files=4)
    assert blocks.count() >= 1000
    write_block_index(blocks, f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    for pattern in ("*.example.org", "example.org/p1", "example.org/p1*", "http://h0042.com/p7", "nothing.org/*", "https://h0001.com/*"):
        got = sorted(r.digest for r in find_in_blocks(index, f"{folder}/lines", pattern).collect())
        from pagestrata import parse_cdx
        from pagestrata.operators.filters import url_pattern

        want = sorted(r.digest for r in parse_cdx(df).filter(url_pattern(pattern, keyed=True)).collect())
        assert got == want, pattern
        read = blocks_for(index, key_prefixes(pattern)).agg(F.sum("length")).first()[0] or 0
        assert read < 0.12 * index.agg(F.sum("length")).first()[0], pattern
    plan = blocks_for(index, ["org,example)"])._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(max_key,org,example))" in plan and "LessThan(min_key" in plan
    got = sorted(tuple(r) for r in scan_blocks(spark, f"{folder}/lines", split_bytes=5_000).drop("error").collect())
    assert got == sorted(tuple(r) for r in blocks.collect())


def test_one_large_file_is_read_by_many_tasks(spark):
    folder, put = local(spark)
    text = sorted(lines(5_000))
    chunks = ["\n".join(text[i : i + 40]) + "\n" for i in range(0, len(text), 40)]
    put("big.gz", b"".join(member(c.encode()) for c in chunks))
    found = scan_blocks(spark, folder, split_bytes=1_000)
    assert found.agg(F.sum("n_lines")).first()[0] == 5_000 and found.count() == len(chunks)
    # Sparse index of first keys only, with one key that goes on over many blocks.
    at, idx = 0, []
    for c in chunks:
        size = len(member(c.encode()))
        idx.append("\t".join([" ".join(c.split(" ")[:2]), "big.gz", str(at), str(size), "1"]))
        at += size
    put("cluster/cluster.idx", "\n".join(idx).encode())
    sparse = read_cluster_index(spark, f"{folder}/cluster")
    for prefix in ("org,example)", "com,h0100)/p", "net,z)", "a", "zz"):
        got = sorted(r.value for r in read_blocks(sparse, folder, [prefix]).collect())
        assert got == [x for x in text if x.startswith(prefix)], prefix


def test_lookup_without_a_key():
    with pytest.raises(ValueError, match="within its host"):
        key_prefixes("http://exam*")
    assert key_prefixes("*.a.org") == ["org,a,", "org,a)", "org,a:"]
    assert gzip.decompress(member(b"x")) == b"x" and blocks_module.BLOCK_LINES and uuid


def test_many_misread_ranges_take_few_rounds(spark, monkeypatch):
    from pagestrata.sources import members as members_module

    folder, rng = shared_folder(spark), random.Random(4)
    # Every record holds whole members, stored as they are, so ranges begin at the wrong ones.
    data = [member(b"".join(member(rng.randbytes(300)) for _ in range(20)), 0) for _ in range(40)]
    os.makedirs(folder)
    with open(f"{folder}/one.gz", "wb") as out:
        out.write(b"".join(data))
    rounds = []

    def misread(ranges):
        rounds.append(ranges)
        return _misread(ranges)

    _misread = members_module._misread
    monkeypatch.setattr(members_module, "_misread", misread)
    found = index_records(spark, folder, split_bytes=3000).select("offset", "length").collect()
    assert sorted(map(tuple, found)) == [(at, size) for at, size, *_ in places([(m, m) for m in data])]
    assert len(rounds) <= 6
