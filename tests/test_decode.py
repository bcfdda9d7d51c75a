import gzip
import zlib

import pytest

from pagestrata.sources.decode import charset_of, decode_bodies, decoded, joined_chunks

TEXT = "<p>naïve 漢字 ¿sí?</p>" * 20


def chunks(data, size=7):
    parts = [data[i : i + size] for i in range(0, len(data), size)]
    return b"".join(b"%X\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\nTrailer: x\r\n\r\n"


def raw(data):
    packer = zlib.compressobj(wbits=-15)
    return packer.compress(data) + packer.flush()


@pytest.mark.parametrize("charset", ["utf-8", "utf-16-le", "gb18030", "utf-32-be"])
def test_codings_in_any_order(charset):
    data = TEXT.encode(charset)
    media = f"text/html; Charset = \"{charset}\""
    for body, transfer, coding in (
        (data, None, None), (chunks(data), "chunked", None), (gzip.compress(data), None, "gzip"), (zlib.compress(data), None, "Deflate"),
        (raw(data), None, "deflate"), (chunks(gzip.compress(data)), "gzip, Chunked", "x-gzip"), (gzip.compress(zlib.compress(data)), None, "deflate, gzip"),
        (gzip.compress(data[:9]) + gzip.compress(data[9:]), None, "gzip"), (gzip.compress(data) + b"trailing", None, "identity, gzip"),
        (data, "chunked", "gzip"),
    ):
        assert decoded(body, transfer, coding, media) == (TEXT, charset, "header", None)


def test_errors_are_of_the_row():
    packed = gzip.compress(TEXT.encode())
    for body, transfer, coding, error in (
        (packed[:-9], None, "gzip", "cut short"), (b"\x1f\x8b\x08junk and more of it", None, "gzip", "Error -3"), (b"x", None, "br", "br is not known"),
        (chunks(b"abcdefghij")[:8], "chunked", None, "cut short"), (b"3\r\nabc\r\nzz\r\n", "chunked", None, "no size at byte 8"),
    ):
        text, charset, source, said = decoded(body, transfer, coding, None)
        assert text is charset is source is None and error in said
    assert decoded(gzip.compress(b"a" * 5000), None, "gzip", None, 4999)[3] == "Larger than 4999 bytes"
    assert decoded(gzip.compress(b"a" * 5000), None, "gzip", None, 5000)[3] is None
    assert decoded(None, "chunked", "gzip", "x") == (None,) * 4
    assert decoded(b"", "chunked", "gzip", None) == ("", "utf-8", "guess", None)


def test_where_a_charset_is_found():
    page = b'<html><head><meta http-equiv="Content-Type" content="text/html; charset=windows-1251">'
    for body, media, want in (
        (b"\xef\xbb\xbfx", "text/html; charset=latin1", ("utf-8", "mark", 3)), (b"\xff\xfea\0", None, ("utf-16-le", "mark", 2)),
        (b"\xff\xfe\0\0a\0\0\0", None, ("utf-32-le", "mark", 4)), (b"x", "text/html;charset=ISO-8859-1", ("cp1252", "header", 0)),
        (page, "text/html", ("cp1251", "document", 0)), (page, "text/html; charset=nonsense", ("cp1251", "document", 0)),
        (b'<meta charset="utf-16">', None, ("utf-8", "document", 0)), (b'<?xml version="1.0" encoding="EUC-JP"?>', None, ("euc_jp", "document", 0)),
        (b"<meta charset=rot13>", None, ("utf-8", "guess", 0)), (b"caf\xe9", None, ("cp1252", "guess", 0)), ("café".encode(), "text/plain", ("utf-8", "guess", 0)),
    ):
        assert charset_of(body, media) == want
    assert decoded(b"a\xffb", None, None, "x; charset=utf-8")[0] == "a�b"


def test_chunks():
    assert joined_chunks(chunks(b"0123456789" * 9)) == b"0123456789" * 9
    assert joined_chunks(b"5;name=value\nhello\n0\n\n") == b"hello"
    assert joined_chunks(b"0\r\n\r\n") == b"" and joined_chunks(b"<html>") == b"<html>"


def test_columns(spark):
    df = spark.createDataFrame(
        [(1, (TEXT.encode("utf-16"), {"content-TYPE": "text/html"})), (2, (gzip.compress(b"x")[:5], {"Content-Encoding": "gzip"})), (3, (None, None)), (4, None)],
        "id long, response struct<body: binary, headers: map<string,string>>",
    ).withColumn("charset", __import__("pyspark").sql.functions.lit("old"))
    got = {r.id: r for r in decode_bodies(df).collect()}
    assert (got[1].decoded_body, got[1].charset, got[1].charset_source, got[1].decode_error) == (TEXT, "utf-16-le", "mark", None)
    assert got[2].decoded_body is None and "cut short" in got[2].decode_error
    assert got[3].decoded_body is None and got[3].decode_error is None and got[4].charset is None
    assert decode_bodies(df.filter("id > 9")).count() == 0
