import datetime as dt

from pyspark.sql import functions as F

from helpers import empty, rows, with_clashes
from pagestrata.llm import revisits
from pagestrata.llm.revisits import canonical_url, resolve_revisits, with_payload

RECORDS = "record_id long, kind string, uri string, date timestamp, http string, payload string"
FULL = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nETag: \"{}\"\r\nLast-Modified: {}\r\nX: 1\r\nx: 2\r\n\r\n"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def unchanged(*lines):
    return "HTTP/1.1 304 Not Modified\r\n" + "".join(f"{x}\r\n" for x in lines) + "\r\n"


def table(spark, records):
    return spark.createDataFrame(records, RECORDS)


def test_canonical_url(spark):
    cases = {
        "HTTP://User:pw@Example.COM:80": "example.com/",
        "https://example.com:443/a%2fb?q=%c3#x": "example.com/a%2Fb?q=%C3",
        "http://example.com:8080/A": "example.com:8080/A",
        "https://[::1]:443/": "[::1]/",
        "http://e.com/100%": "e.com/100%",
        "no url": "no url",
        "": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    assert {r.u: r.c for r in df.withColumn("c", canonical_url(F.col("u"))).collect()} == cases


def test_states_and_headers(spark):
    u = "https://e.com/a"
    df = table(spark, [
        (1, "response", u, day(1), FULL.format("a", "m1"), "one"),
        (2, "revisit", "http://E.com/a#f", day(2), unchanged("ETag: W/\"a\"", "X: 9", "Content-Length: 0", "Age: 1", "Age: 2"), None),
        (3, "response", u, day(3), FULL.format("b", "m2"), "two"),
        (4, "revisit", u, day(4), unchanged("ETag: \"a\""), None),
        (5, "revisit", u, day(4), unchanged("last-modified: m2"), None),
        (6, "revisit", u, day(4), unchanged("Server: s"), None),
        (7, "revisit", u, day(0), unchanged("ETag: \"a\""), None),
        (8, "response", u, day(5), FULL.format("c", "m3").replace("200 OK", "206 Partial"), "part"),
        (9, "revisit", u, day(6), unchanged("ETag: \"b\""), None),
        (10, "revisit", "https://e.com/b", day(6), unchanged("ETag: \"b\""), None),
        (11, "request", u, day(6), "GET / HTTP/1.1\r\n\r\n", None),
        (12, "revisit", None, day(6), None, None),
        (13, "revisit", u, None, unchanged("ETag: \"a\""), None),
    ])
    found = {r.record_id: r for r in with_payload(resolve_revisits(df), df).collect()}
    assert {k: (r.state, r.refers_to, r.payload) for k, r in found.items()} == {
        2: ("resolved", 1, "one"),
        4: ("validators differ", None, None),
        5: ("resolved", 3, "two"),
        6: ("no validator", None, None),
        7: ("no earlier response", None, None),
        9: ("resolved", 3, "two"),
        10: ("no earlier response", None, None),
        12: ("no earlier response", None, None),
        13: ("no earlier response", None, None),
    }
    assert found[2].http == (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nLast-Modified: m1\r\n"
        "ETag: W/\"a\"\r\nX: 9\r\nAge: 1\r\nAge: 2\r\n\r\n"
    )
    assert found[4].http is None


def test_ties_and_folded_lines(spark):
    u = "https://e.com/"
    folded = "HTTP/1.0 200 OK\nETag:\n \"t\"\nbad line\n\nbody: no"
    df = table(spark, [
        (1, "response", u, day(1), FULL.format("t", "m"), "one"),
        (2, "response", u, day(1), folded, "two"),
        (3, "revisit", u, day(1), unchanged("etag: \"t\""), None),
        (3, "revisit", u, day(1), unchanged("etag: \"t\""), None),
    ])
    found = resolve_revisits(df).collect()
    assert [(r.state, r.refers_to, r.http) for r in found] == [
        ("resolved", 2, "HTTP/1.0 200 OK\r\netag: \"t\"\r\n\r\n")
    ] * 2


def test_one_url_in_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(revisits, "ROWS_PER_RANGE", 40)
    records = []
    for i in range(600):
        if i % 50 == 10:
            records.append((i, "response", "http://e.com/", day(i), FULL.format(f"t{i}", "m"), str(i)))
        else:
            last = (i - 10) // 50 * 50 + 10
            records.append((i, "revisit", "http://e.com/", day(i), unchanged(f"ETag: \"t{last}\""), None))
    got = rows(resolve_revisits(table(spark, records).repartition(5)), "record_id", "state", "refers_to")
    want = [
        (i, "resolved", (i - 10) // 50 * 50 + 10) if i > 10 else (i, "no earlier response", None)
        for i in range(600) if i % 50 != 10
    ]
    assert sorted(got) == want


def test_empty_and_clashing(spark):
    df = table(spark, [(1, "revisit", "http://e.com/", day(1), unchanged("ETag: \"a\""), None)])
    assert resolve_revisits(empty(spark, df.schema)).count() == 0
    clash = with_clashes(df, "url", "etag", "last", "id", "later", "state", "_v", "_n")
    assert rows(resolve_revisits(clash), "state") == [("no earlier response",)]
