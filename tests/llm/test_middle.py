import hashlib
import random

import pyarrow as pa
import pytest

from helpers import documents, empty, prose, rows, with_clashes
from pagestrata.llm import middle
from pagestrata.llm.middle import cut, fill_in_middle, middle_digests, restore_texts

NUMBERS = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]


def brute(doc_id, text, seed=1, rate=90, suffix_first=20):
    text = text or ""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < suffix_first:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def check(spark, docs):
    want = [brute(*d) for d in docs]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    outputs = fill_in_middle(documents(spark, docs))
    assert rows(outputs, *NUMBERS, "output") == sorted(want, key=key)
    assert rows(restore_texts(outputs), "doc_id", "text") == sorted(((i, t or "") for i, t in docs), key=key)
    digests = rows(middle_digests(documents(spark, docs)), *NUMBERS, "output_sha256", "restored_sha256")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    both = [(*w[:5], sha(w[5]), sha(d[1] or "")) for w, d in zip(want, docs)]
    assert digests == sorted(both, key=key)
    return want


def test_forms(spark):
    rng = random.Random(4)
    docs = [(i, prose(rng, rng.randrange(60))) for i in range(150)]
    docs += [(1000 + i, "".join(rng.choice("aé漢😀\u0301\n<PSM>") for _ in range(i))) for i in range(80)]
    assert {w[2] for w in check(spark, docs)} == {"plain", "psm", "spm"}


def test_nulls_ties_and_odd_texts(spark):
    docs = [(1, None), (2, ""), (None, "no id"), (None, "no id"), (3, "same"), (3, "same"), (3, "another"), (4, "a\0b"),
            (5, "has <P> in it"), (6, "<M>"), (7, "ends with <"), (8, "S>P>M>"), (9, "<<<<<"), (10, " "), (11, "x")]
    check(spark, docs)


def test_sentinels_do_not_form_at_cuts(spark):
    check(spark, [(i, "<P<S<M>S>P>M>" .replace("<M>", "<M") * 3) for i in range(60)])


def test_long_texts_and_steps(spark, monkeypatch):
    monkeypatch.setattr(middle, "STEP", 7)
    check(spark, [(i, "日本語 text " * i) for i in range(30)])
    monkeypatch.setattr(middle, "STEP", 1 << 20)
    check(spark, [(i, "é" * 3_000_000 + "<" * i) for i in range(3)])


def test_sentinel_across_steps(monkeypatch):
    monkeypatch.setattr(middle, "STEP", 4)
    for before in range(9):
        text = b"x" * before + b"<S>" + b"y" * 3
        assert middle._holds_sentinel(memoryview(text), 0, len(text))
    assert not middle._holds_sentinel(memoryview(b"<S<S<S<"), 0, 7)


def test_bytes_that_are_no_text(spark):
    raw = spark.sql("SELECT id AS doc_id, CAST(unhex('61FF80C3') AS STRING) AS text FROM range(40)")
    found = middle_digests(raw).collect()
    assert {r["restored_sha256"] for r in found} == {hashlib.sha256(b"a\xff\x80\xc3").hexdigest()}


def test_empty_and_extra_columns(spark):
    assert fill_in_middle(documents(spark, [])).collect() == []
    assert middle_digests(empty(spark, "doc_id long, text string")).collect() == []
    docs = with_clashes(documents(spark, [(1, "one two three"), (2, "four")]), "form", "output", "n", "prefix_chars")
    assert rows(fill_in_middle(docs), *NUMBERS) == sorted(brute(i, t)[:5] for i, t in [(1, "one two three"), (2, "four")])


def test_rates(spark):
    docs = [(i, f"text {i}") for i in range(50)]
    none = fill_in_middle(documents(spark, docs), rate=0)
    assert {r["form"] for r in none.collect()} == {"plain"}
    all_spm = fill_in_middle(documents(spark, docs), rate=100, suffix_first=100)
    assert {r["form"] for r in all_spm.collect()} == {"spm"}
    other = rows(fill_in_middle(documents(spark, docs), seed=2), *NUMBERS, "output")
    assert sorted(other, key=str) == sorted((brute(i, t, seed=2) for i, t in docs), key=str)


def test_outputs_without_their_sentinels():
    with pytest.raises(ValueError, match="<S>"):
        middle.parsed(memoryview(b"<P>no more"), 0, 10, "psm")


def test_cut():
    assert cut([(0, 5, 9), (0, 20, 30)], 6) == [(0, 5, 9), (0, 20, 22), (0, 22, 30)]
    assert cut([(0, 5, 9)], 0) == [(0, 5, 5), (0, 5, 9)]
    assert cut([(0, 5, 9)], 4) == [(0, 5, 9), (0, 9, 9)]


def test_spans_of_a_slice():
    buffers, spans = middle._spans(middle._binary(pa.array(["aa", None, "b"]).slice(1)))
    assert [bytes(buffers[0][a:b]) for a, b in spans] == [b"", b"b"]
