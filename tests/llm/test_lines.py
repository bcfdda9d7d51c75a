import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import documents, empty, rows, with_clashes
from pagestrata.llm.lines import keep_bitmaps, kept_text, pack, unpack

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(docs):
    holders = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            if len(key) >= 20:
                holders.setdefault(key, set()).add(doc_id)
    low = lambda i: (i is not None, i or 0)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        keys = [x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in lines]
        left = [
            x for x, k in zip(lines, keys, strict=True)
            if len(holders.get(k, ())) < 3 or max(holders[k], key=low) == doc_id
        ]
        digest = hashlib.sha256("\n".join(left).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(left), digest))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def check(spark, docs, parts=3):
    df = documents(spark, docs, parts)
    found = kept_text(df, keep_bitmaps(df))
    assert rows(found, "doc_id", "n_lines", "n_dropped", "kept_sha256") == expected(docs)


def test_against_brute_force_with_hot_lines(spark):
    rng = random.Random(2)
    pool = [f"Line number {i} that many of them share" for i in range(60)]
    docs = []
    for i in range(700):
        lines = ["the most common line of all of them  "] if i % 3 else []
        lines += [rng.choice([str.upper, str.lower, str])(rng.choice(pool)) for _ in range(rng.randrange(6))]
        lines += ["\tédge of twenty chars!" if i % 2 else "short", f"own line of document {i}"]
        rng.shuffle(lines)
        docs.append((i * 7 % 700, "\n".join(lines)))
    check(spark, docs, 5)


def test_odd_rows(spark):
    line = "a line of more than twenty characters"
    check(spark, [(1, None), (2, ""), (3, "\n\n"), (None, line), (None, line), (4, line), (5, f"{line}\n{line} \n x")])
    check(spark, [(1, line), (1, line), (2, line)])
    check(spark, [(1, line), (2, line.upper()), (3, f" {line}\r"), (3, f" {line}\r")])
    check(spark, [(i, "é" * 19 + "\n" + "é" * 20) for i in range(4)])
    check(spark, [(i, (f"{line}\nno\n" * 30_000)) for i in range(3)])


def test_empty_and_clashing(spark):
    none = empty(spark, documents(spark, [(1, "a")]).schema)
    assert keep_bitmaps(none).count() == 0 and kept_text(none, keep_bitmaps(none)).count() == 0
    df = with_clashes(documents(spark, [(i, "a line of more than twenty characters") for i in range(3)]),
                      "row_hash", "keep", "hi", "lo", "kind", "n_docs", "places", "n_lines")
    assert sorted(r.n_dropped for r in kept_text(df, keep_bitmaps(df)).collect()) == [0, 1, 1]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 500), min_size=1), st.integers(0, 40))
def test_bitmaps_round_trip(lost, more):
    n = max(lost) + 1 + more
    kept = unpack(pack(np.array(sorted(lost))), n)
    assert set(np.flatnonzero(~kept).tolist()) == lost and len(kept) == n
    assert unpack(None, n).all()
