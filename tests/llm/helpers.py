"""Small tables for the operators' tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, parts=3):
    """``rows`` as (doc_id, text) or (doc_id, text, lang) or (doc_id, text, lang, source)."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, None, None)[:4]
        full.append((doc_id, text, lang, source, len(text or "")))
    return spark.createDataFrame(full, DOCS).repartition(parts) if full else empty(spark, DOCS)


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def with_clashes(df, *names):
    """``df`` with further columns of names that an operator may use itself."""
    for name in names:
        if name not in df.columns:
            df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


def rows(df, *columns):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)
