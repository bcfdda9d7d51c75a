"""What SQL can say of the queries that have no SQL of their own, over whole tables."""

import os

import __spark_entry__ as entry_points
from compare import database

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


def found(spark, name, columns):
    return sorted(tuple(r) for r in entry_points.queries()[name](spark, SF_DIR).select(*columns).collect())


def wanted(sql):
    return sorted(database(SF_DIR).execute(sql).fetchall())


def test_every_document_has_a_language(spark):
    assert [r[0] for r in found(spark, "op5_language_id", ["doc_id"])] == [r[0] for r in wanted("SELECT doc_id FROM documents")]


def test_sizes_of_shingle_sets(spark):
    sql = r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents)
    SELECT doc_id, CASE WHEN len(words) >= 5 THEN len(list_distinct(list_transform(range(1, len(words) - 3),
        lambda i: array_to_string(words[i:i + 4], ' ')))) ELSE least(len(words), 1) END FROM w"""
    assert found(spark, "op7_minhash_dedup", ["doc_id", "n_shingles"]) == wanted(sql)


def test_token_files_hold_all_documents_in_order(spark):
    rows = found(spark, "op8_token_files", ["doc_id", "start", "n_tokens"])
    assert [r[0] for r in rows] == [r[0] for r in wanted("SELECT doc_id FROM documents")]
    start = 0
    for _, at, n in rows:
        assert at == start and n >= 1
        start += n


def test_links_of_all_vectors(spark):
    sql = """
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
    SELECT a.vec_id, count(b.vec_id) FROM v a LEFT JOIN v b ON a.vec_id <> b.vec_id
      AND list_cosine_similarity(a.e, b.e) >= 0.9 GROUP BY a.vec_id"""
    assert found(spark, "op6_vector_dedup", ["vec_id", "n_links"]) == wanted(sql)
