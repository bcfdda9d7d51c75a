import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from helpers import documents, prose
from pagestrata.llm.mixing import mix


def corpus():
    rng = random.Random(4)
    item = " ".join(f"item{i}" for i in range(30))
    docs, out = [], set()
    for i in range(200):
        docs.append((i, prose(rng, rng.randrange(20, 90)), "aa", "s1" if i % 3 else "s2"))
    for i in range(0, 40, 2):
        docs.append((1000 + i, docs[i][1].upper(), "aa", "s1"))
        out.add(1000 + i)
    for i in range(10):
        docs.append((2000 + i, prose(rng, 40) + " " + item + " " + prose(rng, 10), "aa", "s1"))
        out.add(2000 + i)
    docs += [(3000, None, None, "s1"), (3001, "123 456", None, "s1"), (3002, "", "aa", "s2")]
    return docs, out | {3000, 3001, 3002}, item


def test_run_against_brute_force(spark, tmp_path):
    docs, out, item = corpus()
    documents(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [d for d in docs if d[0] not in out]
    copies = {r.doc_id: r.copies for r in mix(documents(spark, left)).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, want = 0, []
    for doc_id, text, *_ in sorted(left):
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        for _ in range(copies[doc_id]):
            want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == want


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    docs, _, item = corpus()
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs[:40], []):
        df = documents(spark, rows).withColumn("kept", F.lit("clash"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, df, str(tmp_path)).columns == df.columns
        corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path)).count()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "decontamination", "mixing", "token_files",
    ]
