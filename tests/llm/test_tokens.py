import io
import json
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame
from tokenizers import Tokenizer

from helpers import documents, empty, prose, rows, with_clashes
from pagestrata.llm.common import stored
from pagestrata.llm.tokens import (
    Encoder, Reader, Writer, _by_range, _chunks, cuts_at_blanks, pack_block, read_token_files, token_digests, unpack_block, write_token_files,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return Encoder(f.read())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


def test_pieces_give_what_whole_texts_give(library, encoder):
    rng = random.Random(1)
    texts = ["", " ", "a  b", " a", "a ", "\n a b", "it's the 'll x, y.", "x <|endoftext|> y", "héllo wörld 12 !?", "中文 字", "a\tb c", "U.S. a. .b"]
    texts += ["".join(rng.choice(" ab\n'.é1\t　,!") for _ in range(rng.randrange(40))) for _ in range(1500)]
    ids, lengths = encoder(pa.array(texts))
    want = [ids_of(library, t) for t in texts]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=300), st.integers(1, 100))
def test_blocks_round_trip(ids, percentile):
    ids = np.array(ids, np.uint32)
    assert (unpack_block(pack_block(ids, percentile)) == ids).all()


def test_outliers_do_not_widen_a_block():
    ids = np.arange(4096, dtype=np.uint32) % 16 + 7
    plain = len(pack_block(ids))
    ids[::400] = 2**32 - 1
    assert len(pack_block(ids)) <= plain + 8 * 11


def test_files_round_trip_and_single_blocks():
    rng = np.random.default_rng(3)
    lengths = np.array([1, 5000, 3, 4095, 1, 9000, 1])
    ids = rng.integers(0, 50_000, lengths.sum()).astype(np.uint32)
    out = io.BytesIO()
    writer = Writer(out)
    doc_ids = [None, 1, 1, 2, 3, 4, 9]
    for at in range(0, 7, 3):
        a, b = lengths[:at].sum(), lengths[: at + 3].sum()
        writer.add(pa.array(doc_ids[at : at + 3], pa.int64()), ids[a:b], lengths[at : at + 3])
    writer.close()
    data = out.getvalue()
    reader = Reader(pa.BufferReader(data))
    found = list(reader.documents())
    assert [d for d, _ in found] == doc_ids
    assert (np.concatenate([i for _, i in found]) == ids).all()
    assert (reader.block(1) == ids[4096:8192]).all()
    with pytest.raises(ValueError, match="cut short"):
        Reader(pa.BufferReader(data[:-1]))


def test_digests_against_the_library(spark, library):
    rng = random.Random(5)
    docs = [(i * 37 % 301, prose(rng, rng.randrange(60))) for i in range(301)]
    docs += [(None, "no id"), (400, None), (401, ""), (402, "same"), (402, "same"), (403, prose(rng, 30_000))]
    manifest = write_token_files(documents(spark, docs), PATH, shard_bytes=20_000)
    assert manifest.count() > 5
    found = token_digests(manifest).collect()
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0]))
    start, want = 0, []
    for doc_id, text in order:
        ids = ids_of(library, text)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.doc_id is not None, tuple(r)) for r in found) == sorted((w[0] is not None, w) for w in want)
    whole = {r.start: np.frombuffer(bytes(r.ids), "<u4").tolist() for r in read_token_files(manifest).collect()}
    assert whole[want[5][1]] == ids_of(library, order[5][1])


def test_empty_and_clashing(spark):
    df = with_clashes(documents(spark, [(1, "a b")]), "shard", "path", "start", "ids", "n_docs")
    assert rows(token_digests(write_token_files(df, PATH)), "doc_id", "start", "n_tokens") == [(1, 0, 3)]
    assert token_digests(write_token_files(empty(spark, df.schema), PATH)).count() == 0


def test_several_files_of_a_task(spark, library, monkeypatch):
    monkeypatch.setattr("pagestrata.llm.tokens.MOST_TASKS", 2)
    monkeypatch.setattr("pagestrata.llm.tokens.CHUNK_CHARS", 500)
    rng = random.Random(6)
    docs = [(i, prose(rng, 20)) for i in range(200)]
    manifest = write_token_files(documents(spark, docs), PATH, shard_bytes=1_000)
    assert manifest.count() > 6
    want, start = [], 0
    for doc_id, text in docs:
        ids = ids_of(library, text)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in token_digests(manifest).collect()) == want


def test_pieces_of_any_length_and_language(library, encoder):
    rng = random.Random(8)
    words = ["naïve", "中文字", "x" * 63, "x" * 64, "x" * 65, "y" * 3000, "don't", "'s", "１２", "\u200b", "é" * 32, "é" * 33, "…", "<|endoftext|>", "a<|endoftext|>"]
    words += ["a\u00a0b", "\u3000", "tab\tin", "line\nin", "\x1c", "\x85"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    for _ in range(2):  # new, then remembered
        ids, _ = encoder(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in ids_of(library, t)]


def test_other_definitions_are_encoded_whole():
    with open(PATH, encoding="utf-8") as f:
        rules = json.load(f)
    assert cuts_at_blanks(rules)
    rules["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": False}
    assert not cuts_at_blanks(rules)
    definition = json.dumps(rules)
    texts = ["of the world, of the", "it is of the", "", "a  b"]
    whole = Tokenizer.from_str(definition)
    ids, _ = Encoder(definition)(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in ids_of(whole, t)]
    rules["normalizer"] = {"type": "Lowercase"}
    assert not cuts_at_blanks(rules | {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}})


def test_forgetting_pieces(library):
    with open(PATH, encoding="utf-8") as f:
        encode = Encoder(f.read(), 3)
    for text in ("a b c d e f", "g h, i. a b", "a b c!"):
        assert encode(pa.array([text]))[0].tolist() == ids_of(library, text)


def test_a_task_gets_little_text_at_a_time(spark, monkeypatch):
    class Watched(Encoder):
        def __call__(self, texts):
            if texts.buffers()[2].size > 4 << 20:
                raise ValueError("a large batch")
            return super().__call__(texts)

    monkeypatch.setattr("pagestrata.llm.tokens.Encoder", Watched)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(8000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("of the "), 300).alias("text"))
    assert token_digests(write_token_files(docs, PATH)).count() == 8000
    assert spark.conf.get(name) == before


def test_a_task_fetches_and_sorts_a_part_at_a_time(spark, monkeypatch):
    plans = []

    def watched(df):
        plans.append((df.rdd.getNumPartitions(), df._jdf.queryExecution().toString()))
        return stored(df)

    monkeypatch.setattr("pagestrata.llm.tokens.stored", watched)
    docs = [(i, f"text {i} " + "of the " * 20) for i in range(400)]
    write_token_files(documents(spark, docs), PATH, shard_bytes=20_000)
    (tasks, plan), = plans
    assert tasks == -(-sum(len(t) for _, t in docs) // 20_000)
    assert {int(n) for n in re.findall(r"rangepartitioning\(.*, (\d+)\)", plan)} == {4 * tasks}


@pytest.mark.parametrize("dealt", [[0, 1, 2, 3], [0, 2, 3, 5], [4, 0, 1, 3]])
def test_ranges_of_a_task_need_not_be_neighbours(dealt):
    parts = np.repeat(dealt, 3)
    batch = pa.RecordBatch.from_arrays([pa.array(parts), pa.array(["x"] * 12), pa.array(parts, pa.int32())], names=["doc_id", "text", "part"])
    found = [(part, rows.column(0).to_pylist()) for part, rows in _by_range(batch)]
    assert found == [(p, [p] * 3) for p in dealt]
    assert list(_by_range(batch.slice(0, 0))) == []


@pytest.mark.parametrize("shard_bytes", [600, 3_000])
def test_files_stand_in_order_however_ranges_are_dealt(spark, library, monkeypatch, shard_bytes):
    # Reversed tasks' ranges and gaps between them, as they come when tasks are dealt by place.
    def dealt(self, n):
        return coalesce(self.repartition(n, F.col("part") % 3).sortWithinPartitions((F.col("part") + 5) % 7, "part", "doc_id"), n)

    coalesce = DataFrame.coalesce
    monkeypatch.setattr(DataFrame, "coalesce", dealt)
    monkeypatch.setattr("pagestrata.llm.tokens.CHUNK_CHARS", 300)
    rng = random.Random(12)
    docs = [(i, prose(rng, 20)) for i in range(200)]
    manifest = write_token_files(documents(spark, docs), PATH, shard_bytes=shard_bytes)
    want, start = [], 0
    for doc_id, text in docs:
        ids = ids_of(library, text)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in token_digests(manifest).collect()) == want


def test_memory_of_a_chunk():
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**9)}" for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(4_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4_000)), pa.array(texts)], names=["doc_id", "text"])
    with open(PATH, encoding="utf-8") as f:
        encode = Encoder(f.read())
    tracemalloc.start()
    for some in _chunks(batch):
        encode(some.column(1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20


def test_ids_beyond_two_bytes():
    model = {"type": "WordLevel", "vocab": {"[UNK]": 0, "a": 70_000, "b": 65_535}, "unk_token": "[UNK]"}
    encode = Encoder(json.dumps({"version": "1.0", "added_tokens": [], "pre_tokenizer": {"type": "Whitespace"}, "model": model}))
    assert encode(pa.array(["a b", "b"]))[0].tolist() == [70_000, 65_535, 0, 65_535, 0]
