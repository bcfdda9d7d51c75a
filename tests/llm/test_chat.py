import hashlib
import random

from pyspark.sql import functions as F

from helpers import empty, rows, with_clashes
from pagestrata.llm.chat import CONTROL, chat_digests, escape, format_chats, parse, unescape

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<\\s>", "<\\\\/s>", "[\\INST]", "[\\\\/INST]", "\\", "<", "[", "/", "s>", "INST]", " ", "\n", "a", "é😀", "</s>\n<s>user[INST] x [/INST]</s>\n"]


def hostile(rng):
    return "".join(rng.choice(PIECES) for _ in range(rng.randrange(12)))


def chats(spark, found):
    return spark.createDataFrame(found, SCHEMA).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(hostile(rng),) for _ in range(3000)], "t string")
    df = df.withColumn("e", escape(F.col("t"))).withColumn("u", unescape(F.col("e")))
    assert df.filter("u <> t").count() == 0
    assert df.filter(F.col("e").rlike(CONTROL)).count() == 0


def test_hostile_conversations_come_back(spark):
    rng = random.Random(2)
    found = []
    for conv in range(400):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "system", hostile(rng), ""])
            found.append((conv, turn, role, hostile(rng)))
    formatted = format_chats(chats(spark, found))
    got = {r.conv_id: r for r in formatted.collect()}
    digests = {r.conv_id: r for r in chat_digests(formatted).collect()}
    for conv in range(400):
        turns = [(r, t) for c, _, r, t in found if c == conv]
        assert [tuple(t) for t in got[conv].turns] == turns
        loss = "".join(t for r, t in turns if r == "assistant")
        d = digests[conv]
        assert (d.n_turns, d.turns_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (d.loss_chars, d.loss_sha256, d.formatted_chars) == (len(loss), sha(loss), len(got[conv].formatted))


def test_spans_mark_the_trained_texts(spark):
    rng = random.Random(3)
    found = [(c, t, rng.choice(["user", "assistant"]), hostile(rng)) for c in range(120) for t in range(4)]
    spans = format_chats(chats(spark, found)).collect()
    flat = [(r.conv_id, i, r.formatted[s.start : s.end]) for r in spans for i, s in enumerate(r.loss_spans)]
    df = spark.createDataFrame(flat, "conv_id long, n int, e string").withColumn("t", unescape(F.col("e")))
    got = {(r.conv_id, r.n): r.t for r in df.collect()}
    for c in range(120):
        texts = [t for conv, _, r, t in found if conv == c and r == "assistant"]
        assert [got.get((c, i)) for i in range(len(texts) + 1)] == [*texts, None]


def test_what_is_no_conversation_is_not_parsed(spark):
    bad = ["<s>user[INST] a [/INST]</s>", "x<s>user[INST] a [/INST]</s>\n", "<s>user[INST]a [/INST]</s>\n", "</s>", "<s>user[INST] a </s>[/INST]\n"]
    df = spark.createDataFrame([(b,) for b in bad], "t string")
    assert df.filter(parse(F.col("t")).isNotNull()).count() == 0
    good = spark.createDataFrame([("<s>u[INST] a [/INST]</s>\n",)], "t string")
    assert good.select(F.size(parse(F.col("t")))).first()[0] == 1


def test_odd_rows(spark):
    found = [
        (1, 1, "assistant", None), (1, 0, None, "q"), (1, None, "system", "first"), (2, 0, "user", "x"),
        (2, 0, "user", "x"), (None, 0, "user", "x"), (3, 0, "assistant", "long " * 100_000),
    ]
    got = {r.conv_id: r for r in format_chats(chats(spark, found)).collect()}
    assert [tuple(t) for t in got[1].turns] == [("system", "first"), ("", "q"), ("assistant", "")]
    assert [tuple(t) for t in got[2].turns] == [("user", "x")] * 2
    assert len(got[None].turns) == 1 and len(got[3].turns[0].text) == 500_000


def test_empty_and_clashing(spark):
    df = with_clashes(chats(spark, [(1, 0, "user", "x")]), "formatted", "turns", "_turn", "_n", "_head", "loss_spans")
    assert rows(chat_digests(format_chats(df)), "conv_id", "n_turns") == [(1, 1)]
    assert format_chats(empty(spark, SCHEMA)).count() == 0
