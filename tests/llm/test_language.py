import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from helpers import documents, empty, rows, with_clashes
from pagestrata.llm import language
from pagestrata.llm.language import WINDOW, Scorer, accepted, fit, held_out, predict, softmax, windows_of

WORDS = {
    "aa": "the of and to in is was that it for on with as are this".split(),
    "bb": "der die das und ist nicht ein eine mit auf für von zu über".split(),
    "cc": "el la los de que y en un una por con para está según".split(),
}


def text_in(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def labelled(n=240):
    rng = random.Random(3)
    langs = sorted(WORDS)
    return [(i, text_in(rng, langs[i % 3], rng.randrange(5, 120)), langs[i % 3]) for i in range(n)]


@pytest.fixture(scope="module")
def network(spark):
    return fit(documents(spark, labelled()), steps=250)


def test_tables_give_what_the_network_gives(network):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (40, WINDOW)).astype(np.uint8)
    pooled = []
    for width, bank, bias in zip(language.WIDTHS, network.banks, network.biases, strict=True):
        vectors = network.vectors[x]
        at = [vectors[:, i : i + width].reshape(len(x), -1) @ bank + bias for i in range(WINDOW - width + 1)]
        pooled.append(np.max(at, axis=0))
    want = softmax(np.maximum(np.concatenate(pooled, 1), 0) @ network.out + network.out_bias)
    assert np.allclose(Scorer(network)(x), want, atol=1e-4)


def test_gradients(network):
    rng = np.random.default_rng(1)
    x = rng.integers(97, 123, (6, WINDOW)).astype(np.uint8)
    y = rng.integers(0, 3, 6)

    def loss():
        p = Scorer(network)(x).astype(float)
        return -np.log(p[np.arange(6), y]).mean()

    for weights, found in zip(network.parameters(), language._gradients(network, x, y), strict=True):
        places = np.argsort(-np.abs(found).ravel())[:2]
        for at in places:
            at = np.unravel_index(at, weights.shape)
            kept = weights[at]
            weights[at] = kept + 1e-3
            up = loss()
            weights[at] = kept - 1e-3
            down = loss()
            weights[at] = kept
            assert found[at] == pytest.approx((up - down) / 2e-3, rel=0.2, abs=2e-3)


def test_whole_texts_decide(spark, network):
    rng = random.Random(4)
    # The beginning and the end are in one language, most of the text is in another.
    mixed = text_in(rng, "aa", 60) + " " + text_in(rng, "bb", 3000) + " " + text_in(rng, "aa", 60)
    docs = documents(spark, [(1, mixed), (2, text_in(rng, "cc", 60_000)), (3, text_in(rng, "aa", 4))])
    found = {r.doc_id: r for r in predict(docs, network).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["bb", "cc", "aa"]
    assert all(0 <= r.score <= 1 for r in found.values())


def test_odd_rows(spark, network):
    docs = documents(spark, [(1, None), (2, ""), (3, "12 !? \n"), (None, "the and of is"), (4, "the and"), (4, "the and"), (5, "\x00\x00a")])
    found = rows(predict(docs, network), "doc_id", "lang_pred")
    assert found[:3] == [(1, "und"), (2, "und"), (3, "und")]
    assert found[3][0] == found[4][0] == 4 and found[3][1] == found[4][1] != "und"
    assert found[-1] == (None, "aa")
    assert predict(empty(spark, docs.schema), network).count() == 0


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "the and"), (2, None, "aa"), (3, "12", "aa")])
    net = fit(docs)
    assert net.languages == []
    assert rows(predict(docs, net), "lang_pred", "score") == [("und", 0.0)] * 3
    one = fit(documents(spark, [(1, "the and of", "aa")]), steps=5)
    assert rows(predict(docs, one), "lang_pred", "score")[0] == ("aa", 1.0)


def test_repeated_texts_leave_the_sample_full(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(language, "train", lambda x, y, languages, *_: taken.append((languages, np.bincount(y).tolist())))
    ids = spark.range(40_000).withColumn("k", F.col("id") % 500)
    many = ids.selectExpr("concat('text ', k) AS text", "'aa' AS lang")
    few = ids.selectExpr("concat('wort ', k % 7) AS text", "'bb' AS lang")
    fit(many.unionByName(few), sample=30)
    fit(ids.selectExpr("'the same' AS text", "'cc' AS lang"), sample=30)
    fit(ids.selectExpr("concat('text ', id) AS text", "'aa' AS lang"), sample=1)
    assert taken == [(["aa", "bb"], [30, 7]), (["cc"], [1]), (["aa"], [1])]
    assert fit(many, sample=0).languages == []


def test_labels_are_no_inputs(spark, network):
    docs = documents(spark, labelled(60))
    other = docs.withColumn("lang", F.lit("cc")).withColumn("source", F.lit("x")).withColumn("doc_id", -F.col("doc_id"))
    assert rows(predict(docs, network), "lang_pred", "score") == rows(predict(other, network), "lang_pred", "score")


def test_fit_is_the_same_again_and_bounded(spark):
    docs = documents(spark, labelled(), 2)
    one, two = fit(docs, sample=30, steps=3), fit(docs.repartition(5), sample=30, steps=3)
    assert all((a == b).all() for a, b in zip(one.parameters(), two.parameters(), strict=True))


def test_accepted_keeps_rows_whole(spark, network):
    docs = with_clashes(documents(spark, [*labelled(30), (90, "17"), (91, None)]), "score", "lang_pred")
    kept = accepted(docs, network, 0.35)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(30))


def test_held_out_third(spark):
    found = spark.range(300).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in found)


def test_windows():
    assert windows_of(b"").tolist() == [[0] * WINDOW]
    assert windows_of(b"a" * (WINDOW + 1)).sum(1).tolist() == [97 * WINDOW, 97]


def test_held_out_accuracy(spark):
    found = entry_points.queries()["op5_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.filter("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] >= 0.97


def test_more_labels_than_are_learnt(spark):
    rows_ = [(i, f"some words of text number {i}", "en") for i in range(60)]
    rows_ += [(100 + i, f"ein paar andere worte {i} und noch mehr", "de") for i in range(50)]
    rows_ += [(1000 + i, f"stray {i} column", f"label{i}") for i in range(230)]
    net = fit(documents(spark, rows_), steps=20, languages=2)
    assert net.languages == ["de", "en"]
    assert len(fit(documents(spark, rows_), steps=2).languages) <= 200
