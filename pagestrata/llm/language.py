"""Language of texts by a small convolutional network over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Bytes of a window, in training and in use; the last one of a text is filled with zeros.
WINDOW = 256
#: Windows per language that the network is fitted on at most, and languages at most.
SAMPLE = 1500
LANGUAGES = 200
#: Texts that pass for the sample besides, so that small samples are full too.
SPARE = 64
WIDTHS = (2, 3, 4)
FILTERS = 12
DIMENSIONS = 8
#: Steps of training, of so many windows each; small samples are gone through more often.
STEPS = 600
BATCH = 64
#: Windows that a task scores at a time.
CHUNK = 512


@dataclass
class Network:
    """Byte vectors, a filter bank and bias per width, and a softmax over languages."""

    languages: list[str]
    vectors: np.ndarray
    banks: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, *self.banks, *self.biases, self.out, self.out_bias]


def fit(
    docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS, seed: int = 5, languages: int = LANGUAGES
) -> Network:
    """Fit a network on rows of ``docs`` (``text``, ``lang``), both not NULL.

    Fitted on ``sample`` windows per language at most, of ``WINDOW`` characters at a place that
    the text's hash gives, one for a text; the windows of all languages come to the driver. Of more
    than ``languages`` labels the most frequent by distinct texts are learnt, and the others
    are never predicted. Repeated texts count once. Texts without letters are left out.
    No rows give a network without languages.
    """
    labelled = docs.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    labelled = labelled.filter(F.col("text").rlike(r"\p{L}"))
    picked = labelled.withColumn("_hash", F.xxhash64("text"))
    counts = picked.groupBy("lang").agg(F.approx_count_distinct("_hash").alias("n"))
    counts = counts.orderBy(F.desc("n"), "lang").limit(languages).collect()
    none = np.zeros(0)
    unknown = Network([], none, [], [], none, none)
    if not counts:
        return unknown
    # Of the distinct texts, all copies of which pass or none, twice as many as wanted and some
    # more pass by their hash; the smallest hashes of them are taken.
    rates = [F.lit(x) for r in counts for x in (r["lang"], (2.0 * sample + SPARE) / max(1, r["n"]))]
    rates = F.create_map(*rates)
    place = F.pmod(F.shiftrightunsigned("_hash", 20), F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1)
    windows = (
        picked.filter(F.pmod("_hash", F.lit(1 << 20)) < F.element_at(rates, F.col("lang")) * (1 << 20))
        .select("lang", "_hash", F.substring("text", place.cast("int") + 1, F.lit(WINDOW)).alias("window"))
        .distinct()
    )
    by_hash = Window.partitionBy("lang").orderBy(F.pmod("_hash", F.lit(1 << 20)), "window")
    rows = windows.withColumn("_n", F.row_number().over(by_hash)).filter(F.col("_n") <= sample)
    rows = sorted((r["lang"], r["_n"], r["window"]) for r in rows.drop("_hash").collect())
    if not rows:
        return unknown
    names = sorted({r[0] for r in rows})
    x = np.concatenate([windows_of(r[2].encode()[:WINDOW])[:1] for r in rows])
    y = np.array([names.index(r[0]) for r in rows])
    return train(x, y, names, steps, seed)


def train(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int, seed: int) -> Network:
    """Fit by Adam on batches of windows ``x`` (n, WINDOW) with classes ``y``."""
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    net = Network(
        languages,
        normal(256, DIMENSIONS, scale=0.5),
        [normal(w * DIMENSIONS, FILTERS, scale=(w * DIMENSIONS) ** -0.5) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        normal(FILTERS * len(WIDTHS), len(languages), scale=0.2),
        np.zeros(len(languages), np.float32),
    )
    weights = net.parameters()
    means, squares = [np.zeros_like(p) for p in weights], [np.zeros_like(p) for p in weights]
    turns = -(-steps * BATCH // len(x))
    order = np.concatenate([rng.permutation(len(x)) for _ in range(turns)])
    for step in range(1, steps + 1):
        some = order[(step - 1) * BATCH : step * BATCH]
        for p, g, m, s in zip(weights, _gradients(net, x[some], y[some]), means, squares, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    n = len(x)
    rows = np.arange(n)[:, None]
    vectors = net.vectors[x]
    columns, tops = [], []
    for width, bank, bias in zip(WIDTHS, net.banks, net.biases, strict=True):
        slid = np.lib.stride_tricks.sliding_window_view(vectors, width, axis=1)
        columns.append(slid.transpose(0, 1, 3, 2).reshape(n, -1, width * DIMENSIONS))
        tops.append(columns[-1] @ bank + bias)
    places = [t.argmax(1) for t in tops]
    pooled = np.concatenate([t.max(1) for t in tops], 1)
    hidden = np.maximum(pooled, 0)
    error = softmax(hidden @ net.out + net.out_bias)
    error[np.arange(n), y] -= 1
    error /= n
    back = (error @ net.out.T) * (pooled > 0)
    d_vectors = np.zeros_like(net.vectors)
    d_banks, d_biases = [], []
    for i, width in enumerate(WIDTHS):
        g = back[:, i * FILTERS : (i + 1) * FILTERS]
        seen = columns[i][rows, places[i]]
        d_banks.append(np.einsum("bfk,bf->kf", seen, g))
        d_biases.append(g.sum(0))
        to = (g[:, :, None] * net.banks[i].T).reshape(n, FILTERS, width, DIMENSIONS)
        for k in range(width):
            np.add.at(d_vectors, x[rows, places[i] + k], to[:, :, k])
    return [d_vectors, *d_banks, *d_biases, hidden.T @ error, error.sum(0)]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows_of(data: bytes) -> np.ndarray:
    """The bytes as rows of ``WINDOW``, the last filled up with zeros; one row at least."""
    n = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


class Scorer:
    """A network in the form of tables: a filter's value at a place is a sum of entries for
    the pairs of bytes (and the single byte) under it."""

    def __init__(self, net: Network):
        self.net = net
        self.tables = []
        for width, bank in zip(WIDTHS, net.banks, strict=True):
            of_byte = [net.vectors @ b for b in bank.reshape(width, DIMENSIONS, FILTERS)]
            pairs = [
                (first[:, None] + second[None]).reshape(-1, FILTERS)
                for first, second in zip(of_byte[0::2], of_byte[1::2], strict=False)
            ]
            self.tables.append((pairs, of_byte[-1] if width % 2 else None))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """The probabilities (n, languages) of windows (n, WINDOW)."""
        wide = x.astype(np.int32)
        pairs = wide[:, :-1] * 256 + wide[:, 1:]
        pooled = []
        for width, (tables, single), bias in zip(WIDTHS, self.tables, self.net.biases, strict=True):
            n = WINDOW - width + 1
            values = tables[0].take(pairs[:, :n], axis=0)
            for i, table in enumerate(tables[1:], 1):
                values += table.take(pairs[:, 2 * i : 2 * i + n], axis=0)
            if single is not None:
                values += single.take(wide[:, width - 1 : width - 1 + n], axis=0)
            pooled.append(values.max(1) + bias)
        hidden = np.maximum(np.concatenate(pooled, 1), 0)
        return softmax(hidden @ self.net.out + self.net.out_bias)


#: Bytes that belong to letters as far as a byte tells: ASCII letters and all others than ASCII.
LETTERS = np.array([chr(b).isalpha() or b > 127 for b in range(256)])


def predict(docs: DataFrame, net: Network, keep: tuple[str, ...] = ()) -> DataFrame:
    """The language of every whole text of ``docs`` (``doc_id``, ``text``).

    Returns ``doc_id``, ``lang_pred``, ``score``, and the ``keep`` columns under their names. The
    probabilities of all windows of a text are averaged by their letters; the greatest
    gives the language and the score. Texts that are NULL or have no letter, and all texts
    if the network knows no language, are ``und`` with score 0. Every row is scored by itself,
    so ids may repeat or be NULL; of equal averages the first language wins.
    """
    source = docs.select("doc_id", "text", *keep)
    fields = [f"`{n}` {t}" for n, t in docs.select("doc_id", *keep).dtypes]
    schema = ", ".join([*fields, "`lang_pred` string", "`score` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net.languages else None
        for batch in batches:
            found = _predict(batch.column(1), scorer, net.languages)
            rest = [c for i, c in enumerate(batch.columns) if i != 1]
            names = [n for i, n in enumerate(batch.schema.names) if i != 1]
            yield pa.RecordBatch.from_arrays([*rest, *found], names=[*names, "lang_pred", "score"])

    return source.mapInArrow(run, schema)


def accepted(docs: DataFrame, net: Network, min_score: float) -> DataFrame:
    """The rows of ``docs`` whose language ``net`` tells with a score of ``min_score`` or more."""
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net.languages else None
        for batch in batches:
            names, scores = _predict(batch.column(text), scorer, net.languages)
            known = pc.and_(pc.not_equal(names, UNKNOWN), pc.greater_equal(scores, min_score))
            yield batch.filter(known)

    return docs.mapInArrow(run, docs.schema)


def _predict(texts: pa.Array, scorer: Scorer | None, languages: list[str]) -> list[pa.Array]:
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    sums = np.zeros((len(texts), len(languages)))
    weight = np.zeros(len(texts))
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def score() -> None:
        x = np.concatenate([w for _, w in held])
        owner = np.repeat([i for i, _ in held], [len(w) for _, w in held])
        letters = LETTERS[x].sum(1).astype(float)
        for at in range(0, len(x), CHUNK):
            part = slice(at, at + CHUNK)
            np.add.at(sums, owner[part], scorer(x[part]) * letters[part, None])
        np.add.at(weight, owner, letters)

    for i, text in enumerate(texts):
        text = text.as_py()
        if scorer is None or text is None or not any(map(str.isalpha, text)):
            continue
        held.append((i, windows_of(text.encode())))
        size += len(held[-1][1])
        if size >= 16 * CHUNK:
            score()
            held, size = [], 0
    if held:
        score()
    for i in np.flatnonzero(weight).tolist():
        best = int(sums[i].argmax())
        names[i], scores[i] = languages[best], min(1.0, float(sums[i, best] / weight[i]))
    return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept for testing: a third of all, by the CRC of its id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
