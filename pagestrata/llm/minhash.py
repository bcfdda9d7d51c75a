"""Near-duplicate documents by circulant minimum hashing and exact comparison."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagestrata.llm.common import if_few, small_batches, stored
from pagestrata.llm.groups import blocks, comparable, forest, in_blocks, whole_groups, with_components

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Coordinates of a band, and the share of links that the bands may miss.
ROWS = 6
MISS = 1e-5
#: Places that the two permutations permute.
UNIVERSE = 1 << 20
#: A part of a bucket has about so many shingles and documents.
PART_SHINGLES = 200_000
PART_DOCS = 512
#: Bytes of text that a task gets and hashes at a time.
CHUNK = 1 << 20

_SKETCH = "doc_id long, row long, n_shingles long, hi long, lo long, bands array<long>"


def n_bands(percent: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands that together miss a link of just ``percent`` with probability ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows)))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, seed: int = 3) -> DataFrame:
    """Classes of near-duplicate documents among ``docs`` (``doc_id``, ``text``).

    Returns one row per row: ``doc_id``, ``n_shingles`` (size of the set of 5-word shingles of
    the text with A-Z lower-cased), ``component_id`` (the smallest id that links reach) and
    ``kept`` (whether it is that). Documents are linked if 100 * intersection >= ``percent`` *
    union of their whole sets.

    Documents with equal sets are one class from the start, whatever their number. Class
    representatives meet in the buckets of their bands; a bucket is compared in blocks of
    bounded size. First the blocks are run over band keys alone, which tells who has a
    partner not met in an earlier band; only their texts are sent to the blocks. There all
    pairs are compared exactly, and a block gives back no more links than members.

    Texts that are NULL or have no words have an empty set and no links; texts of one to four
    words are one shingle. Rows with NULL ids have no ``component_id`` and are kept. Rows that
    repeat an id are compared each by its text. No rows give no rows.
    """
    return _placed(docs, percent, seed).select("doc_id", "n_shingles", "component_id", "kept")


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each class of ``near_duplicates``: of its smallest id, and of that the
    text of the smallest hash. Rows that repeat an id stand by their texts, so that a text
    goes only with its like; rows with NULL ids all stay."""
    first = _placed(docs, percent).filter("first").select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"))
    same = (docs["doc_id"] == first["_id"]) & (F.xxhash64(docs["text"]) == first["_row"])
    known = docs.filter("doc_id IS NOT NULL").join(first.distinct(), same, "left_semi")
    # Repeated rows are one; a text's hash stands for it.
    row = F.xxhash64("text")
    once = known.withColumn("_row", row).dropDuplicates(["doc_id", "_row"]).drop("_row")
    return once.unionByName(docs.filter("doc_id IS NULL"))


def _placed(docs: DataFrame, percent: int, seed: int = 3) -> DataFrame:
    """The columns of ``near_duplicates``, ``row`` (hash of the text) and ``first``: whether no row of the
    class comes before this one by id and hash."""
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("row"))
    bands = n_bands(percent)
    with small_batches(docs.sparkSession, CHUNK):
        sketches = stored(
            texts.mapInArrow(lambda batches: _sketch(batches, bands, seed), _SKETCH)
        )
    # Each distinct set is a node. Its number is not an id, of which several sets may have one.
    reps = stored(
        sketches.filter("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("hi", "lo")
        .agg(
            F.min(F.struct("doc_id", "row")).alias("first"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        )
        .select("hi", "lo", F.col("first.doc_id").alias("rep"), F.col("first.row").alias("row"), "n", "bands")
        .withColumn("node", F.monotonically_increasing_id())
    )
    links = stored(_links(texts, reps, percent))
    found = with_components(reps.select("node", "rep", "row"), links, F.struct("rep", "row"))
    found = reps.select("hi", "lo", "node", F.struct("rep", "row").alias("own")).join(
        found.select("node", "component"), "node", "left"
    )
    least = found.select(
        F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), F.coalesce("component", "own").alias("least")
    )
    of_class = sketches.drop("bands").join(
        least, (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo")), "left"
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least.rep", "doc_id"))
    return of_class.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        "row",
        F.coalesce((F.col("doc_id") == F.col("least.rep")) & (F.col("row") == F.col("least.row")), F.lit(True)).alias("first"),
    )


def _links(texts: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Links between representatives (``u``, ``v``) that hold all linked ones together."""
    keys = reps.select("node", "n", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("docs"), F.sum("n").alias("size"))
    buckets = buckets.filter("docs > 1")
    parts = F.greatest(F.ceil(F.col("docs") / PART_DOCS), F.ceil(F.col("size") / PART_SHINGLES))
    met = blocks(keys.join(buckets, "key"), "node", parts).join(reps.select("node", "bands"), "node")
    block = "key long, low long, high long, part long, node long"
    wanted = stored(
        in_blocks(met, ["part", "node", "n", "bands"]).mapInArrow(
            lambda batches: _with_new_partner(batches, percent), block
        )
    )
    # The texts wanted are taken out first: all others need not be shuffled.
    nodes = wanted.select("node").distinct().join(reps.select("node", "rep", "row"), "node")
    ids = if_few(nodes.withColumnsRenamed({"rep": "_rep", "row": "_row"}))
    same = (texts["doc_id"] == ids["_rep"]) & (texts["row"] == ids["_row"])
    # Repeated rows would come as often as they are there.
    source = texts.join(ids, same).select("node", "text").dropDuplicates(["node"])
    return in_blocks(wanted.join(source, "node"), ["part", "node", "text"]).mapInArrow(
        lambda batches: _compare(batches, percent), "u long, v long"
    )


def _sketch(batches: Iterator[pa.RecordBatch], bands: int, seed: int) -> Iterator[pa.RecordBatch]:
    hasher = Circulant(bands * ROWS, seed)
    spread = np.random.default_rng(seed + 1).integers(1, 1 << 63, (bands, ROWS), np.uint64) | np.uint64(1)
    for batch in batches:
        for some in chunks(batch, 1):
            sizes, digests, keys = [], [], []
            for shingles in sets_of(some.column(1)):
                sizes.append(len(shingles))
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                if len(shingles):
                    signature = hasher(shingles).reshape(bands, ROWS).astype(np.uint64)
                    keys.append(mixed((signature * spread).sum(1) + spread[:, 0]).view(np.int64))
            fingerprints = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            ends = np.concatenate([[0], np.cumsum(np.array(sizes) > 0) * bands])
            flat = np.concatenate([np.zeros(0, np.int64), *keys])
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(2), pa.array(sizes, pa.int64()),
                 pa.array(fingerprints[:, 0]), pa.array(fingerprints[:, 1]),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                names=["doc_id", "row", "n_shingles", "hi", "lo", "bands"],
            )


class Circulant:
    """Minimum hashes from two permutations of ``UNIVERSE`` places (Li and Li, C-MinHash).

    The first gives a shingle its place. The second, shifted by k around the circle, gives
    coordinate k: a set's is the least value at its places so shifted. The values that a
    place has for all coordinates lie side by side.
    """

    def __init__(self, coordinates: int, seed: int):
        rng = np.random.default_rng(seed)
        second = rng.permutation(UNIVERSE).astype(np.uint32)
        circle = np.concatenate([second, second[:coordinates]])
        self.shifted = np.lib.stride_tricks.sliding_window_view(circle, coordinates)
        self.first = np.uint64(int(rng.integers(1, 1 << 62)) * 2 + 1)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        places = ((shingles * self.first) >> np.uint64(44)).astype(np.int64)
        least = self.shifted[places[:8192]].min(0)
        for at in range(8192, len(places), 8192):
            least = np.minimum(least, self.shifted[places[at : at + 8192]].min(0))
        return least


#: Odd multipliers, one for each word of a shingle and one for the number of words.
_ODD = np.random.default_rng(11).integers(1, 1 << 63, SHINGLE + 1, np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def sets_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text its shingles as sorted distinct 64-bit hashes."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    counts = np.asarray(pc.list_value_length(lists), np.int64)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    at = np.asarray(coded.indices, np.int64)
    # Blanks at the ends leave empty pieces, which are no words.
    real = np.array([w != "" for w in words], bool)[at]
    owner = np.repeat(np.arange(len(counts)), counts)[real]
    counts = np.bincount(owner, minlength=len(counts))
    values = hashes[at[real]]
    n = max(0, len(values) - SHINGLE + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        rolled += values[k : k + n] * _ODD[k]
    rolled = mixed(rolled)
    stops = np.cumsum(counts)
    for stop, count in zip(stops.tolist(), counts.tolist(), strict=True):
        start = stop - count
        if count >= SHINGLE:
            found = np.sort(rolled[start : stop - SHINGLE + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif count:
            # As a whole, with its number of words as one more.
            short = np.append(values[start:stop], np.uint64(count)) * np.append(_ODD[:count], _ODD[SHINGLE])
            yield mixed(short.sum(keepdims=True))
        else:
            yield np.zeros(0, np.uint64)


def chunks(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``CHUNK`` bytes of text, of one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
    ends = np.cumsum(np.asarray(lengths, np.int64))
    row = 0
    while row < batch.num_rows:
        done = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, done + CHUNK)))
        yield batch.slice(row, stop - row)
        row = stop


def _with_new_partner(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Members of a block that have a partner there, alike in size, whom they have met in no
    earlier band."""
    for batch, starts, stops in whole_groups(batches):
        key, low, high, part, _, n = (np.asarray(batch.column(i)) for i in range(6))
        lists = batch.column(6)
        bands = np.asarray(lists.flatten()).reshape(batch.num_rows, -1)
        stay = np.zeros(batch.num_rows, bool)
        for start, stop in zip(starts, stops, strict=True):
            if stop - start < 2:
                continue
            own = bands[start:stop]
            band = int(np.argmax(own[0] == key[start]))
            pairs = comparable(part[start:stop], low[start], high[start])
            size = n[start:stop]
            pairs &= 100 * np.minimum.outer(size, size) >= percent * np.maximum.outer(size, size)
            for earlier in range(band):
                if not pairs.any():
                    break
                values = own[:, earlier]
                pairs &= values[:, None] != values[None, :]
            stay[start:stop] = pairs.any(0) | pairs.any(1)
        yield pa.RecordBatch.from_arrays(
            batch.columns[:5], names=["key", "low", "high", "part", "node"]
        ).filter(pa.array(stay))


def _compare(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch, starts, stops in whole_groups(batches):
        low, high, part, node = (np.asarray(batch.column(i)) for i in range(1, 5))
        out: list[tuple[int, int]] = []
        for start, stop in zip(starts, stops, strict=True):
            if stop - start < 2:
                continue
            sets = list(sets_of(batch.column(5).slice(start, stop - start)))
            both = shared(sets)
            size = np.array([len(s) for s in sets])
            links = 100 * both >= percent * (size[:, None] + size[None, :] - both)
            links &= comparable(part[start:stop], low[start], high[start])
            out += forest(node[start:stop], links)
        if out:
            u, v = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of all pairs of sorted distinct ``sets``."""
    m = len(sets)
    if m == 2:
        both = np.sort(np.concatenate(sets))
        n = np.count_nonzero(both[1:] == both[:-1])
        return np.array([[len(sets[0]), n], [n, len(sets[1])]], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    # Number the hashes that more than one set has; of all others no pair has any.
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    number = np.cumsum(new) - 1
    often = np.bincount(number) > 1
    row = (np.cumsum(often) - 1)[number]
    stay = often[number]
    row, owner = row[stay], owner[stay]
    total = np.zeros((m, m), np.int64)
    width = max(256, (8 << 20) // max(m, 1) // 4)
    edges = np.searchsorted(row, np.arange(0, (int(row[-1]) + 1 if len(row) else 0) + width, width))
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        has = np.zeros((m, width), np.float32)
        has[owner[a:b], row[a:b] - i * width] = 1
        total += (has @ has.T).astype(np.int64)
    return total
