"""Near-duplicate vectors by p-stable hashing and exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagestrata.llm.common import stored
from pagestrata.llm.groups import blocks, comparable, forest, in_blocks, whole_groups, with_components

#: Links have at least this cosine; the tables together find so many of those that just have it.
COSINE = 0.9
RECALL = 0.995
#: Width of the cells that projections of unit vectors are quantised to.
CELL = 2.5
#: Unrelated vectors that share a bucket, about.
STRANGERS = 32
#: Vectors of a part of a bucket.
PART = 1024
#: Rows up to which the list of hot buckets is broadcast (24 bytes each); else it is joined.
FEW = 100_000


def meets(distance: float, cell: float = CELL) -> float:
    """The probability that one quantised projection is equal for two vectors so far apart
    (Datar et al., Locality-Sensitive Hashing Scheme Based on p-Stable Distributions)."""
    r = cell / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def shape(n: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Projections of a key and number of tables for ``n`` vectors. More vectors need longer
    keys, lest buckets grow, and so more tables for the same recall."""
    strangers, near = meets(math.sqrt(2)), meets(math.sqrt(2 - 2 * cosine))
    length = max(1, math.ceil(math.log(max(n, 1) / STRANGERS) / -math.log(strangers)))
    return length, math.ceil(math.log(1 - recall) / math.log1p(-(near**length)))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, seed: int = 9) -> DataFrame:
    """Links between ``vectors`` (``vec_id``, ``embedding``) with a cosine of ``cosine`` or more.

    Returns one row per row: ``vec_id``, ``n_links`` (other vectors linked directly),
    ``component_id`` (the smallest id that links reach) and ``kept`` (whether it is that).

    Equal vectors are one class with a count from the start. Classes are hashed into the
    buckets of all tables and compared in blocks of bounded size: first by 8-bit forms,
    whose error is bounded, so that only classes with a partner near enough are sent on
    with their vectors, then by cosine in double precision. A pair counts in the first
    table that both share. A block gives back a count per member and no more links than
    members, so pairs are never rows.

    Vectors that are NULL, zero, empty or hold NULLs, NaN or infinities link with nothing,
    nor do vectors of different length; rows with NULL ids have no ``component_id`` and link
    with nothing. Rows that repeat an id count as vectors of their own. No rows give no rows.
    """
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = F.coalesce(
        F.forall("embedding", number) & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )
    marked = vectors.select(
        "vec_id",
        "embedding",
        (sound & F.col("vec_id").isNotNull()).alias("sound"),
        F.xxhash64("embedding").alias("h1"),
        F.xxhash64(F.lit(1), "embedding").alias("h2"),
    )
    classes = stored(
        marked.filter("sound")
        .groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
        # A class's number is not an id, of which several classes may have one.
        .withColumn("rep", F.monotonically_increasing_id())
    )
    length, tables = shape(classes.count(), cosine)
    hashed = stored(
        classes.select("h1", "rep", "copies", "embedding").mapInArrow(
            lambda batches: _hashed(batches, length, tables, seed),
            "h1 long, rep long, copies long, unit binary, small binary, error double, keys array<long>",
        )
    )
    found = stored(_pairs(hashed, cosine))
    counts = found.groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    nodes = classes.select(F.col("rep").alias("node"), "first")
    reached = with_components(nodes, found.filter("v IS NOT NULL").select("u", "v"), F.col("first"))
    of_class = (
        classes.select("h1", "h2", "rep", "first", "copies")
        .join(counts, "rep", "left")
        .join(reached.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .withColumn("sound", F.lit(True))
    )
    joined = marked.select("vec_id", "sound", "h1", "h2").join(of_class, ["h1", "h2", "sound"], "left")
    component = F.coalesce("component", "first", "vec_id")
    return joined.select(
        "vec_id",
        (F.coalesce("n", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _pairs(hashed: DataFrame, cosine: float) -> DataFrame:
    """Rows (``u``, NULL, ``n``): links counted for ``u``; rows (``u``, ``v``, 0): links."""
    keys = hashed.select("h1", "rep", "small", "error", F.explode("keys").alias("key"))
    hot = stored(keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > PART))
    few = hot.count() <= FEW
    met = keys.join(F.broadcast(hot) if few else hot, "key", "left")
    met = blocks(met, "rep", F.coalesce(F.ceil(F.col("n") / PART), F.lit(1)))
    block = "key long, low long, high long, part long, rep long, h1 long"
    wanted = in_blocks(met, ["part", "rep", "h1", "small", "error"]).mapInArrow(
        lambda batches: _near(batches, cosine), block
    )
    whole = hashed.select(F.col("rep").alias("_rep"), F.col("h1").alias("_h1"), "copies", "unit", "keys")
    sent = wanted.join(whole, (F.col("rep") == F.col("_rep")) & (F.col("h1") == F.col("_h1")))
    return in_blocks(sent, ["part", "rep", "copies", "unit", "keys"]).mapInArrow(
        lambda batches: _linked(batches, cosine), "u long, v long, n long"
    )


def _hashed(
    batches: Iterator[pa.RecordBatch], length: int, tables: int, seed: int
) -> Iterator[pa.RecordBatch]:
    projections: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    odd = np.random.default_rng(seed).integers(1, 1 << 62, (tables, length + 1), np.uint64)
    odd = odd * np.uint64(2) + np.uint64(1)
    for batch in batches:
        out: list[tuple] = []
        for h1, rep, copies, values in zip(*(batch.column(i) for i in range(4)), strict=True):
            x = np.asarray(values.values, np.float64)
            x = x / np.abs(x).max()
            x /= math.sqrt(x @ x)
            if len(x) not in projections:
                rng = np.random.default_rng([seed, len(x)])
                direction = rng.normal(size=(len(x), tables * length))
                projections[len(x)] = direction, rng.uniform(0, CELL, tables * length)
            direction, shift = projections[len(x)]
            cells = np.floor((x @ direction + shift) / CELL).astype(np.int64).view(np.uint64)
            keys = (cells.reshape(tables, length) * odd[:, 1:]).sum(1) + odd[:, 0] * np.uint64(len(x))
            keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            step = np.abs(x).max() / 127
            small = np.rint(x / step).astype(np.int8)
            error = float(np.linalg.norm(x - small * step))
            out.append(
                (h1.as_py(), rep.as_py(), copies.as_py(), x.tobytes(),
                 np.float32(step).tobytes() + small.tobytes(), error + 1e-6, keys.view(np.int64).tolist())
            )
            if len(out) >= 2000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 3 + [pa.binary()] * 2 + [pa.float64(), pa.list_(pa.int64())]
    names = ["h1", "rep", "copies", "unit", "small", "error", "keys"]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _stack(values: list[bytes], kind: type) -> np.ndarray | None:
    """Vectors of one length as rows; None if a key's collision mixes lengths."""
    if len({len(v) for v in values}) > 1:
        return None
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _near(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Members of a block with a partner whose cosine may reach ``cosine``."""
    for batch, starts, stops in whole_groups(batches):
        low, high, part = (np.asarray(batch.column(i)) for i in range(1, 4))
        error = np.asarray(batch.column(7))
        small = batch.column(6).to_pylist()
        stay = np.zeros(batch.num_rows, bool)
        for start, stop in zip(starts, stops, strict=True):
            if stop - start < 2:
                continue
            rows = _stack(small[start:stop], np.uint8)
            if rows is None:
                stay[start:stop] = True
                continue
            step = np.ascontiguousarray(rows[:, :4]).view(np.float32)
            x = rows[:, 4:].view(np.int8).astype(np.float32) * step
            e = error[start:stop]
            # The forms differ from the unit vectors by their errors at most, the products
            # by these and their product; the rest is for single precision.
            least = cosine - (e[:, None] + e[None, :] + e[:, None] * e[None, :]) - 1e-4
            pairs = comparable(part[start:stop], low[start], high[start]) & (x @ x.T >= least)
            stay[start:stop] = pairs.any(0) | pairs.any(1)
        yield pa.RecordBatch.from_arrays(
            batch.columns[:6], names=["key", "low", "high", "part", "rep", "h1"]
        ).filter(pa.array(stay))


def _linked(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    for batch, starts, stops in whole_groups(batches):
        key, low, high, part, rep, copies = (np.asarray(batch.column(i)) for i in range(6))
        units = batch.column(6).to_pylist()
        tables = np.asarray(batch.column(7).flatten()).reshape(batch.num_rows, -1)
        counts: list[tuple] = []
        for start, stop in zip(starts, stops, strict=True):
            if stop - start < 2:
                continue
            x = _stack(units[start:stop], np.float64)
            if x is None:
                raise ValueError("one key for vectors of different length; use another seed")
            links = comparable(part[start:stop], low[start], high[start]) & (x @ x.T >= cosine)
            own = tables[start:stop]
            for earlier in range(int(np.argmax(own[0] == key[start]))):
                values = own[:, earlier]
                links &= values[:, None] != values[None, :]
            weight = copies[start:stop]
            n = links @ weight + weight @ links
            counts += [(int(u), None, int(c)) for u, c in zip(rep[start:stop], n, strict=True) if c]
            counts += [(u, v, 0) for u, v in forest(rep[start:stop], links)]
        if counts:
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["u", "v", "n"])
