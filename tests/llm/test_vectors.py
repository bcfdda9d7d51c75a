import math

import numpy as np
import pytest

from helpers import empty, rows, with_clashes
from pagestrata.llm import vectors
from pagestrata.llm.vectors import meets, near_vectors, shape

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, found):
    return spark.createDataFrame([(i, v, 0) for i, v in found], SCHEMA).repartition(4)


def brute(found, cosine=0.9):
    ok = [
        v is not None and None not in v and all(map(math.isfinite, v)) and any(v) and i is not None
        for i, v in found
    ]
    n, parent = [0] * len(found), list(range(len(found)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if o else None
            for (_, v), o in zip(found, ok, strict=True)]
    for a in range(len(found)):
        for b in range(a + 1, len(found)):
            if ok[a] and ok[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                n[a], n[b] = n[a] + 1, n[b] + 1
                parent[root(a)] = root(b)
    low = {}
    for a, (i, _) in enumerate(found):
        r = root(a)
        low[r] = i if low.get(r) is None else min(low[r], i)
    out = [(i, n[a], low[root(a)], i is None or i == low[root(a)]) for a, (i, _) in enumerate(found)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def clustered(rng, groups, size, noise, dim=32):
    out = []
    for _ in range(groups):
        center = rng.normal(size=dim)
        center /= np.linalg.norm(center)
        out += [(center + noise * rng.normal(size=dim) / math.sqrt(dim)).tolist() for _ in range(size)]
    return out


def check(spark, found):
    got = near_vectors(table(spark, found))
    assert rows(got, "vec_id", "n_links", "component_id", "kept") == brute(found)


@pytest.mark.parametrize("part", [16, 1024])
def test_against_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(vectors, "PART", part)
    rng = np.random.default_rng(5)
    values = clustered(rng, 40, 6, 0.25) + clustered(rng, 1, 90, 0.25) + clustered(rng, 300, 1, 0)
    values += [values[0]] * 50
    ids = rng.permutation(len(values)).tolist()
    check(spark, list(zip(ids, values, strict=True)))


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    check(spark, [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [1e-30, 0.0]),
        (7, [1.0, 0.0]), (12, [0.9, 0.43588989]), (13, [3e38, 1e37]),
    ])
    got = near_vectors(table(spark, [(None, [1.0, 0.0]), (None, [1.0, 0.0])]))
    assert rows(got, "vec_id", "n_links", "component_id", "kept") == [(None, 0, None, True)] * 2


def test_labels_and_other_columns_do_not_matter(spark):
    df = with_clashes(table(spark, [(1, [1.0, 0.1]), (2, [1.0, 0.0])]), "rep", "copies", "n", "key", "keys", "part", "id", "h1", "sound")
    assert rows(near_vectors(df), "vec_id", "component_id") == [(1, 1), (2, 1)]
    assert near_vectors(empty(spark, df.schema)).count() == 0


def test_recall_of_links_that_just_hold(spark):
    rng = np.random.default_rng(6)
    pairs = []
    for _ in range(400):
        a, b = rng.normal(size=(2, 48))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        pairs += [a.tolist(), (0.9005 * a + math.sqrt(1 - 0.9005**2) * b).tolist()]
    got = near_vectors(table(spark, list(enumerate(pairs))))
    assert got.filter("n_links = 1").count() >= 0.98 * len(pairs)


def test_shape_of_tables():
    assert meets(0.1) > meets(0.5) > meets(1.4) > 0
    lengths = [shape(n)[0] for n in (1, 1000, 10**6, 10**9)]
    assert lengths == sorted(lengths)
    for n in (10**3, 10**6):
        length, tables = shape(n)
        assert 1 - (1 - meets(math.sqrt(0.2)) ** length) ** tables >= 0.995


def test_repeated_ids_link_by_their_vectors(spark):
    a, a2, b, b2 = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [0.0, 0.0, 1.0], [0.0, 0.1, 1.0]
    df = spark.createDataFrame([(1, a), (1, b), (2, a2), (3, b2)], "vec_id long, embedding array<double>")
    got = rows(near_vectors(df), "vec_id", "n_links", "component_id")
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]
    df = spark.createDataFrame([(5, a), (5, b), (2, a2), (7, b2)], "vec_id long, embedding array<double>")
    assert rows(near_vectors(df), "vec_id", "n_links", "component_id") == [(2, 1, 2), (5, 1, 2), (5, 1, 5), (7, 1, 5)]
