"""Exact and approximate search against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import code_search, exact_search

FOLDER = "/root/testdata/sf0.001"
ODD = [
    (None, [1.0, 2.0], "x"),
    (5, None, "x"),
    (6, [1.0, None], "x"),
    (7, [1.0, math.inf], "x"),
    (8, [math.nan, 1.0], "x"),
    (9, [], "x"),
    (10, [0.0, 0.0], "x"),
    (20, [1.0, 0.5], "x"),
    (20, [1.0, 0.5], "x"),
    (30, [1.0, 0.5], "x"),
    (40, [1.0, 0.5], "x"),
    (50, [-1.0, 0.25], "x"),
    (60, [0.5, 0.5, 0.5], "x"),
    (70, [0.001, -0.001], "x"),
]


@pytest.fixture(scope="module")
def odd_vectors(spark):
    return spark.createDataFrame(ODD, "vec_id long, embedding array<float>, shard string")


def usable(rows, zero=True):
    out = {}
    for name, vector, *_ in rows:
        if name is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if zero or any(vector):
            out[name] = min(out.get(name, vector), vector)
    return out


def brute(vectors, queries, k, scale):
    values = {n: [scale(float(np.float32(x))) for x in v] for n, v in vectors.items()}
    out = []
    for q in sorted(queries):
        scored = [
            (-sum(a * b for a, b in zip(values[q], values[n], strict=True)), n)
            for n in values
            if n != q and len(values[n]) == len(values[q])
        ]
        out += [(q, at + 1, n, -s) for at, (s, n) in enumerate(sorted(scored)[:k])]
    return out


def test_exact_top_k_on_odd_vectors(odd_vectors):
    for k, sizes in ((2, (2, 3)), (50, (4096, 16384))):
        found = exact_search.top_k(odd_vectors, F.col("id") % 10 == 0, k, *sizes)
        rows = sorted(tuple(row) for row in found.collect())
        vectors = usable(ODD)
        queries = [n for n in vectors if n % 10 == 0]
        assert rows == brute(vectors, queries, k, lambda x: math.floor(256 * x))


def test_exact_top_k_merges_many_shards(spark, monkeypatch):
    monkeypatch.setattr(exact_search, "FAN_IN", 4)
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    whole = exact_search.top_k(vectors, F.col("id") % 50 == 0, 5)
    parts = exact_search.top_k(vectors, F.col("id") % 50 == 0, 5, tile_rows=4, shard_rows=20)
    assert sorted(whole.collect()) == sorted(parts.collect())
    assert whole.count() == 50


def test_products_too_large_for_doubles():
    a = np.array([[2**30 + 1, 3]])
    assert exact_search.product(a, a)[0, 0] == (2**30 + 1) ** 2 + 9


def test_no_vectors_and_no_queries(odd_vectors):
    for search in (exact_search.top_k, code_search.search):
        assert search(odd_vectors.limit(0), F.col("id") % 10 == 0, 3).count() == 0
        assert search(odd_vectors, F.col("id") < 0, 3).count() == 0


def test_code_search_on_odd_vectors(odd_vectors):
    found = sorted(tuple(r) for r in code_search.search(odd_vectors, F.col("id") % 10 == 0, 30).collect())
    vectors = usable(ODD, zero=False)
    expected = brute(vectors, [n for n in vectors if n % 10 == 0], 30, lambda x: x)
    assert [row[:3] for row in found] == [row[:3] for row in expected]
    assert np.allclose([row[3] for row in found], [row[3] for row in expected])


@pytest.mark.parametrize("shard_rows", [16384, 300])
def test_code_search_recall(spark, shard_rows):
    folder = "/root/testdata/sf0.1"
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    k = 20
    rows = code_search.search(vectors, F.col("id") % 20 == 0, k, shard_rows=shard_rows).collect()
    found: dict[int, list] = {}
    for row in sorted(rows, key=lambda row: (row.query_id, row.rank)):
        found.setdefault(row.query_id, []).append((row.vec_id, row.score))
    values = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()}
    names = np.array(sorted(values))
    every = np.stack([values[n] for n in names])
    right = 0
    for q, hits in found.items():
        assert len(hits) == k and q not in dict(hits)
        assert hits == sorted(hits, key=lambda hit: (-hit[1], hit[0]))
        scores = every @ values[q]
        assert all(abs(s - scores[np.searchsorted(names, n)]) < 1e-12 for n, s in hits)
        scores[np.searchsorted(names, q)] = -9
        right += len(set(names[np.argsort(-scores)[:k]]) & set(dict(hits)))
    assert len(found) == sum(n % 20 == 0 for n in values)
    assert right / (k * len(found)) >= 0.9


@pytest.mark.parametrize("width", [8, 16])
@pytest.mark.parametrize("radius", [0, 3, 13, 31, 64])
def test_index_finds_every_code_within_the_radius(radius, width):
    random = np.random.default_rng(3)
    codes = random.integers(0, 256, (500, 8), np.uint8)
    codes[100:200] = codes[0] ^ (random.random((100, 8)) < 0.2).astype(np.uint8)
    index = code_search.MultiIndex(codes, radius, width)
    for code in codes[:20]:
        apart = np.bitwise_count(codes ^ code).sum(1)
        assert index.within(code).tolist() == np.flatnonzero(apart <= radius).tolist()
        least = np.sort(apart)[29]
        assert np.isin(np.flatnonzero(apart < least), index.nearest(code, 30)).all()


def clustered(count=3000, clusters=60, seed=2):
    random = np.random.default_rng(seed)
    centers = random.normal(size=(clusters, 64))
    points = centers[random.integers(0, clusters, count)] + 0.25 * random.normal(size=(count, 64))
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def test_only_codes_that_were_looked_up_are_compared(monkeypatch):
    points = clustered()
    codes = code_search.Codes.learned(points, 20)
    index = codes.index(codes.of(points))
    hits = [index.nearest(code, 20) for code in index.codes[:200]]
    assert index.compared < 0.5 * 200 * len(points)
    everything = code_search.MultiIndex(index.codes, 8 * index.codes.shape[1])
    assert len(everything.nearest(index.codes[0], 20)) == len(points)
    # Without look-ups nothing is found: no other path leads to a result.
    monkeypatch.setattr(code_search.MultiIndex, "looked_up", lambda *_: np.zeros(0, np.int64))
    assert not len(index.nearest(index.codes[0], 20)) and len(hits[0]) >= 20


def test_recall_on_clusters(spark):
    points = clustered()
    rows = [(at, point.tolist()) for at, point in enumerate(points)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = code_search.search(vectors, F.col("id") % 20 == 0, 20, shard_rows=1000).collect()
    scores = points @ points.T
    np.fill_diagonal(scores, -9)
    right = sum(row.vec_id in np.argsort(-scores[row.query_id])[:20] for row in found)
    assert len(found) == 150 * 20 and right >= 0.9 * len(found)
