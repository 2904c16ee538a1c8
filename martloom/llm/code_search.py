"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes.

A rotation is learned so that the signs of the rotated, centred vectors lose least (alternating
between signs and the orthogonal Procrustes solution); the signs are a vector's code. Codes are
cut into substrings, and each substring has an index from its value to the vectors that have it. If
two codes differ in at most r = m * a + b bits, then in one of the first b + 1 of m substrings they
differ in at most a, or in one of the others in at most a - 1. So looking up these values, a query's
own with some bits turned over, finds every code within r. Only codes so found are compared; those
within r are ranked by their inner product. If fewer than k are within r, r grows until they are.

The vectors are dealt into shards, every one with an index of its own, and the queries into tiles;
a task holds one of each (``exact_search.cells``) and builds the index once for all queries of the
tile, and lists are merged as a tree. No bucket is ever capped: a value that many vectors share only
makes a longer list within a shard.

Rotation, code length, length of substrings and r are fitted on at most ``SAMPLE`` vectors (those with
the smallest hash of their id). For each of ``SHAPES``, r is the least radius that holds ``RECALL`` of
the sample's own nearest neighbours, and the shape is taken whose look-ups find the least of the
sample. In a larger corpus neighbours are nearer, so there the radius holds more of them. How much the
index spares depends on the vectors: little where neighbours are hardly nearer than others.

Edge cases: vectors that are NULL, all zero or hold NULL or non-finite components, and rows with a
NULL id, take no part. An id that occurs in several rows counts once, with its smallest vector.
Vectors are only compared with those of their own length; a length without sample has one code for
all. Equal scores go to the smaller id. A query gets all others if these are fewer than k.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.names import quoted
from martloom.llm.exact_search import by_id, cells, merged, unpacked
from martloom.sinks.scratch import staged

SAMPLE = 4000
SAMPLE_QUERIES = 400
RECALL = 0.93
# Rotations side by side, at least, and bits of a substring (8 or 16).
SHAPES = ((1, 8), (1, 16), (2, 8), (2, 16))
ROUNDS = 25
TILE_ROWS = 65536
SHARD_ROWS = 16384


@dataclass(frozen=True)
class Codes:
    """How vectors of one length are coded and cut, and the radius to search."""

    center: np.ndarray
    rotation: np.ndarray
    radius: int
    width: int = 8

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """A code per vector, as bytes."""
        return np.packbits((vectors - self.center) @ self.rotation > 0, axis=1)

    def index(self, codes: np.ndarray) -> MultiIndex:
        return MultiIndex(codes, self.radius, self.width)

    @staticmethod
    def learned(sample: np.ndarray, k: int, recall: float = RECALL) -> Codes:
        found = [Codes._of_shape(sample, k, recall, *shape) for shape in SHAPES]
        return min(found, key=lambda codes: codes._share_found(sample))

    @staticmethod
    def _of_shape(sample: np.ndarray, k: int, recall: float, rotations: int, width: int) -> Codes:
        random = np.random.default_rng(0)
        size = sample.shape[1]
        center = sample.mean(0)
        rows = sample - center
        # As many bits as give whole substrings.
        bits = -(-max(rotations * size, 16) // width) * width
        drawn = [random.normal(size=(size, size)) for _ in range(-(-bits // size))]
        rotation = np.hstack([np.linalg.qr(one)[0] for one in drawn])[:, :bits]
        for _ in range(ROUNDS):
            signs = np.where(rows @ rotation > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(rows.T @ signs, full_matrices=False)
            rotation = left @ right
        codes = Codes(center, rotation, bits, width)
        return Codes(center, rotation, codes._fitting(sample, k, recall), width)

    def _fitting(self, sample: np.ndarray, k: int, recall: float) -> int:
        """The least radius that holds ``recall`` of the k nearest of some of the sample."""
        queries = min(SAMPLE_QUERIES, len(sample))
        k = min(k, len(sample) - 1)
        if k < 1:
            return self.rotation.shape[1]
        scores = sample[:queries] @ sample.T
        scores[np.arange(queries), np.arange(queries)] = -np.inf
        nearest = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        codes = self.of(sample)
        apart = [
            np.bitwise_count(codes[near] ^ codes[at]).sum(1) for at, near in enumerate(nearest)
        ]
        return int(np.quantile(np.concatenate(apart), recall, method="higher"))

    def _share_found(self, sample: np.ndarray) -> float:
        """Which part of the sample the look-ups of some of it find."""
        codes = self.of(sample)
        index = self.index(codes)
        some = codes[: SAMPLE_QUERIES // 4]
        return sum(len(index.looked_up(code, self.radius)) for code in some) / len(some)


@lru_cache(64)
def flips(width: int, reach: int) -> np.ndarray:
    """All values of a substring with at most ``reach`` bits set: what to turn over."""
    values = np.arange(1 << width, dtype=np.uint32)
    return values[np.bitwise_count(values) <= reach]


class MultiIndex:
    """The codes of a shard, with an index per substring: places by value, end to end."""

    def __init__(self, codes: np.ndarray, radius: int, width: int = 8):
        self.codes, self.radius, self.width = codes, radius, width
        self.parts = self._cut(codes)
        self.substrings = self.parts.shape[1]
        self.indexes = []
        for values in self.parts.T:
            starts = np.zeros((1 << width) + 1, np.int64)
            np.cumsum(np.bincount(values, minlength=1 << width), out=starts[1:])
            self.indexes.append((starts, np.argsort(values, kind="stable")))
        self.compared = 0

    def _cut(self, codes: np.ndarray) -> np.ndarray:
        if self.width == 8:
            return codes
        return codes[:, ::2].astype(np.uint16) << np.uint16(8) | codes[:, 1::2]

    def looked_up(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Places found by looking up the values around a code's own, for codes within ``radius``."""
        seen = np.zeros(len(self.codes), bool)
        whole, rest = divmod(radius, self.substrings)
        for at, own in enumerate(self._cut(code[None, :])[0]):
            reach = min(whole if at <= rest else whole - 1, self.width)
            if reach < 0:
                continue
            starts, places = self.indexes[at]
            values = flips(self.width, reach) ^ np.uint32(own)
            begin, end = starts[values], starts[values + 1]
            held = end > begin
            begin, count = begin[held], (end - begin)[held]
            if len(count):
                stops = np.cumsum(count)
                lists = np.arange(stops[-1]) + np.repeat(begin - (stops - count), count)
                seen[places[lists]] = True
        return np.flatnonzero(seen)

    def within(self, code: np.ndarray, radius: int | None = None) -> np.ndarray:
        """Places of all codes within the radius; only those looked up are compared."""
        radius = self.radius if radius is None else radius
        places = self.looked_up(code, radius)
        self.compared += len(places)
        apart = np.bitwise_count(self.codes[places] ^ code).sum(1, dtype=np.int64)
        return places[apart <= radius]

    def nearest(self, code: np.ndarray, least: int) -> np.ndarray:
        """All codes within the radius; if these are fewer than ``least``, within a larger one."""
        radius, bits = self.radius, 8 * self.codes.shape[1]
        found = self.within(code)
        while len(found) < min(least, len(self.codes)) and radius < bits:
            radius = min(bits, radius + max(1, bits // 16))
            found = self.within(code, radius)
        return found


def learned(points: DataFrame, k: int, sample: int = SAMPLE) -> dict[int, Codes]:
    """Codes for each vector length in a bounded sample of ``points`` (id, vec)."""
    rows = points.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    by_length: dict[int, list] = {}
    for row in rows:
        by_length.setdefault(len(row.vec), []).append(row.vec)
    several = {n: np.array(found) for n, found in by_length.items() if len(found) > 1}
    return {n: Codes.learned(found, k) for n, found in several.items()}


def found_in(index: MultiIndex, codes: np.ndarray, ids: np.ndarray, tile: np.ndarray,
             others: np.ndarray, shard: np.ndarray, k: int) -> list[tuple]:
    """For each query: its id, and ids and scores of its k best in the shard."""
    results = []
    for at, own in enumerate(ids):
        places = index.nearest(codes[at], k + 1)
        places = places[others[places] != own]
        scores = np.einsum("ij,j->i", shard[places], tile[at])
        if len(places) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            top = scores >= least
            places, scores = places[top], scores[top]
        order = np.lexsort((others[places], -scores))[:k]
        results.append((own, others[places][order], scores[order]))
    return results


def search(vectors: DataFrame, is_query: Column, k: int, tile_rows: int = TILE_ROWS,
           shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest k found for each query.

    ``is_query`` is a condition on ``id``. Scores are inner products in double precision.
    """
    doubles = F.transform(quoted("embedding"), lambda x: x.cast("double"))
    points = by_id(vectors, "vec_id", doubles).where(F.exists("vec", lambda x: x != 0))
    points = staged(points, "vectors")
    models = learned(points, k)

    def compute(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        results = []
        if queries.num_rows and candidates.num_rows:
            ids, tile = unpacked(queries, np.float64)
            others, shard = unpacked(candidates, np.float64)
            width = tile.shape[1]
            # Without a sample of this length: one code for all, so that nothing is left out.
            codes = models.get(width) or Codes(np.zeros(width), np.zeros((width, 16)), 16)
            index = codes.index(codes.of(shard))
            results = found_in(index, codes.of(tile), ids, tile, others, shard, k)
        counts = [len(found) for _, found, _ in results]
        owners = np.repeat([own for own, _, _ in results], counts)
        found = np.concatenate([np.zeros(0, np.int64), *[x for _, x, _ in results]])
        return pa.table(
            {
                "query_id": pa.array(owners.astype(np.int64)),
                "vec_id": pa.array(found),
                "score": pa.array(np.concatenate([np.zeros(0), *[x for _, _, x in results]])),
                "shard": pa.array(np.full(sum(counts), key[2].as_py()), pa.int32()),
            }
        )

    out = "query_id long, vec_id long, score double, shard int"
    return merged(cells(points, is_query, tile_rows, shard_rows, compute, out), k)
