"""Exact top-k by inner product: tiles of queries times shards of candidates.

Queries are dealt into tiles and candidates into shards by a hash of their id, so a task holds one
tile and one shard, whatever the number of rows. Each cell is one matrix product and a partial
selection of k per query; the lists are merged as a tree, ``FAN_IN`` shards at a time, so no query
brings more than k * FAN_IN rows together.

Vectors of different lengths have no inner product; a query is answered from vectors of its own
length. Edge cases: NULL vectors, vectors with NULL or non-finite components and rows with a NULL
id take no part, as queries or as candidates; an empty vector neither. An id that occurs in several
rows counts once, with its smallest vector. Equal scores go to the smaller id. Other columns are
not read. An empty table, or one without a query, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.names import quoted
from martloom.sinks.scratch import staged

TILE_ROWS = 4096
SHARD_ROWS = 16384
FAN_IN = 64
STRIPE = 256


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def scaled(vector: Column, factor: int = 256) -> Column:
    """Each component x as floor(factor * x), x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(factor))))


def by_id(vectors: DataFrame, name: str, vector: Column) -> DataFrame:
    """``id, vec``: usable vectors, each id once."""
    return (
        vectors.where(quoted(name).isNotNull() & usable(quoted("embedding")))
        .groupBy(quoted(name).cast("long").alias("id"))
        .agg(F.min(vector).alias("vec"))
    )


def cells(
    points: DataFrame,
    is_query: Column,
    tile_rows: int,
    shard_rows: int,
    compute: Callable,
    out: str,
) -> DataFrame:
    """Apply ``compute(key, queries, candidates)`` (Arrow) to each tile and shard of one length."""
    sized = points.withColumn("dim", F.size("vec"))
    queries = sized.where(is_query)
    counted = sized.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    sizes = zip(counted, (shard_rows, tile_rows), strict=True)
    shards, tiles = (max(1, -(-n // size)) for n, size in sizes)
    number = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("tile", number(tiles)).withColumn("shard", every(shards))
    right = sized.withColumn("shard", number(shards)).withColumn("tile", every(tiles))
    keys = ["dim", "tile", "shard"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compute, out)


def merged(lists: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query of ``lists``, shards merged FAN_IN at a time."""
    lists = staged(lists, "top-lists")
    shards = (lists.agg(F.max("shard")).first()[0] or 0) + 1
    best = [F.desc("score"), F.asc("vec_id")]
    while shards > FAN_IN:
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int"))
        group = Window.partitionBy("query_id", "shard").orderBy(*best)
        lists = lists.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= k)
        shards = -(-shards // FAN_IN)
    final = Window.partitionBy("query_id").orderBy(*best)
    ranked = lists.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def unpacked(rows: pa.Table, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a cell, by ascending id."""
    ids = rows.column("id").to_numpy()
    flat = rows.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    return ids[order], flat.astype(dtype, copy=False).reshape(len(ids), -1)[order]


def product(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer products, through doubles where these are exact."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0))
    if most * queries.shape[1] < 2**53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


def best_of(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k highest scores of each row; ties go to the smaller column."""
    n = scores.shape[1]
    if n > k:
        least = np.partition(scores, n - k, axis=1)[:, n - k]
        row, column = np.nonzero(scores >= least[:, None])
    else:
        row, column = map(np.ravel, np.indices(scores.shape))
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def top_k(vectors: DataFrame, is_query: Column, k: int, tile_rows: int = TILE_ROWS,
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best other rows for each query.

    ``is_query`` is a condition on ``id``. Scores are inner products of the ``scaled`` vectors;
    they are exact where they fit 64 bits.
    """

    def compute(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return _listed([], [], [], key)
        ids, tile = unpacked(queries, np.int64)
        others, shard = unpacked(candidates, np.int64)
        parts = []
        for at in range(0, len(ids), STRIPE):
            own = ids[at : at + STRIPE]
            scores = product(tile[at : at + STRIPE], shard)
            row, column = best_of(scores, k + 1)  # one more, as its own may be among them
            keep = own[row] != others[column]
            row, column = row[keep], column[keep]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            row, column = row[place < k], column[place < k]
            parts.append((own[row], others[column], scores[row, column]))
        return _listed(*map(np.concatenate, zip(*parts, strict=True)), key)

    points = staged(by_id(vectors, "vec_id", scaled(quoted("embedding"))), "points")
    out = "query_id long, vec_id long, score long, shard int"
    return merged(cells(points, is_query, tile_rows, shard_rows, compute, out), k)


def _listed(queries, found, scores, key) -> pa.Table:
    return pa.table(
        {
            "query_id": pa.array(queries, pa.int64()),
            "vec_id": pa.array(found, pa.int64()),
            "score": pa.array(scores, pa.int64()),
            "shard": pa.array(np.full(len(queries), key[2].as_py()), pa.int32()),
        }
    )
