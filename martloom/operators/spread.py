"""Dealing the rows of heavy keys into parts, so that no task gets all rows of a key.

Adaptive execution splits a hot key only where both inputs of a join were just shuffled for it.
Where one input keeps the partitioning it already has (an aggregate by the same key, or an earlier
join on it), or where several joins share a shuffle, heavy keys are dealt here instead.
"""

from __future__ import annotations

from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.names import quoted
from martloom.functions.sizes import fits_broadcast
from martloom.sinks.scratch import staged

# Rows of one key that a single task may be left with.
CELL_ROWS = 1_000_000

# At most this many cells per key: more than the tasks of a stage would not spread it further, and
# a row is copied to no more of them than this.
MAX_CELLS = 65_536

# A list of this many keys is broadcast even if the session broadcasts nothing else.
SHORT_LIST = 10_000

# ``monotonically_increasing_id`` counts the rows of a partition in its lower bits.
POSITION_BITS = 33


def heaviest(counted: DataFrame, weight: Column, cell_rows: int) -> DataFrame | None:
    """The rows of ``counted``, one per ``heavy_key``, whose weight is over ``cell_rows``; None if
    there are none.

    All of them, however many: there are at most rows / ``cell_rows``. Written to the shared folder,
    so that every use sees the same list.
    """
    found = staged(counted.where(weight > cell_rows), "heavy-keys")
    return None if found.isEmpty() else found


def offered(heavy: DataFrame) -> DataFrame:
    """A list of heavy keys as a side of a join: broadcast if it is measured small."""
    short = heavy.limit(SHORT_LIST + 1).count() <= SHORT_LIST
    return F.broadcast(heavy) if short or fits_broadcast(heavy) else heavy.hint("merge")


def with_parts(counted: DataFrame, tables: int, cell_rows: int) -> DataFrame:
    """Add ``parts_0``, ``parts_1``..: in how many parts to deal the rows of each table's key, of
    which it holds ``rows_0``, ``rows_1``...

    A cell takes one part of each table and joins it to about ``cell_rows`` rows. Tables share
    that evenly, as factors; one that has less to give goes whole and leaves the rest to larger
    ones. So the copies that are shuffled stay few beside the rows that are produced.
    """
    held = [F.col(f"rows_{at}").cast("double") for at in range(tables)]
    room = F.greatest(F.lit(float(cell_rows)), reduce(mul, held) / MAX_CELLS)
    ranked = [F.struct(rows.alias("rows"), F.lit(at).alias("at")) for at, rows in enumerate(held)]
    out = counted.withColumn("__room", room)
    out = out.withColumn("__ranked", F.array_sort(F.array(*ranked)))
    for done in range(tables):
        rows = F.col("__ranked")[done]["rows"]
        share = F.greatest(F.pow("__room", F.lit(1 / (tables - done))), F.lit(1.0))
        # Roots are not exact; without rounding a whole number of parts could become one more.
        out = out.withColumn("__taken", F.round(F.least(share, rows), 6))
        out = out.withColumn(f"__parts_{done}", F.ceil(rows / F.col("__taken")).cast("long"))
        out = out.withColumn("__room", F.col("__room") / F.col("__taken"))
    for at in range(tables):
        own = [
            F.when(F.col("__ranked")[done]["at"] == at, F.col(f"__parts_{done}"))
            for done in range(tables)
        ]
        out = out.withColumn(f"parts_{at}", F.coalesce(*own))
    return out.drop("__room", "__ranked", "__taken", *[f"__parts_{d}" for d in range(tables)])


def with_part(df: DataFrame, names: list[str], parts: Column, into: str = "__part") -> DataFrame:
    """Add the part, of ``parts`` many, that each row belongs to.

    The rows of a partition that are to be dealt are ordered by a hash of their columns ``names``
    and take parts by turns, so equal rows are dealt apart as well. A recomputed task deals alike
    even if its rows arrive in another order: only equal rows can change places.
    """
    hashed = [_hashable(df.schema[name]) for name in names]
    split = df.withColumn("__order", F.when(parts > 1, F.xxhash64(*hashed)))
    ordered = split.sortWithinPartitions("__order")
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    offset = F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(MAX_CELLS))
    part = F.when(parts > 1, F.pmod(position + offset, parts)).otherwise(F.lit(0).cast("long"))
    return ordered.withColumn(into, part).drop("__order")


def heavy_keys(rows: DataFrame, key: str, cell_rows: int = CELL_ROWS) -> DataFrame | None:
    """``(heavy_key, parts)`` of the keys, NULL included, with more than ``cell_rows`` rows.

    Runs one job over the key column, if there are rows enough. None if no key is heavy.
    """
    if rows.count() <= cell_rows:
        return None
    counts = rows.groupBy(quoted(key).alias("heavy_key")).agg(F.count(F.lit(1)).alias("rows_0"))
    found = heaviest(counts, F.col("rows_0"), cell_rows)
    if found is None:
        return None
    return with_parts(found, 1, cell_rows).select("heavy_key", F.col("parts_0").alias("parts"))


def join_keyed(
    rows: DataFrame,
    key: str,
    keyed: DataFrame,
    keyed_by: str,
    how: str,
    heavy: DataFrame | None,
) -> DataFrame:
    """Join ``rows`` with ``keyed``, which holds each key once, on ``key = keyed_by``.

    ``how``: inner, left, left_semi or left_anti. A heavy key's rows (those of a NULL key
    included) are dealt into parts, and its one row in ``keyed`` is copied to each of them.
    ``heavy`` is what ``heavy_keys`` gives for ``rows``.
    """
    same = quoted(key) == quoted(keyed_by)
    if heavy is None:
        return rows.join(keyed, same, how)
    listed = offered(heavy.toDF("__heavy", "__parts"))
    whole = F.coalesce(F.col("__parts"), F.lit(1).cast("long"))
    marked = rows.join(listed, quoted(key).eqNullSafe(F.col("__heavy")), "left")
    dealt = with_part(marked, rows.columns, whole).drop("__heavy", "__parts")
    copied = keyed.join(listed, quoted(keyed_by) == F.col("__heavy"), "left").select(
        *map(quoted, keyed.columns),
        F.explode(F.sequence(F.lit(0).cast("long"), whole - 1)).alias("__copy"),
    )
    # Spark estimates the copied rows as if there were one each, and might broadcast them by that.
    joined = dealt.join(copied.hint("merge"), same & (F.col("__part") == F.col("__copy")), how)
    return joined.drop("__part", "__copy")


def _hashable(field: T.StructField) -> Column:
    """The column, or its JSON text if its type has no hash."""
    kinds = [field.dataType]
    for kind in kinds:
        if isinstance(kind, (T.MapType, T.VariantType)):
            return F.to_json(F.struct(quoted(field.name)))
        if isinstance(kind, T.ArrayType):
            kinds.append(kind.elementType)
        if isinstance(kind, T.StructType):
            kinds += [inner.dataType for inner in kind.fields]
    return quoted(field.name)
