"""Upsert (MERGE) of a source frame into a target frame by one key.

Matched target rows take all source values, NULLs included; unmatched source rows are added;
other target rows stay. A NULL key matches nothing.

Written as two joins whose preserved side is the large one. A full outer join would express the
same in one step, but it can neither broadcast a small batch nor have a hot key split at run
time, so it shuffles the whole target on every run. Here a hot target key is split by adaptive
execution, and a hot source key, which can only be one that is added, is dealt into parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.names import quoted, require_columns
from martloom.functions.sizes import fits_broadcast
from martloom.operators.fanout import FanoutJoin
from martloom.operators.quality import duplicate_groups
from martloom.operators.spread import CELL_ROWS, heavy_keys, join_keyed, offered
from martloom.sinks.scratch import staged

CONFLICTS_SHOWN = 20


class MergeConflict(RuntimeError):
    """Several source rows match one target key."""


def conform(source: DataFrame, target: T.StructType) -> DataFrame:
    """Bring ``source`` to the target's columns, by name; both must have the same ones."""
    require_columns(source, target.names, "merge source")
    surplus = [name for name in source.columns if name not in target.names]
    if surplus:
        raise ValueError(f"merge source: the target has no column {', '.join(surplus)}")
    return source.to(T.StructType([T.StructField(f.name, f.dataType) for f in target]))


def merge_frame(
    target: DataFrame, source: DataFrame, key: str, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """The target as it is after the upsert.

    Raises ``MergeConflict`` if several source rows match one target key, however many they are.
    Runs one job that counts the source per key, and one over the target's keys if any source key
    is repeated. Repeated keys are therefore new ones; those with more than ``cell_rows`` rows keep
    out of the join with the target, and are dealt into parts where they are added.
    """
    names = target.columns
    require_columns(target, [key], "merge target")
    incoming = conform(source, target.schema)
    require_no_conflicts(target, incoming, key)
    packed = incoming.select(
        quoted(key).alias("__key"), F.struct(*map(quoted, names)).alias("__new")
    )
    heavy = heavy_keys(incoming, key, cell_rows)
    if heavy is not None:
        is_heavy = F.col("__key") == F.col("heavy_key")
        packed = packed.join(offered(heavy), is_heavy, "left_anti")
    hit = F.col("__new").isNotNull()
    kept = target.join(packed, quoted(key) == F.col("__key"), "left").select(
        *[
            F.when(hit, F.col("__new").getField(name)).otherwise(quoted(name)).alias(name)
            for name in names
        ]
    )
    known = matched_keys(target, incoming, key)
    added = join_keyed(incoming, key, known, "__known", "left_anti", heavy)
    return kept.unionAll(added.select(*map(quoted, names)))


def matched_keys(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The distinct keys found on both sides, as ``__known``; reads only the key columns."""
    return matched_distinct(target.select(quoted(key).alias("__known")), source, key)


def matched_distinct(held: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The distinct rows of ``held`` whose ``__known`` is a key of the source.

    Both sides are made distinct before they are shuffled, so a hot key leaves each task once. If
    the source is small enough to broadcast, Spark moves the semi join below the first of these
    steps, and only matches are shuffled.
    """
    asked = source.select(quoted(key).alias("__asked")).distinct()
    return held.distinct().join(asked, F.col("__known") == F.col("__asked"), "left_semi")


def conflicts(target: DataFrame, source: DataFrame | FanoutJoin, key: str) -> DataFrame:
    """``(key, n)`` for each key with several source rows that some target row matches.

    The source is counted and filtered first: what reaches the join is only what is repeated.
    A source key repeated without any match is not a conflict, all its rows are added.
    """
    repeated = _repeated(source, key)
    known = matched_keys(target, repeated, key)
    return repeated.join(known, quoted(key) == F.col("__known"), "left_semi")


def _repeated(source: DataFrame | FanoutJoin, key: str) -> DataFrame:
    return duplicate_groups(source, key).where(quoted(key).isNotNull())


def require_no_conflicts(target: DataFrame, source: DataFrame | FanoutJoin, key: str) -> None:
    """Raise ``MergeConflict``. A source without repeated keys is let through unseen by the target,
    whose keys are then not read at all."""
    if _repeated(source, key).isEmpty():
        return
    shown = conflicts(target, source, key).limit(CONFLICTS_SHOWN).collect()
    if shown:
        keys = ", ".join(f"{row[0]} ({row[1]} rows)" for row in shown)
        raise MergeConflict(f"several source rows for one target key, among them: {keys}")


def change_rows(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """What an upsert changes: ``action``, then ``before_<c>`` and ``after_<c>`` of every column.

    A row for each target row that a source row replaces (``updated``, also if nothing differs) and
    for each source row that is added (``inserted``, its before image NULL). Raises
    ``MergeConflict`` as the merge does. The target is read once: the updated rows are written down,
    so the source rows that were not added are known from them. No target row moves that is not
    updated if the source proves small, as then it is broadcast.
    """
    names = target.columns
    require_columns(target, [key], "merge target")
    incoming = conform(source, target.schema)
    require_no_conflicts(target, incoming, key)
    before = [quoted(name).alias(f"before_{name}") for name in names]
    after = [quoted(name).alias(f"after_{name}") for name in names]
    packed = incoming.where(quoted(key).isNotNull()).select(
        quoted(key).alias("__key"), F.struct(*after).alias("__after")
    )
    packed = F.broadcast(packed) if fits_broadcast(packed) else packed
    hits = target.join(packed, quoted(key) == F.col("__key")).select(
        F.lit("updated").alias("action"), *before, F.col("__after.*")
    )
    updated = staged(hits, "merge-updated")
    known = updated.select(quoted(f"after_{key}").alias("__known")).distinct()
    heavy = heavy_keys(incoming, key)
    added = join_keyed(incoming, key, known, "__known", "left_anti", heavy)
    images = [
        F.lit(None).cast(updated.schema[f"before_{name}"].dataType).alias(f"before_{name}")
        for name in names
    ]
    return updated.unionAll(added.select(F.lit("inserted").alias("action"), *images, *after))


def action_counts(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``(action, n)``: result rows ``updated``, ``inserted`` and ``untouched`` by the upsert.

    Both sides are counted per key before they meet, so no group of rows travels.
    """
    held = target.groupBy(quoted(key).alias("held")).agg(F.count(F.lit(1)).alias("n_held"))
    given = source.groupBy(quoted(key).alias("given")).agg(F.count(F.lit(1)).alias("n_given"))
    pairs = held.join(given, F.col("held") == F.col("given"), "full")
    n_held, n_given = F.col("n_held"), F.col("n_given")
    action = (
        F.when(n_given.isNull(), "untouched").when(n_held.isNull(), "inserted").otherwise("updated")
    )
    n = F.coalesce(n_held, F.lit(1)) * F.coalesce(n_given, F.lit(1))
    return pairs.groupBy(action.alias("action")).agg(F.sum(n).alias("n"))
