"""Joins of a core frame with several many-per-key sides that share one key.

The joined ("wide") frame holds, per key, every combination of core and side rows, so it can be
far larger than its inputs. Two things follow.

* **Counting needs no combinations.** Row counts, NULL counts and group counts of the wide frame
  are sums of products of per-key counts. Each input is counted per key first (map-side combined,
  so a hot key leaves every task as one row) and only those counts are joined.
* **Rows that match nothing need no shuffle.** Keys with many rows in one table that another lacks
  are found by the same counts, and their rows are dropped where they are read.
  Where most of a large side's rows are of many such keys with few rows each, a Bloom filter of the
  joined keys, built from the counts, stops them where the side is read.
* **Building it needs an even spread.** All sides join on the same key, so one shuffle per input
  serves the whole chain. That chain is one stage, which adaptive skew splitting leaves alone, so
  heavy keys are cut here: each table's rows of such a key are dealt into parts, and every
  combination of parts (a *cell*) becomes a shuffle key of its own. Which keys are heavy comes from
  the per-key counts, counted before the join runs. A side that is small, by its measured size and
  by its rows per key, is broadcast instead and moves no other row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil
from operator import and_, mul, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.key_filter import KeyFilter
from martloom.functions.names import quoted, require_columns, require_disjoint
from martloom.functions.sizes import FIELD_BYTES, fits_broadcast, measured_bytes
from martloom.operators.spread import (
    CELL_ROWS,
    heaviest,
    heavy_keys,
    join_keyed,
    offered,
    with_part,
    with_parts,
)
from martloom.sinks.scratch import staged

# Sides that together give up to this many rows per core row may be broadcast. Beyond it, the rows
# produced outweigh a shuffle of the core, and cells spread them better than the core's files do.
BROADCAST_FANOUT = 100


# A core is spread over more tasks if each of its rows gives at least this many on average, so that
# moving it costs little beside what it yields. A task that reads a core has about SPLIT_ROWS rows.
# It is spread over at most SPREAD_WAVES times as many tasks as the session runs at once.
SPREAD_FANOUT = 10
SPREAD_WAVES = 64
SPLIT_ROWS = 1_000_000


# A table of so many rows is filtered by the joined keys if this share of them is idle: the filter
# then keeps more out of the shuffle than it costs to build.
FILTER_ROWS = 10_000_000
FILTER_SHARE = 0.5


# Counts per table and hash that bound the rows of a join, and how many hashes are tried.
BOUND_BUCKETS = 1 << 16
BOUND_HASHES = 3


class FanoutTooLarge(RuntimeError):
    """The joined frame would hold more rows than the caller allows."""


@dataclass(frozen=True)
class FanoutJoin:
    """``core`` joined with every frame in ``sides`` on ``key`` (``how``: left or inner).

    ``counts`` holds the rows of every table per key, and the NULLs of ``counted_nulls``, if they
    have been written down; see ``counted``.
    """

    core: DataFrame
    key: str
    sides: tuple[DataFrame, ...]
    how: str = "left"
    counts: DataFrame | None = None
    counted_nulls: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.how not in ("left", "inner"):
            raise ValueError(f"how must be left or inner, not {self.how!r}")
        label = f"fan-out on {self.key}"
        tables = (self.core, *self.sides)
        for at, table in enumerate(tables):
            require_columns(table, [self.key], label)
            for later in tables[at + 1 :]:
                require_disjoint(table, later, self.key, label)

    @property
    def columns(self) -> list[str]:
        """Column names of the joined frame, without joining."""
        names = [self.key] + [c for c in self.core.columns if c != self.key]
        return names + [c for side in self.sides for c in side.columns if c != self.key]

    def pruned(self, columns: Sequence[str]) -> FanoutJoin:
        """The same join over only the key and ``columns`` of each table."""
        for column in columns:
            self._owner(column)
        wanted = {self.key, *columns}
        core, *sides = [
            table.select(*[quoted(c) for c in table.columns if c in wanted])
            for table in (self.core, *self.sides)
        ]
        return FanoutJoin(core, self.key, tuple(sides), self.how, self.counts, self.counted_nulls)

    # -- counts ---------------------------------------------------------------------------

    def counted(self, null_columns: Sequence[str] = ()) -> FanoutJoin:
        """The same join with its counts per key written down, so that the reports, checks and
        joins that follow do not count the tables again."""
        if self.counts is not None and set(null_columns) <= set(self.counted_nulls):
            return self
        columns = tuple(dict.fromkeys(null_columns))
        counts = staged(self._counts(columns), "fanout-counts")
        return FanoutJoin(self.core, self.key, self.sides, self.how, counts, columns)

    def _counts(self, null_columns: Sequence[str]) -> DataFrame:
        """One row per key of any table: ``rows_0`` (core), ``rows_1``.. (sides), NULL where the
        table lacks it; ``nulls_j`` counts NULLs of the column at ``j`` among its table's rows."""
        owners = [self._owner(column) for column in null_columns]
        tables = (self.core, *self.sides)
        names = [f"rows_{at}" for at in range(len(tables))]
        names += [f"nulls_{j}" for j in range(len(null_columns))]
        ones = []
        for at, table in enumerate(tables):
            if at > 0 or self.how == "inner":
                table = table.where(quoted(self.key).isNotNull())
            own = {f"rows_{at}": F.lit(1)} | {
                f"nulls_{j}": quoted(column).isNull().cast("int")
                for j, column in enumerate(null_columns)
                if owners[j] == at
            }
            none = F.lit(None).cast("int")
            ones.append(
                table.select(
                    quoted(self.key).alias("key"), *[own.get(n, none).alias(n) for n in names]
                )
            )
        # One shuffle for all tables, of a row per key and task.
        sums = [F.sum(name).alias(name) for name in names]
        return reduce(DataFrame.unionAll, ones).groupBy("key").agg(*sums)

    def _joining(self) -> Column:
        """Whether a key of the counts has joined rows."""
        if self.how == "left":
            return F.col("rows_0").isNotNull()
        tables = range(len(self.sides) + 1)
        return reduce(and_, [F.col(f"rows_{at}").isNotNull() for at in tables])

    def per_key(self, null_columns: Sequence[str] = ()) -> DataFrame:
        """The counts of every key that has joined rows; see ``_counts``."""
        if self.counts is None or not set(null_columns) <= set(self.counted_nulls):
            return self._counts(null_columns).where(self._joining())
        rows = [F.col(f"rows_{at}") for at in range(len(self.sides) + 1)]
        nulls = [
            F.col(f"nulls_{self.counted_nulls.index(column)}").alias(f"nulls_{j}")
            for j, column in enumerate(null_columns)
        ]
        return self.counts.where(self._joining()).select("key", *rows, *nulls)

    def _idle(self, cell_rows: int) -> Column:
        """Whether a key of the counts has over ``cell_rows`` rows in some table and no joined
        row."""
        tables = range(len(self.sides) + 1)
        many = [F.coalesce(F.col(f"rows_{at}") > cell_rows, F.lit(False)) for at in tables]
        return ~self._joining() & reduce(or_, many)

    def without_idle_keys(self, cell_rows: int = CELL_ROWS) -> FanoutJoin:
        """The same join without the rows of keys that have over ``cell_rows`` of them in some
        table and none in the joined frame."""
        join = self.counted()
        idle = join._idle(cell_rows)
        listed = staged(join.counts.where(idle).select(F.col("key").alias("__idle")), "idle-keys")
        listed = offered(listed)
        core, *sides = [
            table.join(listed, quoted(self.key) == F.col("__idle"), "left_anti")
            if at > 0 or self.how == "inner"
            else table
            for at, table in enumerate((self.core, *self.sides))
        ]
        counts = join.counts.where(~idle)
        return FanoutJoin(core, self.key, tuple(sides), self.how, counts, join.counted_nulls)

    def reduced(self, rows: int = FILTER_ROWS, share: float = FILTER_SHARE) -> FanoutJoin:
        """The same join without most rows of keys that the joined frame lacks, dropped where they
        are read: from tables of at least ``rows`` rows of which at least ``share`` are idle.

        The filter is made from the counts per key, so no table is read for it. It is broadcast, or
        left out if it proves too large for that.
        """
        join = self.counted()
        tables = (join.core, *join.sides)
        joining = join._joining()
        held = [F.coalesce(F.col(f"rows_{at}"), F.lit(0)) for at in range(len(tables))]
        totals = [F.sum(n) for n in held] + [F.sum(F.when(~joining, n)) for n in held]
        found = [n or 0 for n in join.counts.agg(*totals).first()]
        wide = [at for at, n in enumerate(found[: len(tables)]) if n >= rows]
        worth = [at for at in wide if found[len(tables) + at] >= share * found[at]]
        if self.how == "left":  # every core row is in the joined frame
            worth = [at for at in worth if at > 0]
        keys = KeyFilter.of(join.counts.where(joining).select("key"), "joined-keys") if worth else None
        if keys is None:
            return join
        core, *sides = [
            keys.passed(table, self.key) if at in worth else table
            for at, table in enumerate(tables)
        ]
        return FanoutJoin(core, self.key, tuple(sides), self.how, join.counts, join.counted_nulls)

    def _multiplier(self, at: int) -> Column:
        """How often table ``at`` repeats the rows of the others for a key."""
        rows = F.col(f"rows_{at}")
        return rows if at == 0 or self.how == "inner" else F.coalesce(rows, F.lit(1))

    def _product(self, without: int | None = None) -> Column:
        return reduce(
            mul,
            [self._multiplier(at) for at in range(len(self.sides) + 1) if at != without],
            F.lit(1).cast("long"),
        )

    def summary(self) -> DataFrame:
        """One row: rows of the core, rows of the joined frame, most rows from one core row."""
        counts = self.per_key().select(
            F.col("rows_0").alias("core_rows"),
            self._product().alias("joined_rows"),
            self._product(without=0).alias("fanout"),
        )
        return counts.agg(
            F.coalesce(F.sum("core_rows"), F.lit(0)).alias("core_rows"),
            F.coalesce(F.sum("joined_rows"), F.lit(0)).alias("joined_rows"),
            F.max("fanout").alias("max_fanout"),
        )

    def row_bound(self, buckets: int = BOUND_BUCKETS, hashes: int = BOUND_HASHES) -> DataFrame:
        """One row, ``row_bound``: a number of rows that the joined frame does not exceed.

        Every table is counted per bucket of a hash of the key, and the counts of a bucket are
        multiplied as those of a key would be. Keys that share a bucket only make the product
        larger, so the sum over buckets is a bound for each hash, and the least of them is taken. A
        task sends at most ``buckets`` rows for each hash, however many keys there are; an exact
        count sends one for each key.
        """
        tables = (self.core, *self.sides)
        names = [f"rows_{at}" for at in range(len(tables))]
        kind = self.core.schema[self.key].dataType
        ones = []
        for at, table in enumerate(tables):
            if at > 0 or self.how == "inner":
                table = table.where(quoted(self.key).isNotNull())
            # Hashes depend on the type, so all tables hash the key as the core has it, or as text.
            same = all(t.schema[self.key].dataType == kind for t in tables)
            key = quoted(self.key) if same else quoted(self.key).cast("string")
            drawn = [
                F.struct(
                    F.lit(n).alias("hash"),
                    F.pmod(F.xxhash64(key, F.lit(n)), F.lit(buckets)).alias("bucket"),
                )
                for n in range(hashes)
            ]
            counts = [F.lit(1 if name == names[at] else 0).alias(name) for name in names]
            ones.append(table.select(F.inline(F.array(*drawn)), *counts))
        united = reduce(DataFrame.unionAll, ones).groupBy("hash", "bucket")
        held = united.agg(*[F.sum(name).cast("double").alias(name) for name in names])
        least = 1.0 if self.how == "left" else 0.0
        factors = [F.greatest(F.col(name), F.lit(least)) for name in names[1:]]
        product = reduce(mul, factors, F.col(names[0]))
        sums = held.groupBy("hash").agg(F.sum(product).alias("bound"))
        return sums.agg(F.coalesce(F.min("bound"), F.lit(0.0)).alias("row_bound"))

    def stays_within(self, rows: int) -> bool:
        """Whether the joined frame has at most so many rows; keys are counted only if a bound from
        far fewer counts does not tell already."""
        if self.row_bound().first().row_bound <= rows:
            return True
        return self.summary().first().joined_rows <= rows

    def null_counts(self, columns: Sequence[str] = ()) -> DataFrame:
        """One row: ``rows`` of the joined frame and ``nulls_j`` of each column in it."""
        totals = [F.coalesce(F.sum(self._product()), F.lit(0)).alias("rows")]
        for j, column in enumerate(columns):
            own = self._owner(column)
            nulls = F.col(f"nulls_{j}")
            if own > 0 and self.how == "left":  # an unmatched core row is one NULL
                nulls = F.when(F.col(f"rows_{own}").isNull(), 1).otherwise(nulls)
            count = F.sum(nulls * self._product(without=own))
            totals.append(F.coalesce(count, F.lit(0)).alias(f"nulls_{j}"))
        return self.per_key(columns).agg(*totals)

    def group_counts(self, column: str, cell_rows: int = CELL_ROWS) -> DataFrame:
        """``(column, n)``: what ``groupBy(column).count()`` gives on the joined frame."""
        weighted = self._weighted(column, cell_rows)
        return weighted.groupBy("value").agg(F.sum("weight").alias("n")).toDF(column, "n")

    def count_present(self, column: str) -> DataFrame:
        """One row, ``row_count``: joined rows in which ``column`` is not NULL."""
        counts = self.null_counts([column])
        return counts.select((F.col("rows") - F.col("nulls_0")).alias("row_count"))

    def _owner(self, column: str) -> int:
        """Position of the table that supplies ``column``: 0 for the core, then the sides."""
        for at, table in enumerate((self.core, *self.sides)):
            if column in table.columns and (at == 0 or column != self.key):
                return at
        raise ValueError(f"fan-out on {self.key}: no column {column}")

    def _weighted(self, column: str, cell_rows: int) -> DataFrame:
        """``(value, weight)``: each input value with the number of joined rows it is in.

        The rows of one table meet the per-key counts, which hold each key once.
        """
        counts = self.per_key()
        if column == self.key:
            return counts.select(F.col("key").alias("value"), self._product().alias("weight"))
        own = self._owner(column)
        weights = counts.select(
            F.col("key").alias("counted"), self._product(without=own).alias("weight")
        )
        table = (self.core, *self.sides)[own]
        values = table.select(quoted(self.key).alias("key"), quoted(column).alias("value"))
        if own == 0 and self.how == "left":
            # Only a NULL key finds no counts, and it meets no side row either.
            heavy = heavy_keys(values, "key", cell_rows)
            weighted = join_keyed(values, "key", weights, "counted", "left", heavy)
            return weighted.select("value", F.coalesce("weight", F.lit(1)).alias("weight"))
        values = values.where(F.col("key").isNotNull())
        heavy = heavy_keys(values, "key", cell_rows)
        matched = join_keyed(values, "key", weights, "counted", "inner", heavy)
        matched = matched.select("value", "weight")
        if self.how == "inner":
            return matched
        kind = table.schema[column].dataType
        unmatched = counts.where(F.col(f"rows_{own}").isNull()).select(
            F.lit(None).cast(kind).alias("value"), self._product(without=own).alias("weight")
        )
        return matched.unionAll(unmatched)

    # -- rows -----------------------------------------------------------------------------

    def frame(self, max_rows: int | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
        """The joined frame; refuses to build one of more than ``max_rows`` rows.

        Runs one job over the key columns to learn how the rows spread over the keys. Heavy keys
        are dealt by all columns of their rows, so take the ``pruned`` join of those you need.
        """
        # As doubles: a total past the range of a long must still reach the refusal below.
        counts = self._counts(()) if self.counts is None else self.counts
        held = lambda column: F.when(self._joining(), column)
        joined = held(self._product_as_double())
        sides = [F.col(f"rows_{at + 1}") for at in range(len(self.sides))]
        row = counts.agg(
            F.count_if(self._idle(cell_rows)),
            F.sum(held(F.col("rows_0"))),
            F.sum(joined),
            F.max(joined),
            *[F.max(held(rows)) for rows in sides],
            *[F.sum(rows) for rows in sides],
            *[F.sum(F.when(~self._joining(), rows)) for rows in sides],
        ).first()
        idle, core_rows, total, top, *per_side = [value or 0 for value in row]
        count = len(sides)
        groups, side_rows, idle_rows = [
            per_side[at * count : (at + 1) * count] for at in range(3)
        ]
        if max_rows is not None and total > max_rows:
            raise FanoutTooLarge(f"fan-out on {self.key}: {total:.0f} rows, allowed are {max_rows}")
        join = self.counted() if idle or top > cell_rows else self
        if idle:
            join = join.without_idle_keys(cell_rows)
        if any(
            every >= FILTER_ROWS and own >= FILTER_SHARE * every
            for every, own in zip(side_rows, idle_rows, strict=True)
        ):
            join = join.reduced()
        small = join._small_sides(groups) if top > cell_rows else []
        large = [at for at in range(len(self.sides)) if at not in small]
        rest = join._only(large)
        heavy = rest.heavy_keys(cell_rows) if top > cell_rows and large else None
        if heavy is not None:
            joined = rest._join_in_cells(heavy)
        else:
            core = join.core
            tasks = _tasks(core, core_rows, total, cell_rows)
            if tasks and join._stays(large, side_rows):
                core = core.repartition(tasks)
            joined = FanoutJoin(core, self.key, rest.sides, self.how)._join_whole()
        for at in small:
            joined = joined.join(F.broadcast(join.sides[at]), self.key, self.how)
        return joined.select(*map(quoted, self.columns))

    def _only(self, sides: Sequence[int]) -> FanoutJoin:
        """The join with some of the sides, and their counts if they are written down."""
        tables = [0, *[at + 1 for at in sides]]
        rows = [F.col(f"rows_{table}").alias(f"rows_{at}") for at, table in enumerate(tables)]
        counts = None if self.counts is None else self.counts.select("key", *rows)
        kept = tuple(self.sides[at] for at in sides)
        return FanoutJoin(self.core, self.key, kept, self.how, counts)

    def _stays(self, sides: Sequence[int], rows: Sequence[int]) -> bool:
        """Whether the core is joined where it is read; sides that Spark would not broadcast move
        it anyway. ``rows`` holds how many each side has."""
        conf = self.core.sparkSession._jsparkSession.sessionState().conf()
        limit = conf.autoBroadcastJoinThreshold()
        return all(
            rows[at] * FIELD_BYTES * len(self.sides[at].columns) <= limit
            and measured_bytes(self.sides[at]) <= limit
            for at in sides
        )

    def first_rows(self, order: str, rows: int) -> DataFrame:
        """The first ``rows`` of the joined frame by ``order``, a column of the core; ties by the
        other core columns, then by those of each side. NULLs come first.

        Only as many core rows are joined, each with as many rows of its key from each side, so
        the joined frame is never built.
        """
        if self._owner(order) != 0:
            raise ValueError(f"fan-out on {self.key}: {order} is not a column of the core")
        first = [order, *[c for c in self.core.columns if c != order]]
        core = self.core
        if self.how == "inner":
            for side in self.sides:
                core = core.join(side.select(quoted(self.key)), self.key, "left_semi")
        core = core.orderBy(*map(quoted, first)).limit(rows)
        # At most ``rows`` keys.
        keys = F.broadcast(core.select(quoted(self.key)).distinct())
        sides = []
        for side in self.sides:
            others = [quoted(c) for c in side.columns if c != self.key]
            place = F.row_number().over(Window.partitionBy(quoted(self.key)).orderBy(*others))
            near = side.join(keys, self.key, "left_semi").withColumn("__place", place)
            sides.append(near.where(F.col("__place") <= rows).drop("__place"))
        joined = FanoutJoin(core, self.key, tuple(sides), self.how)._join_whole()
        ordered = [*first, *[c for c in self.columns if c not in first]]
        return joined.orderBy(*map(quoted, ordered)).limit(rows).select(*map(quoted, self.columns))

    def _join_whole(self) -> DataFrame:
        return reduce(lambda left, side: left.join(side, self.key, self.how), self.sides, self.core)

    def _small_sides(self, groups: Sequence[int]) -> list[int]:
        """Positions in ``sides`` of those to broadcast, given the most rows each has of a key."""
        small, fanout = [], 1
        for at in sorted(range(len(self.sides)), key=lambda at: groups[at]):
            fanout *= max(groups[at], 1)
            if fanout > BROADCAST_FANOUT:
                break
            if fits_broadcast(self.sides[at]):
                small.append(at)
        return small

    def _product_as_double(self) -> Column:
        return reduce(
            mul, [self._multiplier(at).cast("double") for at in range(len(self.sides) + 1)]
        )

    def heavy_keys(self, cell_rows: int = CELL_ROWS) -> DataFrame | None:
        """``heavy_key`` and ``parts_0``, ``parts_1``..: in how many parts to deal each table."""
        tables = len(self.sides) + 1
        counts = self.per_key().select(
            F.col("key").alias("heavy_key"),
            *[self._multiplier(at).alias(f"rows_{at}") for at in range(tables)],
        )
        found = heaviest(counts, self._product_as_double(), cell_rows)
        if found is None:
            return None
        parts = [F.col(f"parts_{at}") for at in range(tables)]
        return with_parts(found, tables, cell_rows).select("heavy_key", *parts)

    def _join_in_cells(self, heavy: DataFrame) -> DataFrame:
        names = self.columns
        cell, key = "__cell", "__key"
        dealt = [self._deal(at, heavy) for at in range(len(self.sides) + 1)]
        joined = dealt[0]
        for at, right in enumerate(dealt[1:], start=1):
            right = right.withColumnsRenamed({self.key: f"{key}_{at}", cell: f"{cell}_{at}"})
            right = right.drop(*[f"__split_{n}" for n in range(len(dealt))])
            on = (quoted(self.key) == F.col(f"{key}_{at}")) & (F.col(cell) == F.col(f"{cell}_{at}"))
            # Spark estimates a dealt side without its copies, and might broadcast it by that.
            joined = joined.join(right.hint("merge"), on, self.how)
            if self.how == "left":
                # A key whose side rows were dealt has matches; a cell that happened to get none
                # of them must not pass for an unmatched row.
                joined = joined.where(~F.col(f"__split_{at}") | F.col(f"{key}_{at}").isNotNull())
        return joined.select(*map(quoted, names))

    def _deal(self, at: int, heavy: DataFrame) -> DataFrame:
        """Give each row of table ``at`` the numbers of the cells it takes part in.

        Cells of a key are numbered in mixed radix over the parts of all tables; a row is copied
        to every cell that agrees with it on its own part. Light keys have the single cell 0.
        """
        table = (self.core, *self.sides)[at]
        tables = range(len(self.sides) + 1)
        columns = table.columns
        if at > 0 or self.how == "inner":
            table = table.where(quoted(self.key).isNotNull())
        marked = table.join(offered(heavy), quoted(self.key).eqNullSafe(F.col("heavy_key")), "left")
        parts = [F.coalesce(F.col(f"parts_{n}"), F.lit(1).cast("long")) for n in tables]
        one = F.lit(1).cast("long")
        below = reduce(mul, parts[:at], one)
        others = reduce(mul, parts[at + 1 :], below)
        split = [(parts[n] > 1).alias(f"__split_{n}") for n in tables]
        copies = with_part(marked, columns, parts[at]).select(
            *map(quoted, columns),
            *split,
            "__part",
            parts[at].alias("__parts"),
            below.alias("__below"),
            F.explode(F.sequence(F.lit(0).cast("long"), others - 1)).alias("__other"),
        )
        number = F.expr(
            "(__other div __below) * __below * __parts + __part * __below + __other % __below"
        )
        return copies.select(
            *map(quoted, columns), *[f"__split_{n}" for n in tables], number.alias("__cell")
        )


def _tasks(core: DataFrame, core_rows: int, joined_rows: float, cell_rows: int) -> int:
    """Over how many tasks to spread ``core`` for its joined rows; 0 to leave it as it is read.

    Broadcast sides leave a core where it is read, and a small one is read in few tasks, however
    many rows each of its rows gives.
    """
    context = core.sparkSession.sparkContext
    tasks = min(ceil(joined_rows / cell_rows), SPREAD_WAVES * context.defaultParallelism)
    worthwhile = joined_rows >= SPREAD_FANOUT * core_rows and tasks > 1 + core_rows / SPLIT_ROWS
    return tasks if worthwhile else 0
