"""Near-duplicate documents by MinHash, and their connected components.

Words are runs of bytes other than ASCII white space, A-Z in lower case; a document's set holds
its distinct shingles. Two documents are linked if their sets have a Jaccard similarity of at
least ``percent`` / 100. Steps:

1. Each set gets ``HASHES`` minima of universal hashes and ``BANDS`` band keys. Documents with
   equal sets form a class, named by its smallest doc_id; from here on only classes count.
   Two sets at the threshold share a band but for 1 case in 20 million (0.8, 32 bands of 4).
2. Classes with an equal band key form a bucket; buckets with the same members count once. A bucket
   is dealt into cells of about ``CELL`` members and ``CELL_SHINGLES`` shingles, or of single members
   that have more, each with the bucket's smallest member. A cell's task compares all pairs not yet connected by size, by signature, and then by their full sets.
3. Links are joined to components by alternating large-star and small-star.
4. Only for buckets of several cells whose members ended in several components, the pairs between
   cells are tested the same way and the components joined again. So no link is lost to a cell, and
   a large group of copies is tested once against its smallest member, not pair by pair.

A task holds one cell's sets. Keys that many documents share are dealt over several tasks.

Edge cases: a text that is NULL or has no words has no shingle and is linked with nothing. With
fewer words than a shingle, the whole sequence is the only one. Rows that share a doc_id are one
document; a row without one belongs to the class of its set if that has any doc_id, else its
component is NULL. Similarities are compared as integers, so a pair at the threshold is linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.sizes import fits_broadcast
from martloom.llm import words
from martloom.llm.common import numbered, salted_join, text_blocks
from martloom.sinks.scratch import staged

HASHES = 128
BANDS = 32
CELL = 1024
CELL_SHINGLES = 1 << 23
# A pair at a similarity of 0.8 shares fewer minima than this in 1 case of 10 million.
LEAST_SHARED = 0.62
HASHED_AT_ONCE = 4096
STAR_SALTS = 32

_random = np.random.default_rng(words.SEED + 1)
FACTORS = _random.integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _random.integers(0, 2**63, HASHES, np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    lowered = words.LOWER[data]
    begins, ends, bounds = words.word_spans(lowered, offsets)
    hashes = words.word_hashes(lowered, begins, ends)
    return words.distinct(*words.shingle_hashes(hashes, bounds, width))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash over a set that is not empty."""
    least = np.full(HASHES, 2**32 - 1, np.uint64)
    for at in range(0, len(shingles), HASHED_AT_ONCE):
        part = shingles[None, at : at + HASHED_AT_ONCE]
        hashed = (FACTORS[:, None] * part + TERMS[:, None]) >> np.uint64(32)
        np.minimum(least, hashed.min(1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key per band, from its number and its minima."""
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, -1).T:
        keys = words.mixed(keys * words.BASE + column + words.STEP)
    return keys.astype(np.int64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, high, low, bands, signature``; high and low are a hash of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, offsets in text_blocks(batches, "text"):
            sets = shingle_sets(data, offsets, width)
            high, low, bands, short = [], [], [], []
            for one in sets:
                least = minima(one) if len(one) else np.zeros(0, np.uint64)
                high.append(np.bitwise_xor.reduce(words.mixed(one)))
                low.append(np.add.reduce(words.mixed(one ^ words.STEP)))
                bands.append(band_keys(least) if len(one) else [])
                short.append(least.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array([len(one) for one in sets], pa.int64()),
                    pa.array(np.array(high, np.uint64).view(np.int64)),
                    pa.array(np.array(low, np.uint64).view(np.int64)),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(short, pa.binary()),
                ],
                ["doc_id", "n_shingles", "high", "low", "bands", "signature"],
            )

    out = "doc_id long, n_shingles long, high long, low long, bands array<long>, signature binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, out)


def shingles_of(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``node, shingles`` (8 bytes each, ascending) of the documents that ``nodes`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, offsets in text_blocks(batches, "text"):
            sets = [one.tobytes() for one in shingle_sets(data, offsets, width)]
            yield pa.RecordBatch.from_arrays(
                [block.column("node"), pa.array(sets, pa.binary())], ["node", "shingles"]
            )

    wanted = F.broadcast(nodes) if fits_broadcast(nodes) else nodes
    rows = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    return rows.join(wanted, "node", "left_semi").mapInArrow(run, "node long, shingles binary")


class Cell:
    """The members of a cell: connects those whose sets are similar enough."""

    def __init__(self, shingles: np.ndarray, sizes: np.ndarray, signatures: np.ndarray,
                 roots: np.ndarray, percent: int):
        self.places = np.unique(shingles, return_inverse=True)[1]
        self.ends = np.cumsum(sizes)
        self.sizes, self.signatures, self.percent = sizes, signatures, percent
        self.roots = roots.copy()
        self.held = np.zeros(len(shingles), bool)

    def _shared(self, first: int, others: np.ndarray) -> np.ndarray:
        """How many shingles the first has in common with each of the others."""
        own = self.places[self.ends[first] - self.sizes[first] : self.ends[first]]
        lengths = self.sizes[others]
        stops = np.cumsum(lengths)
        begins = self.ends[others] - lengths
        at = np.arange(stops[-1]) + np.repeat(begins - (stops - lengths), lengths)
        self.held[own] = True
        found = np.add.reduceat(self.held[self.places[at]], stops - lengths, dtype=np.int64)
        self.held[own] = False
        return found

    def links(self) -> list[tuple[int, int]]:
        """Links that connect what is not connected yet, as pairs of places."""
        found = []
        least = int(LEAST_SHARED * HASHES)
        for first in range(len(self.sizes) - 1):
            others = np.flatnonzero(self.roots[first + 1 :] != self.roots[first]) + first + 1
            if not len(others):
                continue
            size, sizes = self.sizes[first], self.sizes[others]
            near = 100 * np.minimum(size, sizes) >= self.percent * np.maximum(size, sizes)
            others = others[near]
            same = (self.signatures[others] == self.signatures[first]).sum(1)
            others = others[same >= least]
            if not len(others):
                continue
            shared = self._shared(first, others)
            union = size + self.sizes[others] - shared
            for other in others[100 * shared >= self.percent * union].tolist():
                if self.roots[other] != self.roots[first]:
                    found.append((first, other))
                    self.roots[self.roots == self.roots[other]] = self.roots[first]
        return found


def links_in(members: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links found in cells. ``members``: key, block, node, root, n_shingles, signature,
    shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ("key", "block", "other")):
            ends, data = _bytes(rows.column("shingles"))
            data = data[: ends[-1]].view(np.uint64)
            at, marks = _bytes(rows.column("signature"))
            marks = marks[at[0] : at[-1]].reshape(-1, HASHES)
            nodes, roots = rows.column("node").to_numpy(), rows.column("root").to_numpy()
            pairs = []
            for a, b in group_bounds(rows, ("key", "block", "other")):
                sizes = np.diff(ends[a : b + 1]) // 8
                own = data[ends[a] // 8 : ends[b] // 8]
                found = Cell(own, sizes, marks[a:b], roots[a:b], percent).links()
                pairs += [(nodes[a + x], nodes[a + y]) for x, y in found]
            if pairs:
                left, right = zip(*pairs, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"]
                )

    dealt = members.repartition("key", "block", "other")
    ordered = dealt.sortWithinPartitions("key", "block", "other", "node")
    return ordered.mapInArrow(run, "a long, b long")


def group_bounds(rows: pa.RecordBatch, keys: tuple[str, ...]) -> list[tuple[int, int]]:
    """Begin and end of each run of equal keys."""
    new = np.zeros(rows.num_rows + 1, bool)
    new[[0, -1]] = True
    for key in keys:
        values = rows.column(key).to_numpy()
        new[1:-1] |= values[1:] != values[:-1]
    at = np.flatnonzero(new).tolist()
    return list(zip(at, at[1:], strict=False))


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]
) -> Iterator[pa.RecordBatch]:
    """Batches cut anew so that none ends within a run of equal keys."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = group_bounds(batch, keys)[-1][0]
        if kept and (cut or not _continues(kept[-1], batch, keys)):
            yield _joined([*kept, batch.slice(0, cut)])
            kept = []
        elif cut:
            yield _joined([batch.slice(0, cut)])
        kept.append(batch.slice(cut))
    if kept:
        yield _joined(kept)


def _continues(before: pa.RecordBatch, after: pa.RecordBatch, keys: tuple[str, ...]) -> bool:
    return all(before.column(key)[-1].equals(after.column(key)[0]) for key in keys)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One batch of all rows; binary columns become large ones, as they may pass 2 GB."""
    table = pa.Table.from_batches(parts)
    large = [
        field.with_type(pa.large_binary()) if pa.types.is_binary(field.type) else field
        for field in table.schema
    ]
    table = table.cast(pa.schema(large)).combine_chunks()
    (whole,) = table.to_batches(max_chunksize=max(table.num_rows, 1))
    return whole


def _bytes(column: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the values, one more than there are, and the bytes that these count in."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return ends, np.frombuffer(data, np.uint8)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of all linked nodes; the component is its smallest node.

    Alternates large-star and small-star until every edge points at the smallest node of its
    component. Each round is written to the shared folder, which cuts the lineage.
    """
    edges = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    edges = staged(edges.where("high <> low").distinct(), "star")
    while True:
        large = _large_star(edges)
        edges = staged(_small_star(large), "star")
        parents = edges.groupBy("high").agg(F.count(F.lit(1)).alias("n"))
        several = parents.where("n > 1").select("high")
        chained = edges.select(F.col("low").alias("high")).distinct().join(parents, "high")
        if several.unionAll(chained.select("high")).isEmpty():
            return edges.select(F.col("high").alias("node"), F.col("low").alias("component"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to the smallest of its neighbourhood."""
    parents = edges.groupBy(F.col("high").alias("low")).agg(F.min("low").alias("parent"))
    # Only of a node that others point at the parent is asked for, and copied.
    parents = parents.join(edges.select("low").distinct(), "low", "left_semi")
    found = salted_join(edges, parents, ["low"], "left", STAR_SALTS)
    return found.select("high", F.coalesce("parent", "low").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of these."""
    salt = F.pmod(F.xxhash64("high", "low"), F.lit(STAR_SALTS)).cast("int").alias("salt")
    dealt = edges.select("high", "low", salt)
    parents = _parents(dealt)
    found = dealt.join(_copied(parents), ["high", "salt"]).where("low > parent")
    others = found.select(F.col("low").alias("high"), F.col("parent").alias("low"))
    own = parents.select("high", F.col("parent").alias("low"))
    return own.unionAll(others).distinct()


def _parents(dealt: DataFrame) -> DataFrame:
    """Of each node the smallest and the last neighbour, and a bit for each salt of its edges."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("salt"))
    return dealt.groupBy("high").agg(
        F.min("low").alias("parent"), F.max("low").alias("last"), F.bit_or(bit).alias("held")
    )


def _copied(parents: DataFrame) -> DataFrame:
    """``high, parent, salt``: no more copies of a parent than its node has edges.

    A node with a single smaller neighbour has no other to move, and its parent is not copied.
    """
    salts = F.sequence(F.lit(0), F.lit(STAR_SALTS - 1))
    held = F.filter(salts, lambda at: F.bit_get("held", at) == 1)
    several = parents.where("parent < last")
    return several.select("high", "parent", F.explode(held).alias("salt"))


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, cell: int = CELL
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document; see the module."""
    signed = staged(signatures(docs, width), "dup-signatures")
    same = ["high", "low", "n_shingles"]
    classes = (
        signed.where("n_shingles > 0")
        .groupBy(*same)
        .agg(
            F.min("doc_id").alias("node"),
            F.count(F.lit(1)).alias("n_docs"),
            F.first("bands").alias("bands"),
            F.first("signature").alias("signature"),
        )
        .where(F.col("node").isNotNull())
    )
    classes = staged(classes, "dup-classes")
    banded = classes.select("node", "n_shingles", F.explode("bands").alias("key"))
    buckets = (
        banded.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("n_shingles").alias("held"),
            F.min("node").alias("hub"),
            F.bit_xor(F.xxhash64("node")).alias("one"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
        )
        .where("n > 1")
    )
    distinct = buckets.groupBy("n", "held", "hub", "one", "two").agg(F.min("key").alias("key"))
    blocks = F.greatest(F.ceil(F.col("n") / cell), F.ceil(F.col("held") / CELL_SHINGLES))
    blocks = F.least(blocks, F.col("n")).cast("long").alias("blocks")
    members = banded.select("key", "node").join(distinct.select("key", "n", "hub", blocks), "key")
    members = staged(members, "dup-members")
    marks = classes.select("node", "n_shingles", "signature")
    sets = shingles_of(docs, members.select("node").distinct(), width)
    sets = staged(sets.join(marks, "node"), "dup-sets")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    hub = (F.col("node") == F.col("hub")) & (F.col("blocks") > 1)
    cells = members.select(
        "key",
        F.explode(F.when(hub, everywhere).otherwise(F.array(block))).alias("block"),
        F.lit(0).cast("long").alias("other"),
        "node",
        F.col("node").alias("root"),
    ).join(sets, "node")
    links = staged(links_in(cells, percent), "dup-links")
    found = components(links)
    wide = members.where("blocks > 1")
    if not wide.isEmpty():
        links = staged(_between_cells(wide, found, sets, block, percent), "dup-links")
        if not links.isEmpty():
            known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
            found = components(known.unionAll(links))
    named = classes.join(found, "node", "left")
    grouped = named.where("n_docs > 1 OR component IS NOT NULL").select(
        *same, F.coalesce("component", "node").alias("component")
    )
    rows = signed.select("doc_id", *same)
    joined = salted_join(rows, grouped, same, "left")
    component = F.coalesce("component", "doc_id")
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def _between_cells(wide: DataFrame, found: DataFrame, sets: DataFrame, block, percent: int):
    """Links between members in different cells of a bucket and in different components."""
    placed = wide.join(found, "node", "left").withColumn("root", F.coalesce("component", "node"))
    placed = staged(placed.select("key", "blocks", "node", "root"), "dup-wide")
    mixed = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"))
    mixed = mixed.where("a <> b").select("key")
    dealt = placed.join(mixed, "key", "left_semi").withColumn("own", block)
    others = F.filter(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda x: x != F.col("own")
    )
    pairs = dealt.withColumn("with", F.explode(others)).select(
        "key",
        F.least("own", "with").alias("block"),
        (F.greatest("own", "with") + 1).alias("other"),
        "node",
        "root",
    )
    return links_in(pairs.join(sets, "node"), percent)


def without_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id.

    Rows are told apart by a number, not by their doc_id: of repeated rows one stays, also without
    a doc_id, and rows that share one are judged each by its own text. Rows without words all stay.
    """
    rows = numbered(docs, "dup-rows")
    texts = rows.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text"))
    found = near_duplicates(texts, width, percent).select(
        F.col("doc_id").alias("row"), F.col("component_id").alias("component"), "kept"
    )
    found = staged(found, "dup-found")
    several = found.where("NOT kept AND component <> row").select("component").distinct()
    members = salted_join(found.drop("kept"), several, ["component"], "left_semi")
    named = members.join(rows.select("row", F.col("doc.doc_id").alias("name")), "row")
    named = staged(named, "dup-named")
    order = F.struct(F.col("name").isNull().alias("none"), "name", "row")
    stay = named.groupBy("component").agg(F.min(order).getField("row").alias("row"))
    gone = named.select("row").join(stay.select("row"), "row", "left_anti")
    gone = staged(gone, "dup-gone")
    listed = F.broadcast(gone) if fits_broadcast(gone) else gone
    return rows.join(listed, "row", "left_anti").select("doc.*")
