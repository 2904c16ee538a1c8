"""Spelling variants: words one code point apart, found by pairs of trie nodes.

Words are counted over the whole texts; those of at least ``LENGTH`` code points and ``COUNT``
occurrences are the dictionary. Steps:

1. Every distinct beginning of a dictionary word is a node of the forward trie, every distinct end
   one of the reversed trie. Nodes get whole numbers, equal for equal strings: the words are sorted
   and cut into parts, a word adds a node for each code point beyond what it shares with the word
   before it, and the driver carries only the path of the last word from part to part.
2. A word is then two paths of numbers. For every place, the pair (node of what is before, node of
   what is behind) is its key with that code point *skipped*, or, without skipping, with a code
   point *inserted* there. Two words with the same skipped key differ in that code point alone; a
   skipped key of one that equals an inserted key of the other means one code point more.
   Equal numbers mean equal strings, so the join finds all near words and no others.
3. A word's form is its most frequent near word, if that is ``RATIO`` times as frequent. Forms are
   followed by doubling: each round a word takes the form of its form's last.

At most as many words share a key as there are letters (126 and deletions), so no key is hot.
Words are counted before they are shuffled; joins on forms, where one word may be the form of many,
deal their rows over several tasks. Numbers of nodes take 8 bytes a code point of the dictionary.

Edge cases: NULL and empty texts have no words. Repeated rows count as often as they occur. A NULL
doc_id counts as the empty text where the method hashes ids. Ties among near words go to the
smallest in code-point order. A word without near words has no form and is its own root. An empty
dictionary gives no rows. Very long words are treated like all others. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.names import quoted
from martloom.functions.sizes import fits_broadcast
from martloom.llm.common import salted_join
from martloom.sinks.scratch import staged

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LENGTH = 5
COUNT = 3
RATIO = 2
# One run in so many loses a code point: the contract's stand-in for misspelling.
SLIP = 97
# Code points of dictionary words that a part of a trie holds.
PART_POINTS = 1 << 21


def runs_of(docs: DataFrame) -> DataFrame:
    """``doc, run``: every run of letters of every text, A-Z in lower case."""
    lowered = F.translate(F.coalesce(quoted("text"), F.lit("")), UPPER, LOWER)
    runs = F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))
    doc = F.coalesce(quoted("doc_id").cast("string"), F.lit(""))
    return docs.select(doc.alias("doc"), F.explode(runs).alias("run"))


def slipped(doc: Column, run: Column) -> Column:
    """The run, without one code point if ``SLIP`` divides the hash of document and run."""
    h = F.crc32(F.concat_ws(":", doc, run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % SLIP == 0, shorter).otherwise(run)


def counted(words: DataFrame, length: int = LENGTH, count: int = COUNT) -> DataFrame:
    """``word, n`` of a column ``word``: those long and frequent enough."""
    long_enough = words.where(F.char_length("word") >= length)
    found = long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return found.where(F.col("n") >= count)


# -- numbering the nodes of a trie -----------------------------------------------------------


def shared_start(one: str, two: str) -> int:
    """How many code points two words begin with in common."""
    most = min(len(one), len(two))
    for at in range(most):
        if one[at] != two[at]:
            return at
    return most


@dataclass(frozen=True)
class Summary:
    """What a part of the sorted words tells about the numbering: its ends and its nodes."""

    first: str
    last: str
    nodes: int
    path: list[int]


class Walk:
    """Numbers the nodes of sorted words: ``path`` holds the node of each start of ``word``."""

    def __init__(self, word: str = "", path: list[int] | None = None, made: int = 0):
        self.word, self.path, self.made = word, path or [0], made

    def to(self, word: str) -> list[int]:
        shared = shared_start(self.word, word)
        new = len(word) - shared
        path = [*self.path[: shared + 1], *range(self.made + 1, self.made + new + 1)]
        self.word, self.path, self.made = word, path, self.made + new
        return path


def _summary(words: list[str]) -> Summary:
    walk = Walk()
    for word in words:
        walk.to(word)
    return Summary(words[0], words[-1], walk.made, walk.path)


def starts(summaries: dict[int, Summary]) -> dict[int, Walk]:
    """Where the numbering of each part begins, from the parts before it.

    A part numbered on its own gives its first word a whole path of new nodes. In truth that word
    shares some with the last one before the part: its first ``shared`` nodes are not new.
    """
    found = {}
    walk = Walk()
    for part in sorted(summaries):
        own = summaries[part]
        found[part] = Walk(walk.word, walk.path, walk.made)
        shared = shared_start(walk.word, own.first)
        known = walk.path[: shared + 1]
        moved = walk.made - shared
        path = [known[n] if n <= shared else n + moved for n in own.path]
        walk = Walk(own.last, path, own.nodes + moved)
    return found


def paths(words: DataFrame, key: Column, points: int, label: str) -> DataFrame:
    """``id, path``: the node numbers of every start of ``key``, the empty one first.

    ``words``: ``id, word, n``; ``points``: the code points of all its words.
    """
    parts = points // PART_POINTS + 1
    ranged = words.select("id", key.alias("key")).repartitionByRange(parts, "key")
    placed = ranged.withColumn("part", F.spark_partition_id())
    placed = staged(placed, label)
    by_part = placed.groupBy("part")

    def summarise(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        own = _summary(sorted(rows.column("key").to_pylist()))
        held = [[key[0].as_py()], [own.first], [own.last], [own.nodes], [own.path]]
        kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64())]
        names = ["part", "first", "last", "nodes", "path"]
        arrays = [pa.array(x, kind) for x, kind in zip(held, kinds, strict=True)]
        return pa.table(dict(zip(names, arrays, strict=True)))

    out = "part int, first string, last string, nodes long, path array<long>"
    known = {
        row.part: Summary(row.first, row.last, row.nodes, list(row.path))
        for row in by_part.applyInArrow(summarise, out).collect()
    }
    begin = starts(known)

    def number(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        at = begin[key[0].as_py()]
        walk = Walk(at.word, at.path, at.made)
        names, words = rows.column("id").to_pylist(), rows.column("key").to_pylist()
        order = sorted(range(len(words)), key=words.__getitem__)
        found = [walk.to(words[n]) for n in order]
        return pa.table(
            {
                "id": pa.array([names[n] for n in order], pa.int64()),
                "path": pa.array(found, pa.list_(pa.int64())),
            }
        )

    return by_part.applyInArrow(number, "id long, path array<long>")


# -- near words ------------------------------------------------------------------------------


def node_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, before, behind, skipped`` for every place of every word."""
    for batch in batches:
        ids = batch.column("id").to_numpy()
        ahead, back = batch.column("ahead"), batch.column("back")
        out: list[list[np.ndarray]] = [[], [], [], []]
        for row, name in enumerate(ids):
            before = ahead[row].values.to_numpy()
            behind = back[row].values.to_numpy()[::-1]
            places = len(before)
            for skip, (a, b) in enumerate([(before, behind), (before[:-1], behind[1:])]):
                out[0].append(np.full(places - skip, name))
                out[1].append(a)
                out[2].append(b)
                out[3].append(np.full(places - skip, skip == 1))
        if len(ids):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(column)) for column in out],
                ["id", "before", "behind", "skipped"],
            )


def near_pairs(spark: SparkSession, words: DataFrame) -> DataFrame:
    """``id, other``: both directions of every pair of words one code point apart, once each.

    ``words``: ``id, word, n``, written.
    """
    points = words.agg(F.sum(F.char_length("word"))).first()[0]
    if points is None:
        return words.select("id", F.col("id").alias("other")).where(F.lit(False))
    ahead = paths(words, F.col("word"), points, "trie-ahead").withColumnRenamed("path", "ahead")
    back = paths(words, F.reverse("word"), points, "trie-back").withColumnRenamed("path", "back")
    both = ahead.join(back, "id")
    out = "id long, before long, behind long, skipped boolean"
    pairs = staged(both.mapInArrow(node_pairs, out), "trie-pairs")
    skipped = pairs.where("skipped").drop("skipped")
    inserted = pairs.where("NOT skipped").drop("skipped")
    keys = ["before", "behind"]
    renamed = skipped.withColumnRenamed("id", "other")
    replaced = skipped.join(renamed, keys).where("id <> other").select("id", "other")
    longer = renamed.join(inserted, keys).select("id", "other").distinct()
    turned = longer.select(F.col("other").alias("id"), F.col("id").alias("other"))
    return replaced.unionAll(longer).unionAll(turned)


def followed(forms: DataFrame) -> DataFrame:
    """``id, root``: the last of the forms that begin with ``id, form`` (NULL for none).

    A form is more frequent than its word, so there are no circles; each round doubles how far
    a word has come.
    """
    reached = staged(forms.select("id", F.coalesce("form", "id").alias("root")), "roots")
    while True:
        ahead = reached.where("id <> root").select(
            F.col("id").alias("root"), F.col("root").alias("beyond")
        )
        if fits_broadcast(ahead):
            joined = reached.join(F.broadcast(ahead), "root", "left")
        else:
            joined = salted_join(reached, ahead, ["root"], "left")
        moved = F.col("beyond").isNotNull().alias("moved")
        further = F.coalesce("beyond", "root").alias("root")
        reached = staged(joined.select("id", further, moved), "roots")
        if reached.where("moved").isEmpty():
            return reached.select("id", "root")
        reached = reached.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a dictionary ``word, n`` of distinct words."""
    spark = words.sparkSession
    numbered = words.select(F.monotonically_increasing_id().alias("id"), "word", "n")
    words = staged(numbered, "spellings")
    near = [F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n")]
    names = words.select(*near)
    pairs = staged(near_pairs(spark, words), "near-pairs")
    # The most frequent near word, the smallest of equally frequent ones.
    best = F.min(F.struct(-F.col("near_n"), "near", "other")).alias("best")
    near = pairs.join(names, "other").groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best)
    joined = words.join(near, "id", "left")
    near_n = -F.col("best").getField("col1")
    good = near_n >= ratio * F.col("n")
    chosen = joined.select(
        "id",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("best.near")).alias("form"),
        F.when(good, near_n).alias("form_n"),
        F.when(good, F.col("best.other")).alias("form_id"),
    )
    chosen = staged(chosen, "forms")
    roots = followed(chosen.select("id", F.col("form_id").alias("form")))
    last = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    if fits_broadcast(last):
        named = roots.join(F.broadcast(last), "root")
    else:
        named = salted_join(roots, last, ["root"], "inner")
    found = chosen.join(named.select("id", "root_word"), "id")
    return found.select("word", "form", F.col("root_word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of whole texts, with the slips that the contract asks for."""
    words = runs_of(docs).select(slipped(F.col("doc"), F.col("run")).alias("word"))
    return variants(counted(words))
