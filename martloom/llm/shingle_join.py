"""Documents whose word shingles agree, by prefixes of token combinations; and their components.

Words are runs of bytes other than ASCII white space, A-Z in lower case; a document's set holds its
distinct shingles. Two documents are linked if their sets have a Jaccard similarity of at least
``percent`` / 100. Every link is found; no step is a matter of chance. Steps:

1. Documents with equal sets form a class; from here on only classes count.
2. **Order.** Tokens (shingles) are ordered by the number of classes that hold them, rarest first.
   Classes are dealt into blocks, each counts its tokens, and the counts are added per range of
   tokens; what returns to a block is a byte per token, the logarithm of the sum. So a token that all
   documents share is a single number in every block. Tokens are told apart by 48 bits here, which
   may raise a count, but alike for all that hold the token.
3. **Keys.** If sets x and y are linked, at most n - ceil(t * n) tokens of x are missing from y. Tokens
   in few classes are keys by themselves, more frequent ones only in combinations of two or three of
   the same *group* (a hash of the token). Of a group with g tokens of x, k - 1 may be shared without a
   shared combination of k, so the group secures g - k + 1. x's *prefix* is the shortest start of its
   order that secures n - ceil(t * n) + 1: the prefix is longer the more frequent tokens it holds,
   and two linked sets have a key in common. Tokens that no other class holds secure one each and
   need no key, so most documents have none. The number of groups grows with the size of the sets,
   in levels of doubling size (a set takes part in each level where it can have partners), so that
   a set has keys in proportion to its tokens; it is small enough for every prefix to exist.
4. **Cells.** Classes with an equal key form a bucket, buckets with the same members count once. Members
   carry no set, but a parity sketch of its tokens: the bits in which two sketches differ are never
   more than the tokens in which the sets differ. In a cell, pairs that size, number of shareable
   tokens and sketches allow are proposed, the surest first, until those allowed are connected.
5. **Verification** with the full sets. If a proposed pair is refused, its cell proposes again if it has
   more, each time ``EXTRA`` times as many for a component, and after ``ROUNDS`` times everything it
   has left. From the second time on it names the members of the pairs left, and only these are read
   again. Then every allowed pair of a cell is connected or refused.
6. A bucket of several cells, each with the bucket's smallest member, is gone through again if its
   members ended in several components: those outside its largest component meet all others.

Links are joined to components by alternating large-star and small-star (``near_dups.components``).
A task holds a block of about ``BLOCK_SHINGLES`` shingles, a range of about ``PART_SHINGLES``, or a
cell; a single long text may exceed a block.

Edge cases: a text that is NULL or has no words has an empty set and is linked with nothing. With
fewer words than a shingle, the whole sequence is the only one. Rows that share a doc_id are classes
by their own texts. A row without a doc_id cannot name a class: its component is that of documents
with its set, else NULL. Similarities are compared as integers. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.sizes import fits_broadcast
from martloom.llm import words
from martloom.llm.common import salted_join, text_blocks
from martloom.llm.near_dups import components, group_bounds, whole_groups
from martloom.sinks.scratch import staged

BLOCK_SHINGLES = 1 << 20
PART_SHINGLES = 1 << 21
TOKEN_BITS = 48

# Tokens in fewer than 2**6 classes are keys, those in fewer than 2**12 in pairs, others in triples.
PAIRED, TRIPLED = 6, 12
# Tokens of the smallest prefix of a level that fall into one group, about.
PAIR_GROUP, TRIPLE_GROUP = 4, 3

CELL = 4096
CELL_BYTES = 1 << 25
SKETCH = 4  # bits a token, at least
ROUNDS = 4
# Pairs above a forest that a component may have in the second round; in each later one as many times
# more. A pair is sure if it is linked though tokens undo each other by so many deviations more.
EXTRA = 8
DOUBT = 2
PAIRS_A_GROUP = 64


# -- sets and classes ------------------------------------------------------------------------


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    lowered = words.LOWER[data]
    begins, ends, bounds = words.word_spans(lowered, offsets)
    hashes = words.word_hashes(lowered, begins, ends)
    return words.distinct(*words.shingle_hashes(hashes, bounds, width))


def placed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with ``place``, a hash of both that finds the row again."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return named.withColumn("place", F.xxhash64("doc_id", "text"))


def described(texts: DataFrame, width: int) -> DataFrame:
    """``doc_id, place, n, high, low`` of every document; high and low are a hash of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, offsets in text_blocks(batches, "text"):
            sets = shingle_sets(data, offsets, width)
            high = [np.bitwise_xor.reduce(words.mixed(one)) for one in sets]
            low = [np.add.reduce(words.mixed(one ^ words.STEP)) for one in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    block.column("place"),
                    pa.array([len(one) for one in sets], pa.int64()),
                    pa.array(np.array(high, np.uint64).view(np.int64)),
                    pa.array(np.array(low, np.uint64).view(np.int64)),
                ],
                ["doc_id", "place", "n", "high", "low"],
            )

    return texts.mapInArrow(run, "doc_id long, place long, n long, high long, low long")


def block_sets(
    texts: pa.Table, wanted: pa.Table, width: int
) -> tuple[list[int], list[np.ndarray]]:
    """Nodes of a block, ascending, and their sets. ``wanted``: node, doc_id, place."""
    columns = [wanted.column(name).to_pylist() for name in ("doc_id", "place", "node")]
    nodes = {(a, b): node for a, b, node in zip(*columns, strict=True)}
    keys = zip(texts.column("doc_id").to_pylist(), texts.column("place").to_pylist(), strict=True)
    found = [(nodes.pop(key), at) for at, key in enumerate(keys) if key in nodes]
    found.sort()
    rows = texts.select(["text"]).take(pa.array([at for _, at in found], pa.int64()))
    sets = []
    for _, data, offsets in text_blocks(iter(rows.combine_chunks().to_batches()), "text"):
        sets += shingle_sets(data, offsets, width)
    return [node for node, _ in found], sets


# -- the order of tokens ---------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, which compress well where the numbers are small."""
    width = 4 if not len(values) or int(values.max()) < 2**32 else 8
    raw = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    return bytes([width]) + raw.T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    return planes.T.copy().view(f"<u{width}").ravel().astype(np.uint64)


def short_tokens(sets: list[np.ndarray]) -> np.ndarray:
    joined = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return joined >> np.uint64(64 - TOKEN_BITS)


def part_bounds(tokens: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins in ascending tokens; a part is a range of tokens."""
    edges = [-(-(part << TOKEN_BITS) // parts) for part in range(parts + 1)]
    return np.searchsorted(tokens, np.array(edges, np.uint64))


def token_counts(blocks, width: int, parts: int) -> DataFrame:
    """``part, blk, tokens, counts``: the distinct tokens of each block, by range."""

    def run(key, texts: pa.Table, wanted: pa.Table) -> pa.Table:
        _, sets = block_sets(texts, wanted, width)
        tokens, counts = np.unique(short_tokens(sets), return_counts=True)
        bounds = part_bounds(tokens, parts)
        held = np.flatnonzero(np.diff(bounds))
        cuts = [(bounds[part], bounds[part + 1]) for part in held]
        steps = [np.diff(tokens[a:b], prepend=np.uint64(0)) for a, b in cuts]
        return pa.table(
            {
                "part": pa.array(held, pa.int32()),
                "blk": pa.array([key[0].as_py()] * len(held), pa.int64()),
                "tokens": pa.array([packed(step) for step in steps], pa.binary()),
                "counts": pa.array([packed(counts[a:b]) for a, b in cuts], pa.binary()),
            }
        )

    return blocks.applyInArrow(run, "part int, blk long, tokens binary, counts binary")


def token_ranks(counts: DataFrame) -> DataFrame:
    """``part, blk, ranks``: for each token of a block, the logarithm of its count in all blocks;
    0 for a token that only one class holds."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        tokens = [np.cumsum(unpacked(x.as_py())) for x in rows.column("tokens")]
        held = [unpacked(x.as_py()) for x in rows.column("counts")]
        _, place = np.unique(np.concatenate(tokens), return_inverse=True)
        total = np.bincount(place, np.concatenate(held))
        rank = np.floor(np.log2(total)).astype(np.uint8)[place]
        ends = np.cumsum([len(x) for x in tokens])
        cuts = [part.tobytes() for part in np.split(rank, ends[:-1])]
        return pa.table(
            {
                "part": rows.column("part"),
                "blk": rows.column("blk"),
                "ranks": pa.array(cuts, pa.binary()),
            }
        )

    return counts.groupBy("part").applyInArrow(run, "part int, blk long, ranks binary")


# -- prefixes and keys -----------------------------------------------------------------------


def least_shared(percent: int, total):
    """Tokens that linked sets of ``total`` tokens in all have in common, at least."""
    return -(-percent * total // (100 + percent))


def secured(n: int, percent: int) -> int:
    """How many tokens a prefix of a set of ``n`` has to secure."""
    return n + (-percent * n // 100) + 1


def levels_of(n: int, percent: int) -> range:
    """The levels in which a set of ``n`` takes part: its own, and those of larger partners."""
    return range(n.bit_length() - 1, (100 * n // percent).bit_length())


@lru_cache(256)
def groups_at(level: int, percent: int) -> tuple[int, int]:
    """Numbers of groups for pairs and for triples at a level; 0 if it has none.

    Every set of the level must be able to secure its prefix though each group may lose one
    token, or two. The smallest sets, of ``least`` tokens, can spare ``spare`` of them.
    """
    least = -(-percent * (1 << level) // 100)
    need = secured(least, percent)
    spare = least - need
    pairs, triples = max(1, need // PAIR_GROUP), max(1, need // TRIPLE_GROUP)
    if pairs + 2 * triples <= spare:
        return pairs, triples
    return (pairs, 0) if pairs <= spare else (0, 0)


def _classes(tokens: np.ndarray, ranks: np.ndarray, level: int, percent: int):
    """How many tokens of its group each token is combined with, and its group."""
    pairs, triples = groups_at(level, percent)
    size = np.ones(len(tokens), np.int64)
    group = np.arange(len(tokens), dtype=np.int64)
    if pairs:
        spread = (words.mixed(tokens) >> np.uint64(8)).astype(np.int64)
        third = ranks >= TRIPLED if triples else np.zeros(len(tokens), bool)
        second = (ranks >= PAIRED) & ~third
        size[second], group[second] = 2, -1 - spread[second] % pairs
        if triples:
            size[third], group[third] = 3, -1 - pairs - spread[third] % triples
    return size, group


def keys_of(tokens: np.ndarray, ranks: np.ndarray, percent: int) -> np.ndarray:
    """The keys of a set, from its tokens and their ranks."""
    order = np.lexsort((tokens, ranks))
    tokens, ranks = tokens[order], ranks[order]
    n = len(tokens)
    need = secured(n, percent)
    found = []
    for level in levels_of(n, percent):
        size, group = _classes(tokens, ranks, level, percent)
        by_group = np.argsort(group, kind="stable")
        sorted_group = group[by_group]
        first = np.searchsorted(sorted_group, sorted_group)
        place = np.empty(n, np.int64)
        place[by_group] = np.arange(n) - first
        prefix = int(np.searchsorted(np.cumsum(place >= size - 1), need)) + 1
        own = by_group[by_group < prefix]
        single = own[(size[own] == 1) & (ranks[own] > 0)]
        found.append(words.mixed(tokens[single] ^ words.STEP))
        for k in (2, 3):
            members = own[size[own] == k]
            if len(members) >= k:
                found.append(_combined(tokens[members], group[members], k, level))
    return np.unique(np.concatenate(found))


def _combined(tokens: np.ndarray, group: np.ndarray, k: int, level: int) -> np.ndarray:
    """Hashes of all combinations of ``k`` tokens of a group; both in order."""
    most = int(np.max(np.unique(group, return_counts=True)[1]))
    salt = words.mixed(np.array([2 * level + k], np.uint64))
    found = []
    for one in range(1, most):
        for two in range(one + 1, most) if k == 3 else (one,):
            fits = np.flatnonzero(group[: len(group) - two] == group[two:])
            if not len(fits):
                continue
            value = words.mixed(tokens[fits] * words.BASE + salt)
            value = words.mixed(value + tokens[fits + one] * words.STEP)
            if k == 3:
                value = words.mixed(value * words.BASE + tokens[fits + two])
            found.append(value)
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def sketch_bits(n: int) -> int:
    return max(64, 1 << (SKETCH * n - 1).bit_length())


def sketch(tokens: np.ndarray) -> bytes:
    """For every bit, whether an odd number of tokens falls on it."""
    bits = sketch_bits(len(tokens))
    places = (tokens & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def keyed(blocks, width: int, percent: int) -> DataFrame:
    """``node, n, spare, keys, sketch`` of the classes that have keys; ``spare`` is how many of its
    tokens others hold too. The second side of a block holds its nodes and its ranks."""

    def run(key, texts: pa.Table, known: pa.Table) -> pa.Table:
        nodes = known.filter(pc.is_valid(known.column("node")))
        ranked = known.filter(pc.is_valid(known.column("ranks"))).sort_by("part")
        names, sets = block_sets(texts, nodes, width)
        ranks = b"".join(x.as_py() for x in ranked.column("ranks"))
        _, place = np.unique(short_tokens(sets), return_inverse=True)
        ranks = np.frombuffer(ranks, np.uint8)[place]
        rows: list[tuple] = []
        end = 0
        for name, tokens in zip(names, sets, strict=True):
            begin, end = end, end + len(tokens)
            own = ranks[begin:end]
            spare = int(np.count_nonzero(own))
            if spare < -(-percent * len(tokens) // 100):
                continue
            keys = keys_of(tokens, own, percent)
            if len(keys):
                rows.append((name, len(tokens), spare, keys.view(np.int64), sketch(tokens)))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        named = ["node", "n", "spare", "keys", "sketch"]
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
        return pa.table(dict(zip(named, arrays, strict=True)))

    out = "node long, n long, spare long, keys array<long>, sketch binary"
    return blocks.applyInArrow(run, out)


# -- cells -----------------------------------------------------------------------------------


@dataclass
class Members:
    """The members of a cell."""

    nodes: np.ndarray
    roots: np.ndarray
    sizes: np.ndarray
    spares: np.ndarray
    sketches: list[bytes]

    def proposals(
        self, percent: int, refused: set[tuple[int, int]], extra: int, everything: bool
    ) -> tuple[list[tuple[int, int]], list[int]]:
        """Pairs of nodes that may be linked and are not connected yet, and the members that have more.

        Unless ``everything`` is asked for, only enough of them to connect what they allow: those
        first whose sketches leave no doubt, then the likeliest. A component may have ``extra``
        pairs above these, in case that they are refused. Without any, pairs that are passed over
        are told by sizes alone, so that more members may seem to have them.
        """
        roots = self.roots.copy()
        found: list[tuple[int, int]] = []
        doubtful, left = [], np.zeros(len(self.nodes), bool)
        mates: dict[int, list[int]] = {}
        for a, b in refused:
            mates.setdefault(a, []).append(b)
            mates.setdefault(b, []).append(a)
        for first, others, apart, bits, passed in self._near(roots, percent, extra, everything):
            slack, sure = self._slack(first, others, apart, bits, percent)
            if everything:
                sure[:] = True
            order = np.argsort(apart, kind="stable")
            met = []
            for other in others[order][sure[order]].tolist():
                pair = self._pair(first, other)
                if pair in refused:
                    continue
                if roots[other] == roots[first]:
                    met.append(other)
                    continue
                found.append(pair)
                if not everything:
                    roots[roots == roots[other]] = roots[first]
            apart_yet = roots[others] != roots[first]
            rest = np.flatnonzero(~sure & apart_yet)
            if len(rest):
                doubtful.append((np.full(len(rest), first, np.int32), others[rest], slack[rest]))
            passed = np.concatenate([passed, np.array(met, np.int64), others[~sure & ~apart_yet]])
            if gone := mates.get(int(self.nodes[first])):
                passed = passed[~np.isin(self.nodes[passed], gone)]
            if len(passed):
                left[passed] = left[first] = True
        if doubtful:
            one, two, slack = (np.concatenate(part) for part in zip(*doubtful, strict=True))
            order = np.argsort(-slack, kind="stable")
            used: Counter[int] = Counter()
            for a, b in zip(one[order].tolist(), two[order].tolist(), strict=True):
                pair = self._pair(a, b)
                if pair in refused:
                    continue
                own = int(self.roots[a]), int(self.roots[b])
                joined = roots[a] == roots[b]
                if joined and min(used[own[0]], used[own[1]]) >= extra:
                    left[a] = left[b] = True
                    continue
                found.append(pair)
                if joined:
                    used.update(own)
                else:
                    roots[roots == roots[b]] = roots[a]
        return found, self.nodes[left].tolist()

    def _pair(self, first: int, other: int) -> tuple[int, int]:
        a, b = int(self.nodes[first]), int(self.nodes[other])
        return (a, b) if a < b else (b, a)

    def _slack(self, first, others, apart, bits, percent):
        """By how many tokens less than allowed two sets differ, about; and whether that is sure."""
        total = self.sizes[first] + self.sizes[others]
        allowed = total - 2 * least_shared(percent, total)
        # Two tokens on the same bit undo each other. Of d tokens on m bits about d * d / m do.
        share = np.minimum(2 * apart / bits, 1 - 1e-9)
        differ = -bits / 2 * np.log1p(-share)
        return allowed - differ, differ * (1 + DOUBT * np.sqrt(2 / bits)) <= allowed

    def _near(self, roots: np.ndarray, percent: int, extra: int, everything: bool):
        """For each member the later ones that sketches allow: itself, the others, in how many of how
        many bits they differ, and those passed over as they are connected by now; these are not
        compared by sketches if there is no ``extra``."""
        lengths = np.array([len(one) for one in self.sketches])
        matrix, folded = {}, {}
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            raw = b"".join(self.sketches[row] for row in rows)
            whole = np.frombuffer(raw, np.uint64).reshape(len(rows), -1)
            matrix[length] = (rows, whole)
            if length >= 16:
                half = whole.shape[1] // 2
                folded[length // 2] = (rows, whole[:, :half] ^ whole[:, half:])
        for length, (rows, whole) in matrix.items():
            for at, first in enumerate(rows.tolist()):
                for others, bits in (
                    (rows[at + 1 :], whole[at + 1 :]),
                    folded.get(length, (rows[:0], whole[:0])),
                ):
                    total = self.sizes[first] + self.sizes[others]
                    least = least_shared(percent, total)
                    fits = np.flatnonzero(
                        (self.roots[others] != self.roots[first])
                        & (np.minimum(self.sizes[first], self.sizes[others]) >= least)
                        & (np.minimum(self.spares[first], self.spares[others]) >= least)
                    )
                    passed = fits[:0]
                    if not everything and not extra:
                        apart_yet = roots[others[fits]] != roots[first]
                        passed, fits = fits[~apart_yet], fits[apart_yet]
                    apart = np.bitwise_count(bits[fits] ^ whole[at]).sum(1, dtype=np.int64)
                    near = apart <= total[fits] - 2 * least[fits]
                    fits, apart = fits[near], apart[near]
                    if extra and not everything:
                        apart_yet = roots[others[fits]] != roots[first]
                        passed, fits, apart = fits[~apart_yet], fits[apart_yet], apart[apart_yet]
                    if len(fits) or len(passed):
                        yield first, others[fits], apart, 8 * length, others[passed]


CELL_KEYS = ("key", "block", "other")


def proposed(cells: DataFrame, percent: int, extra: int, everything: bool) -> DataFrame:
    """``key, block, other, a, b, more``: pairs that the cells propose, and whether they have more.
    With ``extra``, a row of a cell without ``b`` names a member that has more pairs.

    ``cells``: the cell, then node, root, n, spare, sketch of a member; or node and ``mate``, a pair
    that was refused.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, CELL_KEYS):
            names = [rows.column(name).to_numpy() for name in CELL_KEYS]
            mates = rows.column("mate").to_numpy(zero_copy_only=False)
            member = rows.column("mate").is_null().to_numpy(zero_copy_only=False)
            columns = [
                rows.column(name).to_numpy(zero_copy_only=False)
                for name in ("node", "root", "n", "spare")
            ]
            sketches = rows.column("sketch")
            found = []
            for a, b in group_bounds(rows, CELL_KEYS):
                own = np.flatnonzero(member[a:b]) + a
                _, once = np.unique(columns[0][own], return_index=True)
                own = own[once]
                gone = np.flatnonzero(~member[a:b]) + a
                refused = {(int(columns[0][at]), int(mates[at])) for at in gone}
                values = [column[own].astype(np.int64) for column in columns]
                cell = Members(*values, [sketches[at].as_py() for at in own.tolist()])
                cell_name = tuple(int(name[a]) for name in names)
                pairs, left = cell.proposals(percent, refused, extra, everything)
                found += [(*cell_name, *pair, bool(left)) for pair in pairs]
                if extra:
                    found += [(*cell_name, node, None, True) for node in left]
            if found:
                *numbers, more = zip(*found, strict=True)
                arrays = [*(pa.array(x, pa.int64()) for x in numbers), pa.array(more)]
                yield pa.RecordBatch.from_arrays(arrays, [*CELL_KEYS, "a", "b", "more"])

    dealt = cells.repartition(*CELL_KEYS).sortWithinPartitions(*CELL_KEYS, "node")
    out = "key long, block long, other long, a long, b long, more boolean"
    return dealt.mapInArrow(run, out)


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int):
    """``a, b, linked`` of distinct pairs of nodes, by their full sets.

    A pair's first node meets its partners in groups of ``PAIRS_A_GROUP``, so its set is copied
    once for that many; a text is read where it lies if the list of nodes is small.
    """
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_A_GROUP).alias("groups"))
    group = F.pmod(F.xxhash64("b"), F.col("groups")).alias("g")
    dealt = staged(pairs.join(degree, "a").select("a", "b", group), "join-dealt")
    sides = dealt.select(F.col("b").alias("node"), "a", "g").unionAll(
        dealt.select(F.col("a").alias("node"), "a", "g").distinct()
    )
    meets = F.struct("a", F.col("g").cast("long").alias("g"))
    asked = sides.groupBy("node").agg(F.collect_list(meets).alias("meets"))
    asked = asked.join(classes.select("node", "doc_id", "place"), "node")
    asked = staged(asked, "join-asked")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, offsets in text_blocks(batches, "text"):
            found = [one.tobytes() for one in shingle_sets(data, offsets, width)]
            yield pa.RecordBatch.from_arrays(
                [block.column("node"), block.column("meets"), pa.array(found, pa.binary())],
                ["node", "meets", "shingles"],
            )

    wanted = F.broadcast(asked) if fits_broadcast(asked) else asked
    rows = texts.join(wanted, ["doc_id", "place"]).select("node", "meets", "text")
    found = rows.mapInArrow(
        sets, "node long, meets array<struct<a: long, g: long>>, shingles binary"
    )
    spread = found.select("node", F.explode("meets").alias("meet"), "shingles")
    spread = spread.select("meet.a", "meet.g", "node", "shingles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ("a", "g")):
            nodes, hubs = rows.column("node").to_numpy(), rows.column("a").to_numpy()
            held = rows.column("shingles")
            result = []
            for a, b in group_bounds(rows, ("a", "g")):
                sets = {}
                for at in range(a, b):
                    if int(nodes[at]) not in sets:
                        raw = held[at].as_buffer()
                        sets[int(nodes[at])] = np.frombuffer(raw, np.uint64)
                hub = int(hubs[a])
                own = sets.pop(hub)
                for other, values in sets.items():
                    place = np.minimum(np.searchsorted(own, values), len(own) - 1)
                    shared = int(np.count_nonzero(own[place] == values))
                    union = len(own) + len(values) - shared
                    result.append((hub, other, 100 * shared >= percent * union))
            if result:
                first, second, linked = zip(*result, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(linked)],
                    ["a", "b", "linked"],
                )

    together = spread.repartition("a", "g").sortWithinPartitions("a", "g", "node")
    return together.mapInArrow(compare, "a long, b long, linked boolean")


def settled(
    cells: DataFrame, marks: DataFrame, found: DataFrame, verify, percent: int
) -> DataFrame:
    """The components of all links so far, when every pair that a cell allows is connected or refused.
    ``cells``: key, block, other, node; ``marks``: node, n, spare, sketch; ``found``: the components
    so far."""
    refused = None
    for turn in range(ROUNDS + 1):
        rooted = cells.join(marks, "node").join(found, "node", "left")
        rooted = rooted.select(
            *CELL_KEYS, "node", F.lit(None).cast("long").alias("mate"),
            F.coalesce("component", "node").alias("root"), "n", "spare", "sketch",
        )
        if refused is not None:
            gone = refused.select(*CELL_KEYS, F.col("a").alias("node"), F.col("b").alias("mate"))
            rooted = rooted.unionByName(gone, allowMissingColumns=True)
        extra = EXTRA**turn if turn else 0
        told = staged(proposed(rooted, percent, extra, turn == ROUNDS), "join-offers")
        offers = told.where("b IS NOT NULL")
        if offers.isEmpty():
            break
        checked = staged(verify(offers.select("a", "b").distinct()), "join-checked")
        linked = checked.where("linked").select("a", "b")
        if not linked.isEmpty():
            known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
            found = components(known.unionAll(linked))
        if turn == ROUNDS:
            break
        # A cell that has proposed all it may is done, whatever was refused.
        bad = offers.where("more").join(checked.where("NOT linked").select("a", "b"), ["a", "b"])
        bad = staged(bad.select(*CELL_KEYS, "a", "b"), "join-refused")
        if bad.isEmpty():
            break
        refused = bad if refused is None else refused.unionAll(bad)
        fresh = staged(bad.select(*CELL_KEYS).distinct(), "join-again")
        if turn:
            cells = told.where("b IS NULL").select(*CELL_KEYS, F.col("a").alias("node"))
        cells = staged(cells.join(fresh, list(CELL_KEYS), "left_semi"), "join-cells")
        refused = staged(refused.join(fresh, list(CELL_KEYS), "left_semi"), "join-refused")
    return found


def first_cells(marks: DataFrame, cell: int) -> tuple[DataFrame, DataFrame]:
    """``key, node, hub, blocks`` of distinct buckets, and their first cells."""
    paired = marks.select(
        "node", F.octet_length("sketch").alias("bytes"), F.explode("keys").alias("key")
    )
    buckets = (
        paired.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("bytes").alias("bytes"),
            F.min("node").alias("hub"),
            F.bit_xor(F.xxhash64("node")).alias("one"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
        )
        .where("n > 1")
    )
    kinds = buckets.groupBy("n", "bytes", "hub", "one", "two").agg(F.min("key").alias("key"))
    blocks = F.greatest(F.ceil(F.col("n") / cell), F.ceil(F.col("bytes") / CELL_BYTES))
    blocks = F.least(blocks, F.col("n")).cast("long").alias("blocks")
    members = paired.select("key", "node").join(kinds.select("key", "hub", blocks), "key")
    members = staged(members, "join-members")
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    hub = (F.col("node") == F.col("hub")) & (F.col("blocks") > 1)
    own = F.array(F.pmod(F.xxhash64("node"), F.col("blocks")))
    block = F.explode(F.when(hub, everywhere).otherwise(own)).alias("block")
    none = F.lit(0).cast("long").alias("other")
    return members, members.select("key", block, none, "node")


def cross_cells(wide: DataFrame, found: DataFrame, cell: int) -> DataFrame:
    """Cells in which members outside a bucket's largest component meet all other members."""
    rooted = wide.join(found, "node", "left")
    rooted = rooted.select("key", "node", F.coalesce("component", "node").alias("root"), "blocks")
    rooted = staged(rooted, "join-wide")
    held = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = held.groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n")
    )
    # As many blocks as for cells of the same size, whatever their sketches take.
    mixed = largest.where("most.n < n").select(
        "key",
        F.col("most.root").alias("main"),
        F.col("most.n").alias("n_main"),
        (F.col("n") - F.col("most.n")).alias("n_minor"),
        F.col("n").alias("n_all"),
    )
    share = lambda n: F.ceil(F.col(n) * F.col("blocks") / F.col("n_all")).cast("long")
    dealt = rooted.join(mixed, "key").select(
        "key",
        "node",
        (F.col("root") == F.col("main")).alias("in_main"),
        share("n_main").alias("mains"),
        share("n_minor").alias("minors"),
    )
    up_to = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    own_main = F.pmod(F.xxhash64("node"), F.col("mains"))
    own_minor = F.pmod(F.xxhash64("node"), F.col("minors"))
    pair = lambda a, b: F.struct(a.alias("block"), b.alias("other"))
    # A cell of a main and a minor block is numbered from 1 on, one of two minor blocks below -1.
    with_minors = F.transform(up_to("minors"), lambda j: pair(own_main + 1, j + 1))
    with_mains = F.transform(up_to("mains"), lambda i: pair(i + 1, own_minor + 1))
    among = F.transform(
        F.filter(up_to("minors"), lambda j: j != own_minor),
        lambda j: pair(-1 - F.least(j, own_minor), -1 - F.greatest(j, own_minor)),
    )
    places = F.when(F.col("in_main"), with_minors).otherwise(F.concat(with_mains, among))
    spread = dealt.select("key", "node", F.explode(places).alias("at"))
    return spread.select("key", "at.block", "at.other", "node")


def joined(docs: DataFrame, width: int = 5, percent: int = 80, cell: int = CELL) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; see the module."""
    spark = docs.sparkSession
    texts = placed_texts(docs)
    signed = staged(described(texts, width), "join-documents")
    same = ["high", "low", "n"]
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "place"))
    classes = (
        signed.where("n > 0")
        .groupBy(*same)
        .agg(F.min(named).alias("of"))
        .where("of IS NOT NULL")
        .select(F.monotonically_increasing_id().alias("node"), *same, "of.doc_id", "of.place")
    )
    classes = staged(classes, "join-classes")
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    blocks, parts = shingles // BLOCK_SHINGLES + 1, shingles // PART_SHINGLES + 1
    blk = F.pmod(F.col("place"), F.lit(blocks)).alias("blk")
    dealt = texts.where("doc_id IS NOT NULL").select(blk, "doc_id", "place", "text").groupBy("blk")
    nodes = classes.select(blk, "node", "doc_id", "place")
    counts = token_counts(dealt.cogroup(nodes.groupBy("blk")), width, parts)
    ranks = token_ranks(counts)
    known = nodes.unionByName(ranks, allowMissingColumns=True).groupBy("blk")
    marks = staged(keyed(dealt.cogroup(known), width, percent), "join-keys")
    members, cells = first_cells(marks, cell)

    def verify(pairs: DataFrame) -> DataFrame:
        return verified(pairs, classes, texts, width, percent)

    sketches = marks.select("node", "n", "spare", "sketch")
    found = spark.createDataFrame([], "node long, component long")
    cells = staged(cells, "join-cells")
    found = settled(cells, sketches, found, verify, percent)
    wide = members.where("blocks > 1")
    if not wide.isEmpty():
        crossed = staged(cross_cells(wide, found, cell), "join-cells")
        found = settled(crossed, sketches, found, verify, percent)
    rooted = classes.join(found, "node", "left").select(
        *same, "doc_id", F.coalesce("component", "node").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    grouped = salted_join(rooted.drop("doc_id"), least, ["root"], "inner").drop("root")
    rows = signed.select("doc_id", *same)
    out = salted_join(rows, grouped, same, "left")
    component = F.coalesce("component_id", "doc_id").alias("component_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component)
