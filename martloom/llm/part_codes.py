"""Vector compression: a codebook per part of the vector, searched by equal averages.

Components become whole numbers, floor(``SCALE`` * x), and a vector is cut into ``PARTS`` equal
consecutive parts. Each part position has a codebook of at most ``ENTRIES`` entries, which begins
as that part of the first vectors by id and is refined in ``ROUNDS`` rounds of k-means; a part's
code is the number of its nearest entry.

Equal-average search: by Cauchy and Schwarz the squared distance of two parts of d components is
at least the squared gap of their component sums over d. Entries are sorted by sum; a search begins
at the part's own sum and goes outward on both sides, and a side ends at the first entry whose
squared gap over d strictly exceeds the best distance. So equally near entries are all seen, and the
smaller number wins. All of it is exact, in 64-bit integers.

A round is one pass over the vectors: a task adds up the parts of each entry, and only these sums,
``ENTRIES`` times the vector's length for a task, are shuffled and added. The codebooks, as large as
``ENTRIES`` vectors, are all that the driver holds. Codes then take ``PARTS`` bytes a vector.

Edge cases: vectors that are NULL or hold a NULL or non-finite component take no part. A length
that ``PARTS`` does not divide is filled up with zeros, which change no distance; an empty vector
becomes one zero a part. Vectors of another (filled) length have codebooks of their own. Rows are
taken as they come: repeated ids give several rows, rows without an id come last in the order that
begins the codebooks, and rows of one id are ordered by their vector. Fewer rows than ``ENTRIES``
give fewer entries. Labels only group errors; NULL labels are one group. Other columns are not
read. An empty table gives no rows. Components so large that distances would pass 64 bits raise
``ValueError``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.names import quoted
from martloom.functions.sizes import fits_broadcast
from martloom.llm.common import salted_join
from martloom.sinks.scratch import staged

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
STRIPE = 4096

# Per vector length: an array of part, entry, component.
Codebooks = dict[int, np.ndarray]


class EqualAverage:
    """The entries of one part position, in the order of their component sums."""

    def __init__(self, entries: np.ndarray):
        sums = entries.sum(1)
        self.order = np.argsort(sums, kind="stable")
        self.sums, self.entries = sums[self.order], entries[self.order]
        self.width = entries.shape[1]
        self.seen = 0

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry of each part, and the squared distance to it."""
        found = [self._nearest(parts[at : at + STRIPE]) for at in range(0, len(parts), STRIPE)]
        numbers, distances = zip(*found, strict=True)
        return np.concatenate(numbers), np.concatenate(distances)

    def _nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = parts.sum(1)
        start = np.searchsorted(self.sums, sums)
        best = np.full(len(parts), np.iinfo(np.int64).max // self.width)
        number = np.full(len(parts), len(self.order))
        sides = [[1, start, np.arange(len(parts))], [-1, start - 1, np.arange(len(parts))]]
        step = 0
        while any(len(rows) for _, _, rows in sides):
            for side in sides:
                move, first, rows = side
                at = first[rows] + move * step
                inside = (at >= 0) & (at < len(self.order))
                rows, at = rows[inside], at[inside]
                gap = self.sums[at] - sums[rows]
                reach = gap * gap <= best[rows] * self.width
                rows, at = rows[reach], at[reach]
                side[2] = rows
                if not len(rows):
                    continue
                apart = self.entries[at] - parts[rows]
                distance = np.einsum("ij,ij->i", apart, apart)
                entry = self.order[at]
                nearer = (distance < best[rows]) | (
                    (distance == best[rows]) & (entry < number[rows])
                )
                best[rows[nearer]], number[rows[nearer]] = distance[nearer], entry[nearer]
                self.seen += len(rows)
            step += 1
        return number, best


def whole_numbers(vectors: DataFrame, *columns: Column, scale: int = SCALE) -> DataFrame:
    """``columns`` and ``vec``, floor(scale * x) filled up to whole parts, of the usable vectors."""
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    floors = F.transform(
        "embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")
    )
    size = F.size("embedding")
    missing = F.when(size == 0, PARTS).otherwise(F.pmod(-size, F.lit(PARTS)))
    filled = F.concat(floors, F.array_repeat(F.lit(0).cast("long"), missing))
    return vectors.where(F.coalesce(finite, F.lit(False))).select(*columns, filled.alias("vec"))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each vector length in a batch: the length, its rows, and these cut into parts."""
    lists = batch.column("vec")
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        most = max(-int(flat.min()), int(flat.max()))
        if (2 * most) ** 2 * length >= 2**62:
            raise ValueError(f"a component of {most} is too large for exact distances")
        yield length, rows, flat.reshape(len(rows), PARTS, length // PARTS)


def first_codebooks(points: DataFrame, entries: int = ENTRIES) -> Codebooks:
    """The parts of the first ``entries`` vectors of each length, by ``vec_id``."""
    books = {}
    lengths = [row[0] for row in points.select(F.size("vec")).distinct().collect()]
    for length in sorted(lengths):
        own = points.where(F.size("vec") == length).orderBy(F.asc_nulls_last("vec_id"), "vec")
        first = np.array([row.vec for row in own.select("vec").limit(entries).collect()], np.int64)
        books[length] = first.reshape(len(first), PARTS, -1).swapaxes(0, 1).copy()
    return books


def refined(points: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round: each used entry becomes the floored mean of its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = {n: [EqualAverage(part) for part in book] for n, book in books.items()}
        sums = {n: np.zeros(book.shape, np.int64) for n, book in books.items()}
        counts = {n: np.zeros(book.shape[:2], np.int64) for n, book in books.items()}
        for batch in batches:
            for length, _, parts in _by_length(batch):
                for at in range(PARTS):
                    numbers, _ = search[length][at].nearest(parts[:, at])
                    np.add.at(sums[length][at], numbers, parts[:, at])
                    counts[length][at] += np.bincount(numbers, minlength=counts[length].shape[1])
        for length, held in counts.items():
            part, entry = np.nonzero(held)
            if len(part):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(part), length), pa.int32()),
                        pa.array(part, pa.int32()),
                        pa.array(entry, pa.int32()),
                        pa.array(held[part, entry]),
                        pa.array(list(sums[length][part, entry]), pa.list_(pa.int64())),
                    ],
                    ["length", "part", "entry", "n", "sums"],
                )

    out = "length int, part int, entry int, n long, sums array<long>"
    partial = points.select("vec").mapInArrow(run, out)
    places = partial.select("length", "part", "entry", "n", F.posexplode("sums").alias("at", "x"))
    totals = places.groupBy("length", "part", "entry", "at").agg(
        F.sum("x").alias("x"), F.sum("n").alias("n")
    )
    moved = {length: book.copy() for length, book in books.items()}
    for row in totals.collect():
        moved[row.length][row.part, row.entry, row.at] = row.x // row.n
    return moved


def learned(points: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of ``points`` (vec_id, vec); ``points`` is read once a round."""
    books = first_codebooks(points, entries)
    for _ in range(rounds):
        books = refined(points, books)
    return books


def digest(book: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, as decimal numbers with commas."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def encoded(points: DataFrame, books: Codebooks) -> DataFrame:
    """``points`` without ``vec``, with ``code`` (a byte a part), ``error`` (the squared distance to
    what the code stands for) and ``codebooks_sha256``."""
    kept = [name for name in points.columns if name != "vec"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = {n: [EqualAverage(part) for part in book] for n, book in books.items()}
        digests = {n: digest(book) for n, book in books.items()}
        for batch in batches:
            for length, rows, parts in _by_length(batch):
                found = [search[length][at].nearest(parts[:, at]) for at in range(PARTS)]
                codes = np.stack([numbers for numbers, _ in found], 1).astype(np.uint8)
                own = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[own.column(name) for name in kept],
                        pa.array([code.tobytes() for code in codes], pa.binary()),
                        pa.array(sum(distances for _, distances in found)),
                        pa.array([digests[length]] * len(rows)),
                    ],
                    [*kept, "code", "error", "codebooks_sha256"],
                )

    fields = ", ".join(f"`{name}` {kind}" for name, kind in points.dtypes if name != "vec")
    out = f"{fields}, code binary, error long, codebooks_sha256 string"
    return points.mapInArrow(run, out)


def restored(coded: DataFrame, book: np.ndarray) -> DataFrame:
    """``coded`` with ``vec``, the whole numbers that each code stands for; one vector length."""
    place = {at: F.lit(part.tolist()) for at, part in enumerate(book)}
    entry = [F.conv(F.hex(F.substring("code", at + 1, 1)), 16, 10).cast("int") for at in place]
    parts = [F.element_at(place[at], number + 1) for at, number in enumerate(entry)]
    return coded.withColumn("vec", F.concat(*parts))


def compressed(vectors: DataFrame, make: Callable[[DataFrame], Codebooks] = learned) -> DataFrame:
    """``vec_id, code`` (two hex digits a part), ``error, label_error, codebooks_sha256``.

    ``label_error`` is the error of all rows with the same label. Errors are added up per label
    before anything is shuffled, and joined to rows of a label that are dealt over several tasks.
    """
    group = F.coalesce(quoted("label").cast("string"), F.lit("")).alias("label")
    none = quoted("label").isNull().alias("no_label")
    named = quoted("vec_id").cast("long").alias("vec_id")
    points = staged(whole_numbers(vectors, named, group, none), "part-points")
    coded = staged(encoded(points, make(points)), "part-codes")
    keys = ["no_label", "label"]
    totals = coded.groupBy(*keys).agg(F.sum("error").alias("label_error"))
    totals = staged(totals, "part-totals")
    if fits_broadcast(totals):
        joined = coded.join(F.broadcast(totals), keys)
    else:
        joined = salted_join(coded, totals, keys, "inner")
    code = F.lower(F.hex("code")).alias("code")
    return joined.select("vec_id", code, "error", "label_error", "codebooks_sha256")
