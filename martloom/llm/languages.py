"""Language identification by error-correcting output codes.

Each language gets a codeword of +1 and -1. For every bit a binary classifier tells languages
with +1 from those with -1 by the byte trigrams of a text: the weight of a trigram is the log
ratio of its rates on both sides. A text's margin for a bit is the mean weight of its trigrams.
Decoding gives each codeword a loss, log(1 + exp(-bit * margin)) over all bits, each weighted by
how well its classifier parts the languages it learned from, and takes the least.

The rates come from all training rows, counted where they are read and summed per language and
trigram bucket, in a written table. Weights are sums over languages of that table, and so is the trust
in a bit; both are added up in tasks, a language's counts read as one row. The driver holds a codeword
for each language and ``BUCKETS`` weights for each bit, some 10 * log2(languages) bits: 8,000 languages
have 130 bits. Up to ``TRIED`` languages several random codes are compared; beyond, a code is drawn
once, and the language's number in binary is part of it, so that no two are equal.

Edge cases: a NULL text, or one without a letter, is ``und`` with score 0. Ties go to the first
language by code point. Without any training row every text is ``und``. Copies and repeated rows
count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.names import quoted_name
from martloom.llm.common import text_blocks
from martloom.sinks.scratch import staged

BUCKETS = 1 << 15
SMOOTHING = 0.5
EXHAUSTIVE = 7
CODES_TRIED = 200
TRIED = 256
SUMS_AT_ONCE = 1024
SHARPNESS = 2.0
AMBIGUOUS = 1.0
UNKNOWN = "und"

# ASCII letters in lower case; every other ASCII byte counts as a gap between words.
FOLD = np.arange(256, dtype=np.uint32)
FOLD[:128] = 32
FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bucket of the three bytes at each place; ``BUCKETS`` at the last two of a text, and
    where all three are gaps."""
    folded = FOLD[data]
    code = np.full(len(data), BUCKETS, np.uint32)
    if len(data) > 2:
        joined = folded[:-2] << 16 | folded[1:-1] << 8 | folded[2:]
        hashed = (joined * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)
        code[:-2] = np.where(joined == 0x202020, BUCKETS, hashed)
    for back in (1, 2):
        last = offsets[1:] - back
        code[last[last >= offsets[:-1]]] = BUCKETS
    return code


def codebook(languages: int) -> np.ndarray:
    """Codewords, one row per language. Up to ``EXHAUSTIVE`` languages: all ways to part them."""
    if languages <= EXHAUSTIVE:
        ways = np.arange(1, 1 << max(languages - 1, 0))
        bits = ways[None, :] >> np.arange(languages)[:, None] & 1
        return np.where(bits == 1, 1, -1).astype(np.float32)
    random = np.random.default_rng(0)
    width = int(np.ceil(10 * np.log2(languages)))
    if languages > TRIED:
        code = random.choice([-1, 1], (languages, width)).astype(np.float32)
        own = (languages - 1).bit_length()
        bits = np.arange(languages)[:, None] >> np.arange(own)[None, :] & 1
        code[:, :own] = np.where(bits == 1, 1, -1)
        return code
    best, found = -1, None
    for _ in range(CODES_TRIED):
        code = random.choice([-1, 1], (languages, width)).astype(np.float32)
        apart = (width - code @ code.T) / 2 + np.eye(languages) * width
        if apart.min() > best and (np.abs(code.sum(0)) < languages).all():
            best, found = apart.min(), code
    return found


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # a row per bucket, and a row of zeros for what counts as no trigram
    trust: np.ndarray

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        code = trigrams(data, offsets)
        used = np.concatenate([[0], np.cumsum(code < BUCKETS)])
        counts = used[offsets[1:]] - used[offsets[:-1]]
        sums = np.zeros((len(offsets) - 1, self.code.shape[1]), np.float64)
        full = offsets[1:] > offsets[:-1]
        if full.any():
            starts = offsets[:-1][full]
            for bit in range(self.code.shape[1]):
                values = self.weights[:, bit][code]
                sums[full, bit] = np.add.reduceat(values, starts, dtype=np.float64)
        return sums / np.maximum(counts, 1)[:, None]

    def decoded(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the nearest codeword, its share of all by exp(-loss), and the gap in loss to
        the second."""
        signed = SHARPNESS * margins[:, None, :] * self.code[None, :, :]
        losses = np.logaddexp(0, -signed) @ (self.trust * self.code.shape[1])
        share = np.exp(losses.min(1, keepdims=True) - losses)
        best = losses.argmin(1)
        score = share.max(1) / share.sum(1)
        ordered = np.sort(losses, 1)
        gap = ordered[:, 1] - ordered[:, 0] if losses.shape[1] > 1 else np.full(len(best), np.inf)
        return best, score, gap


def counted(docs: DataFrame) -> DataFrame:
    """``lang, bucket, n``: trigrams of the texts of each language, summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for block, data, offsets in text_blocks(batches, "text"):
            code = trigrams(data, offsets)
            langs = block.column("lang").to_pylist()
            lengths = np.diff(offsets)
            for lang in set(langs):
                own = np.repeat([one == lang for one in langs], lengths)
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang] += np.bincount(code[own], minlength=BUCKETS + 1)[:BUCKETS]
        for lang, row in sums.items():
            full = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(full), pa.string()),
                    pa.array(full, pa.int32()),
                    pa.array(row[full], pa.int64()),
                ],
                ["lang", "bucket", "n"],
            )

    rows = docs.select("lang", "text").mapInArrow(count, "lang string, bucket int, n long")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def learned(docs: DataFrame) -> Model:
    """A model from all rows with a text and a lang."""
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    held = F.collect_list(F.struct("bucket", "n")).alias("counts")
    rows = staged(counted(usable).groupBy("lang").agg(held, F.sum("n").alias("all")), "languages")
    totals = sorted((row.lang, row["all"]) for row in rows.select("lang", "all").collect())
    languages = [lang for lang, _ in totals]
    code = codebook(len(languages))
    bits = code.shape[1]
    if not languages:
        return Model([], code, np.zeros((BUCKETS + 1, bits), np.float32), np.zeros(bits, np.float32))
    whole = np.array([n for _, n in totals]) + SMOOTHING * BUCKETS
    # The rates of a side's languages, added up; what smoothing gives is the same in every bucket.
    sides = [np.where(code > 0, 1.0, 0.0), np.where(code < 0, 1.0, 0.0)]
    smooth = [(SMOOTHING / whole) @ side for side in sides]
    sums = [np.zeros((BUCKETS, bits)) for _ in sides]
    for bucket, up, down in _side_sums(rows, languages, code, whole):
        sums[0][bucket] += up
        sums[1][bucket] += down
    up, down = [
        (total + base) / side.sum(0)
        for total, base, side in zip(sums, smooth, sides, strict=True)
    ]
    weights = np.zeros((BUCKETS + 1, bits), np.float32)
    weights[:BUCKETS] = np.log(up / down)
    least = _least_apart(rows, languages, code, whole, weights)
    trust = np.maximum(least, 1e-3)
    return Model(languages, code, weights, (trust / trust.sum()).astype(np.float32))


def _counts(batches: Iterator[pa.RecordBatch], places: dict[str, int]):
    """For every row of a batch: the place of its language, its buckets, and their counts."""
    for batch in batches:
        lists = batch.column("counts")
        for at, lang in enumerate(batch.column("lang").to_pylist()):
            own = lists[at].values
            yield places[lang], own.field("bucket").to_numpy(), own.field("n").to_numpy()


def _side_sums(rows: DataFrame, languages: list[str], code: np.ndarray, whole: np.ndarray):
    """Bucket by bucket, the rates of the languages on either side of every bit, without smoothing.

    A task adds up its languages; only its sums are shuffled, and what is collected is a row per
    bucket, whatever the number of languages.
    """
    places = {lang: at for at, lang in enumerate(languages)}
    bits = code.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((BUCKETS, 2 * bits))
        both = np.hstack([code > 0, code < 0])
        for place, bucket, n in _counts(batches, places):
            sums[bucket] += np.outer(n / whole[place], both[place])
        full = np.flatnonzero(sums.any(1))
        for begin in range(0, len(full), SUMS_AT_ONCE):
            some = full[begin : begin + SUMS_AT_ONCE]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(list(sums[some]), pa.list_(pa.float64()))],
                ["bucket", "sums"],
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column("sums")
            for at, bucket in enumerate(batch.column("bucket").to_pylist()):
                own = lists[at].values.to_numpy()
                sums[bucket] = sums[bucket] + own if bucket in sums else own
        if sums:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(sums), pa.int32()),
                    pa.array(list(sums.values()), pa.list_(pa.float64())),
                ],
                ["bucket", "sums"],
            )

    out = "bucket int, sums array<double>"
    parts = rows.select("lang", "counts").mapInArrow(add, out)
    merged = parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, out)
    for row in merged.toLocalIterator():
        yield row.bucket, np.array(row.sums[:bits]), np.array(row.sums[bits:])


def _least_apart(
    rows: DataFrame, languages: list[str], code: np.ndarray, whole: np.ndarray, weights: np.ndarray
) -> np.ndarray:
    """For every bit, the mean weight that the worst of its own languages gets on its own side."""
    places = {lang: at for at, lang in enumerate(languages)}
    base = weights[:BUCKETS].sum(0, dtype=np.float64) * SMOOTHING

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.full(code.shape[1], np.inf)
        for place, bucket, n in _counts(batches, places):
            mean = (n @ weights[bucket].astype(np.float64) + base) / whole[place]
            np.minimum(found, mean * code[place], out=found)
        yield pa.RecordBatch.from_arrays([pa.array([found], pa.list_(pa.float64()))], ["least"])

    parts = rows.select("lang", "counts").mapInArrow(least, "least array<double>")
    of = F.posexplode("least").alias("bit", "least")
    bits = parts.select(of).groupBy("bit").agg(F.min("least").alias("least"))
    return np.array([row.least for row in sorted(bits.collect())])


def identified(docs: DataFrame, model: Model, *carried: Column) -> DataFrame:
    """``carried`` with ``lang_pred, score, ambiguous`` per document; only the text is looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], object)
        for block, data, offsets in text_blocks(batches, "__text"):
            letters = block.column("__letters").to_numpy(zero_copy_only=False).astype(bool)
            best = np.full(block.num_rows, len(model.languages))
            score, gap = np.zeros(block.num_rows), np.zeros(block.num_rows)
            if model.languages:
                best, score, gap = model.decoded(model.margins(data, offsets))
                best = np.where(letters, best, len(model.languages))
                score, gap = np.where(letters, score, 0.0), np.where(letters, gap, 0.0)
            added = [pa.array(names[best], pa.string()), pa.array(score), pa.array(gap < AMBIGUOUS)]
            yield pa.RecordBatch.from_arrays(
                [*block.columns[2:], *added],
                [*block.schema.names[2:], "lang_pred", "score", "ambiguous"],
            )

    rows = docs.select(
        F.col("text").alias("__text"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letters"),
        *carried,
    )
    fields = [f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in rows.schema[2:]]
    added = ["lang_pred string", "score double", "ambiguous boolean"]
    return rows.mapInArrow(run, ", ".join([*fields, *added]))
