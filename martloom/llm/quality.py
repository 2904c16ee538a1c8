"""Quality scores by Bradley-Terry ranking of preference pairs.

A document of label 1 is preferred to one of label 0. The score is linear in the features below;
its weights minimise the logistic loss over the feature differences of all preference pairs. Among
the quantiles of the training scores, the threshold is the one that parts the labels best, and a
score is given as ``sigmoid(score - threshold + logit(0.7))``, so that 0.7 is the threshold.

Every labelled document counts, in the means and spreads of the features, in the weights and in the
threshold, and every pair of a document of label 1 and one of label 0. The pairs are not listed: how
likely a pair is told apart depends on its two scores alone, so tasks add up the documents of each
label by cells of ``CELL`` of a score, and a pair of cells stands for the pairs of their documents, as
if these had their cell's mean. Newton's steps are taken on such sums until one is below ``ENOUGH``.
They start from the weights that ``fitted`` finds on ``SAMPLE`` documents of each label. The loss is
convex, so that the start changes how many steps are taken and not where they end. The threshold is
found from counts of both labels in ``FINE`` cells of the range of scores. Scoring looks at the whole
text and at nothing else.

Edge cases: a NULL or empty text has the features of a text without words. A document labelled
more than once counts with its lowest label; labels other than 0 and 1, NULL included, and labels
of unknown documents are left out. Of texts with the same doc_id the smallest counts. With fewer than
two labels in the data all scores are 0.7.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.names import quoted_name
from martloom.llm import words
from martloom.llm.common import text_blocks
from martloom.sinks.scratch import staged

SAMPLE = 4000
PAIRS = 100_000
RIDGE = 1e-3
STEPS = 25
QUANTILES = 1000
CELL = 1 / 32
FINE = 1 << 16
ENOUGH = 1e-3
DIGITS = 9
PAIRED_CELLS = 256
AT_THRESHOLD = 0.7

# Kinds of bytes: 0 blank, 1 newline, 2 lower case, 3 upper case, 4 digit, 5 sentence marks,
# 6 other ASCII, 7 beyond ASCII.
KINDS = 8
KIND = np.full(256, 6, np.uint8)
KIND[words.BLANK] = 0
KIND[ord("\n")] = 1
KIND[ord("a") : ord("z") + 1] = 2
KIND[ord("A") : ord("Z") + 1] = 3
KIND[ord("0") : ord("9") + 1] = 4
KIND[[ord(mark) for mark in ".,;:?"]] = 5
KIND[128:] = 7


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row per text: shares of kinds of bytes and words, lengths, and repetition."""
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    kind = KIND[data]
    owner = np.repeat(np.arange(rows), sizes)
    kinds = np.bincount(owner * KINDS + kind, minlength=rows * KINDS).reshape(rows, KINDS)
    begins, ends, bounds = words.word_spans(data, offsets)
    counts = np.diff(bounds)
    of_word = np.repeat(np.arange(rows), counts)
    lengths = ends - begins

    def within(some: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(some)])
        return sums[ends] - sums[begins]

    def share(flag: np.ndarray) -> np.ndarray:
        return np.bincount(of_word, flag, rows) / np.maximum(counts, 1)

    letters = within((kind == 2) | (kind == 3) | (kind == 7))
    upper, other, digits = within(kind == 3), within(kind == 6), within(kind == 4)
    mean = np.bincount(of_word, lengths, rows) / np.maximum(counts, 1)
    square = np.bincount(of_word, lengths.astype(float) ** 2, rows) / np.maximum(counts, 1)
    hashes = words.word_hashes(data, begins, ends)
    pairs, pair_bounds = words.shingle_hashes(hashes, bounds, 2)
    varied, commonest = _variety(hashes, bounds)
    varied_pairs, commonest_pair = _variety(pairs, pair_bounds)
    lines, line_bounds = _lines(data, offsets, kind)
    varied_lines, _ = _variety(lines, line_bounds)
    line_counts = np.diff(line_bounds)
    shares = kinds / np.maximum(sizes, 1)[:, None]
    columns = [
        *shares.T,
        *np.sqrt(shares.T),
        shares[:, 3] / np.maximum(shares[:, 2] + shares[:, 3], 1e-9),
        share(letters == 0),
        share((upper == letters) & (letters > 1)),
        share(other > 0),
        share((other > 0) & (letters > 0)),
        share((digits > 0) & (letters > 0)),
        np.log1p(mean),
        np.log1p(np.sqrt(np.maximum(square - mean**2, 0))),
        np.log1p(counts),
        varied,
        commonest,
        varied_pairs,
        commonest_pair,
        varied_lines,
        np.log1p(counts / np.maximum(line_counts, 1)),
        (counts == 0).astype(float),
    ]
    return np.stack(columns, 1)


def _variety(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of distinct values in each text, and share of its commonest value."""
    counts = np.diff(bounds)
    distinct, most = np.ones(len(counts)), np.zeros(len(counts))
    for at in np.flatnonzero(counts):
        row = np.sort(values[bounds[at] : bounds[at + 1]])
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        runs = np.diff(np.append(starts, len(row)))
        distinct[at], most[at] = len(starts) / len(row), runs.max() / len(row)
    return distinct, most


def _lines(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lines that are not empty, and their number before each text."""
    inside = kind != 1
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:-1]
    end[:-1] &= ~inside[1:] | first[1:-1]
    begins = np.flatnonzero(begin)
    hashes = words.word_hashes(data, begins, np.flatnonzero(end) + 1)
    return hashes, np.searchsorted(begins, offsets)


WIDTH = features(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape[1]


@dataclass(frozen=True)
class Ranking:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def standard(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.center) / self.scale).clip(-10, 10)

    def latent(self, rows: np.ndarray) -> np.ndarray:
        return self.standard(rows) @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        above = self.latent(rows) - self.threshold + np.log(AT_THRESHOLD / (1 - AT_THRESHOLD))
        return 1 / (1 + np.exp(-above.clip(-700, 700)))


def fitted(better: np.ndarray, worse: np.ndarray, share_worse: float) -> Ranking:
    """Weights and threshold from the features of both labels."""
    width = WIDTH
    if not len(better) or not len(worse):
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    both = np.concatenate([better, worse])
    center, scale = both.mean(0), np.maximum(both.std(0), 1e-6)
    random = np.random.default_rng(0)
    up = ((better - center) / scale).clip(-10, 10)
    down = ((worse - center) / scale).clip(-10, 10)
    gaps = up[random.integers(0, len(up), PAIRS)] - down[random.integers(0, len(down), PAIRS)]
    weights = np.zeros(width)
    for _ in range(STEPS):  # Newton's method; the loss is convex
        lost = 1 / (1 + np.exp((gaps @ weights).clip(-700, 700)))
        slope = RIDGE * weights - gaps.T @ lost / PAIRS
        bend = (gaps * (lost * (1 - lost))[:, None]).T @ gaps / PAIRS + RIDGE * np.eye(width)
        weights = weights - np.linalg.solve(bend, slope)
    model = Ranking(center, scale, weights, 0.0)
    high, low = np.sort(model.latent(better)), np.sort(model.latent(worse))
    each = ((1 - share_worse) / len(high), share_worse / len(low))
    weight = np.repeat(each, (len(high), len(low)))
    scores = np.concatenate([high, low])
    order = np.argsort(scores, kind="stable")
    reached = np.cumsum(weight[order])
    at = np.searchsorted(reached, np.arange(1, QUANTILES) / QUANTILES)
    tried = scores[order][np.minimum(at, len(order) - 1)]
    right = np.searchsorted(low, tried) / len(low) + 1 - np.searchsorted(high, tried) / len(high)
    best = np.flatnonzero(right >= right.max() - 1e-9)
    # The scores between the last quantile below and the best one part the labels alike.
    edge = low[low < tried[best[0]]]
    under = edge[-1] if len(edge) else tried[best[0]]
    return Ranking(center, scale, weights, float((tried[best[0]] + under) / 2))


def _described(docs: DataFrame, *carried: str) -> DataFrame:
    """``carried`` with ``row``, the bytes of the features of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, offsets in text_blocks(batches, "text"):
            rows = pa.array([row.tobytes() for row in features(data, offsets)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(block.column(name) for name in carried), rows], [*carried, "row"]
            )

    named = docs.select(*(F.col(name).cast("long").alias(name) for name in carried), "text")
    return named.mapInArrow(run, ", ".join([*(f"{name} long" for name in carried), "row binary"]))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, quality, row`` of every labelled document."""
    marks = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("long").alias("quality"))
    )
    # Features are joined, not texts, which are ten times as large.
    found = _described(docs.where("doc_id IS NOT NULL"), "doc_id")
    held = found.groupBy("doc_id").agg(F.min("row").alias("row"), F.max("row").alias("most"))
    rows = held.join(marks, "doc_id").select(
        "doc_id", "quality", "row", (F.col("row") != F.col("most")).alias("several")
    )
    rows = staged(rows, "quality-rows")
    several = rows.where("several").select("doc_id", "quality")
    rows = rows.select("doc_id", "quality", "row")
    if several.isEmpty():
        return rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    least = texts.join(several, "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    others = rows.join(several.select("doc_id"), "doc_id", "left_anti")
    chosen = others.unionByName(_described(least, "doc_id", "quality"))
    return staged(chosen, "quality-rows")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    raw = b"".join(batch.column("row").to_pylist())
    return np.frombuffer(raw).reshape(batch.num_rows, -1)


def _sums(
    rows: DataFrame, width: int, of: Callable[[np.ndarray, int], tuple[np.ndarray, np.ndarray]]
) -> dict[int, np.ndarray]:
    """For each label the sums of its cells, ascending. ``of`` gives cells and rows of ``width`` values
    that are to be added up by cell, from features and their label. Tasks add up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix, quality = _matrix(batch), batch.column("quality").to_numpy()
            for label in np.unique(quality).tolist():
                cells, values = of(matrix[quality == label], label)
                order = np.argsort(cells, kind="stable")
                cells, first = np.unique(cells[order], return_index=True)
                values = np.add.reduceat(values[order], first, axis=0)
                for cell, value in zip(cells.tolist(), values, strict=True):
                    known = total.get((label, cell))
                    total[label, cell] = value if known is None else known + value
        if total:
            names, values = zip(*total.items(), strict=True)
            arrays = [pa.array(column, pa.int64()) for column in zip(*names, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array([value.tolist() for value in values], pa.list_(pa.float64()))],
                ["label", "cell", "held"],
            )

    parts = rows.select("quality", "row").mapInArrow(run, "label long, cell long, held array<double>")
    sums = [F.sum(F.col("held")[at]).alias(f"sum_{at}") for at in range(width)]
    added = parts.groupBy("label", "cell").agg(*sums).toArrow()
    added = added.sort_by([("label", "ascending"), ("cell", "ascending")])
    label, *columns = (column.to_numpy() for column in added.columns[:1] + added.columns[2:])
    values = np.stack(columns, 1)
    return {one: values[label == one] for one in np.unique(label).tolist()}


def _rounded(values: np.ndarray) -> np.ndarray:
    """Sums of several tasks differ in their last digits with the order of the tasks."""
    return np.array([float(f"{value:.{DIGITS}g}") for value in values])


def _spread(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
    """Means and standard deviations of the features, and how many rows each label has."""

    def held(matrix: np.ndarray, _: int) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(len(matrix), int), np.column_stack([np.ones(len(matrix)), matrix])

    sums = {label: values[0] for label, values in _sums(rows, WIDTH + 1, held).items()}
    counts = {label: int(values[0]) for label, values in sums.items()}
    if len(counts) < 2:
        return np.zeros(0), np.zeros(0), counts
    both = sums[0] + sums[1]
    center = _rounded(both[1:] / both[0])

    def apart(matrix: np.ndarray, _: int) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(len(matrix), int), (matrix - center) ** 2

    square = sum(values[0] for values in _sums(rows, WIDTH, apart).values())
    return center, _rounded(np.maximum(np.sqrt(square / both[0]), 1e-6)), counts


@dataclass(frozen=True)
class Lost:
    """The loss over all pairs, its slope, and what its curvature takes from pairs of cells: the
    curvature at the scores of the cells, by label, and the part that both labels share."""

    loss: float
    slope: np.ndarray
    pairs: float
    known: dict[int, tuple[np.ndarray, np.ndarray]]
    cross: np.ndarray


def _lost(rows: DataFrame, model: Ranking) -> Lost:
    def by_score(matrix: np.ndarray, _: int) -> tuple[np.ndarray, np.ndarray]:
        own = model.standard(matrix)
        cells = np.floor(own @ model.weights / CELL).astype(np.int64)
        return cells, np.column_stack([np.ones(len(own)), own])

    sums = _sums(rows, WIDTH + 1, by_score)
    (n_up, up), (n_down, down) = ((sums[label][:, 0], sums[label][:, 1:]) for label in (1, 0))
    at_up, at_down = up @ model.weights / n_up, down @ model.weights / n_down
    lost_up, lost_down = np.zeros(len(n_up)), np.zeros(len(n_down))
    bend_up, bend_down = np.zeros(len(n_up)), np.zeros(len(n_down))
    cross, loss = np.zeros((WIDTH, WIDTH)), 0.0
    for first in range(0, len(n_up), PAIRED_CELLS):
        cut = slice(first, first + PAIRED_CELLS)
        gap = at_down - at_up[cut, None]
        loss += n_up[cut] @ np.logaddexp(0, gap) @ n_down
        share = 1 / (1 + np.exp(-gap.clip(-700, 700)))
        curve = share * (1 - share)
        lost_up[cut], bend_up[cut] = share @ n_down, curve @ n_down
        lost_down += n_up[cut] @ share
        bend_down += n_up[cut] @ curve
        cross += up[cut].T @ curve @ down
    pairs = n_up.sum() * n_down.sum()
    slope = RIDGE * model.weights - (lost_up @ up - lost_down @ down) / pairs
    whole = float(loss / pairs + RIDGE / 2 * model.weights @ model.weights)
    return Lost(whole, slope, pairs, {1: (at_up, bend_up), 0: (at_down, bend_down)}, cross)


def _step(rows: DataFrame, model: Ranking, lost: Lost) -> np.ndarray:
    """Newton's step from the weights of ``model``."""

    def bent(matrix: np.ndarray, label: int) -> tuple[np.ndarray, np.ndarray]:
        own = model.standard(matrix)
        weight = np.interp(own @ model.weights, *lost.known[label])
        return np.arange(WIDTH), (own * weight[:, None]).T @ own

    curves = sum(_sums(rows, WIDTH, bent).values()) - lost.cross - lost.cross.T
    return np.linalg.solve(curves / lost.pairs + RIDGE * np.eye(WIDTH), lost.slope)


def _threshold(rows: DataFrame, model: Ranking) -> float:
    """Among the quantiles of all scores, the one that parts the labels best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = pa.array(model.latent(_matrix(batch)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("quality"), found], ["quality", "score"]
                )

    scores = rows.select("quality", "row").mapInArrow(run, "quality long, score double")
    scores = staged(scores, "quality-scores")
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    cell = F.floor((F.col("score") - low) * (FINE / max(high - low, 1e-12))).alias("cell")
    better, worse = F.col("quality") == 1, F.col("quality") == 0
    cells = scores.groupBy(cell).agg(
        F.min("score").alias("least"),
        F.count_if(better).alias("better"),
        F.count_if(worse).alias("worse"),
        F.max(F.when(worse, F.col("score"))).alias("edge"),
    )
    cells = cells.toArrow().sort_by("cell")
    least, up, down = (cells.column(name).to_numpy() for name in ("least", "better", "worse"))
    edge = np.nan_to_num(cells.column("edge").to_numpy(), nan=-np.inf)
    right = (np.cumsum(down) - down) / down.sum() + 1 - (np.cumsum(up) - up) / up.sum()
    reached = np.cumsum(up + down)
    tried = np.searchsorted(reached, np.arange(1, QUANTILES) / QUANTILES * reached[-1])
    best = tried[np.flatnonzero(right[tried] >= right[tried].max() - 1e-9)[0]]
    # The scores between the last quantile below and the best one part the labels alike.
    under = edge[:best].max(initial=-np.inf)
    return float((least[best] + (under if np.isfinite(under) else least[best])) / 2)


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranking:
    """A ranking from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality), all of them.

    ``sample``: with how many documents of each label the weights to start from are found."""
    rows = training_rows(docs, labels)
    center, scale, counts = _spread(rows)
    if len(counts) < 2:
        return fitted(np.zeros(0), np.zeros(0), 0.0)
    first = []
    for label in (1, 0):
        own = rows.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
        raw = [bytes(row.row) for row in own.limit(sample).select("row").collect()]
        first.append(np.frombuffer(b"".join(raw)).reshape(len(raw), -1))
    start = fitted(*first, counts[0] / sum(counts.values()))
    model = Ranking(center, scale, start.weights * scale / start.scale, 0.0)
    lost = _lost(rows, model)
    if lost.loss > np.log(2):  # worse than no weights at all
        model = replace(model, weights=np.zeros(WIDTH))
        lost = _lost(rows, model)
    for _ in range(STEPS):  # Newton's method; the loss is convex
        step = _step(rows, model, lost)
        while np.abs(step).max() >= ENOUGH:
            tried = replace(model, weights=model.weights - step)
            found = _lost(rows, tried)
            if found.loss <= lost.loss:
                break
            step = step / 2
        else:
            model = replace(model, weights=model.weights - step)
            break
        model, lost = tried, found
    model = replace(model, weights=model.weights.round(6))
    return replace(model, threshold=_threshold(rows, model))


def scored(docs: DataFrame, model: Ranking, *carried: Column) -> DataFrame:
    """``carried`` with ``score`` per document; only the text is looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, offsets in text_blocks(batches, "__text"):
            found = model.scores(features(data, offsets))
            yield pa.RecordBatch.from_arrays(
                [*block.columns[1:], pa.array(found)], [*block.schema.names[1:], "score"]
            )

    rows = docs.select(F.col("text").alias("__text"), *carried)
    fields = [f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in rows.schema[1:]]
    return rows.mapInArrow(run, ", ".join([*fields, "score double"]))
