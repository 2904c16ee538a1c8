"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.names import quoted
from martloom.sinks.scratch import staged
from martloom.sources.tables import folder_reader

# What the contracts call white space between words: these ASCII characters and no others.
BLANK = r"\x20\x09-\x0D"
WORD = f"[^{BLANK}]+"

SALTS = 16
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return folder_reader(spark, sf_dir)(name)


def numbered(rows: DataFrame, label: str) -> DataFrame:
    """``row``, a number for each row, and ``doc``, the row itself, written once.

    Two reads of a table may split it differently, as the cores alive at that moment ask, and would
    number it differently. Every side of a join on ``row`` is to come from this one table.
    """
    doc = F.struct(*map(quoted, rows.columns)).alias("doc")
    return staged(rows.select(F.monotonically_increasing_id().alias("row"), doc), label)


def crc_remainder(column: str, divisor: int) -> Column:
    """``crc32`` of the value as text, modulo ``divisor``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(quoted(column).cast("string"), F.lit("")).cast("binary")) % divisor


def salted_join(
    rows: DataFrame, keyed: DataFrame, keys: Sequence[str], how: str, salts: int = SALTS
) -> DataFrame:
    """Join ``rows`` with ``keyed``, which holds each key once, without leaving a hot key whole.

    Rows of a key are dealt by a hash of the row over ``salts`` shuffle keys; the key's one row
    in ``keyed`` is copied to each. NULL keys match nothing.
    """
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64(*map(quoted, rows.columns)), F.lit(salts)))
    copied = keyed.withColumn(
        "__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    )
    return dealt.join(copied, [*keys, "__salt"], how).drop("__salt")


def filled_texts(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The texts of a batch, a NULL as the empty text; copied only if there is one."""
    texts = batch.column(column).cast(pa.large_string())
    return pc.fill_null(texts, "") if texts.null_count else texts


def text_blocks(
    batches: Iterator[pa.RecordBatch], text: str, most: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches so that a block's texts take about ``most`` bytes; a single text is never cut.

    Yields the block, its texts' UTF-8 bytes on end, and the offsets between them (one more than
    there are rows). A NULL text is empty.
    """
    for batch in batches:
        filled = filled_texts(batch, text)
        _, offsets, data = filled.buffers()
        ends = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(ends, ends[first] + most, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            cut = ends[first : last + 1]
            yield batch.slice(first, last - first), raw[cut[0] : cut[-1]], cut - cut[0]
            first = last


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return filled_texts(batch, column).to_pylist()
