"""Blocked Bloom filters of keys as plain columns: a word per key and a few of its bits.

A key falls into one word of 64 bits by one hash and on ``HASHES`` of its bits by another, so looking
a key up is a single equi-join on the word, which Spark can broadcast and run where rows are read. A
filter lets some keys pass that were never put in, and stops none that was.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.names import quoted
from martloom.functions.sizes import fits_broadcast
from martloom.sinks.scratch import staged

BITS = 16
HASHES = 4
WORD_BITS = 64

# Equal values of these types have equal hashes.
HASHED = (T.IntegralType, T.StringType, T.DateType, T.DecimalType)


def word(key: Column, words: Column) -> Column:
    """The word of a key, of ``words`` many."""
    return F.pmod(F.xxhash64(key), words)


def mask(key: Column) -> Column:
    """``HASHES`` bits of a word, some of which may be the same."""
    drawn = F.xxhash64(key, F.lit(1))
    bits = [
        F.shiftrightunsigned(drawn, 6 * at).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")
        for at in range(HASHES)
    ]
    one = [F.call_function("shiftleft", F.lit(1).cast("long"), bit) for bit in bits]
    all_bits = one[0]
    for bit in one[1:]:
        all_bits = all_bits.bitwiseOR(bit)
    return all_bits


def words_for(keys: Column) -> Column:
    """How many words a filter of so many keys takes: a power of two."""
    wanted = F.greatest(keys * F.lit(BITS / WORD_BITS), F.lit(1.0))
    return F.pow(F.lit(2.0), F.ceil(F.log2(wanted)))


@dataclass(frozen=True)
class KeyFilter:
    """``rows``: ``word, bits`` of the words that are not empty; ``words``: how many there are;
    ``kind``: the type of the keys, as which others are looked up."""

    rows: DataFrame
    words: int
    kind: T.DataType

    @staticmethod
    def of(keys: DataFrame, label: str) -> KeyFilter | None:
        """A filter of distinct keys (one column), written down; None if it is too large to
        broadcast, as it would then cost about what it saves, or its keys are of another type than
        those in ``HASHED``."""
        (name,) = keys.columns
        kind = keys.schema[name].dataType
        if not isinstance(kind, HASHED):
            return None
        key = quoted(name)
        keys = keys.where(key.isNotNull())
        words = keys.agg(words_for(F.count(F.lit(1))).cast("long")).first()[0]
        size = F.lit(words)
        held = keys.groupBy(word(key, size).alias("word")).agg(F.bit_or(mask(key)).alias("bits"))
        held = staged(held, label)
        return KeyFilter(held, words, kind) if fits_broadcast(held) else None

    def passed(self, table: DataFrame, key: str) -> DataFrame:
        """The rows of ``table`` whose key the filter lets through; a NULL key is stopped."""
        value = quoted(key).cast(self.kind)
        own = mask(value)
        same = word(value, F.lit(self.words)) == F.col("__word")
        listed = self.rows.toDF("__word", "__bits")
        hit = F.col("__bits").bitwiseAND(own) == own
        given = quoted(key).isNotNull()
        return table.where(given).join(F.broadcast(listed), same & hit, "left_semi")
