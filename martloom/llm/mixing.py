"""Mix sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

DataFrame functions only. Steps:

1. Words of each document and of each source. Sources, by code point with NULL last, weigh 3, 1,
   2, repeating. They share ``share`` times all words; a target stops at ``most`` times its
   source's words, and what is over is shared again by weight.
2. The whole mix is cut into blocks of ``block_words`` words, and the sources get blocks by highest
   quotients (weight / 1, / 3, / 5 ...). A source that is due more than all its words is passed
   whole as often as that goes; the rest of its blocks is its quota for one more, partial pass.
3. A source's documents are dealt into shards of about ``shard_words`` words, and its quota is
   apportioned to the shards the same way. No window spans more than a shard.
4. In a shard, documents lie end to end in an order drawn from the seed and are cut into blocks.
   The partial pass takes the quota's number of blocks at even distances from a seeded start.
   Where a block lies follows from arithmetic, so no row per block is ever made.

Every value is an integer but the targets, so reruns agree. Edge cases: a NULL or empty text has
size 0 and is never taken; a NULL source is a source; repeated rows are separate documents; an
empty table gives an empty mix. Columns besides the three named ones are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.names import quoted
from martloom.functions.sizes import fits_broadcast
from martloom.llm.common import BLANK, WORD, numbered
from martloom.sinks.scratch import staged

# Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)


@dataclass(frozen=True)
class Mix:
    share: float = 1.5
    most: int = 2
    block_words: int = 64
    shard_words: int = 1 << 17
    seed: str = "mix"


def measured(docs: DataFrame, mix: Mix, row: Column | None = None) -> DataFrame:
    """``row, doc_id, source, size, draw``; ``draw`` orders documents by the seed.

    Without ``row``, a column of ``docs``, rows are numbered as they are read; a second read may
    number them differently.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
        "doc_id",
        "source",
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(mix.seed), name, F.md5(text))).alias("draw"),
    )


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """``source, source_size, weight, target``, one row per source.

    Sources are raised together by weight until each stops at its ceiling. In ascending order of
    ceiling / weight, the level is what is left after the full ones, by the weight still rising.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = totals.withColumn(
        "weight",
        F.element_at(
            F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(in_order) - 1) % len(WEIGHTS) + 1
        ),
    )
    ceiling = F.col("source_size") * mix.most
    rising = Window.orderBy(ceiling / F.col("weight"), F.col("source").isNull(), "source")
    up_to = rising.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = mix.share * F.sum("source_size").over(whole) - (F.sum(ceiling).over(up_to) - ceiling)
    still = F.sum("weight").over(whole) - (F.sum("weight").over(up_to) - F.col("weight"))
    level = ranked.withColumn("level", left / still).withColumn(
        "full", F.col("level") * F.col("weight") >= ceiling
    )
    # Up to the first that stays below its ceiling levels rise, after it they fall.
    first = F.max(F.when(~F.col("full"), F.col("level"))).over(whole)
    return level.withColumn("found", first).select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("full"), ceiling.cast("double"))
        .otherwise(F.col("found") * F.col("weight"))
        .alias("target"),
    )


def apportioned(groups: DataFrame, within: list[str], weight: Column, seats: Column) -> DataFrame:
    """``groups`` with ``quota``: ``seats``, the same in all rows of a ``within``, by quotients.

    With n rows, a row's quota differs from its exact share q by at most (n * q / seats + 1) / 2.
    So only quotients in that range are listed, about as many as rows, whatever the seats. Ties
    go to the first row by ``tie``.
    """
    every = Window.partitionBy(*within)
    weighed = groups.withColumn("__w", weight.cast("double")).withColumn("__s", seats)
    part = F.col("__w") / F.sum("__w").over(every)
    shares = weighed.withColumn("__part", F.coalesce(F.when(F.col("__w") > 0, part), F.lit(0.0)))
    room = F.count(F.lit(1)).over(every) * F.col("__part") / 2 + 1.5
    exact = F.col("__s") * F.col("__part")
    ranged = shares.withColumn(
        "__low", F.greatest(F.lit(0), F.floor(exact - room)).cast("long")
    ).withColumn("__high", F.ceil(exact + room).cast("long"))
    ranged = ranged.withColumn("__open", F.col("__s") - F.sum("__low").over(every))
    listed = ranged.withColumn("__k", F.explode(F.sequence("__low", "__high")))
    by_quotient = every.orderBy(F.desc(F.col("__w") / (2 * F.col("__k") + 1)), "tie", "__k")
    won = (F.row_number().over(by_quotient) <= F.col("__open")) & (F.col("__w") > 0)
    return (
        listed.withColumn("__won", won.cast("long"))
        .groupBy(*map(quoted, groups.columns))
        .agg((F.min("__low") + F.sum("__won")).alias("quota"))
    )


def placed(docs: DataFrame, mix: Mix, row: Column | None = None) -> DataFrame:
    """One row per document with its place in its shard and the shard's quota of blocks.

    Columns: those of ``measured``, ``source_size``, ``target``, ``passes`` (whole passes over the
    source), ``begin`` and ``end`` (words, in the shard), ``blocks``, ``quota``, ``start``.
    """
    sizes = staged(measured(docs, mix, row), "mix-sizes")
    block = mix.block_words
    targets = source_targets(sizes, mix).withColumn(
        "tie", F.struct(F.col("source").isNull(), F.col("source"))
    )
    everything = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    seats = F.round(F.sum("target").over(everything) / block).cast("long")
    passes = F.floor(F.try_divide("target", "source_size"))
    passes = F.coalesce(passes, F.lit(0)).cast("long")
    rest = F.col("quota") - F.round(F.col("passes") * F.col("source_size") / block).cast("long")
    sources = staged(
        apportioned(targets.withColumn("seats", seats), [], F.col("target"), F.col("seats"))
        .withColumn("passes", F.least(passes, F.lit(mix.most).cast("long")))
        .select(
            F.col("source").alias("name"),
            "source_size",
            "target",
            "passes",
            F.when(F.col("passes") >= mix.most, 0).otherwise(F.greatest(F.lit(0), rest))
            .cast("long")
            .alias("rest"),
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / mix.shard_words))
            .cast("long")
            .alias("shards"),
        ),
        "mix-sources",
    )
    drawn = F.conv(F.substring("draw", 1, 8), 16, 10).cast("long")
    dealt = sizes.join(sources, F.col("source").eqNullSafe(F.col("name"))).withColumn(
        "shard", F.struct(F.col("name"), F.pmod(drawn, F.col("shards")).alias("number"))
    )
    summed = dealt.groupBy("shard", "rest").agg(F.sum("size").alias("length"))
    summed = summed.select("*", F.col("shard.name").alias("name"), F.col("shard").alias("tie"))
    quotas = apportioned(summed, ["name"], F.col("length"), F.col("rest")).select(
        F.col("shard").alias("of"),
        "quota",
        "length",
        F.ceil(F.col("length") / block).cast("long").alias("blocks"),
    )
    name, number = F.coalesce("of.name", F.lit("")), F.col("of.number").cast("string")
    seeded = F.md5(F.concat_ws(":", F.lit(mix.seed), name, number))
    quotas = quotas.select(
        "of",
        F.least("quota", "blocks").alias("quota"),
        "blocks",
        F.pmod(
            F.conv(F.substring(seeded, 1, 8), 16, 10).cast("long"),
            F.greatest("blocks", F.lit(1).cast("long")),
        ).alias("start"),
    )
    in_shard = (
        Window.partitionBy("shard")
        .orderBy("draw", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    laid = dealt.withColumn("end", F.sum("size").over(in_shard))
    return laid.join(quotas, F.col("shard").eqNullSafe(F.col("of"))).select(
        "row",
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "passes",
        (F.col("end") - F.col("size")).alias("begin"),
        "end",
        "blocks",
        "quota",
        "start",
    )


def blocks_before(block: Column) -> Column:
    """How many of a shard's blocks before ``block`` the partial pass takes."""
    of = F.greatest(F.col("blocks"), F.lit(1).cast("long"))
    return F.floor((block * F.col("quota") + F.col("start")) / of) - F.floor(F.col("start") / of)


def words_before(place: Column, mix: Mix) -> Column:
    """How many of a shard's words before ``place`` the partial pass takes."""
    block = F.floor(place / mix.block_words)
    before = blocks_before(block)
    into = place - block * mix.block_words
    return before * mix.block_words + into * (blocks_before(block + 1) - before)


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document; see the module."""
    rows = placed(docs, mix)
    partial = words_before(F.col("end"), mix) - words_before(F.col("begin"), mix)
    return rows.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size") + partial).cast("long").alias("taken"),
    )


def mixed_texts(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents of the mix, in the columns of ``docs``.

    One row for each whole pass that takes a document, its text as it was, and one for what the
    partial pass takes of it: the words of the taken blocks, each with the white space before it.
    ``n_chars``, if there is one, is counted anew.
    """
    taken = words_before(F.col("end"), mix) - words_before(F.col("begin"), mix)
    numbers = numbered(docs, "mix-documents")
    sized = numbers.select("row", "doc.doc_id", "doc.source", "doc.text")
    places = placed(sized, mix, F.col("row")).withColumn("taken", taken)
    places = places.where("passes > 0 OR taken > 0").where("size > 0")
    places = staged(
        places.select("row", "size", "passes", "taken", "begin", "blocks", "quota", "start"),
        "mix-places",
    )
    places = F.broadcast(places) if fits_broadcast(places) else places
    rows = numbers.join(places, "row")
    pieces = F.regexp_extract_all(F.col("doc.text"), F.lit(f"[{BLANK}]*{WORD}"), F.lit(0))
    kept = F.filter(
        pieces,
        lambda _, at: blocks_before(F.floor((F.col("begin") + at) / mix.block_words) + 1)
        > blocks_before(F.floor((F.col("begin") + at) / mix.block_words)),
    )
    cut = F.ltrim(F.array_join(kept, ""))
    whole = F.col("whole") | (F.col("taken") == F.col("size"))
    text = F.when(whole, F.col("doc.text")).otherwise(cut)
    copies = F.concat(
        F.array_repeat(F.lit(True), F.col("passes").cast("int")),
        F.array_repeat(F.lit(False), F.when(F.col("taken") > 0, 1).otherwise(0)),
    )
    out = rows.withColumn("whole", F.explode(copies)).withColumn("words", text)
    anew = {"text": F.col("words")}
    if "n_chars" in docs.columns:
        anew["n_chars"] = F.char_length("words").cast(docs.schema["n_chars"].dataType)
    return out.select(
        *[anew.get(name, F.col("doc").getField(name)).alias(name) for name in docs.columns]
    )
