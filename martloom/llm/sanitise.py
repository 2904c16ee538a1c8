"""Personal data: base spans by pattern, and terms that disclose them by corpus co-occurrence.

DataFrame functions only. Steps:

1. E-mail addresses, IP addresses, card and phone numbers are found in whole texts. The patterns are
   written so that Java's engine neither recurses nor rescans long runs; they match what the plain
   patterns in ``tests/llm`` match.
2. A value that is found is an entity to protect. The words of its documents, at any distance and
   outside its own values, are the terms that may disclose it.
3. With n documents, of which n_t hold a term, n_c an entity and n_tc both, the term outside the
   entity's own values, the term carries log2(n * n_tc / (n_t * n_c)) of the entity's log2(n / n_c)
   bits. From ``GENERALISE`` of them on a term is generalised to its kind of word, from ``REMOVE``
   on it is removed, wherever it stands in the entity's documents. Only terms seen in ``SUPPORT``
   documents of an entity are judged; copies are documents like others.

All counts are over all documents. As n_tc is at most n_c, no term with n_t over
n ** (1 - GENERALISE) * n_c ** GENERALISE reaches the threshold; such pairs are left out early.

Edge cases: a NULL text is empty and has no span. A word that overlaps a base span is not replaced
there but by that span, and a word that a base span cuts is no term. Repeated rows count as documents of their own. If n_c = n the entity has no bits, and no
term discloses it. Other columns are left alone; ``sanitised`` also counts ``n_chars`` anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.sizes import fits_broadcast
from martloom.llm.common import numbered, salted_join
from martloom.sinks.scratch import staged

# The kinds in their order, and a pattern for each.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = ("removed", "general")

TERM = r"[\p{L}\p{N}]+"
_LAST_TERM = r"(?<![\p{L}\p{N}])[\p{L}\p{N}]++$"
SUPPORT = 2
# Code points by which a text is cut to find places in it.
CHUNK = 256
GENERALISE = 0.8
REMOVE = 0.95


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _small_parts(found: Column) -> Column:
    """Whether all parts of an IP address are at most 255."""

    def small(part: Column) -> Column:
        bare = F.concat(F.lit("0"), F.regexp_replace(part, "^0+", ""))
        return F.when(F.length(bare) <= 4, bare.cast("int") <= 255).otherwise(False)

    return F.forall(F.split(found, r"\."), small)


def _luhn(found: Column) -> Column:
    """Whether 13 to 19 digits pass the check of card numbers."""
    digits = F.reverse(_digits(found))

    def worth(place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(place % 2 == 1, digit).when(double > 9, double - 9).otherwise(double)

    places = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x)
    return F.when(F.length(digits).between(13, 19), total % 10 == 0).otherwise(False)


def _valid(kind: Column, found: Column) -> Column:
    return (
        F.when(kind == 0, True)
        .when(kind == 1, _small_parts(found))
        .when(kind == 2, _luhn(found))
        .otherwise(F.length(_digits(found)).between(9, 15))
    )


def _values(rows: DataFrame) -> DataFrame:
    """``row, kind, start, end, entity`` of every valid span."""
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    has = {"email": text.contains("@"), "phone": text.contains("+")}
    digit = text.rlike("[0-9]")

    def matches(kind: str) -> Column:
        pattern = PATTERNS[kind]
        gaps = F.split(text, pattern, -1)
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        # One gap more than matches, so the last element holds a gap alone.
        zipped = F.arrays_zip(gaps.alias("gap"), found.alias("found"))
        return F.when(has.get(kind, F.lit(True)) & ((kind == "email") | digit), zipped)

    kinds = F.array(
        *[
            F.struct(F.lit(at).alias("kind"), matches(kind).alias("parts"))
            for at, kind in enumerate(KINDS)
        ]
    )
    parts = rows.where(text.contains("@") | digit).select("row", F.explode(kinds).alias("of"))
    parts = parts.where("size(of.parts) > 1")
    parts = parts.select("row", F.col("of.kind").alias("kind"), F.posexplode("of.parts"))
    ends = parts.where("col.found IS NOT NULL").select(
        "row", "kind", "pos", F.col("col.found").alias("found"), F.char_length("col.gap").alias("gap")
    )
    order = Window.partitionBy("row", "kind").orderBy("pos")
    length = F.char_length("found")
    end = F.sum(F.col("gap") + length).over(order.rowsBetween(Window.unboundedPreceding, 0))
    valid = ends.withColumn("end", end).where(_valid(F.col("kind"), F.col("found")))
    named = F.when(F.col("kind").isin(2, 3), _digits(F.col("found"))).otherwise(F.lower("found"))
    return valid.select(
        "row",
        "kind",
        (F.col("end") - length).cast("long").alias("start"),
        F.col("end").cast("long").alias("end"),
        F.concat_ws(":", F.col("kind").cast("string"), named).alias("entity"),
    )


def base_spans(docs: DataFrame) -> DataFrame:
    """``row, kind, start, end, entity, pieces`` of every valid span.

    Places are counted in code points from 0, the end is exclusive. ``kind`` is a place in
    ``KINDS``. Texts without a digit and without an ``@`` are never searched. The ``pieces`` of all
    spans of a row make up its text: ``at, said, own`` of what stands before a span, of the span
    itself (``own``) and, with the last one, of what stands after it.
    """
    return _spans(numbered(docs, "pii-documents"))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _chunks(text: Column) -> Column:
    """A text in chunks of ``CHUNK`` code points, so that a place in it is found without counting
    from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def _cut(chunks: Column, first: Column, last: Column) -> Column:
    """What stands between two places of a text that is given as chunks."""
    size = F.lit(CHUNK)
    at, to = F.floor(first / size).cast("int"), F.floor(last / size).cast("int")
    begin, end = (first % size).cast("int"), (last % size).cast("int")
    chunk = lambda number: F.coalesce(F.get(chunks, number), F.lit(""))
    within = F.substring(chunk(at), begin + 1, F.greatest(end - begin, F.lit(0)))
    between = F.array_join(F.slice(chunks, at + 2, F.greatest(to - at - 1, F.lit(0))), "")
    across = F.concat(
        F.substring(chunk(at), begin + 1, size), between, F.substring(chunk(to), F.lit(1), end)
    )
    return F.when(first >= last, "").when(at == to, within).otherwise(across)


def _spans(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    numbered_spans = F.row_number().over(order)
    values = _values(rows).withColumn("past", F.coalesce(before, F.lit(0).cast("long")))
    values = values.withColumn("number", numbered_spans)
    listed = F.array_sort(
        F.collect_list(F.struct("start", "end", "kind", "past", "number", "entity"))
    )
    by_row = values.groupBy(F.col("row").alias("__of")).agg(listed.alias("spans"))
    by_row = staged(by_row, "pii-values")
    small = F.broadcast(by_row) if fits_broadcast(by_row) else by_row
    joined = rows.select("row", F.col("doc.text").alias("text")).join(
        small, F.col("row") == F.col("__of")
    )

    def piece(chunks: Column, first: Column, last: Column) -> Column:
        """What stands between two places, without parts of words that a base span cuts."""
        cut_first = (first > 0) & _cut(chunks, first - 1, first).rlike(TERM)
        cut_last = _cut(chunks, last, last + 1).rlike(TERM)

        def bared(said: Column) -> Column:
            bare = F.when(cut_first, F.regexp_replace(said, f"^{TERM}", "")).otherwise(said)
            whole = lambda x: F.when(cut_last, F.regexp_replace(x, _LAST_TERM, "")).otherwise(x)
            return _bound(
                bare,
                lambda x: F.struct(
                    (first + F.char_length(said) - F.char_length(x)).alias("at"),
                    whole(x).alias("said"),
                    F.lit(False).alias("own"),
                ),
            )

        return _bound(_cut(chunks, first, last), bared)

    def span(chunks: Column, length: Column, count: Column, one: Column) -> Column:
        own = F.struct(
            one["start"].alias("at"),
            _cut(chunks, one["start"], one["end"]).alias("said"),
            F.lit(True).alias("own"),
        )
        parts = F.array(piece(chunks, one["past"], one["start"]), own)
        rest = F.array(piece(chunks, F.greatest(one["past"], one["end"]), length))
        pieces = F.when(one["number"] == count, F.concat(parts, rest)).otherwise(parts)
        names = ("kind", "start", "end", "entity")
        return F.struct(*[one[name].alias(name) for name in names], pieces.alias("pieces"))

    length, count = F.char_length("text").cast("long"), F.size("spans")
    found = _bound(
        _chunks(F.col("text")),
        lambda chunks: F.transform("spans", lambda one: span(chunks, length, count, one)),
    )
    return joined.select("row", F.explode(found).alias("of")).select("row", "of.*")


def context_terms(spans: DataFrame) -> DataFrame:
    """``row, term, holder``: the words of the spans' rows; in a value, with its entity."""
    pieces = spans.select("row", "entity", F.explode("pieces").alias("of"))
    return pieces.select(
        "row",
        F.explode(_words(F.col("of.said"))).alias("term"),
        F.when(F.col("of.own"), F.col("entity")).alias("holder"),
    )


def _words(text: Column) -> Column:
    """The distinct words of a text in lower case."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TERM), F.lit(0))
    return F.array_distinct(F.transform(F.array_distinct(found), F.lower))


def judged(
    docs: DataFrame, spans: DataFrame, terms: DataFrame, least: float | None = None
) -> DataFrame:
    """``entity, term, share``: how much of an entity's information a term carries.

    With ``least``, only pairs with that share or more.
    """
    together = spans.select("entity", "row").distinct()
    entities = together.groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"))
    entities = entities.where(F.col("n_c") >= SUPPORT)
    near = F.collect_list(F.struct("entity", "n_c")).alias("near")
    by_row = salted_join(together, entities, ["entity"], "inner").groupBy("row")
    by_row = staged(by_row.agg(near, F.max("n_c").alias("most")), "pii-near")
    n = float(docs.count())
    held = docs.select(F.explode(_words(F.col("text"))).alias("term"))
    frequencies = held.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    frequencies = frequencies.where(F.col("n_t") >= SUPPORT)

    def rare(n_c: Column) -> Column:
        """Whether a term could carry ``least``, if it stood in all of n_c documents."""
        if least is None:
            return F.lit(True)
        return F.col("n_t") <= n ** (1 - least) * F.pow(n_c, F.lit(least)) * (1 + 1e-9)

    most = by_row.agg(F.max("most")).first()[0] or 0
    frequencies = staged(frequencies.where(rare(F.lit(float(most)))), "pii-frequencies")
    if fits_broadcast(frequencies):
        counted = terms.join(F.broadcast(frequencies), "term")
    else:
        counted = salted_join(terms, frequencies, ["term"], "inner")
    # A term that stands in the values of one entity only is no evidence about that entity.
    inside = (F.count("holder") == F.count(F.lit(1))) & (F.min("holder") == F.max("holder"))
    by_term = counted.groupBy("row", "term", "n_t").agg(F.when(inside, F.min("holder")).alias("only"))
    paired = salted_join(by_term, by_row, ["row"], "inner").where(rare(F.col("most")))
    paired = paired.select("row", "term", "n_t", "only", F.explode("near").alias("of"))
    paired = paired.where(F.col("only").isNull() | (F.col("only") != F.col("of.entity")))
    paired = paired.where(rare(F.col("of.n_c"))).groupBy(F.col("of.entity").alias("entity"), "term")
    pairs = paired.agg(
        F.count(F.lit(1)).alias("n_tc"),
        F.first("n_t").alias("n_t"),
        F.first("of.n_c").alias("n_c"),
    ).where(F.col("n_tc") >= SUPPORT)
    carried = F.log2(F.lit(n) * F.col("n_tc") / (F.col("n_t") * F.col("n_c")))
    bits = F.log2(F.lit(n) / F.col("n_c"))
    shares = pairs.select("entity", "term", F.when(bits > 0, carried / bits).alias("share"))
    return shares if least is None else shares.where(F.col("share") >= least)


def all_spans(rows: DataFrame) -> DataFrame:
    """``row, kind, start, end, word``: base spans, and those of disclosing terms.

    ``rows`` are ``numbered``. Kinds of added spans follow those of ``KINDS`` in the order of
    ``ADDED``.
    """
    spans = staged(_spans(rows), "pii-spans")
    texts = rows.select("doc.text")
    disclosing = staged(judged(texts, spans, context_terms(spans), GENERALISE), "pii-disclosing")
    kind = F.when(F.col("share") >= REMOVE, len(KINDS)).otherwise(len(KINDS) + 1)
    listed = disclosing.groupBy("entity").agg(F.collect_list(F.struct("term", "share")).alias("of"))
    of_rows = salted_join(spans.select("row", "entity").distinct(), listed, ["entity"], "inner")
    of_rows = of_rows.select("row", F.explode("of").alias("of")).select("row", "of.*")
    of_rows = of_rows.groupBy("row", "term").agg(F.min(kind).alias("kind"))
    asked = F.map_from_entries(F.collect_list(F.struct("term", "kind"))).alias("asked")
    asked = staged(of_rows.groupBy("row").agg(asked), "pii-asked")
    asked = F.broadcast(asked) if fits_broadcast(asked) else asked
    pieces = spans.join(asked, "row").select("row", "asked", F.explode("pieces").alias("of"))
    pieces = pieces.where("NOT of.own")
    free = pieces.select("row", F.explode(_placed(F.col("of"), F.col("asked"))).alias("span"))
    base = spans.select("row", "kind", "start", "end", F.lit(None).cast("string").alias("word"))
    return base.unionByName(free.select("row", "span.*"))


def _placed(piece: Column, asked: Column) -> Column:
    """``kind, start, end, word`` of the words of a piece that ``asked`` names."""
    parts = F.arrays_zip(
        F.split(piece["said"], TERM, -1).alias("gap"),
        F.regexp_extract_all(piece["said"], F.lit(TERM), F.lit(0)).alias("found"),
    )
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,word:string>>")

    def step(state: Column, part: Column) -> Column:
        word = F.lower(part["found"])
        start = state["at"] + F.char_length(part["gap"])
        end = start + F.coalesce(F.char_length(part["found"]), F.lit(0))
        kind = F.try_element_at(asked, F.coalesce(word, F.lit("")))
        span = F.struct(
            kind.alias("kind"), start.alias("start"), end.alias("end"), word.alias("word")
        )
        seen = F.when(kind.isNull(), state["seen"]).otherwise(F.concat(state["seen"], F.array(span)))
        return F.struct(end.alias("at"), seen.alias("seen"))

    begin = F.struct(piece["at"].alias("at"), none.alias("seen"))
    return F.aggregate(parts, begin, step, lambda state: state["seen"])


def _listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, by kind and start, joined by commas."""
    names = F.array(*map(F.lit, (*KINDS, *ADDED)))

    def said(span: Column) -> Column:
        name = F.element_at(names, span["kind"] + 1)
        return F.concat_ws(":", name, span["start"].cast("string"), span["end"].cast("string"))

    return F.array_join(F.transform(F.array_sort(spans), said), ",")


def found(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_removed, n_general``."""
    every = F.collect_list(F.struct("kind", "start", "end"))
    rows = numbered(docs, "pii-documents")
    by_row = all_spans(rows).groupBy("row").agg(every.alias("all"))
    rows = rows.select(F.col("doc.doc_id").alias("doc_id"), "row").join(by_row, "row", "left")
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    rows = rows.withColumn("all", F.coalesce("all", none))
    base = F.filter("all", lambda x: x["kind"] < len(KINDS))

    def count(kind: int) -> Column:
        return F.size(F.filter("all", lambda x: x["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id",
        *[count(at).alias(f"n_{kind}") for at, kind in enumerate(KINDS)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("all")).alias("spans"),
        *[count(len(KINDS) + at).alias(f"n_{kind}") for at, kind in enumerate(ADDED)],
    )


def _mask(span: Column) -> Column:
    """What stands for a span: its kind in capitals, nothing, or the kind of word it was."""
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    word = F.when(span["word"].rlike("^[0-9]+$"), "[NUMBER]").when(
        span["word"].rlike("[0-9]"), "[CODE]"
    )
    return (
        F.when(span["kind"] < len(KINDS), F.element_at(names, F.least(span["kind"], F.lit(3)) + 1))
        .when(span["kind"] == len(KINDS), "")
        .otherwise(word.otherwise("[WORD]"))
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in their texts replaced; overlapping spans are replaced as one."""
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = numbered(docs, "pii-documents")
    spans = all_spans(rows).withColumn("past", F.coalesce(before, F.lit(0).cast("long")))
    listed = F.array_sort(F.collect_list(F.struct("start", "end", "kind", "past", "word")))
    by_row = spans.groupBy(F.col("row").alias("__of")).agg(listed.alias("__spans"), F.max("end").alias("__last"))
    by_row = staged(by_row, "pii-rows")
    small = F.broadcast(by_row) if fits_broadcast(by_row) else by_row
    said = F.col("doc.text")

    def piece(chunks: Column, span: Column) -> Column:
        gap = _cut(chunks, span["past"], span["start"])
        return F.when(span["start"] >= span["past"], F.concat(gap, _mask(span))).otherwise("")

    pieces = _bound(
        _chunks(said), lambda chunks: F.transform("__spans", lambda span: piece(chunks, span))
    )
    tail = F.substring(said, (F.col("__last") + 1).cast("int"), F.char_length(said))
    cleaned = F.concat(F.array_join(pieces, ""), tail)
    text = F.when(F.col("__spans").isNull(), said).otherwise(cleaned)
    joined = rows.join(small, F.col("row") == F.col("__of"), "left")
    anew = {"text": text}
    if "n_chars" in docs.columns:
        anew["n_chars"] = F.char_length(text).cast(docs.schema["n_chars"].dataType)
    return joined.select(
        *[anew.get(name, F.col("doc").getField(name)).alias(name) for name in docs.columns]
    )
