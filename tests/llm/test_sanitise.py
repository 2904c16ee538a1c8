"""Personal data against the plain patterns, and disclosing terms against plain counts."""

from __future__ import annotations

import hashlib
import math
import re

import pytest

from martloom.llm import sanitise

# The patterns of the contract.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a@b.c_d@e.f x@y a@b_c@d.e .@.. a@b..c",
    "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.4 1.2.3 256.1.1.1 1.2.3.0000255",
    "4111 1111 1111 1111, 4111-1111-1111-1112, 4111--1111 5 1 2",
    "+1 (988) 555-2485 +44 20 1 +1234567890123456 +49.30.1234567) +1",
    "é😀 a@b.co 😀 1.2.3.4 ñ +1 (988) 555-2485",
    "1" * 3000 + " 4111111111111111",
    "a." * 1000 + "@b.c " + "x@" + "a." * 1000 + "b",
    "1 2 3 4 5 6 " * 2000,
    "+1" + "(" * 1000 + "2 +" + "+1" * 500,
]


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(text):
    doubled = [int(c) * (1 + at % 2) for at, c in enumerate(reversed(text))]
    return sum(n - 9 if n > 9 else n for n in doubled) % 10 == 0


VALID = {
    "email": lambda found: True,
    "ip": lambda found: all(int(part) <= 255 for part in found.split(".")),
    "card": lambda found: 13 <= len(digits(found)) <= 19 and luhn(digits(found)),
    "phone": lambda found: 9 <= len(digits(found)) <= 15,
}


def plain_spans(text):
    return [
        (kind, found.start(), found.end())
        for kind, pattern in PLAIN.items()
        for found in re.finditer(pattern, text or "")
        if VALID[kind](found.group())
    ]


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("texts") / "documents.parquet")
    rows = [(at, text) for at, text in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(folder)
    return spark.read.parquet(folder)


def test_base_spans_equal_the_plain_patterns(texts, odd_documents, documents):
    for docs in (texts, odd_documents, documents):
        by_id = {row.doc_id: row.text for row in docs.collect() if row.doc_id is not None}
        rows = [row for row in sanitise.found(docs).collect() if row.doc_id is not None]
        for row in rows:
            spans = plain_spans(by_id[row.doc_id])
            said = ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)
            assert row.base_sha256 == hashlib.sha256(said.encode()).hexdigest(), row.doc_id
            counts = [row.n_email, row.n_ip, row.n_card, row.n_phone]
            assert counts == [sum(s[0] == kind for s in spans) for kind in PLAIN]
            assert row.spans.startswith(said)
        assert len(rows) == docs.where("doc_id IS NOT NULL").count()


def test_long_runs_neither_recurse_nor_rescan(spark):
    long = ["1" * 300_000, "a." * 100_000 + "@b", "1 " * 200_000, "+1" + "(" * 200_000]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    assert {row.spans for row in sanitise.found(docs).collect()} == {""}


def corpus():
    """An address, a town that is mostly named near it, and words that are common elsewhere."""
    rows = [f"please write to Zanna at zanna@one.example.org about case {at}" for at in range(4)]
    rows += [f"the Kappeln office of zanna@one.example.org closes, notice {at}" for at in range(4)]
    rows += ["Kappeln lies on the river"]
    rows += [f"please write to the office about case {at}" for at in range(40)]
    return list(enumerate(rows))


def test_terms_that_disclose_an_entity(spark, tmp_path):
    spark.createDataFrame(corpus(), "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    spans = sanitise.base_spans(docs)
    terms = sanitise.context_terms(spans)
    shares = {row.term: row.share for row in sanitise.judged(docs, spans, terms).collect()}
    texts = [text for _, text in corpus()]
    for term in ("zanna", "kappeln", "please", "the"):
        n_t = sum(term in re.findall(r"\w+", text.lower()) for text in texts)
        with_entity = [text for text in texts if "@" in text]
        around = [text.replace("zanna@one.example.org", " ") for text in with_entity]
        n_tc = sum(term in re.findall(r"\w+", text.lower()) for text in around)
        n, n_c = len(texts), len(with_entity)
        expected = math.log2(n * n_tc / (n_t * n_c)) / math.log2(n / n_c)
        assert shares[term] == pytest.approx(expected)
    cleaned = {row.doc_id: row.text for row in sanitise.sanitised(docs).collect()}
    # "at", "of", "closes" and "notice" occur only near the address; "Kappeln" once elsewhere.
    assert cleaned[0] == "please write to Zanna  [EMAIL] about case 0"
    assert cleaned[4] == "the [WORD] office  [EMAIL] ,  0"
    assert [cleaned[at] for at in range(8, len(texts))] == texts[8:]


def test_sanitised_keeps_rows_and_columns(odd_documents, no_documents):
    out = sanitise.sanitised(odd_documents)
    assert out.dtypes == odd_documents.dtypes
    before = {row.doc_id: row for row in odd_documents.collect()}
    for row in out.collect():
        text = before[row.doc_id].text
        if not plain_spans(text):
            assert row.text == text or row.doc_id is None
        else:
            assert not plain_spans(row.text)
            assert row.n_chars == len(row.text)
    assert sanitise.sanitised(no_documents).count() == 0
    assert sanitise.found(no_documents).count() == 0


def cleaned_texts(spark, folder, rows):
    spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").write.parquet(folder)
    found = sanitise.sanitised(spark.read.parquet(folder)).collect()
    return {row.doc_id: row.text for row in found}


COMMON = [f"we write about the matter {at}" for at in range(40)]


def test_terms_far_from_an_entity_are_judged_and_replaced(spark, tmp_path):
    far = " and so on" * 50
    rows = [f"Kappeln, {at}: we{far}, zanna@one.example.org" for at in range(4)]
    rows += COMMON + [far] * 40
    cleaned = cleaned_texts(spark, f"{tmp_path}/docs", rows)
    assert [cleaned[at] for at in range(4)] == [f", {at}: we{far}, [EMAIL]" for at in range(4)]
    assert [cleaned[at] for at in range(4, len(rows))] == rows[4:]


def test_numbers_beside_a_card_do_not_end_its_context(spark, tmp_path):
    card = "4111 1111 1111 1111"
    rows = [f"Kappeln, 2021, {at}: we write about the matter, {card}" for at in range(4)]
    rows += COMMON + ["2021", "2021 we"] * 20
    cleaned = cleaned_texts(spark, f"{tmp_path}/docs", rows)
    for at in range(4):
        assert cleaned[at] == f", 2021, {at}: we write about the matter, [CARD]"
    assert [cleaned[at] for at in range(4, len(rows))] == rows[4:]


def test_pieces_of_a_row_end_at_valid_spans_only(spark):
    text = "é 12 a@b.co 34, 999.1.1.1 1.2.3.4, 4111 1111 1111 1111 56 +1 2 end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = sorted(sanitise.base_spans(docs).collect(), key=lambda row: row.start)
    assert [(row.kind, row.start, row.end) for row in spans] == [
        (list(PLAIN).index(kind), a, b) for kind, a, b in sorted(plain_spans(text), key=lambda s: s[1])
    ]
    pieces = [piece for row in spans for piece in row.pieces]
    assert "".join(piece.said for piece in pieces) == text
    assert all(text[piece["at"] :].startswith(piece.said) for piece in pieces)


def test_copies_word_for_word_are_documents_like_others(spark, tmp_path):
    rows = ["Kappeln office: we write about the matter, zanna@one.example.org"] * 4
    rows += COMMON + ["the office"] * 40
    cleaned = cleaned_texts(spark, f"{tmp_path}/docs", rows)
    assert {cleaned[at] for at in range(4)} == {" office: we write about the matter, [EMAIL]"}
    assert [cleaned[at] for at in range(4, len(rows))] == rows[4:]


def test_places_in_chunks(spark):
    text = "".join(chr(97 + at % 26) + ("é😀" if at % 7 == 0 else "") for at in range(900))
    places = [(a, b) for a in (0, 1, 255, 256, 257, 511, 512, 900) for b in (0, 1, 256, 300, 513, len(text))]
    rows = spark.createDataFrame([(text, a, b) for a, b in places], "text string, a long, b long")
    chunks = sanitise._chunks(rows.text)
    found = rows.select(rows.a, rows.b, sanitise._cut(chunks, rows.a, rows.b).alias("cut")).collect()
    assert all(row.cut == text[row.a : max(row.a, row.b)] for row in found) and len(found) == 48


def test_a_text_of_very_many_addresses_takes_time_in_proportion(spark, tmp_path):
    import time

    seconds = []
    for count in (10_000, 40_000):
        text = " ".join(f"name{at} mail{at}@one.example.org" for at in range(count))
        folder = f"{tmp_path}/{count}"
        rows = [(1, text), (2, text[::-1]), (3, "nothing")]
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(folder)
        begin = time.perf_counter()
        found = sanitise.sanitised(spark.read.parquet(folder)).where("doc_id = 1").first()
        seconds.append(time.perf_counter() - begin)
        assert found.text.count("[EMAIL]") == count and "@" not in found.text
    assert seconds[1] <= 8 * seconds[0] + 5
