"""Joins on row numbers, where every read of a table splits its files anew."""

from __future__ import annotations

import itertools

import pytest

from martloom.llm import archives, common, mixing, sanitise
from martloom.sinks.scratch import staged

SIZE = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def split_anew(spark, monkeypatch):
    """After each staged table, files are split into parts of another size."""
    before = spark.conf.get(SIZE)
    sizes = itertools.cycle(["20000", "7000", "1g", "3000"])

    def and_split(df, label):
        found = staged(df, label)
        spark.conf.set(SIZE, next(sizes))
        return found

    for module in (archives, common, mixing, sanitise):
        if hasattr(module, "staged"):
            monkeypatch.setattr(module, "staged", and_split)
    spark.conf.set(SIZE, "5000")
    yield
    spark.conf.set(SIZE, before)


def written(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(folder)
    return spark.read.parquet(folder)


def test_values_are_replaced_in_their_own_rows(spark, tmp_path, split_anew):
    rows = [(at, f"{'x' * (at % 90)} n{at}@one.example.org {at * 7919}") for at in range(3000)]
    docs = written(spark, f"{tmp_path}/docs", rows, "doc_id long, text string")
    texts = {row.doc_id: row.text for row in sanitise.sanitised(docs).collect()}
    assert texts == {at: text.replace(f"n{at}@one.example.org", "[EMAIL]") for at, text in rows}
    for row in sanitise.found(docs).collect():
        begin = row.doc_id % 90 + 1
        assert row.spans == f"email:{begin}:{begin + len(f'n{row.doc_id}@one.example.org')}"


def test_a_mix_holds_the_words_that_are_taken(spark, tmp_path, split_anew):
    rows = [(at, " ".join(f"w{at}_{n}" for n in range(at % 40)), f"s{at % 3}") for at in range(2000)]
    docs = written(spark, f"{tmp_path}/docs", rows, "doc_id long, text string, source string")
    taken = {row.doc_id: row.taken for row in mixing.mixed(docs).collect()}
    words = {}
    for row in mixing.mixed_texts(docs).collect():
        words[row.doc_id] = words.get(row.doc_id, 0) + len(row.text.split())
    assert words == {name: n for name, n in taken.items() if n}


def test_every_payload_has_its_response(spark, tmp_path, split_anew):
    rows = [(at, f"u{at}", f"<p>{(at % 700) * 7919}</p>") for at in range(2000)]
    pages = written(spark, f"{tmp_path}/pages", rows, "page_id long, url string, html string")
    marked = archives.marked(pages).collect()
    assert {row.page_id for row in marked if row.response} == set(range(700))
    assert {row.page_id: row["first"] for row in marked if not row.response} == {
        at: at % 700 for at in range(700, 2000)
    }
