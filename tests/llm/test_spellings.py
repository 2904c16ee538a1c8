"""Spelling variants against all pairs in plain Python."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martloom.llm import spellings

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def words_of(rows):
    found = Counter()
    for name, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {word: n for word, n in found.items() if len(word) >= 5 and n >= 3}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:at] + long[at + 1 :] == short for at in range(len(long)))


def brute(words):
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[word] = best if best and words[best] >= 2 * words[word] else None
    rows = []
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        rows.append((word, form[word], root, n, len(near[word]), words.get(form[word])))
    return sorted(rows)


def as_rows(df):
    assert df.columns == list(COLUMNS)
    return sorted(tuple(row) for row in df.collect())


def test_documents_equal_plain_python(documents, odd_documents):
    docs = odd_documents.select("doc_id", "text").unionAll(documents.select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = as_rows(spellings.spelling_variants(odd_documents.unionByName(documents, True)))
    assert found == brute(words_of(rows)) and len(found) > 100


def test_no_words(no_documents, spark):
    assert spellings.spelling_variants(no_documents).count() == 0
    rows = [(1, None), (2, ""), (None, "12 !!"), (3, "ab cd")]
    assert spellings.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0


def dictionary(spark, words):
    return spark.createDataFrame(sorted(words.items()), "word string, n long").repartition(3)


def test_runs_of_equal_letters_ties_and_chains(spark, monkeypatch):
    monkeypatch.setattr(spellings, "PART_POINTS", 7)  # many parts, whose paths must meet
    words = {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24, "baaaa": 6, "aaaab": 6}
    words |= {"größe": 9, "grösse": 4, "große": 20, "grüße": 20, "ÿabcd": 3, "ÿabcde": 5}
    words |= {f"chain{'x' * at}": 2 ** (at + 2) for at in range(30)}
    words |= {"a" * 3000: 5, "a" * 2999: 11, "b" + "a" * 2999: 4, "alone": 7, "abcde": 3}
    words |= {f"stem{chr(97 + a)}{chr(97 + b)}": a + b + 1 for a in range(26) for b in range(26)}
    assert as_rows(spellings.variants(dictionary(spark, words))) == brute(words)


@pytest.mark.parametrize("points", [1, 40, 1 << 20])
def test_numbers_of_nodes_tell_strings_apart(spark, monkeypatch, points):
    monkeypatch.setattr(spellings, "PART_POINTS", points)
    words = ["abcde", "abcdf", "abxyz", "b", "ba", "bab", "abc", "abcd", "cab", "éab", "éabc"]
    frame = spark.createDataFrame(list(enumerate(words)), "id long, word string")
    found = spellings.paths(frame, F.col("word"), sum(map(len, words)), "test-trie").collect()
    nodes = {}
    for row in found:
        word = words[row.id]
        assert len(row.path) == len(word) + 1 and row.path[0] == 0
        for at, node in enumerate(row.path):
            assert nodes.setdefault(node, word[:at]) == word[:at]
    assert len(nodes) == len({word[:at] for word in words for at in range(len(word) + 1)})
    assert sorted(nodes) == list(range(len(nodes)))
