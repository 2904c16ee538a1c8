"""The mix against plain apportionment, and its texts against its counts."""

from __future__ import annotations

import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from martloom.llm import mixing
from martloom.llm.mixing import Mix, apportioned, mixed, mixed_texts

FOLDER = "/root/testdata/sf0.01"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Raise by weight, stop at twice the size, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[at % 3] for at, s in enumerate(order)}
    left, target = Fraction(3, 2) * sum(sizes.values()), dict.fromkeys(order, Fraction(0))
    rising = {s for s in order if sizes[s]}
    while left and rising:
        whole = sum(weight[s] for s in rising)
        share = {s: left * weight[s] / whole for s in rising}
        left = Fraction(0)
        for s in list(rising):
            target[s] += share[s]
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = Fraction(2 * sizes[s])
                rising.discard(s)
    return target


@pytest.mark.parametrize("small", [True, False])
def test_targets_and_words_taken(spark, odd_documents, small):
    docs = odd_documents if small else spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.collect()
    sizes: Counter = Counter()
    for row in rows:
        sizes[row.source] += size(row.text)
    expected = targets(sizes)
    found = mixed(docs).join(docs.select("doc_id", "source").distinct(), "doc_id").collect()
    taken: Counter = Counter()
    for row in found:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(float(expected[row.source]))
        assert 0 <= row.taken <= 2 * row.size
        taken[row.source] += row.taken
    if not small:
        for source, target in expected.items():
            assert abs(taken[source] - target) <= 2 * 64, source
        assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.01)


@pytest.mark.parametrize("mix", [Mix(), Mix(shard_words=2000, block_words=16)])
def test_texts_hold_the_words_that_are_taken(spark, mix):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    taken = {row.doc_id: row.taken for row in mixed(docs, mix).collect()}
    texts = {row.doc_id: row.text for row in docs.collect()}
    words: Counter = Counter()
    for row in mixed_texts(docs, mix).collect():
        words[row.doc_id] += size(row.text)
        assert row.n_chars == len(row.text)
        whole = iter(texts[row.doc_id].split())
        assert row.text == texts[row.doc_id] or all(word in whole for word in row.text.split())
    assert dict(words) == {name: n for name, n in taken.items() if n}


def test_reruns_agree_however_the_rows_are_dealt(documents):
    one = sorted(mixed(documents).collect())
    assert sorted(mixed(documents.repartition(7)).collect()) == one
    other = sorted(mixed(documents, Mix(seed="another")).collect())
    assert other != one and [row.target for row in other] == [row.target for row in one]


def test_odd_documents(odd_documents, no_documents):
    found = mixed(odd_documents)
    assert found.count() == odd_documents.count()
    assert {r.taken for r in found.collect() if r.doc_id in (900_001, 900_002, 900_003)} == {0}
    out = mixed_texts(odd_documents)
    assert out.columns == odd_documents.columns
    assert {row.size for row in out.collect()} == {"x"}
    assert mixed(no_documents).count() == mixed_texts(no_documents).count() == 0


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 1001])
@pytest.mark.parametrize("weights", [[5], [3, 3, 3], [53, 24, 23, 0], [1] * 30 + [1000]])
def test_quotas_by_highest_quotients(spark, seats, weights):
    rows = [(at, weight) for at, weight in enumerate(weights)]
    groups = spark.createDataFrame(rows, "tie int, weight long")
    found = apportioned(groups, [], F.col("weight"), F.lit(seats).cast("long")).collect()
    quotients = sorted(
        ((-Fraction(w, 2 * k + 1), at) for at, w in rows if w for k in range(seats))
    )[:seats]
    expected = Counter(at for _, at in quotients)
    assert {row.tie: row.quota for row in found} == {at: expected[at] for at, _ in rows}


def test_module_weights():
    assert mixing.WEIGHTS == (3, 1, 2)
