"""The shingle join against all pairs in plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import near_dups
from martloom.llm import shingle_join as join
from tests.llm.test_near_dups import brute, shingles


def check(docs, width=5, percent=80, cell=join.CELL):
    found = join.joined(docs, width, percent, cell).where("doc_id IS NOT NULL")
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    expected = [row[:3] for row in brute(rows, width, percent)]
    assert sorted(tuple(row) for row in found.collect()) == expected


@pytest.mark.parametrize("width", [1, 5])
def test_equals_brute_force(odd_documents, width):
    check(odd_documents, width)


def crowd(seed, groups=6, size=25):
    """Groups of near copies, unrelated texts full of common passages, and chains."""
    draw = random.Random(seed)
    passages = [[f"p{n}w{at}" for at in range(40)] for n in range(5)]
    rows = []
    for group in range(groups):
        base = [f"g{group}w{at}" for at in range(60)]
        for _ in range(size):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = f"e{draw.randrange(10**6)}"
            rows.append(" ".join(copy))
    for at in range(40):
        own = [f"u{at}w{n}" for n in range(draw.randint(1, 12))]
        parts = [p for p in passages if draw.random() < 0.6] + [own]
        draw.shuffle(parts)
        rows.append(" ".join(word for part in parts for word in part))
    rows += ["a b c d", "a b c d e", "a b", "A  B", "one", "one two three four five six"]
    rows += rows[:7]
    names = draw.sample(range(10_000), len(rows))
    return list(zip(names, rows, strict=True))


@pytest.mark.parametrize(("seed", "cell"), [(1, join.CELL), (2, 6)])
def test_crowds(spark, monkeypatch, seed, cell):
    monkeypatch.setattr(join, "BLOCK_SHINGLES", 1500)
    monkeypatch.setattr(join, "PART_SHINGLES", 700)
    monkeypatch.setattr(join, "PAIRED", 2)
    monkeypatch.setattr(join, "TRIPLED", 4)
    monkeypatch.setattr(join, "SKETCH", 1)
    docs = spark.createDataFrame(crowd(seed), "doc_id long, text string").repartition(5)
    check(docs, 2, cell=cell)


def test_refused_pairs_are_asked_for_again(spark, monkeypatch):
    """Sketches that tell nothing: everything is proposed and most is refused."""
    monkeypatch.setattr(join, "sketch_bits", lambda n: 64)
    monkeypatch.setattr(join, "PAIRED", 1)
    monkeypatch.setattr(join, "ROUNDS", 1)
    docs = spark.createDataFrame(crowd(3, 3, 12), "doc_id long, text string")
    check(docs, 2, cell=8)


def test_repeated_ids_with_different_texts_and_rows_without_id(spark):
    rows = [(1, "a b c d e f"), (2, "A b c d  e f"), (2, "quite another text of words here")]
    rows += [(None, "a b c d e f"), (None, "x y z"), (None, None), (3, None), (4, " ")]
    found = join.joined(spark.createDataFrame(rows, "doc_id long, text string"), 2)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(1, 5, 1), (2, 5, 1), (2, 5, 2), (None, 5, 1), (None, 2, None), (None, 0, None),
         (3, 0, 3), (4, 0, 4)], key=str,
    )


def test_no_documents(no_documents):
    assert join.joined(no_documents).count() == 0


def token_sets():
    return st.sets(st.integers(0, 40), min_size=1, max_size=30)


@settings(max_examples=200, deadline=None)
@given(token_sets(), st.sets(st.integers(0, 40), max_size=3), st.integers(0, 5), st.integers(0, 9))
def test_linked_sets_have_a_key_in_common(one, extra, gone, seed):
    """Whatever the ranks of tokens are, if only they are above 0 for shared ones."""
    two = set(sorted(one)[gone:]) | extra
    shared, union = len(one & two), len(one | two)
    if not two or 100 * shared < 80 * union or one == two:
        return
    ranks = np.random.default_rng(seed).integers(1, 16, 64).astype(np.uint8)
    keys = [
        join.keys_of(np.array(sorted(s), np.uint64), ranks[sorted(s)], 80) for s in (one, two)
    ]
    assert len(np.intersect1d(*keys))


@settings(max_examples=200, deadline=None)
@given(token_sets(), token_sets(), st.integers(0, 99))
def test_sketches_never_differ_more_than_sets(one, two, seed):
    values = np.random.default_rng(seed).integers(0, 2**63, 64).astype(np.uint64)
    a, b = (values[sorted(s)] for s in sorted((one, two), key=len))
    x, y = (np.frombuffer(join.sketch(s), np.uint64) for s in (a, b))
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    assert np.bitwise_count(x ^ y).sum() <= len(one ^ two)


def test_number_of_keys_grows_with_the_set_only(spark):
    draw = np.random.default_rng(4)
    for n in (100, 1000, 10_000):
        tokens = draw.integers(0, 2**63, n).astype(np.uint64)
        for rank in (3, 8, 14):
            keys = join.keys_of(np.sort(tokens), np.full(n, rank, np.uint8), 80)
            assert 0 < len(keys) <= 12 * n
        assert not len(join.keys_of(np.sort(tokens), np.zeros(n, np.uint8), 80))


def near_copies(seed, size):
    """Sketches of copies of one set, each with a few tokens of its own, and their true distances."""
    draw = np.random.default_rng(seed)
    base = draw.integers(0, 2**63, 90).astype(np.uint64)
    sets = []
    for at in range(size):
        own = draw.random(90) >= (0.5 if at % 10 == 0 else 0.05)
        other = draw.integers(0, 2**63, 90 - own.sum()).astype(np.uint64)
        sets.append(np.sort(np.concatenate([base[own], other])))
    sizes = np.full(size, 90)
    sketches = [join.sketch(one) for one in sets]
    linked = lambda a, b: len(np.intersect1d(sets[a], sets[b])) >= join.least_shared(80, 180)
    return join.Members(np.arange(size), np.arange(size), sizes, sizes, sketches), linked


def test_sure_pairs_first_and_few_refused():
    """A forest is proposed; pairs near the bound wait until all sure ones are."""
    cell, linked = near_copies(1, 150)
    found, more = cell.proposals(80, set(), 0, False)
    assert more and len(found) < 150
    refused = {pair for pair in found if not linked(*pair)}
    # Tied to the first that its sketch allows, 14 of these would be refused.
    assert len(refused) <= 5
    again, _ = cell.proposals(80, refused, 8, False)
    assert not refused & set(again) and len(again) == len(set(again))


def test_a_cell_knows_when_nothing_is_left():
    cell, linked = near_copies(2, 2)
    cell.roots[:] = [0, 1]
    found, more = cell.proposals(80, set(), 0, False)
    assert len(found) <= 1 and not more
    cell, linked = near_copies(3, 40)
    whole, more = cell.proposals(80, set(), 0, True)
    assert not more and len(whole) == len(set(whole))
    assert {(a, b) for a in range(40) for b in range(a + 1, 40) if linked(a, b)} <= set(whole)
    seen = set()
    for turn in range(join.ROUNDS + 1):
        extra = join.EXTRA**turn if turn else 0
        found, more = cell.proposals(80, seen, extra, turn == join.ROUNDS)
        assert not seen & set(found)
        seen |= set(found)  # all of them refused
        if not more:
            break
    assert seen == set(whole)


def test_a_cell_names_the_members_of_the_pairs_left():
    """Exactly these are read again; without extra pairs at least these."""
    members = lambda pairs: {node for pair in pairs for node in pair}
    for seed, extra in ((4, 1), (5, 8), (6, 64)):
        cell, _ = near_copies(seed, 80)
        whole, _ = cell.proposals(80, set(), 0, True)
        found, left = cell.proposals(80, set(), 0, False)
        assert members(set(whole) - set(found)) <= set(left)
        cell.roots[np.arange(80) % 10 != 0] = 1
        whole, _ = cell.proposals(80, set(), 0, True)
        refused = set(whole[::3])
        found, left = cell.proposals(80, refused, extra, False)
        assert not refused & set(found)
        assert set(left) == members(set(whole) - refused - set(found))
    assert len(left) < 80


def test_parents_are_copied_only_where_asked_for(spark):
    """A star's members are at no one's lower end, so that no copies of them are made."""
    edges = spark.range(1, 2000).selectExpr("id AS high", "0L AS low")
    asked = near_dups._large_star(edges)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in asked
    assert near_dups._large_star(edges).count() == 1999


def test_numbers_survive_packing():
    for values in ([], [0, 5, 2**32 - 1], [1, 2**40]):
        values = np.array(values, np.uint64)
        assert join.unpacked(join.packed(values)).tolist() == values.tolist()
    assert shingles("a b", 5) == {(b"a", b"b")}
