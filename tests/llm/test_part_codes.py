"""Part codes against plain Python, and the search against all entries."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import part_codes

ODD = [
    (None, [1.0] * 8, 1, "x"),
    (5, None, 1, "x"),
    (6, [1.0, None] * 4, 1, "x"),
    (7, [1.0, math.inf] * 4, 1, "x"),
    (8, [math.nan] * 8, 1, "x"),
    (9, [], None, "x"),
    (10, [0.0] * 8, None, "x"),
    (20, [1.0, 0.5, -0.25, 3.0, 0.001, -0.001, 7.5, 2.0], 2, "x"),
    (20, [1.0, 0.5, -0.25, 3.0, 0.001, -0.001, 7.5, 2.0], 2, "x"),
    (20, [1.5, 0.5, -0.25, 3.0, 0.001, -0.001, 7.5, 2.0], None, "x"),
    (30, [0.5, 0.25, 0.125], 2, "x"),
]


def floors(vector):
    out = [math.floor(1024 * float(np.float32(x))) for x in vector]
    return out + [0] * (4 if not out else -len(out) % 4)


def brute(rows, entries=256, rounds=4):
    """(vec_id, code, error, label_error, sha) of each row, in plain Python."""
    kept = [
        (name, floors(vector), label)
        for name, vector, label, *_ in rows
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    found = []
    for length in sorted({len(v) for _, v, _ in kept}):
        own = [row for row in kept if len(row[1]) == length]
        own.sort(key=lambda row: (row[0] is None, row[0] or 0, row[1]))
        width = length // 4
        parts = [[v[at * width : (at + 1) * width] for at in range(4)] for _, v, _ in own]
        books = [[p[at] for p in parts[:entries]] for at in range(4)]

        def nearest(part, book):
            return min(
                (sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), n)
                for n, e in enumerate(book)
            )

        for _ in range(rounds):
            for at in range(4):
                groups = {}
                for p in parts:
                    groups.setdefault(nearest(p[at], books[at])[1], []).append(p[at])
                for n, held in groups.items():
                    books[at][n] = [sum(c) // len(held) for c in zip(*held, strict=True)]
        text = ",".join(str(x) for book in books for entry in book for x in entry)
        sha = hashlib.sha256(text.encode()).hexdigest()
        for (name, _, label), p in zip(own, parts, strict=True):
            best = [nearest(p[at], books[at]) for at in range(4)]
            code = "".join(f"{n:02x}" for _, n in best)
            found.append((name, code, sum(d for d, _ in best), label, sha))
    totals = {}
    for _, _, error, label, _ in found:
        totals[label] = totals.get(label, 0) + error
    return sorted(((n, c, e, totals[lab], s) for n, c, e, lab, s in found), key=str)


def as_rows(df):
    names = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted((tuple(row[n] for n in names) for row in df.collect()), key=str)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    columns = "vec_id long, embedding array<float>, label int, code string"
    return spark.createDataFrame(ODD, columns)


def test_odd_vectors_equal_plain_python(odd_vectors):
    assert as_rows(part_codes.compressed(odd_vectors)) == brute(ODD)


def test_more_rows_than_entries(spark):
    random = np.random.default_rng(3)
    rows = [
        (int(at), [float(x) for x in random.integers(-3, 4, 8) / 512], int(at) % 3 or None)
        for at in random.permutation(400)
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert as_rows(part_codes.compressed(frame.repartition(5))) == brute(rows)


def test_no_rows(odd_vectors):
    assert part_codes.compressed(odd_vectors.limit(0)).count() == 0


def test_huge_components_are_refused(spark):
    columns = "vec_id long, embedding array<float>, label int"
    frame = spark.createDataFrame([(1, [1e20] * 4, 1)], columns)
    with pytest.raises(Exception, match="too large"):
        part_codes.compressed(frame).collect()


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.integers(-6, 6), min_size=3, max_size=3), min_size=1, max_size=30),
    st.lists(st.lists(st.integers(-9, 9), min_size=3, max_size=3), min_size=1, max_size=30),
)
def test_search_equals_all_distances(entries, parts):
    entries, parts = np.array(entries, np.int64), np.array(parts, np.int64)
    number, distance = part_codes.EqualAverage(entries).nearest(parts)
    apart = ((parts[:, None] - entries[None]) ** 2).sum(2)
    assert number.tolist() == apart.argmin(1).tolist()
    assert distance.tolist() == apart.min(1).tolist()


def test_search_leaves_out_most_entries():
    random = np.random.default_rng(1)
    search = part_codes.EqualAverage(random.integers(-500, 500, (256, 16)))
    search.nearest(random.integers(-500, 500, (1000, 16)))
    spread = part_codes.EqualAverage(
        np.arange(256)[:, None] * 10 + random.integers(-5, 5, (256, 16))
    )
    spread.nearest(np.arange(256)[:, None] * 10 + random.integers(-5, 5, (256, 16)))
    assert search.seen <= 256 * 1000 and spread.seen < 0.05 * 256 * 256


def test_codes_are_restored(spark):
    random = np.random.default_rng(5)
    rows = [(at, [float(x) for x in random.normal(size=8)], 1) for at in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    named = part_codes.quoted("vec_id")
    points = part_codes.whole_numbers(frame, named)
    books = part_codes.learned(points, entries=16)
    found = part_codes.restored(part_codes.encoded(points, books), books[8]).collect()
    for row in found:
        whole = [math.floor(1024 * x) for x in rows[row.vec_id][1]]
        assert sum((a - b) ** 2 for a, b in zip(whole, row.vec, strict=True)) == row.error
