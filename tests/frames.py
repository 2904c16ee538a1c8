"""Helpers to state small frames and compare rows as multisets."""

from __future__ import annotations

import contextlib
import io
from collections import Counter

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> Counter:
    return Counter(tuple(row) for row in df.collect())


def same_rows(found: DataFrame, expected: DataFrame) -> None:
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)


def plan_text(df: DataFrame) -> str:
    """The physical plan as ``explain`` prints it."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue()


@contextlib.contextmanager
def settings(spark, **values):
    """Run with other SQL settings; ``__`` in a name stands for a dot."""
    named = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in named}
    for name, value in named.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
