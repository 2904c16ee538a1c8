"""Strict renames and projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from martloom.functions.names import name_folder, quoted, require_columns


def rename_columns(df: DataFrame, renames: Mapping[str, str], label: str) -> DataFrame:
    """Rename in map order, as one projection.

    A later rule may refer to the result of an earlier one. A rule that maps a name to
    itself is skipped. A rule whose source is absent, or whose result is already taken by
    another column (a swap included), raises ``ValueError``.
    """
    fold = name_folder(df)
    names = list(df.columns)
    for old, new in renames.items():
        if old == new:
            continue
        if old not in names:
            raise ValueError(f"{label}: cannot rename {old!r}, columns are {sorted(names)}")
        at = names.index(old)
        others = names[:at] + names[at + 1 :]
        if fold(new) in map(fold, others):
            raise ValueError(f"{label}: renaming {old!r} would make a second {new!r}")
        names[at] = new
    return df if names == df.columns else df.toDF(*names)


def select_columns(df: DataFrame, columns: Sequence[str], label: str = "projection") -> DataFrame:
    """Keep exactly ``columns`` in that order; all absent ones are reported together."""
    require_columns(df, columns, label)
    return df.select(*[quoted(name) for name in columns])
