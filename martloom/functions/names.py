"""Column references that survive dots, spaces and back-quotes in names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Reference one top-level column by its exact name."""
    return F.col(quoted_name(name))


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def name_folder(df: DataFrame):
    """The function under which this session treats two names as the same column."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false")
    return (lambda name: name) if sensitive == "true" else str.casefold


def require_keys(section: object, known: Iterable[str], label: str) -> None:
    """A section of a configuration must be a mapping without keys that nothing would read."""
    if not isinstance(section, Mapping):
        raise ValueError(f"{label}: expected a mapping, not {section!r}")
    unknown = sorted(str(key) for key in section if key not in set(known))
    if unknown:
        raise ValueError(f"{label}: unknown {', '.join(unknown)}")


def texts_in(section: Mapping, key: str, label: str) -> tuple[str, ...]:
    """A list of texts under a key, empty if it is absent."""
    found = section.get(key) or ()
    if isinstance(found, str) or not all(isinstance(text, str) for text in found):
        raise ValueError(f"{label}: {key} must be a list of names")
    return tuple(found)


def require_columns(df: DataFrame, names: Iterable[str], label: str) -> None:
    """Fail on every absent column at once; the comparison is case-sensitive."""
    present = set(df.columns)
    absent = [name for name in names if name not in present]
    if absent:
        have = ", ".join(sorted(present))
        raise ValueError(f"{label}: no column {', '.join(absent)}; have {have}")


def require_disjoint(left: DataFrame, right: DataFrame, key: str, label: str) -> None:
    """A join on ``key`` must not yield two columns of the same name."""
    fold = name_folder(left)
    shared = {fold(n) for n in left.columns} & {fold(n) for n in right.columns}
    shared.discard(fold(key))
    if shared:
        names = ", ".join(sorted(shared))
        raise ValueError(f"{label}: both sides hold {names}; rename one of them")
