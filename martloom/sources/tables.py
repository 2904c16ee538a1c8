"""Source tables declared as data: where each one is and which columns it renames."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from martloom.functions.names import require_keys
from martloom.operators.projection import rename_columns

Reader = Callable[[str], DataFrame]


@dataclass(frozen=True)
class TableSource:
    table: str
    renames: Mapping[str, str] = field(default_factory=dict)

    def load(self, read: Reader) -> DataFrame:
        return rename_columns(read(self.table), self.renames, self.table)

    @classmethod
    def from_mapping(cls, section: Mapping, label: str = "source") -> TableSource:
        """A section of a configuration file: ``table``, and ``renames`` from old to new names."""
        require_keys(section, ("table", "renames"), label)
        table, renames = section.get("table"), section.get("renames") or {}
        if not isinstance(table, str) or not table:
            raise ValueError(f"{label}: table must be a name")
        require_keys(renames, renames, f"{label}: renames")
        if not all(isinstance(name, str) and name for pair in renames.items() for name in pair):
            raise ValueError(f"{label}: renames must be from name to name")
        return cls(table, dict(renames))


def sources_from_mapping(sections: Mapping) -> dict[str, TableSource]:
    """All sections of a configuration, as YAML or JSON files give them."""
    require_keys(sections, sections, "sources")
    return {
        name: TableSource.from_mapping(section, f"source {name}")
        for name, section in sections.items()
    }


def catalog_reader(spark: SparkSession, namespace: str = "") -> Reader:
    """Read tables by catalog name; ``namespace`` is a ``catalog.schema`` prefix."""
    prefix = f"{namespace}." if namespace else ""
    return lambda table: spark.table(prefix + table)


def folder_reader(spark: SparkSession, folder: str) -> Reader:
    """Read ``<folder>/<table>.parquet``, a file or a directory of part files."""
    return lambda table: spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def load_sources(
    read: Reader, sources: Mapping[str, TableSource], required: Iterable[str]
) -> dict[str, DataFrame]:
    """Load the required sections; an undeclared one is an error, not an empty table."""
    wanted = list(required)
    undeclared = [name for name in wanted if name not in sources]
    if undeclared:
        raise KeyError(f"source sections not declared: {', '.join(undeclared)}")
    return {name: sources[name].load(read) for name in wanted}
