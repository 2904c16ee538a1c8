"""Compare a Spark result with a DuckDB result: names, types, and rows as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

# DuckDB type names and the Spark types that hold the same values.
SAME_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return db


def require_same(result: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> int:
    answer = db.execute(sql)
    expected_types = {c[0]: SAME_TYPE[str(c[1])] for c in answer.description}
    assert dict(result.dtypes) == expected_types
    names = sorted(expected_types)
    order = [list(expected_types).index(name) for name in names]
    expected = Counter(tuple(row[at] for at in order) for row in answer.fetchall())
    found = Counter(tuple(row) for row in result.select(*names).collect())
    assert found == expected
    return sum(found.values())
