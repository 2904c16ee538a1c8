from __future__ import annotations

import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark, documents, tmp_path_factory):
    """Some documents, edge cases, repeated rows, and columns with names used inside operators."""
    long = "word " * 30_000 + "end. Mail to long@one.example.org"
    odd = [
        (None, "a text without an id", "en", "s1", 20),
        (None, None, None, None, None),
        (900_001, None, "en", "s1", 0),
        (900_002, "", None, "s2", 0),
        (900_003, " \t\n ", "de", None, 4),
        (900_004, "one", "en", "s1", 3),
        (900_005, "one", "fr", "s2", 3),
        (900_006, "12 34 !!", "en", "s1", 8),
        (900_007, long, "en", "s1", len(long)),
        (900_008, "twice the same row here", "en", "s1", 23),
        (900_008, "twice the same row here", "en", "s1", 23),
        (900_009, "é😀 ñandú <|endoftext|>  two  spaces \n\n and a line  ", "es", "s3", 50),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = documents.limit(60).unionAll(spark.createDataFrame(odd, schema))
    for name in ("row", "__row", "size", "score", "target", "node", "key", "spans", "ids", "begins"):
        rows = rows.withColumn(name, F.lit("x"))
    folder = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    rows.write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.limit(0)
