"""A corpus pipeline of five stages, each one of the operators in ``martloom.llm``.

Every stage takes the documents its predecessor kept and returns their columns; the last returns
the tokens. No stage has SQL: scores, signatures and pieces are beyond it, so ``tests/llm`` tests
the run against plain Python.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.names import quoted
from martloom.llm import mixing, near_dups, pieces, quality, sanitise
from martloom.llm.common import crc_remainder, table
from martloom.sinks.scratch import staged


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the preference ranking scores at its threshold or better."""
    labels = table(spark, sf_dir, "labels").where(crc_remainder("doc_id", 4) != 2)
    model = quality.learned(docs, labels)
    scored = quality.scored(docs, model, F.struct(*map(quoted, docs.columns)).alias("doc"))
    return scored.where(F.col("score") >= quality.AT_THRESHOLD).select("doc.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles agree to 0.8 or more."""
    return near_dups.without_duplicates(docs, width=5, percent=80)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data and the terms that disclose it are replaced in their texts."""
    return sanitise.sanitised(docs)


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole and partial passes over the documents, as the sources' targets ask."""
    return mixing.mixed_texts(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every text: ``doc_id, n_tokens, ids_sha256, decoded_sha256, covered, ids``."""
    return pieces.digests(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("quality", good_documents),
    ("near-duplicates", one_of_each_group),
    ("personal data", without_personal_data),
    ("mixing", mixed_to_weights),
    ("pieces", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
