"""Corpus pipeline: documents through the training-data stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but
the last return the columns of ``documents``; the last returns the tokens. Nulls, empty and very long
texts, repeated rows and extra columns have the results that each operator's module states; null and
empty texts fail the base rules, so they end with the first stage. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventsieve.llm import mixing, ngram_join, pieces, quality, secrets
from eventsieve.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the isolation forests reject go."""
    return quality.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies stays."""
    return ngram_join.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with the secrets in its text masked."""
    return secrets.mask_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document."""
    return pieces.encode_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secret_scans),
    ("source mix", source_mix),
    ("tokens", tokens),
]

#: The stages run a forest, MinHash and a token machine, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
