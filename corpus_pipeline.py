"""The corpus pipeline: quality, near-duplicates, benchmark items, personal data, tokens.

Every stage takes an empty table, texts of any length, null in any column and
columns of its own beside those of ``documents``, which pass through whatever
they are called; a null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waymark import session, tables
from waymark.llm import bpe, decontaminate, pii, quality, simhash


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with their own columns.

    Null and empty texts go (fewer than 20 words). A null language or source is
    a group with fences of its own; a value on a fence stays. Repeated rows are
    judged alike and all stay or go.
    """
    session.ship(spark)
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Exactly one row of a group stays: of repeated rows and of rows with one id
    (ties) any one, a row without an id only where no other is. Null and empty
    texts are one group.
    """
    session.ship(spark)
    return simhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none, and null or empty items are in none. Repeated
    rows stay or go together; rows without an id are judged like others.
    """
    session.ship(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; ``n_chars`` follows the text.

    All rows stay. A null text stays null, an empty one empty. Repeated rows are
    rewritten alike, and one value has one surrogate in all documents.
    """
    session.ship(spark)
    return pii.rewritten(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's ids and decoded text.

    One row for each row: a null or empty text has no tokens, repeated rows and
    null ids come out as they went in.
    """
    session.ship(spark)
    return bpe.round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("decontamination", clean),
    ("pii", private),
    ("bpe", tokens),
]

#: BPE cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = tables.table(docs, name)
    return docs
