"""The corpus pipeline: documents in, token ids of a clean corpus out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents. Rows and columns that a stage has no
say in pass through: nulls, empty and very long texts, repeated rows and further columns are defined by the
operator that the stage calls.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomset.llm import contamination, language_id, merges, near_text, repeats
from loomset.llm.tables import written_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without text or letters go."""
    return language_id.with_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near duplicates on five-word shingles."""
    return near_text.without_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes or more that an earlier document has; whole characters stay."""
    return repeats.without_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark item occurs."""
    return contamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of the text decoded from them."""
    return merges.round_trip_report(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("pieces", pieces),
]

#: SQL can express neither the language trees nor the merges
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before wrote to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
