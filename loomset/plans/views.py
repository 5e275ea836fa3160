"""Views of the driver tables in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table, texts


def split_of(column: Column) -> Column:
    """train, val or test by the digest of an id; the same row always lands in the same split."""
    head = F.substring(F.md5(F.concat(F.lit("42|"), column.cast("string"))), 1, 4)
    return F.when(head < "b333", "train").when(head < "d999", "val").otherwise("test")


def with_scores(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """Rows of documents with their scores; a missing score means coherent and in distribution."""
    scores = table(spark, sf_dir, "labels")
    return docs.join(scores, "doc_id", "left").select(
        *docs.columns,
        F.coalesce(F.col("quality"), F.lit(1)).cast("double").alias("coherence"),
        (F.coalesce(F.col("toxic"), F.lit(0)) == 1).alias("is_ood"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their scores."""
    return with_scores(spark, sf_dir, texts(spark, sf_dir).select("doc_id", "text", "lang", "source", "n_chars"))


def doc_labels(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Documents with labels from their own columns; ``more`` names columns of documents to keep."""
    scores = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").join(scores, "doc_id", "left")
    size = F.when(F.col("n_chars") > 4000, "long").when(F.col("n_chars") > 800, "mid").otherwise("short")
    return docs.select(
        "doc_id", "source", split_of(F.col("doc_id")).alias("split"),
        F.array_compact(F.array(
            F.col("lang"),
            F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor"),
            F.when(F.col("toxic") == 1, "toxic"),
            size,
            F.when(F.col("text").contains("\n"), "multiline"),
            F.when(F.col("text").contains("@"), "has_email"),
        )).alias("labels"),
        *more,
    )
