"""Writers, and the small reports that accompany a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.operators.ranking import dense_numbers, top_n_per_group


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder of JSON lines per split."""
    df.write.partitionBy(split).json(path)


def document_samples(df: DataFrame, path: Column, doc_id: Column, section: Column, text: Column, chunks: Column,
                     tok_len: Column, needs_chunking: Column) -> DataFrame:
    return df.select(
        path.alias("source_path"), doc_id.cast("string").alias("doc_id"), section.alias("section"),
        text.alias("text"), F.length(text).alias("char_len"), tok_len.cast("int").alias("tok_len"),
        chunks.alias("chunks"), needs_chunking.alias("needs_chunking"),
        F.lit(None).cast("string").alias("template_hint"),
    )


def number_batches(df: DataFrame, id_: str, size: int) -> DataFrame:
    """``sample_no`` counts rows in id order, ``batch_id`` numbers batches of ``size`` from 1. Ids of any type."""
    return dense_numbers(df, [id_], "sample_no").withColumn("batch_id", F.floor((F.col("sample_no") - 1) / size) + 1)


def write_batches(df: DataFrame, path: str) -> None:
    """Rows with their batch_id in files of the size of a task, each a stretch of batches.

    Reading one batch skips the files and row groups of the others by their bounds of batch_id.
    """
    df.write.parquet(path)


def read_batch(spark: SparkSession, path: str, batch: int) -> DataFrame:
    return spark.read.parquet(path).where(F.col("batch_id") == batch)


def long_report(df: DataFrame, section: str, key: str, metrics: Sequence[str]) -> DataFrame:
    """Rows (section, key, metric, value) of a wide result."""
    pairs = F.map_from_arrays(
        F.array(*[F.lit(m) for m in metrics]), F.array(*[F.col(m).cast("double") for m in metrics])
    )
    return df.select(F.lit(section).alias("section"), F.col(key).cast("string").alias("key"), F.explode(pairs).alias("metric", "value"))


def manifest_diff(source: DataFrame, target: DataFrame, path: str = "path", digest: str = "digest") -> DataFrame:
    """new, updated or unchanged for every source path, removed for paths only in the target."""
    a = source.select(F.col(path).alias("path"), F.col(digest).alias("ours"))
    b = target.select(F.col(path).alias("path"), F.col(digest).alias("theirs"))
    status = (
        F.when(F.col("theirs").isNull(), "new").when(F.col("ours").isNull(), "removed")
        .when(F.col("ours") != F.col("theirs"), "updated").otherwise("unchanged")
    )
    return a.join(b, "path", "full_outer").select("path", status.alias("status"))


def retained_versions(df: DataFrame, base: str, version: str, mtime: str, keep: int) -> DataFrame:
    """The newest ``keep`` versions of every base with their age rank; rank 1 is the one to load."""
    return top_n_per_group(df, [base], [F.col(mtime).desc(), F.col(version).desc()], keep, "age_rank")


def expired_versions(df: DataFrame, base: str, version: str, mtime: str, keep: int) -> DataFrame:
    kept = retained_versions(df, base, version, mtime, keep).select(base, version)
    return df.join(kept, [base, version], "left_anti")
