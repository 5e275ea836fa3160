"""Readers for sample, chunk, line and text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas

CORRUPT = "_corrupt_record"
CHUNK_OF = r"^(.*?)_c\d+$"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def complexity_of(classification: Column) -> Column:
    """Both spellings of the field occur in sample files."""
    return F.coalesce(classification["complexity"], classification["complexity_level"], F.lit("unknown"))


def scan_samples(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per sample id: the one of the last file by path. Rows without an id and bad files are left out.

    The survivor is an aggregate, not a window, so copies of one id are combined before the shuffle.
    """
    raw = (
        spark.read.schema(_with_corrupt(schemas.PACKED_SAMPLE))
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .withColumn("file_path", F.col("_metadata.file_path"))
    )
    good = raw.where(F.col(CORRUPT).isNull() & F.col("sample_id").isNotNull()).drop(CORRUPT)
    fields = F.struct(*[c for c in good.columns if c != "sample_id"])
    last = good.groupBy("sample_id").agg(F.max_by(fields, F.struct("file_path", F.xxhash64("raw_input"))).alias("s"))
    return last.select("sample_id", "s.*")


def scan_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of all split folders with ``split`` from the folder and ``document_id`` from field or chunk id."""
    rows = spark.read.schema(schemas.CHUNK).json(path).withColumn(
        "split", F.regexp_extract(F.col("_metadata.file_path"), r"/split=(\w+)/", 1)
    )
    return rows.withColumn("document_id", F.coalesce(F.col("sample_id"), document_of_chunk(F.col("chunk_id"))))


def document_of_chunk(chunk_id: Column) -> Column:
    found = F.regexp_extract(chunk_id, CHUNK_OF, 1)
    return F.when(found != "", found).otherwise(chunk_id)


def scan_jsonl_lenient(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All lines but blank ones; ``malformed`` marks those that are no JSON, kept in the corrupt column."""
    raw = spark.read.schema(_with_corrupt(schema)).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", CORRUPT).json(path)
    return raw.withColumn("malformed", F.col(CORRUPT).isNotNull())


def decode_text(content: Column) -> Column:
    """UTF-8 where the bytes are valid, else Latin-1, which accepts any byte."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))


def scan_text_files(
    spark: SparkSession, path: str, extensions: Sequence[str] = ("txt", "md"), recursive: bool = True
) -> DataFrame:
    """One row per file with its path, size, time and decoded text."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", recursive)
        .option("pathGlobFilter", "*.{" + ",".join(extensions) + "}")
        .load(path)
    )
    return files.select(
        F.col("path").alias("source_path"),
        doc_id_hash(F.col("path"), F.col("modificationTime").cast("double")).alias("doc_id"),
        F.regexp_extract("path", r"\.(\w+)$", 1).alias("extension"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("mtime"),
        decode_text(F.col("content")).alias("text_content"),
    )


def doc_id_hash(path: Column, mtime: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", path, mtime.cast("string")), 256), 1, 16)
