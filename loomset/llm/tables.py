"""Shared folder, written tables and Arrow settings for the operators of this subpackage."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

from loomset.session import scratch_path, written_table

#: rows that Spark hands to Python at once; bounds the memory of a worker when texts are long
ROWS_AT_ONCE = 2000


def bounded_batches(spark: SparkSession) -> None:
    """Hold the rows of one Arrow batch of this session at ROWS_AT_ONCE or fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if not 0 < now <= ROWS_AT_ONCE:
        spark.conf.set(key, str(ROWS_AT_ONCE))


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone, so that other columns of any name stay out of the way."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def nullable(kind: DataType) -> DataType:
    """The type with nulls allowed at every level, as Arrow batches from Python have it."""
    if isinstance(kind, ArrayType):
        return ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, MapType):
        return MapType(nullable(kind.keyType), nullable(kind.valueType), True)
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, nullable(f.dataType), True, f.metadata) for f in kind.fields])
    return kind


class Packed(NamedTuple):
    """Documents as (doc_id, text, row), where ``row`` holds all columns but the text under plain names."""

    rows: DataFrame
    kind: StructType
    names: list[str]

    @classmethod
    def of(cls, docs: DataFrame) -> Packed:
        """Columns go by their place, so their names, and whether they may be null, are of no matter."""
        bounded_batches(docs.sparkSession)
        fields, names = docs.schema.fields, docs.columns
        plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
        kind = StructType([StructField(f"c{i}", nullable(f.dataType)) for i, f in enumerate(fields) if names[i] != "text"])
        row = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kind.fields]).cast(kind)
        at = {name: F.col(f"c{names.index(name)}") for name in ("doc_id", "text")}
        return cls(plain.select(at["doc_id"].cast("bigint").alias("doc_id"), at["text"].cast("string").alias("text"), row.alias("row")), kind, names)

    @property
    def field(self) -> StructField:
        return StructField("row", self.kind)

    def named(self, row: str = "row") -> Column:
        """The packed columns as a struct of their own names."""
        return F.col(row).cast(StructType([StructField(self.names[int(f.name[1:])], f.dataType) for f in self.kind.fields]))

    def unpacked(self, found: DataFrame, text: str = "text") -> DataFrame:
        """The columns of the documents again, the text being the column ``text`` of ``found``."""
        plain = [F.col(text) if name == "text" else F.col("row").getField(f"c{i}") for i, name in enumerate(self.names)]
        return found.select(*[c.alias(f"c{i}") for i, c in enumerate(plain)]).toDF(*self.names)


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts, by one aggregate over the column."""
    return docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("bigint"))).first()[0] or 0


def parts_for(spark: SparkSession, size: int, each: int) -> int:
    """How many partitions hold ``size`` bytes at ``each`` bytes apiece; grows with the data."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // each))


#: a key with this share of all rows or more is hot; so there are at most as many hot keys
HOT_SHARE = 4096


def joined_by_key(rows: DataFrame, facts: DataFrame, key: str | list[str], count: str, how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row per key and in ``count`` how many rows have it.

    Keys that hold one in HOT_SHARE of the counted rows are at most HOT_SHARE and are broadcast, so that their
    rows stay where they are; the others are joined by a shuffle. Both tables should be written ones.
    """
    keys = [key] if isinstance(key, str) else key
    total = facts.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) * HOT_SHARE >= F.lit(total)
    hot = F.broadcast(facts.where(is_hot).drop(count))
    cold = facts.where(~is_hot).drop(count)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys, how))


__all__ = ["Packed", "bounded_batches", "joined_by_key", "parts_for", "scratch_path", "text_bytes", "text_rows", "written_table"]
