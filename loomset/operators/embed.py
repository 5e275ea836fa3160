"""Encoding of texts with a pluggable encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from loomset.functions import chunks as C
from loomset.functions import text as T
from loomset.functions.encoders import Encoder, hashed_terms


def embed(df: DataFrame, text: str, make: Callable[[], Encoder] = hashed_terms, batch: int = 32, out: str = "vec") -> DataFrame:
    """Adds the vector of a text column. ``make`` runs once per task, the encoder on batches of ``batch`` texts."""

    @F.pandas_udf(ST.ArrayType(ST.FloatType()))
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make()
        for part in parts:
            rows: list = []
            for start in range(0, len(part), batch):
                rows.extend(encoder(part.iloc[start:start + batch].tolist()).astype("float32"))
            yield pd.Series(rows, index=part.index)

    return df.withColumn(out, encode(F.col(text)))


def bucket_counts(text: Column, dim: int = 64) -> Column:
    """How many tokens of a text fall in each of ``dim`` buckets, by the digest of the token."""
    bucket = lambda t: F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("bigint") % dim
    found = F.transform(T.tokens(F.coalesce(text, F.lit(""))), bucket)
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(dim - 1).cast("bigint"))
    return T.let(found, lambda b: F.transform(every, lambda k: F.size(b) - F.size(F.array_remove(b, k))))


def term_weights(df: DataFrame, text: str, dim: int = 64) -> DataFrame:
    """One row (weights): for each bucket ln((n + 1) / (d + 1)), where d of the n texts have a token in it."""
    counts = df.select(bucket_counts(F.col(text), dim).alias("c"))
    seen = [F.count_if(F.col("c")[k] > 0) for k in range(dim)]
    return counts.agg(F.array(*[F.ln((F.count("*") + 1) / (d + 1)) for d in seen]).alias("weights"))


def term_vectors(df: DataFrame, text: str, weights: DataFrame | None = None, dim: int = 64, out: str = "vec") -> DataFrame:
    """Adds the default vector of a text column: token counts in ``dim`` buckets at unit length, all zero without tokens.

    ``weights`` from :func:`term_weights` lets rare tokens count for more. All of it is done by array functions.
    """
    counts = bucket_counts(F.col(text), dim)
    if weights is not None:
        df = df.withColumn("__weights", weights.scalar())
        counts = F.zip_with(counts, "__weights", lambda c, w: c * w)
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    scaled = T.let(F.transform(counts, lambda x: x.cast("double")), lambda v: T.let(
        length(v), lambda n: F.transform(v, lambda x: F.when(n > 0, x / n).otherwise(0.0).cast("float"))))
    return df.withColumn(out, scaled).drop("__weights")


def chunk_table(df: DataFrame, text: str, keep: list[str], max_tokens: int = 480, **how) -> DataFrame:
    """One row per chunk with its number: the table form of the chunk fold."""
    made = C.chunk_greedy(F.col(text), max_tokens, **how)
    rows = df.select(*keep, F.posexplode(made).alias("i", "chunk"))
    return rows.select(*keep, (F.col("i") + 1).cast("long").alias("chunk_no"), "chunk")
