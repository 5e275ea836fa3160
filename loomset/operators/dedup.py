"""Exact duplicates, survivors and what was removed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.session import written_table

from .graphs import components


def exact_dup_groups(df: DataFrame, id_: str, text: str) -> DataFrame:
    """Rows (digest, n, first_id) for every text that occurs more than once; blank texts are left out."""
    keyed = df.where(F.trim(text) != "").select(F.md5(text).alias("digest"), F.col(id_).alias("id"))
    return keyed.groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("first_id")).where("n > 1")


def best_of(id_: str, coherence: str, is_ood: str):
    """The id that survives: most coherent, in distribution, greatest id as a string."""
    return F.max_by(F.col(id_), F.struct(F.col(coherence), ~F.col(is_ood), F.col(id_).cast("string")))


def resolve_duplicates(
    df: DataFrame, near: DataFrame, id_: str = "id", text: str = "text", coherence: str = "coherence", is_ood: str = "is_ood",
    scored: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows (id, reason) to remove.

    Exact groups go first. Then every component of the edges ``near(a, b)`` is
    reduced among the ids that are left. Where scores are looked up in another table,
    ``scored`` adds them to rows (id_, digest), so that no text goes through the join.
    """
    rows = df.where(F.trim(text) != "").withColumn("digest", F.unhex(F.md5(text)))
    rows = scored(rows.select(id_, "digest")) if scored else rows
    rows = written_table(rows.select(F.col(id_).alias("id"), "digest", F.col(coherence).alias("coherence"), F.col(is_ood).alias("is_ood")), "scored")
    keep = rows.groupBy("digest").agg(best_of("id", "coherence", "is_ood").alias("kept"), F.count("*").alias("n")).where("n > 1")
    exact = rows.join(keep, "digest").where("id <> kept").select(
        "id", F.concat(F.lit("exact_duplicate_of_"), F.col("kept").cast("string")).alias("reason"))
    left = components(near).join(exact, "id", "left_anti").join(rows.select("id", "coherence", "is_ood"), "id")
    keep_near = left.groupBy("component").agg(best_of("id", "coherence", "is_ood").alias("kept"), F.count("*").alias("n")).where("n > 1")
    close = left.join(keep_near, "component").where("id <> kept").select(
        "id", F.concat(F.lit("near_duplicate_of_"), F.col("kept").cast("string")).alias("reason"))
    return exact.unionByName(close)


def survivors_by_digest(df: DataFrame, id_: str, digest: str, coherence: str, is_ood: str) -> DataFrame:
    """One row per distinct digest, picked by an aggregate, so a text copied a billion times is combined early."""
    fields = F.struct(*[F.col(c) for c in df.columns if c != digest])
    order = F.struct(F.col(coherence), ~F.col(is_ood), F.col(id_).cast("string"))
    return df.groupBy(digest).agg(F.max_by(fields, order).alias("s")).select(digest, "s.*")
