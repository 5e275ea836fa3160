"""Phrases and keywords per document, as token tables instead of per-text loops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions import patterns as P
from loomset.functions.text import let


def _grams(words: Column, n: int) -> Column:
    last = F.size(words) - n
    joined = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)]))
    return F.when(last >= 0, joined).otherwise(F.array().cast("array<string>"))


def _frequent(values: Column, top: int) -> Column:
    """The ``top`` values that an array holds more than once, as structs (minus its count, value) in order.

    Equal values are runs of the sorted array, so counting those of a text needs no exchange.
    """
    def runs(s):
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda i, k: F.struct(
            (i - F.coalesce(F.get(at, k + 1), F.size(s))).cast("long").alias("minus"), F.get(s, i).alias("value"))))

    found = let(F.sort_array(values), lambda s: F.when(F.size(s) > 0, runs(s)))
    return F.slice(F.sort_array(F.filter(found, lambda r: r["minus"] < -1)), 1, top)


def _ranked(pos: str, found: str, name: str) -> list[Column]:
    return [F.col(f"{found}.value").alias(name), (-F.col(f"{found}.minus")).alias("n"), (F.col(pos) + 1).cast("long").alias("rank")]


def key_phrases(df: DataFrame, id_: str, text: str, sizes=((2, 20), (3, 10))) -> DataFrame:
    """The most frequent bigrams and trigrams of letter-words of each text that occur more than once."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b[A-Za-z]+\b"), F.lit(0))
    parts = let(found, lambda w: F.array(*[
        F.struct(F.lit(n).cast("long").alias("size"), _frequent(_grams(w, n), top).alias("top")) for n, top in sizes]))
    each = df.select(id_, F.explode(parts).alias("part")).select(id_, "part.size", F.posexplode("part.top").alias("pos", "found"))
    return each.select(id_, *_ranked("pos", "found", "phrase"), "size")


def keywords(df: DataFrame, id_: str, text: str, stops: Sequence[str] = P.KEYWORD_STOPS, top: int = 15) -> DataFrame:
    """The most frequent words of four letters or more that are no stop words and occur more than once."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b[A-Za-z]{4,}\b"), F.lit(0))
    kept = F.filter(found, lambda word: ~word.isin(*stops))
    return df.select(id_, F.posexplode(_frequent(kept, top)).alias("pos", "found")).select(id_, *_ranked("pos", "found", "word"))


def multi_label_merge(df: DataFrame, id_: str, text: str, labels: str, group: str, size: int = 3) -> DataFrame:
    """Samples of two or ``size`` neighbouring rows of a group in seeded order.

    Their first sentences are joined, labels united, ids kept. A sample holds at
    most ``size`` rows, however large the group is.
    """
    from .ranking import seeded_rank

    # cut before the ranks' shuffles, so no whole text goes through them
    short = df.select(id_, group, F.col(labels).alias("labels"), F.trim(F.substring_index(text, ". ", 1)).alias("head"))
    ranked = seeded_rank(short, id_, keys=[group]).withColumn("part", F.floor((F.col("rank") - 1) / size))
    rows = ranked.select(group, "part", F.struct("rank", F.col(id_).alias("id"), "head", "labels").alias("r"))
    merged = rows.groupBy(group, "part").agg(F.array_sort(F.collect_list("r")).alias("rs")).where(F.size("rs") > 1)
    union = F.array_sort(F.array_distinct(F.flatten(F.transform("rs", lambda r: r["labels"]))))
    return merged.select(
        group, "part", F.concat(F.array_join(F.transform("rs", lambda r: r["head"]), ". "), F.lit(".")).alias("text"),
        union.alias("labels"), F.transform("rs", lambda r: r["id"]).alias("source_ids"))
