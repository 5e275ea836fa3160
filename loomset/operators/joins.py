"""Equi joins with defaults, compatibility checks, pair building and negatives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V
from .ranking import digest, digest_bucket, exact_rank, prefix_sum, top_n_per_group


def clean_anti(df: DataFrame, removed: DataFrame, id_: str) -> DataFrame:
    return df.join(removed, id_, "left_anti")


def split_semi(df: DataFrame, members: DataFrame, id_: str) -> DataFrame:
    return df.join(members, id_, "left_semi")


def lookup_default(df: DataFrame, dim: DataFrame, on: str, defaults: dict[str, object]) -> DataFrame:
    """Left join with a default for every looked-up column; the planner broadcasts a small ``dim``."""
    joined = df.join(dim, on, "left")
    for name, value in defaults.items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return joined


def first_split(members: DataFrame, id_: str, order: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """One split per id: the first in ``order`` that lists it."""
    place = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("split"))
    return members.groupBy(id_).agg(F.min_by("split", place).alias("split"))


def compat_check(df: DataFrame, home: DataFrame, allowed: DataFrame, impossible: DataFrame) -> DataFrame:
    """Judge pairs (brand, industry).

    ``home(brand, home_industry)`` is the authoritative table,
    ``allowed(home_industry, industry)`` lists what fits, ``impossible(brand,
    industry)`` what never does. Unknown brands pass.
    """
    bad = impossible.select("brand", "industry", F.lit(True).alias("is_impossible"))
    fits = allowed.select("home_industry", "industry", F.lit(True).alias("fits"))
    joined = (
        df.join(home, "brand", "left").join(bad, ["brand", "industry"], "left")
        .join(fits, ["home_industry", "industry"], "left")
    )
    impossible_ = F.col("is_impossible").isNotNull()
    known = F.col("home_industry").isNotNull()
    valid = ~impossible_ & (~known | F.col("fits").isNotNull())
    confidence = (
        F.when(known & (F.col("home_industry") == F.col("industry")), 0.95)
        .when(valid, 0.85).when(~impossible_, 0.70).otherwise(0.25)
    )
    corrected = F.when(valid | ~known, F.col("industry")).otherwise(F.col("home_industry"))
    return joined.select(
        *df.columns, valid.alias("valid"), confidence.alias("confidence"), corrected.alias("corrected_industry")
    )


def window_pairs(df: DataFrame, id_: str, group: str, bucket: Column, reach: int = 2) -> DataFrame:
    """Pairs of rows at most ``reach`` apart in their group, as an equi join on (group, place)."""
    placed = exact_rank(df.select(id_, group), [id_], bucket, [group], "place")
    ahead = placed.select(
        F.col(group), F.col(id_).alias("a"), F.explode(F.array(*[F.col("place") + i for i in range(1, reach + 1)])).alias("place")
    )
    return ahead.join(placed.select(F.col(group), F.col(id_).alias("b"), "place"), [group, "place"]).select("a", "b", group)


def head_pairs(df: DataFrame, id_: str, group: str, head: int = 10) -> DataFrame:
    """All pairs among the first ``head`` rows of every group."""
    first = top_n_per_group(df.select(id_, group), [group], [F.col(id_)], head).drop("rank")
    other = first.select(F.col(group), F.col(id_).alias("b"))
    return first.withColumnRenamed(id_, "a").join(other, group).where("a < b").select("a", "b", group)


def class_order(df: DataFrame, id_: str, group: str) -> DataFrame:
    """Rows (id, group, place, start, size, total): one seeded order of all rows in which every class is a stretch.

    ``place`` counts from 0, the row's class is the stretch from ``start`` on of ``size`` rows, ``total`` rows
    are there. Rows without a class are left out. Ranks are taken bucket by bucket, so a class may be of any size.
    """
    rows = df.select(id_, group).where(F.col(group).isNotNull())
    sizes = rows.groupBy(group).agg(F.count("*").alias("size")).withColumn("h", digest(F.col(group)))
    starts = prefix_sum(sizes, F.col("size"), ["h", group], digest_bucket(F.col("h")), name="start")
    hashed = rows.withColumn("h", digest(F.col(id_)))
    ranked = exact_rank(hashed, ["h", id_], digest_bucket(F.col("h")), [group], "rank")
    total = rows.agg(F.count("*")).scalar()
    return ranked.join(starts.select(group, "start", "size"), group).select(
        id_, group, (F.col("start") + F.col("rank") - 1).alias("place"), "start", "size", total.alias("total")
    )


def rows_of_other_classes(asking: DataFrame, ordered: DataFrame, id_: str, group: str, count: int) -> DataFrame:
    """Rows (query, id, own, other, slot): ``count`` different rows of other classes for every asking row.

    ``asking`` are rows of ``ordered`` (:func:`class_order`). All rows outside a class follow its stretch, around
    the end of the order, so the j-th of them is a place that is found by one equi join, whatever class it is
    of. The first slot is drawn by the row's digest from all of them, the others lie evenly spread behind it.
    There are fewer slots only where all other classes together have fewer rows.
    """
    others = F.col("total") - F.col("size")
    step = F.greatest(F.lit(1), F.floor(others / count))
    drawn = F.conv(F.substring(digest(F.col(id_), "negative"), 1, 15), 16, 10).cast("long")
    slots = asking.where(others > 0).select(
        F.col(id_).alias("query"), F.col(group).alias("own"), "start", "size", "total", others.alias("others"), step.alias("step"),
        drawn.alias("drawn"), F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("slot"),
    ).where(F.col("slot") < F.col("others"))
    ahead = F.pmod(F.pmod(F.col("drawn"), F.col("others")) + F.col("slot") * F.col("step"), F.col("others"))
    aimed = slots.select("query", "own", F.col("slot").cast("long").alias("slot"), F.pmod(F.col("start") + F.col("size") + ahead, F.col("total")).alias("place"))
    targets = ordered.select(F.col(id_).alias("id"), F.col(group).alias("other"), "place")
    return aimed.join(targets, "place").select("query", "id", "own", "other", "slot")


def negative_pairs(df: DataFrame, id_: str, group: str, head: int = 3) -> DataFrame:
    """The first ``head`` rows of each group, each with a row drawn from all other groups."""
    ordered = class_order(df, id_, group)
    mine = top_n_per_group(ordered, [group], [F.col(id_)], head, "r").drop("r")
    pairs = rows_of_other_classes(mine, ordered, id_, group, 1)
    return pairs.select(F.col("query").alias("a"), F.col("id").alias("b"), F.col("own").alias(group), "other")


def hard_negatives(df: DataFrame, id_: str, label: str, vec: str, n: int = 3, neighbours: int = 50) -> DataFrame:
    """Rows (query, id, rank, tier): ``n`` negatives of another class per row, as long as there are so many.

    First half as many drawn from all other classes, then the nearest of another class among the
    neighbours, then more drawn from all other classes.
    """
    first = max(1, n // 2)
    labels = df.select(F.col(id_).alias("id"), F.col(label).alias("label")).where("label IS NOT NULL")
    ordered = class_order(df, id_, label)
    partners = rows_of_other_classes(ordered, ordered, id_, label, first + n)
    spread = partners.select(
        "query", "id", F.when(F.col("slot") < first, 0).otherwise(2).alias("tier"), F.col("slot").cast("double").alias("key")
    )
    rows = df.where(F.col(label).isNotNull()).select(F.col(id_).alias("id"), F.col(vec).alias("vec"))
    near = V.knn(rows, rows, neighbours, exclude_self=True)
    near = (
        near.join(labels, "id").join(labels.select(F.col("id").alias("query"), F.col("label").alias("mine")), "query")
        .where(F.col("label") != F.col("mine"))
        .select("query", "id", F.lit(1).alias("tier"), F.col("rank").cast("double").alias("key"))
    )
    once = spread.unionByName(near).groupBy("query", "id").agg(F.min(F.struct("tier", "key")).alias("o"))
    ranked = top_n_per_group(once, ["query"], [F.col("o.tier"), F.col("o.key"), F.col("id")], n)
    return ranked.select("query", "id", "rank", F.col("o.tier").alias("tier"))


def profile_select(requests: DataFrame, profiles: DataFrame, low_confidence: float = 0.5, terms: DataFrame | None = None) -> DataFrame:
    """The best profile for every target.

    ``profiles(profile_id, terms, pattern_count, template_count)``; two points per
    term with the target word, one per pattern, a tenth per template, ties to the
    smaller id. Targets meet only profiles that hold their word; all others are
    represented by the one with the best base score. Profiles of many terms give
    them as rows of ``terms(profile_id, term)``, each once, instead of an array.
    """
    made = profiles.withColumn("base", F.col("pattern_count") + 0.1 * F.col("template_count"))
    base = made.select("profile_id", "base")
    listed = made.select("profile_id", "base", F.explode("terms").alias("term")) if terms is None else terms.join(base, "profile_id")
    words = listed.select(
        "profile_id", "base", "term", F.explode(F.array_distinct(F.split(F.lower("term"), " "))).alias("target")
    )
    hits = words.groupBy("target", "profile_id").agg(
        (2 * F.count("*") + F.max("base")).alias("score"))
    best_score = base.agg(F.max("base")).scalar()
    best_id = base.agg(F.min_by("profile_id", F.struct(-F.col("base"), "profile_id"))).scalar()
    asked = requests.select(F.lower("target").alias("target")).distinct()
    matched = asked.join(hits, "target").select("target", "profile_id", "score")
    others = asked.select("target", best_id.alias("profile_id"), best_score.alias("score"))
    both = matched.unionByName(others)
    top = both.groupBy("target").agg(F.min_by(F.struct("profile_id", "score"), F.struct(-F.col("score"), "profile_id")).alias("t"))
    return top.select("target", "t.profile_id", "t.score", (F.col("t.score") < low_confidence).alias("low_confidence"))
