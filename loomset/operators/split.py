"""Train, val and test assignment without leaks, in a seeded order that any cluster reproduces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import digest, digest_bucket, prefix_sum, seeded_rank, top_n_per_group
from .stats import group_majority

SPLITS = ("train", "val", "test")


def group_key(template: Column, industry: Column, client: Column) -> Column:
    tail = F.substring(F.sha1(F.concat_ws("|", industry, client)), 1, 8)
    return F.coalesce(F.concat(F.lit("template_"), template), F.concat(F.lit("industry_client_"), tail))


def group_stratified_split(
    df: DataFrame, group: str, stratum: str, train: float = 0.7, val: float = 0.15, seed: int = 42
) -> DataFrame:
    """Rows (group, stratum, size, split): whole groups go to one split.

    Inside a stratum groups are taken in seeded order: to train until its rows
    reach the share, then to val, then to test. Once train is full it stays full,
    so each split is a stretch of the running row count and no loop is needed.
    """
    groups = group_majority(df, group, stratum)
    sized = groups.withColumn("__h", digest(F.col(group), seed))
    running = prefix_sum(sized, F.col("size"), ["__h", group], digest_bucket(F.col("__h"), 2), [stratum], "__before")
    totals = groups.groupBy(stratum).agg(F.sum("size").cast("double").alias("__total"))
    placed = running.join(totals, stratum)
    in_train = F.col("__before") < F.floor(F.col("__total") * train)
    taken = placed.where(in_train).groupBy(stratum).agg(F.sum("size").alias("__train"))
    placed = placed.join(taken, stratum, "left")
    in_val = F.col("__before") - F.coalesce("__train", F.lit(0)) < F.floor(F.col("__total") * val)
    split = F.when(in_train, "train").when(in_val, "val").otherwise("test")
    return placed.select(group, stratum, "size", split.alias("split"))


def ranked_in(df: DataFrame, id_: str, stratum: str, seed: int = 42) -> DataFrame:
    """Adds ``place`` (0-based seeded rank inside the stratum) and ``n`` (rows of the stratum)."""
    ranked = seeded_rank(df, id_, seed, [stratum], "place").withColumn("place", F.col("place") - 1)
    return ranked.join(df.groupBy(stratum).agg(F.count("*").alias("n")), stratum)


def profile_stratified_split(df: DataFrame, id_: str, stratum: str, train: float = 0.7, val: float = 0.15, seed: int = 42) -> DataFrame:
    """Of every stratum the first int(train * n) rows to train, the next int(val * n) to val, the rest to test."""
    ranked = ranked_in(df, id_, stratum, seed)
    n = F.col("n").cast("double")
    a, b = F.floor(n * train), F.floor(n * val)
    split = F.when(F.col("place") < a, "train").when(F.col("place") < a + b, "val").otherwise("test")
    return ranked.withColumn("split", split).drop("place", "n")


def small_group_split(df: DataFrame, id_: str, stratum: str, train: float = 0.7, val: float = 0.15, seed: int = 42) -> DataFrame:
    """As above, but one row goes to train, of two one each to train and val, and from three on every split gets a row."""
    ranked = ranked_in(df, id_, stratum, seed)
    n = F.col("n").cast("double")
    a = F.greatest(F.lit(1), F.floor(n * train))
    b = F.greatest(F.lit(1), F.floor(n * val))
    room = F.col("n") - 1
    a = F.least(a, room - 1)
    b = F.least(b, room - a)
    split = (
        F.when(F.col("n") == 1, "train")
        .when(F.col("n") == 2, F.when(F.col("place") == 0, "train").otherwise("val"))
        .when(F.col("place") < a, "train").when(F.col("place") < a + b, "val").otherwise("test")
    )
    return ranked.withColumn("split", split).drop("place", "n")


def train_test_split(df: DataFrame, id_: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    """The first int(n * (1 - test)) rows in seeded order are train."""
    total = df.agg(F.count("*").cast("double")).scalar()
    cut = F.floor(total * (1 - test))
    return seeded_rank(df, id_, seed, name="__r").withColumn(
        "split", F.when(F.col("__r") <= cut, "train").otherwise("test")).drop("__r")


def review_sample(df: DataFrame, id_: str, cls: str, edge: Column, is_ood: Column, size: int = 100, extra: int = 10, seed: int = 42) -> DataFrame:
    """size // classes rows per class, and up to ``extra`` edge and out-of-distribution rows; a row may come twice."""
    hashed = df.withColumn("__h", digest(F.col(id_), seed))
    classes = df.agg(F.countDistinct(cls)).scalar()
    per = F.floor(F.lit(size) / classes)
    by_class = top_n_per_group(hashed, [cls], [F.col("__h"), F.col(id_)], size, "__r").where(F.col("__r") <= per)
    parts = [by_class.select(id_, cls, F.lit("class").alias("why"))]
    for why, condition in (("edge", edge), ("ood", is_ood)):
        parts.append(hashed.where(condition).orderBy("__h", id_).limit(extra).select(id_, cls, F.lit(why).alias("why")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def group_unique_batches(df: DataFrame, id_: str, group: str | Column, size: int, seed: int = 42) -> DataFrame:
    """One row per group in batches of ``size``, so no batch holds a group twice. ``group`` may be any Column."""
    key = F.col(group) if isinstance(group, str) else group
    hashed = df.select(F.col(id_).alias("id"), key.cast("string").alias("group_key"))
    one = hashed.groupBy("group_key").agg(F.min_by("id", F.struct(digest(F.col("id"), seed), F.col("id"))).alias("id"))
    ranked = seeded_rank(one, "group_key", seed)
    return ranked.select("id", "group_key", F.floor((F.col("rank") - 1) / size).alias("batch"))


def split_leaks(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    """Groups that occur in more than one split; empty when the split is sound."""
    seen = [F.max(F.when(F.col(split) == s, 1).otherwise(0)) for s in SPLITS]
    return df.groupBy(group).agg((seen[0] + seen[1] + seen[2]).alias("splits")).where("splits > 1")


def require_no_leaks(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    if not split_leaks(df, group, split).isEmpty():
        raise ValueError(f"some {group} is in more than one split")
    return df


def weighted_bucket(unit: Column, weights: Sequence[tuple[str, float]]) -> Column:
    """Pick a name by where a number from [0, 1) falls on the running sum of the weights."""
    out, bound = None, 0.0
    for name, weight in weights[:-1]:
        bound += weight
        case = (unit <= round(bound, 12), name)
        out = F.when(*case) if out is None else out.when(*case)
    return F.lit(weights[-1][0]) if out is None else out.otherwise(weights[-1][0])


def unit_of(id_: Column, seed: int | str = 42) -> Column:
    """A number in [0, 1) from the digest of an id."""
    return F.conv(F.substring(digest(id_, seed), 1, 8), 16, 10).cast("double") / float(1 << 32)
