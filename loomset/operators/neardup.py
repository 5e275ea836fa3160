"""Exact set-similarity join on texts by prefix filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.functions import text as T
from loomset.session import written_table

from .listed import may_pair
from .setblocks import overlap_pairs
from .setgroups import keys, met_in_cells, pairs_in_groups

#: thresholds below it are joined by blocks
LOW = 0.5
#: ids that are sent to every task, so that the rows they pick or drop are not shuffled; some 50 bytes each
MOST_IDS = 4 << 20


def shingles(text: Column, n: int = 3) -> Column:
    """Distinct 64-bit digests of the word n-grams; a shorter text is one shingle."""

    def grams(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))

    # words are digested once and not joined for every n-gram; a text without words has the digest of no word
    words = F.transform(T.tokens(text), lambda w: F.xxhash64(w))
    return F.array_distinct(T.let(words, lambda w: T.let(F.when(F.size(w) == 0, F.array(F.xxhash64(F.lit("")))).otherwise(w), grams)))


def word_set(text: Column) -> Column:
    return F.array_distinct(F.transform(T.words(F.lower(text)), lambda w: F.xxhash64(w)))


def sent(ids: DataFrame) -> DataFrame:
    """A written table of ids for a semi or anti join, beside the scan of the other side while it is not too large."""
    return F.broadcast(ids) if ids.count() <= MOST_IDS else ids


def distinct_texts(df: DataFrame, id_: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Representatives (smallest id per text) and the links to their exact copies.

    Texts are grouped by their digest. The ids of later copies are written and kept away from the texts by an
    anti join, beside the scan while there are at most MOST_IDS.
    """
    keyed = df.select(F.col(id_).alias("id"), F.sha2(text, 256).alias("k"))
    first = keyed.groupBy("k").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).where("copies > 1")
    links = written_table(keyed.join(first, "k").where("id <> rep").select("rep", "id"), "copies")
    reps = df.select(F.col(id_).alias("id"), F.col(text).alias("text")).join(sent(links.select("id")), "id", "left_anti")
    return reps, links


def jaccard_pairs(sets: DataFrame, threshold: float, hot: int = 512, other_than: str | None = None) -> DataFrame:
    """Rows (a, b, jaccard) with a < b for all pairs of sets (id, items) with Jaccard >= threshold.

    Items are ordered from rare to frequent. Two sets that similar must share an
    item among the first ``n - ceil(t * n) + 1`` of each, so only those are met; sizes and
    how often two sets meet rule out most pairs before they are verified. Items go to tasks by
    the first set that lists them, so that a pair meets in few tasks; one listed by more than
    ``hot`` sets is split over several. Before that, sets that share too little with all
    others together are left out (:mod:`listed`), and sets that agree in a smallest digest, as near copies do, are
    compared group by group (:mod:`setgroups`), so that only the other pairs are met by item. Sets with equal values in the column
    ``other_than`` are not paired. Below a threshold of ``LOW``, where prefixes hold most items, blocks of sets
    are multiplied instead (:mod:`setblocks`).
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    # sized in a generator: the filter then does not make the plan build the sets a second time
    sized = F.inline(F.transform(F.array("items"), lambda x: F.struct(x.alias("items"), F.size(x).alias("n"))))
    kind = F.col(other_than) if other_than else F.lit(None).cast("string")
    if threshold < LOW:
        return overlap_pairs(written_table(sets.select("id", kind.alias("kind"), sized).where("n > 0"), "sets"), threshold, other_than is not None)
    # most sets share too little with all others together; they are neither written nor dealt
    sets = sets.where("id IS NOT NULL").join(sent(written_table(may_pair(sets, threshold), "may-pair")), "id", "left_semi")
    sets = sets.select("id", kind.alias("kind"), sized).where("n > 0").withColumn("keys", keys(F.col("items")))
    sets = written_table(sets.withColumn("row", F.monotonically_increasing_id()), "sets")  # ids may repeat
    grouped = pairs_in_groups(sets, threshold, other_than is not None, sent)
    # dealt by item once: the items are counted and looked up where they lie. Both need the same columns and filters for it
    listed = sets.select("row", F.explode("items").alias("item")).where("row IS NOT NULL AND item IS NOT NULL").repartition("item")
    shared = listed.groupBy("item").agg(F.count("row").alias("df"), F.min("row").alias("lead")).where("df > 1")
    # items of one set only are never met, but come first in its order: their number is enough
    kept = listed.join(shared, "item").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("df", "item", "lead"))).alias("o"))
    ordered = kept.join(sets.select("row", "id", "kind", "n", "keys"), "row").withColumn("alone", F.col("n") - F.size("o"))
    # a hair below the exact bound, so that rounding never shortens a prefix
    prefix = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1
    reach = ordered.withColumn("plen", prefix).withColumn("met", F.col("plen") - F.col("alone")).where("met > 0")
    postings = reach.select(
        "row", "id", "kind", "n", "keys", (F.col("n") - F.col("plen")).alias("tail"), F.element_at("o", F.col("met")).alias("last"),
        F.explode(F.slice("o", F.lit(1), F.col("met"))).alias("s")
    ).select("row", "id", "kind", "n", "keys", "tail", F.col("last.df").alias("last_df"), F.col("last.item").alias("last_item"), "s.df", "s.item", "s.lead")
    candidates = met_in_cells(postings, threshold, hot, other_than is not None).groupBy("p", "q").agg(
        F.sum("met").alias("met"), F.max("least").alias("least")).where("met >= least").select("p", "q")
    first = sets.select(F.col("row").alias("p"), F.col("id").alias("a"), F.col("items").alias("x"))
    second = sets.select(F.col("row").alias("q"), F.col("id").alias("b"), F.col("items").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    verified = candidates.join(first, "p").join(second, "q").select(
        "a", "b", (shared / (F.size("x") + F.size("y") - shared)).alias("jaccard")
    )
    return grouped.unionByName(verified.where(F.col("jaccard") >= threshold))


def near_dup_text_pairs(df: DataFrame, id_: str, text: str, threshold: float = 0.7, n: int = 3) -> DataFrame:
    """Pairs of texts whose word n-gram sets have Jaccard >= threshold.

    Equal texts are linked to their first copy, so n copies add n - 1 pairs.
    """
    reps, links = distinct_texts(df, id_, text)
    near = jaccard_pairs(reps.select("id", shingles(F.col("text"), n).alias("items")), threshold)
    copies = links.select(F.col("rep").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("jaccard"))
    return near.unionByName(copies)
