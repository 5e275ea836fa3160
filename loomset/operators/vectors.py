"""Similarity search and similarity joins.

Exact joins and searches run over cells around pivots (:mod:`loomset.operators.cells`); a table of few rows is
sent to the tasks that scan the other one. The banded join takes its candidates from signs of projections.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomset.functions.vectors import dot, normalise
from loomset.session import written_table

from . import cells as C
from .cells import BLOCK_ROWS, VectorIndex


def _block_of(id_: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(id_), blocks).cast("int")


def _blocks(df: DataFrame, block_rows: int) -> Column:
    """How many blocks the rows of a table make, as a scalar."""
    return df.agg(F.ceil(F.greatest(F.count("*"), F.lit(1)) / block_rows).cast("int")).scalar()


def distinct_vectors(df: DataFrame, id_: str, vec: str) -> tuple[DataFrame, DataFrame]:
    """Representatives (smallest id per distinct vector) and the links to their copies."""
    keyed = df.select(F.col(id_).alias("id"), F.col(vec).alias("vec"), F.sha2(F.col(vec).cast("string"), 256).alias("k"))
    first = keyed.groupBy("k").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    reps = keyed.join(first.select(F.col("rep").alias("id")), "id", "left_semi").select("id", "vec")
    links = keyed.select("k", "id").join(first.where("copies > 1"), "k").where("id <> rep").select("rep", "id")
    return reps, links


def all_pairs(rows: DataFrame, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs ``a < b`` with cosine >= threshold among all rows (id, vec), exactly; see :func:`cells.metric_join`."""
    return C.metric_join(rows, threshold, block_rows, block_rows)


def pairs_in_buckets(rows: DataFrame, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs ``a < b`` with cosine >= threshold among rows (bucket, id, vec) that share a bucket.

    A pair found in several buckets comes once.
    """
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    sizes = sizes.select("bucket", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
    return _pairs_in_blocks(rows.join(sizes, "bucket"), threshold)


def _pairs_in_blocks(rows: DataFrame, threshold: float) -> DataFrame:
    placed = rows.withColumn("own", _block_of(F.col("id"), F.col("blocks")))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.concat_ws("|", F.col("bucket").cast("string"), F.least("own", "other").cast("string"),
                    F.greatest("own", "other").cast("string")).alias("cell"),
        (F.col("own") <= F.col("other")).alias("low"), (F.col("own") >= F.col("other")).alias("high"),
        "id", "vec",
    )

    found = spread.repartition("cell").sortWithinPartitions("cell").mapInPandas(C.multiplied(threshold), "a long, b long, sim double")
    return found.groupBy("a", "b").agg(F.max("sim").alias("sim"))


def near_dup_pairs(df: DataFrame, id_: str, vec: str, threshold: float = 0.95, every_copy: bool = False) -> DataFrame:
    """All pairs of distinct vectors with cosine >= threshold, exactly.

    Equal vectors are linked to their first copy only, so a group of n copies adds
    n - 1 pairs and their components stay whole. With ``every_copy`` all pairs of rows
    of different ids are listed, n * (n - 1) / 2 for such a group, and every copy with
    each row that its vector is near to.
    """
    if every_copy:
        return _pairs_of_rows(df, id_, vec, threshold)
    reps, links = distinct_vectors(df, id_, vec)
    near = all_pairs(reps, threshold)
    copies = links.select(F.col("rep").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("sim"))
    return near.unionByName(copies)


def _pairs_of_rows(df: DataFrame, id_: str, vec: str, threshold: float) -> DataFrame:
    """Pairs of rows ``a < b`` by the pairs of their distinct vectors, which are numbered, as ids may repeat."""
    rows = df.select(F.col(id_).alias("row"), F.col(vec).alias("vec")).withColumn("k", F.sha2(F.col("vec").cast("string"), 256)).where("k IS NOT NULL")
    groups = rows.groupBy("k").agg(F.first("vec").alias("vec"), F.count("*").alias("copies"))
    groups = written_table(groups.withColumn("id", F.monotonically_increasing_id()), "distinct-vectors")
    members = rows.select("k", "row").join(groups.select("k", "id", "copies"), "k").select("id", "row", "copies")
    left, right = (members.select(F.col("id").alias(c), F.col("row").alias(f"{c}_row"), F.col("copies").alias(f"{c}_copies")) for c in "ab")
    near = all_pairs(groups.select("id", "vec"), threshold).join(left, "a").join(right, "b").where("a_row <> b_row").select("a_row", "b_row", "sim")
    twice, again = left.where("a_copies > 1"), right.where("b_copies > 1")
    same = twice.join(again, F.col("a") == F.col("b")).where("a_row < b_row").select("a_row", "b_row", F.lit(1.0).alias("sim"))
    return near.unionByName(same).select(F.least("a_row", "b_row").alias("a"), F.greatest("a_row", "b_row").alias("b"), "sim")


def hyperplane_bands(df: DataFrame, bands: int, bits: int, dim: int, seed: int = 42) -> DataFrame:
    """Rows (bucket, id, vec): the signs of ``bits`` random projections make one bucket per band."""

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes = np.random.default_rng(seed).standard_normal((dim, bands * bits))
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            if not len(batch):
                continue
            signs = (C.unit(C.matrix(batch["vec"])) @ planes >= 0).reshape(len(batch), bands, bits)
            keys = signs @ weights + (np.arange(bands, dtype=np.int64) << bits)
            yield batch.assign(keys=list(keys))

    signed = df.select("id", "vec").mapInPandas(project, "id long, vec array<float>, keys array<long>")
    return signed.select(F.explode("keys").alias("bucket"), "id", "vec")


def near_dup_pairs_banded(
    df: DataFrame, id_: str, vec: str, dim: int, threshold: float = 0.95, bands: int = 24, bits: int = 12
) -> DataFrame:
    """The scale arm: candidates share a band of projection signs and are verified exactly.

    Every reported pair is right; a pair near the threshold may be missed, less
    often with more bands.
    """
    reps, links = distinct_vectors(df, id_, vec)
    near = pairs_in_buckets(hyperplane_bands(reps, bands, bits, dim), threshold)
    copies = links.select(F.col("rep").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("sim"))
    return near.unionByName(copies)


def scores_in_cells(
    queries: DataFrame, corpus: DataFrame, k: int | None, exclude_self: bool = False, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Rows (query, id, sim): per block of the corpus the ``k`` best for each query, or all when ``k`` is None."""
    def blocked(df: DataFrame, side: str) -> tuple[DataFrame, Column]:
        many = _blocks(df, block_rows)
        return df.select("id", "vec", _block_of(F.col("id"), many).alias(side)), many

    q, q_blocks = blocked(queries, "qb")
    c, c_blocks = blocked(corpus, "cb")
    q = q.withColumn("cb", F.explode(F.sequence(F.lit(0), c_blocks - 1))).withColumn("is_query", F.lit(True))
    c = c.withColumn("qb", F.explode(F.sequence(F.lit(0), q_blocks - 1))).withColumn("is_query", F.lit(False))
    spread = q.unionByName(c).select(
        F.concat_ws("|", F.col("qb").cast("string"), F.col("cb").cast("string")).alias("cell"), "is_query", "id",
        F.col("vec").cast("array<double>").alias("vec"),
    )

    take = None if k is None else k + exclude_self
    return spread.repartition("cell").sortWithinPartitions("cell").mapInPandas(C.searched(take, exclude_self), "query long, id long, sim double")


def knn(queries: DataFrame, corpus: DataFrame, k: int, exclude_self: bool = False, most_beside: int = C.MOST_BESIDE) -> DataFrame:
    """Rows (query, id, sim, rank) with the ``k`` most similar corpus rows; equal scores by id.

    Both sides have columns (id, vec). Filter the corpus (metadata, deleted rows) before the call. A vector
    whose length is not that of the queries, or with a component that is no finite number, ends the job. If
    one side has at most ``most_beside`` rows, it is sent to the tasks that scan the other, which is not
    shuffled; otherwise the corpus is put in cells (:class:`cells.VectorIndex`), and both sides in blocks of near
    cells (:mod:`blocks`).
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    none = queries.sparkSession.createDataFrame([], "query long, id long, sim double, rank long")
    bank = C.few(corpus, most_beside)
    if bank is not None:
        return C.rank_beside(C.checked(queries, bank.units.shape[1], "query"), bank, k, exclude_self) if len(bank.ids) else none
    asked = C.few(queries, most_beside)
    if asked is not None:
        return C.top_k(C.search_beside(C.checked(corpus, asked.units.shape[1], "row"), asked, k, exclude_self), k) if len(asked.ids) else none
    known = C.checked(corpus, C.dimension(queries), "row")
    if queries is corpus:
        return VectorIndex.search_itself(known, k, exclude_self)
    return VectorIndex.build(known).search(queries, k, exclude_self, most_beside)


def full_ranking(queries: DataFrame, corpus: DataFrame, most_beside: int = C.MOST_BESIDE) -> DataFrame:
    """All corpus rows ranked for every query. For a corpus of classes, not of rows.

    A corpus of at most ``most_beside`` rows is ranked in the stage that scans the queries, without an exchange.
    """
    bank = C.few(corpus, most_beside)
    if bank is not None:
        return C.rank_beside(C.checked(queries, bank.units.shape[1], "query"), bank, None)
    found = scores_in_cells(queries, corpus, None)
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.col("sim").desc(), F.col("id").asc())).cast("long"))


def centroids(df: DataFrame, label: str, vec: str) -> DataFrame:
    """Mean vector per label as (id, vec); means are combined before the shuffle."""
    parts = df.select(F.col(label).cast("long").alias("id"), F.posexplode(vec).alias("pos", "x"))
    means = parts.groupBy("id", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "x")))
    return means.groupBy("id").agg(F.transform(ordered, lambda p: p["x"]).alias("vec"))


def best_match(found: DataFrame, by: list[str]) -> DataFrame:
    """Most similar pair per key of a (query, id, sim) table, as an aggregate."""
    top = F.max_by(F.struct("query", "id", "sim"), F.struct("sim", -F.col("query"), -F.col("id")))
    return found.groupBy(*by).agg(top.alias("top")).select(*by, "top.*")


def _mean_unit(df: DataFrame, name: str) -> DataFrame:
    """One row per dimension with the mean of the unit vectors."""
    parts = df.select(F.posexplode(normalise(F.col("vec"))).alias("pos", "x"))
    return parts.groupBy("pos").agg(F.avg("x").alias(name))


def mean_similarity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Mean cosine over all pairs without forming one: the dot product of the two mean unit vectors."""
    both = _mean_unit(left, "x").join(_mean_unit(right, "y"), "pos")
    return both.agg(F.sum(F.col("x") * F.col("y")).alias("mean_sim"))


def mean_similarity_to(rows: DataFrame, bank: DataFrame, out: str) -> DataFrame:
    """Rows (id, out): mean cosine of every row to all rows of a bank, again through the bank's mean, a single short array."""
    pairs = F.sort_array(F.collect_list(F.struct("pos", "y")))
    mean = _mean_unit(bank, "y").agg(F.transform(pairs, lambda p: p["y"]).alias("mean"))
    return rows.select("id", "vec").withColumn("mean", mean.scalar()).select("id", dot(normalise(F.col("vec")), F.col("mean")).alias(out))


def recall_and_mrr(gold_ranks: DataFrame, rank: str = "rank", ks=(1, 3, 5)) -> DataFrame:
    """Hit rate within the first k and mean reciprocal rank; a null rank means not found."""
    hits = [F.avg(F.when(F.col(rank) <= k, 1.0).otherwise(0.0)).alias(f"recall_at_{k}") for k in ks]
    return gold_ranks.agg(*hits, F.avg(F.coalesce(1.0 / F.col(rank), F.lit(0.0))).alias("mrr"))
