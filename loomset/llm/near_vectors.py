"""Near-duplicate vectors of equal label by spherical-cap filters.

A filter is a direction, the product of two random codewords, one for each half of the turned vector. A
vector belongs to every filter whose cap it reaches, that is whose inner product exceeds a threshold; the
list of those is decoded from the two halves, without going through all filters. Vectors meet in the
filters they share and are compared there in double precision. The number of filters grows with the
vectors, so a filter's share of them shrinks; the threshold lets a vector into about ``lists`` filters,
at which pairs at the threshold of similarity share one with a chance above 0.999.

Equal vectors are one from the start, counted with their number. A first codeword that gathers many
vectors is split into cells of bounded size, each pairing two slices of it.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without
a label or vec_id, link with nothing and are their own component; vectors of different lengths do not
link; repeated rows are copies; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, FloatType, IntegralType, StructField, StructType

from loomset.llm.links import classes
from loomset.llm.tables import bounded_batches, written_table

LISTS = 250
CELL_ROWS = 2048


class Filters:
    """Two codebooks of ``size`` words for vectors of ``dim`` numbers, and the threshold."""

    def __init__(self, dim: int, size: int, lists: int, seed: int = 0):
        make = np.random.default_rng([seed, dim])
        self.turn = np.linalg.qr(make.standard_normal((dim, dim)))[0]
        self.half = dim // 2
        self.books = []
        for width in (self.half, dim - self.half):
            book = make.standard_normal((size, width))
            self.books.append(book / np.maximum(np.linalg.norm(book, axis=1, keepdims=True), 1e-300))
        rare = NormalDist().inv_cdf(1 - min(lists / size**2, 0.5))
        self.least = np.sqrt(2) * min(rare / np.sqrt(dim), 0.42)

    def decode(self, unit: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """For each vector: the first words that have a second word, and those second words."""
        turned = unit @ self.turn
        left, right = turned[:, : self.half] @ self.books[0].T, turned[:, self.half :] @ self.books[1].T
        order = np.argsort(-right, axis=1)
        for row in range(len(unit)):
            falling = right[row, order[row]]
            count = np.searchsorted(-falling, left[row] - self.least, "right")
            first = np.flatnonzero(count)
            yield first, [order[row, : count[k]] for k in first]


_ROWS = "dim int, word int, id bigint, vector array<double>, second array<int>"


def _assign(size: int, lists: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, Filters] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                vectors = [np.array(v) for v in part.column("vector").to_pylist()]
                for dim in sorted({len(v) for v in vectors}):
                    rows = [i for i, v in enumerate(vectors) if len(v) == dim]
                    own = filters.get(dim) or filters.setdefault(dim, Filters(dim, size, lists))
                    unit = np.array([vectors[i] for i in rows])
                    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
                    word, take, second = [], [], []
                    for i, (first, lists_) in zip(rows, own.decode(unit)):
                        word += first.tolist()
                        take += [i] * len(first)
                        second += lists_
                    if take:
                        chosen = part.take(pa.array(take))
                        yield pa.RecordBatch.from_arrays(
                            [
                                chosen.column("label"), pa.array(np.full(len(take), dim, np.int32)), pa.array(word, pa.int32()),
                                chosen.column("id"), chosen.column("vector"), pa.array(second, pa.list_(pa.int32())),
                            ],
                            names=["label", "dim", "word", "id", "vector", "second"],
                        )

    return each


def _pairs_of_cell(threshold: float):
    def each(table: pa.Table) -> pa.Table:
        """Pairs of one cell that share a second word and are similar enough, each once."""
        table = table.combine_chunks()
        ids, side = table.column("id").to_numpy(), table.column("slice").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        vectors = table.column("vector").combine_chunks()
        vectors = vectors if isinstance(vectors, pa.ListArray) else vectors.chunk(0)
        unit = vectors.flatten().to_numpy().reshape(len(ids), -1)
        unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
        second = table.column("second").combine_chunks()
        second = second if isinstance(second, pa.ListArray) else second.chunk(0)
        word = second.flatten().to_numpy()
        owner = np.repeat(np.arange(len(ids)), np.diff(second.offsets.to_numpy()))
        order = np.argsort(word, kind="stable")
        cut = np.append(np.append(0, np.flatnonzero(np.diff(word[order])) + 1), len(word))
        found = [np.zeros((0, 2), np.int64)]
        if (np.diff(cut) ** 2).sum() > len(ids) ** 2:
            # vectors that share most filters: each pair once, and then whether it shares a second word
            has = np.zeros((len(ids), int(word.max()) // 8 * 8 + 8), bool)
            has[owner, word] = True
            has = np.packbits(has, axis=1)
            left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
            for at in range(0, len(left), 512):
                near = np.argwhere(unit[left[at : at + 512]] @ unit[right].T >= threshold - 1e-9)
                pair = np.stack([left[at + near[:, 0]], right[near[:, 1]]], axis=1)
                pair = pair[pair[:, 0] < pair[:, 1]] if i == j else pair
                pair = pair[(has[pair[:, 0]] & has[pair[:, 1]]).any(axis=1)]
                found.append(np.sort(pair, axis=1))
        else:
            for a, b in zip(cut[:-1], cut[1:]):
                if b - a < 2:
                    continue
                rows = owner[order[a:b]]
                left, right = rows[side[rows] == i], rows[side[rows] == j]
                near = np.argwhere(unit[left] @ unit[right].T >= threshold - 1e-9)
                pair = np.stack([left[near[:, 0]], right[near[:, 1]]], axis=1)
                found.append(np.sort(pair[pair[:, 0] != pair[:, 1]], axis=1))
        pair = np.concatenate(found)
        pair = pair[np.sort(np.unique(pair[:, 0] * len(ids) + pair[:, 1], return_index=True)[1])]
        # the exact check, pair by pair, so that it does not depend on how vectors are laid out
        cosine = np.einsum("ij,ij->i", unit[pair[:, 0]], unit[pair[:, 1]])
        pair = ids[pair[cosine >= threshold]]
        return pa.table({"a": pair.min(axis=1) if len(pair) else pa.array([], pa.int64()), "b": pair.max(axis=1) if len(pair) else pa.array([], pa.int64())})

    return each


def _label(vectors: DataFrame):
    """The label as whole number or text; whatever its type, different labels stay different and equal ones equal."""
    kind = vectors.schema["label"].dataType
    if isinstance(kind, IntegralType):
        return F.col("label").cast("bigint")
    if isinstance(kind, (FloatType, DoubleType)):
        return (F.col("label") + 0.0).cast("string")  # of the two zeros one
    return F.hex("label") if isinstance(kind, BinaryType) else F.col("label").cast("string")


def near_vector_classes(
    vectors: DataFrame, threshold: float = 0.93, lists: int = LISTS, cell_rows: int = CELL_ROWS, vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    Vectors of one label are linked if their cosine is ``threshold`` or more; n_links counts the other rows
    a row is linked with, component_id is the smallest vec_id reachable.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), _label(vectors).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    sound = F.expr(
        "vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0"
        " AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
        " AND exists(vector, x -> x <> 0)"
    )
    usable = rows.where(F.coalesce(sound, F.lit(False)))
    distinct = usable.groupBy("label", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    distinct = written_table(distinct, "vectors")
    n = distinct.count()
    size = 64
    while size * size < n:
        size *= 2
    placed = distinct.select("label", "id", "vector").mapInArrow(
        _assign(size, lists), StructType([StructField("label", distinct.schema["label"].dataType), *StructType.fromDDL(_ROWS).fields])
    )
    placed = written_table(placed, "filters")
    key = ["label", "dim", "word"]
    slices = placed.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(
        *key, F.ceil(F.col("n") / cell_rows).cast("int").alias("slices")
    )
    own = F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")
    cells = placed.join(slices, key).withColumn("slice", own).select(
        *key, "id", "vector", "second", "slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("other")
    ).withColumn("i", F.least("slice", "other")).withColumn("j", F.greatest("slice", "other"))
    pairs = cells.groupBy(*key, "i", "j").applyInArrow(_pairs_of_cell(threshold), "a bigint, b bigint")
    pairs = written_table(pairs.dropDuplicates(["a", "b"]), "pairs")
    component = classes(pairs)

    copies = distinct.select(F.col("id").alias("other"), "copies")
    ends = F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")), F.struct(F.col("b").alias("id"), F.col("a").alias("other")))
    links = pairs.select(F.inline(ends)).join(copies, "other").groupBy("id").agg(F.sum("copies").alias("linked"))
    facts = (
        distinct.join(links, "id", "left").join(component, "id", "left")
        .select("id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    # only copies have to look for the vector that stands for them
    several = distinct.where("copies > 1").select("label", "vector", F.col("id").alias("first"))
    placed_rows = rows.join(several, ["label", "vector"], "left").select("vec_id", F.coalesce("first", "vec_id").alias("id"))
    return placed_rows.join(facts, "id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
