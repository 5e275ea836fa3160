"""Exact vector joins and searches over cells around pivots, pruned by angles.

A few rows, chosen by the digest of their ids, are pivots; every row lives in the cell of the pivot nearest to
it. Two facts decide what has to meet, and neither can miss anything:

* a row farther than an angle from the plane halfway between two pivots has nobody on the other side within
  that angle (joins);
* nothing in a cell is nearer to a query than the query's angle to the pivot less the cell's radius (searches).

Cells that hold many rows are cut into blocks of bounded size. Only results leave a block, never its scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.functions.vectors import is_usable
from loomset.session import scratch_path

from . import blocks as B
from .ranking import digest, top_n_per_group

BLOCK_ROWS = 2048
#: pivots at most, and rows for each pivot; bounds what the driver and every task hold of them
MOST_PIVOTS, CELL_ROWS = 4096, 2048
#: rows of a table that is sent to every task instead of being shuffled, and bytes of its vectors
MOST_BESIDE, MOST_BESIDE_BYTES = 4096, 64 << 20
#: rows that a join by cells may shuffle for each row of the table
MOST_SENT = 6
#: slack for rounding, in cosine or radians
_EPS = 1e-9
_ROWS_AT_ONCE = 1024


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64)


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; a row without length stays as it is."""
    m = np.asarray(m, dtype=np.float64)
    lengths = np.linalg.norm(m, axis=1, keepdims=True) if len(m) else np.ones((0, 1))
    return np.divide(m, lengths, out=np.zeros_like(m), where=lengths > 0)


def checked(df: DataFrame, dim: int, what: str) -> DataFrame:
    """(id, vec); a vector of another length or with a component that is no finite number ends the job."""
    vec = F.col("vec").cast("array<double>")
    told = F.raise_error(F.concat(F.lit(f"{what} "), F.col("id").cast("string"), F.lit(f" is no vector of {dim} finite numbers")))
    return df.select("id", F.when(is_usable(vec, dim), vec).otherwise(told.cast("array<double>")).alias("vec"))


def dimension(df: DataFrame) -> int | None:
    """The length of a table's vectors, from one of them."""
    row = df.where("vec IS NOT NULL").select(F.size("vec")).first()
    return row[0] if row else None


class Few(NamedTuple):
    """A small table on the driver: ids ascending, and their unit vectors."""

    ids: np.ndarray
    units: np.ndarray


def few(df: DataFrame, most: int = MOST_BESIDE) -> Few | None:
    """The rows (id, vec) of a table of at most ``most`` rows and MOST_BESIDE_BYTES; None if it has more.

    Vectors of different lengths, or with a component that is no finite number, raise a ValueError.
    """
    rows = df.select("id", "vec").limit(most + 1).collect()
    if len(rows) > most or 8 * sum(len(r["vec"] or ()) for r in rows) > MOST_BESIDE_BYTES:
        return None
    rows.sort(key=lambda r: r["id"])
    dim = len(rows[0]["vec"] or ()) if rows else 0
    if any(r["vec"] is None or len(r["vec"]) != dim or None in r["vec"] for r in rows):
        raise ValueError(f"not all of the {len(rows)} vectors have {dim} numbers")
    vectors = np.array([r["vec"] for r in rows], np.float64).reshape(len(rows), dim)
    if not np.isfinite(vectors).all():
        raise ValueError("a vector holds a component that is no finite number")
    return Few(np.array([r["id"] for r in rows], np.int64), unit(vectors))


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` largest of every row, of equal ones the first, in that order."""
    if k < scores.shape[1]:
        # all that reach the k-th largest, so that ties are decided by the order of the columns
        bound = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
        out = np.empty((len(scores), k), np.int64)
        for row, (line, least) in enumerate(zip(scores, bound[:, 0])):
            at = np.flatnonzero(line >= least)
            out[row] = at[np.argsort(-line[at], kind="stable")][:k]
        return out
    return np.argsort(-scores, axis=1, kind="stable")


def rank_beside(rows: DataFrame, bank: Few, k: int | None, exclude_self: bool = False) -> DataFrame:
    """(query, id, sim, rank): for each row the ``k`` best of the bank, or all, in the stage that scans the rows."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _ROWS_AT_ONCE):
                part = batch.iloc[at : at + _ROWS_AT_ONCE]
                names = part["id"].to_numpy()
                scores = unit(matrix(part["vec"])) @ bank.units.T
                take = len(bank.ids) if k is None else min(k + exclude_self, len(bank.ids))
                if exclude_self:
                    scores[names[:, None] == bank.ids[None, :]] = -np.inf
                best = _best(scores, take)
                picked = np.take_along_axis(scores, best, axis=1)
                rank = np.broadcast_to(np.arange(1, take + 1), picked.shape)
                keep = np.isfinite(picked) & (True if k is None else rank <= k)
                yield pd.DataFrame({
                    "query": np.broadcast_to(names[:, None], picked.shape)[keep], "id": bank.ids[best][keep], "sim": picked[keep], "rank": rank[keep],
                })

    return rows.mapInPandas(score, "query long, id long, sim double, rank long")


def search_beside(corpus: DataFrame, asked: Few, k: int, exclude_self: bool = False) -> DataFrame:
    """(query, id, sim): for every task of the corpus scan the ``k`` best of its rows for each of the few queries."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = np.zeros((len(asked.ids), 0), np.int64)
        sims = np.zeros((len(asked.ids), 0))
        for batch in batches:
            for at in range(0, len(batch), _ROWS_AT_ONCE):
                part = batch.iloc[at : at + _ROWS_AT_ONCE]
                names = part["id"].to_numpy()
                scores = asked.units @ unit(matrix(part["vec"])).T
                if exclude_self:
                    scores[asked.ids[:, None] == names[None, :]] = -np.inf
                ids = np.concatenate([ids, np.broadcast_to(names, scores.shape)], axis=1)
                sims = np.concatenate([sims, scores], axis=1)
                # similarity first, then the id
                order = np.lexsort((ids, -sims), axis=1)[:, :k]
                ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
        keep = np.isfinite(sims)
        yield pd.DataFrame({"query": np.broadcast_to(asked.ids[:, None], ids.shape)[keep], "id": ids[keep], "sim": sims[keep]})

    return corpus.mapInPandas(scan, "query long, id long, sim double")


def top_k(found: DataFrame, k: int) -> DataFrame:
    return top_n_per_group(found, ["query"], [F.col("sim").desc(), F.col("id").asc()], k)


# ---- cells


def pivots(rows: DataFrame, cell_rows: int = CELL_ROWS, most: int = MOST_PIVOTS) -> np.ndarray:
    """Unit vectors of one row in ``cell_rows``, at most ``most``.

    They come from eight times as many rows, the first by the digest of the id. Half are the first of these, so
    dense regions have many; the others are, one by one, the row farthest from all pivots so far, so that every
    group of rows has one.
    """
    n = rows.count()
    want = max(1, min(most, -(-n // cell_rows)))
    drawn = rows.withColumn("h", digest(F.col("id"), "pivot")).orderBy("h", "id").limit(8 * want if want > 1 else 1).collect()
    if not drawn:
        return np.zeros((0, 0))
    known = unit(np.array([r["vec"] for r in drawn], np.float64))
    chosen = list(range((want + 1) // 2))
    nearest = (known @ known[chosen].T).max(axis=1)
    while len(chosen) < want:
        far = int(nearest.argmin())
        chosen.append(far)
        np.maximum(nearest, known @ known[far], out=nearest)
    return known[chosen]


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _blocks_of(n: Column, block_rows: int) -> Column:
    return F.greatest(F.ceil(n / block_rows), F.lit(1)).cast("int")


def whole_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Regroup the batches of a partition sorted by cell into one frame per cell."""
    kept: list[pd.DataFrame] = []
    current = None
    for batch in batches:
        cells = batch["cell"].to_numpy()
        if not len(cells):
            continue
        cuts = np.flatnonzero(cells[1:] != cells[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(cells)]
        for start, stop in zip(bounds[:-1], bounds[1:]):
            if kept and cells[start] != current:
                yield pd.concat(kept, ignore_index=True) if len(kept) > 1 else kept[0]
                kept = []
            current = cells[start]
            kept.append(batch.iloc[start:stop])
    if kept:
        yield pd.concat(kept, ignore_index=True) if len(kept) > 1 else kept[0]


def in_cells(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """(id, vec, cell, angle): every row with the pivot nearest to it."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _ROWS_AT_ONCE):
                part = batch.iloc[at : at + _ROWS_AT_ONCE]
                near = unit(matrix(part["vec"])) @ centres.T
                home = near.argmax(axis=1)
                yield part.assign(cell=home, angle=_angles(near[np.arange(len(part)), home]))

    return rows.select("id", "vec").mapInPandas(place, "id long, vec array<double>, cell long, angle double")


def blocks_of_cells(rows: DataFrame, centres: np.ndarray, block_rows: int = B.BLOCK_ROWS) -> DataFrame:
    """The rows (id, vec) in blocks (:func:`blocks.packed`) of near cells, enough files for all tasks."""
    cut = F.pmod(F.xxhash64("id"), F.lit(64))
    parts = max(2 * rows.sparkSession.sparkContext.defaultParallelism, len(centres) * CELL_ROWS // (16 * B.BLOCK_ROWS))
    dealt = in_cells(rows, centres).repartitionByRange(parts, "cell", cut).sortWithinPartitions("cell")
    return B.packed(dealt, block_rows)


def _visited(units: np.ndarray, centres: np.ndarray, apart: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home): the home of each row, and the cells before it that may hold a partner."""
    near = units @ centres.T
    home, each = near.argmax(axis=1), np.arange(len(units))
    visits = (near[each, home][:, None] - near <= reach * apart[home] + _EPS) if np.isfinite(reach) else np.ones(near.shape, bool)
    visits &= np.arange(len(centres)) < home[:, None]
    visits[each, home] = True
    row, cell = np.nonzero(visits)
    return row, cell, cell == home[row]


def _reach(centres: np.ndarray, threshold: float) -> tuple[np.ndarray, float]:
    apart = np.sqrt(np.maximum(2 - 2 * (centres @ centres.T), 0))
    return apart, np.sqrt(max(0.0, 1 - threshold * threshold)) if threshold > 0 else np.inf


def joined_cells(rows: DataFrame, centres: np.ndarray, threshold: float) -> DataFrame:
    """(cell, home, id, vec): every row in its own cell, and in each cell before it that may hold a partner.

    The partner of a pair that lives in the earlier cell waits there for the other one.
    """
    apart, reach = _reach(centres, threshold)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _ROWS_AT_ONCE):
                part = batch.iloc[at : at + _ROWS_AT_ONCE].reset_index(drop=True)
                if not len(part):
                    continue
                row, cell, home = _visited(unit(matrix(part["vec"])), centres, apart, reach)
                yield pd.DataFrame({"cell": cell, "home": home, "id": part["id"].to_numpy()[row], "vec": [part["vec"].iat[i] for i in row]})

    return rows.select("id", "vec").mapInPandas(place, "cell long, home boolean, id long, vec array<double>")


def rows_sent(rows: DataFrame, centres: np.ndarray, threshold: float, block_rows: int) -> float:
    """How many rows :func:`pairs_in_cells` would shuffle for each row of the table."""
    apart, reach = _reach(centres, threshold)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, guests = np.zeros(len(centres), np.int64), np.zeros(len(centres), np.int64)
        for batch in batches:
            for at in range(0, len(batch), _ROWS_AT_ONCE):
                part = batch.iloc[at : at + _ROWS_AT_ONCE]
                if len(part):
                    _, cell, home = _visited(unit(matrix(part["vec"])), centres, apart, reach)
                    own += np.bincount(cell[home], minlength=len(centres))
                    guests += np.bincount(cell[~home], minlength=len(centres))
        yield pd.DataFrame({"cell": np.arange(len(centres)), "own": own, "guests": guests})

    counted = rows.select("id", "vec").mapInPandas(count, "cell long, own long, guests long").groupBy("cell").agg(F.sum("own"), F.sum("guests")).collect()
    own, guests = (np.array([r[n] for r in counted], np.int64) for n in (1, 2))
    own_blocks, guest_blocks = np.maximum(-(-own // block_rows), 1), -(-guests // block_rows)
    return float((own * (own_blocks + guest_blocks) + guests * own_blocks).sum() / max(own.sum(), 1))


def pairs_in_cells(placed: DataFrame, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs ``a < b`` with cosine >= threshold of two rows of a cell, one of which lives there; each once."""
    sizes = placed.groupBy("cell").agg(F.count_if("home").alias("own"), F.count_if(~F.col("home")).alias("guests"))
    sizes = sizes.select("cell", _blocks_of(F.col("own"), block_rows).alias("own"), F.ceil(F.col("guests") / block_rows).cast("int").alias("guests"))
    known = placed.join(F.broadcast(sizes), "cell")  # one row for each of at most MOST_PIVOTS cells
    block = F.pmod(F.xxhash64("id"), F.when(F.col("home"), F.col("own")).otherwise(F.col("guests"))).cast("int")
    known = known.withColumn("block", block)
    name = lambda *parts: F.concat_ws("|", *[p.cast("string") for p in parts])
    meets = F.when(
        F.col("home"),
        F.concat(
            F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda other: F.struct(
                name(F.col("cell"), F.least("block", other), F.greatest("block", other)).alias("cell"),
                (F.col("block") <= other).alias("low"), (F.col("block") >= other).alias("high"))),
            F.transform(F.filter(F.sequence(F.lit(-1), F.col("guests") - 1), lambda g: g >= 0), lambda guest: F.struct(
                F.concat(name(F.col("cell"), F.col("block"), guest), F.lit("|guests")).alias("cell"), F.lit(True).alias("low"), F.lit(False).alias("high"))),
        ),
    ).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda own: F.struct(
            F.concat(name(F.col("cell"), own, F.col("block")), F.lit("|guests")).alias("cell"), F.lit(False).alias("low"), F.lit(True).alias("high")))
    )
    spread = known.select(F.explode(meets).alias("m"), "id", "vec").select("m.cell", "m.low", "m.high", "id", "vec")
    return spread.repartition("cell").sortWithinPartitions("cell").mapInPandas(multiplied(threshold), "a long, b long, sim double")


def multiplied(threshold: float):
    """The pairs of every cell of a partition sorted by cell (cell, low, high, id, vec)."""

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in whole_cells(batches):
            low, high = cell[cell["low"]], cell[cell["high"]]
            if not len(low) or not len(high):
                continue
            scores = unit(matrix(low["vec"])) @ unit(matrix(high["vec"])).T
            i, j = np.nonzero(scores >= threshold)
            left, right = low["id"].to_numpy()[i], high["id"].to_numpy()[j]
            keep = left < right if low.index.equals(high.index) else left != right
            yield pd.DataFrame({"a": np.minimum(left, right)[keep], "b": np.maximum(left, right)[keep], "sim": scores[i, j][keep]})

    return multiply


def metric_join(rows: DataFrame, threshold: float, block_rows: int = BLOCK_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Pairs ``a < b`` with cosine >= threshold among all rows (id, vec), exactly and each once.

    A row visits only cells within the threshold's angle of its own cell's border, so rows that lie in groups
    meet their own group and its neighbours. Where all rows are far from the pivots (random directions, a low
    threshold) little can be ruled out and the work is that of all pairs: then the rows are written as blocks
    whose pairs the tasks read (:func:`blocks.pairs`), instead of being sent to many cells.
    """
    centres = pivots(rows, cell_rows)
    if not len(centres):
        return rows.sparkSession.createDataFrame([], "a long, b long, sim double")
    if rows_sent(rows, centres, threshold, block_rows) > MOST_SENT:
        return B.pairs(blocks_of_cells(rows, centres, min(2 * block_rows, B.BLOCK_ROWS)), threshold)
    return pairs_in_cells(joined_cells(rows, centres, threshold), threshold, block_rows)


class VectorIndex(NamedTuple):
    """A corpus in cells: files by cell, and for every cell its pivot, its radius and its number of rows."""

    path: str
    centres: np.ndarray
    radius: np.ndarray
    size: np.ndarray

    @classmethod
    def build(cls, corpus: DataFrame, path: str | None = None, cell_rows: int = CELL_ROWS) -> VectorIndex:
        """Write (id, vec) below ``path``, one folder for each cell; a large cell is several files."""
        spark = corpus.sparkSession
        path = path or scratch_path(spark, "vector-index")
        centres = pivots(corpus, cell_rows)

        cut = F.pmod(F.xxhash64("id"), F.lit(64))
        in_cells(corpus, centres).repartitionByRange("cell", cut).write.partitionBy("cell").parquet(path)
        facts = spark.read.parquet(path).groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n")).collect() if len(centres) else []
        radius, size = np.full(len(centres), -np.inf), np.zeros(len(centres), np.int64)
        for row in facts:
            radius[row["cell"]], size[row["cell"]] = row["radius"], row["n"]
        return cls(path, centres, radius, size)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("id long, vec array<double>, angle double, cell long").parquet(self.path).select("cell", "id", "vec")

    def bounds(self, units: np.ndarray) -> np.ndarray:
        """The least angle at which each cell can hold a row, for every query; infinite for an empty cell."""
        return np.where(self.size > 0, np.maximum(_angles(units @ self.centres.T) - self.radius, 0), np.inf)

    def first_visits(self, bounds: np.ndarray, k: int) -> np.ndarray:
        """The cells of lowest bound that hold ``k`` rows between them, for every query."""
        order = np.argsort(bounds, axis=1, kind="stable")
        held = np.cumsum(self.size[order], axis=1)
        wanted = np.zeros(bounds.shape, bool)
        np.put_along_axis(wanted, order, np.column_stack([np.zeros(len(bounds), held.dtype), held[:, :-1]]) < k, axis=1)
        return wanted & np.isfinite(bounds)

    def _few(self, spark: SparkSession, asked: Few, k: int, exclude_self: bool) -> DataFrame:
        bounds = self.bounds(asked.units)
        first = self.first_visits(bounds, k + exclude_self).any(axis=0)
        cells = self.rows(spark)
        read = lambda which: cells.where(F.col("cell").isin(np.flatnonzero(which).tolist())).select("id", "vec")
        found = top_k(search_beside(read(first), asked, k, exclude_self), k).collect()
        least = np.full(len(asked.ids), -1.0)
        place = {int(i): n for n, i in enumerate(asked.ids)}
        for row in found:
            if row["rank"] == k:
                least[place[row["query"]]] = row["sim"]
        more = (bounds <= _angles(least)[:, None] + _EPS).any(axis=0) & ~first & (self.size > 0)
        start = spark.createDataFrame([tuple(r)[:3] for r in found], "query long, id long, sim double")
        if not more.any():
            return top_k(start, k)
        return top_k(start.unionByName(search_beside(read(more), asked, k, exclude_self)), k)

    def search(self, queries: DataFrame, k: int, exclude_self: bool = False, most_beside: int = MOST_BESIDE) -> DataFrame:
        """(query, id, sim, rank) of the ``k`` most similar rows of the index; exact, equal scores by id.

        Few queries first visit the cells nearest to them that hold k rows, then only those whose bound the k-th
        similarity does not beat, and read the files of these cells alone. Many are put in blocks that go through
        the blocks of the index, past those that they can rule out; no vector is shuffled for it.
        """
        if k < 1:
            raise ValueError("k must be at least 1")
        spark = queries.sparkSession
        none = "query long, id long, sim double, rank long"
        if not self.size.sum():
            return spark.createDataFrame([], none)
        dim = self.centres.shape[1]
        asked = few(queries, most_beside)
        if asked is not None and len(asked.ids):
            if asked.units.shape[1] != dim:
                raise ValueError(f"queries of {asked.units.shape[1]} numbers for vectors of {dim}")
            return self._few(spark, asked, k, exclude_self)
        if asked is not None:
            return spark.createDataFrame([], none)
        asked = blocks_of_cells(checked(queries, dim, "query"), self.centres)
        return top_k(B.nearest(asked, B.packed(self.rows(spark)), k, exclude_self), k)

    @staticmethod
    def search_itself(corpus: DataFrame, k: int, exclude_self: bool = False) -> DataFrame:
        """As :meth:`search` for the rows (id, vec) of a table among themselves."""
        centres = pivots(corpus)
        if not len(centres):
            return corpus.sparkSession.createDataFrame([], "query long, id long, sim double, rank long")
        known = blocks_of_cells(corpus, centres)
        return top_k(B.nearest(known, known, k, exclude_self), k)


def searched(k: int | None, exclude_self: bool):
    """The ``k`` best per query and cell, or all, of a partition sorted by cell (cell, is_query, id, vec)."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in whole_cells(batches):
            asked, known = cell[cell["is_query"]], cell[~cell["is_query"]]
            if not len(asked) or not len(known):
                continue
            known = known.sort_values("id")
            ids, names = known["id"].to_numpy(), asked["id"].to_numpy()
            scores = unit(matrix(asked["vec"])) @ unit(matrix(known["vec"])).T
            if exclude_self:
                scores[names[:, None] == ids[None, :]] = -np.inf
            take = len(ids) if k is None else min(k, len(ids))
            best = _best(scores, take)
            picked = np.take_along_axis(scores, best, axis=1)
            keep = np.isfinite(picked)
            yield pd.DataFrame({"query": np.repeat(names, take).reshape(picked.shape)[keep], "id": ids[best][keep], "sim": picked[keep]})

    return search

