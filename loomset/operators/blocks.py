"""All pairs of blocks of vectors, without a shuffle of vectors.

A block is one row of a table that is written once: some ids and their vectors, the mean direction and the
largest angle to it. Tasks read the cross product of two such tables from the files, one stretch of the left
side after all of the right side, so vectors are written once and only results move on. A block is met only
by rows that its direction and angle cannot rule out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.session import written_table

BLOCK_ROWS = 4096
#: rows of a block whose scores are held at once
_ROWS_AT_ONCE = 1024
#: slack for rounding, in radians
_EPS = 1e-6
_PACKED = "block long, ids binary, single boolean, vecs binary, centre binary, radius double"


def _units(m: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, lengths, out=np.zeros_like(m), where=lengths > 0)


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _pack(block_rows: int):
    def row(block: int, ids: np.ndarray, vecs: np.ndarray) -> dict:
        units, narrow = _units(vecs), vecs.astype(np.float32)
        single = bool((narrow == vecs).all())  # floats of a table of floats take half the room and lose nothing
        centre = _units(units.mean(axis=0)[None, :])[0]
        return {
            "block": [block], "ids": [ids.astype(np.int64).tobytes()], "single": [single], "vecs": [(narrow if single else vecs).tobytes()],
            "centre": [centre.tobytes()], "radius": [float(_angles(units @ centre).max())],
        }

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = TaskContext.get().partitionId() << 32
        ids, vecs, cells = np.zeros(0, np.int64), None, np.zeros(0, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            fresh = np.array(batch["vec"].tolist(), dtype=np.float64)
            ids, cells = np.append(ids, batch["id"].to_numpy()), np.append(cells, batch["cell"].to_numpy())
            vecs = fresh if vecs is None else np.concatenate([vecs, fresh])
            while len(ids) >= block_rows:
                # a block ends with a cell, if that leaves it at least half full
                ends = np.flatnonzero(cells[:block_rows] != np.append(cells, -1)[1 : block_rows + 1]) + 1
                cut = int(ends[-1]) if len(ends) and ends[-1] >= block_rows // 2 else block_rows
                yield pd.DataFrame(row(name, ids[:cut], vecs[:cut]))
                name, ids, vecs, cells = name + 1, ids[cut:], vecs[cut:], cells[cut:]
        if len(ids):
            yield pd.DataFrame(row(name, ids, vecs))

    return pack


def packed(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The blocks of rows (id, vec, cell), written; rows that follow each other should be of one cell."""
    return written_table(rows.select("id", "vec", "cell").mapInPandas(_pack(block_rows), _PACKED), "blocks")


class _Block:
    """Row ``at`` of a batch of pairs of blocks, its left or right side."""

    def __init__(self, batch: pa.RecordBatch, at: int, side: str):
        field = lambda name: batch.column(f"{side}_{name}")[at]
        self.name = field("block").as_py()
        self.ids = np.frombuffer(field("ids").as_buffer(), np.int64).copy()
        vecs = np.frombuffer(field("vecs").as_buffer(), np.float32 if field("single").as_py() else np.float64)
        self.units = _units(vecs.reshape(len(self.ids), -1).astype(np.float64))
        self.narrow = self.units.astype(np.float32)
        self.centre, self.radius = np.frombuffer(field("centre").as_buffer(), np.float64).copy(), field("radius").as_py()
        # more than single precision can lose of a product of unit vectors
        self.loss = (self.units.shape[1] + 4) * 2.0**-23

    def least_angles(self, other: _Block) -> np.ndarray:
        """How near each row can come to any row of the other block."""
        return np.maximum(_angles(self.units @ other.centre) - other.radius, 0) - _EPS


def crossed(left: DataFrame, right: DataFrame, where: Column | None = None) -> DataFrame:
    """All pairs of a left and a right block, or those for which ``where`` holds, columns named l_ and r_.

    The pairs of one partition of the left side follow each other, so a task goes through the right side block by block.
    """
    named = lambda df, side: df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])
    parts = max(left.rdd.getNumPartitions(), 1)
    if where is None:
        return named(left, "l").crossJoin(named(right, "r")).coalesce(parts)
    return named(left, "l").join(named(right, "r"), where).coalesce(max(parts, 8 * left.sparkSession.sparkContext.defaultParallelism))


def each_once() -> Column:
    """Of the two orders of a pair of blocks one, the same share for every block."""
    low, high = F.least("l_block", "r_block"), F.greatest("l_block", "r_block")
    return (F.col("l_block") == F.col("r_block")) | ((F.col("l_block") < F.col("r_block")) == (F.pmod(F.xxhash64(low, high), F.lit(2)) == 0))


def _products(left: _Block, right: _Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of pairs in double precision, the same for equal vectors wherever they stand."""
    return np.einsum("ij,ij->i", left.units[i], right.units[j])


class _Asked:
    """A block of queries and the ``k`` best rows for each so far. Its vectors are held only while its pairs come."""

    def __init__(self, block: _Block, k: int, exclude_self: bool):
        self.block, self.ids, self.k, self.exclude_self = block, block.ids, k, exclude_self
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        self.waiting = 0
        self.least = np.full(len(block.ids), -np.inf)

    def meet(self, other: _Block) -> None:
        mine = self.block
        near = np.flatnonzero(mine.least_angles(other) <= _angles(self.least))
        for at in range(0, len(near), _ROWS_AT_ONCE):
            self._meet(other, near[at : at + _ROWS_AT_ONCE])
        if self.waiting > max(16384, self.k * len(mine.ids) // 2) or (len(near) and np.isneginf(self.least).any()):
            self.settle()

    def _meet(self, other: _Block, may: np.ndarray) -> None:
        mine = self.block
        scores = mine.narrow[may] @ other.narrow.T
        if self.exclude_self and len(np.intersect1d(mine.ids, other.ids)):
            scores[mine.ids[may][:, None] == other.ids[None, :]] = -np.inf
        least = self.least[may]
        fresh = np.flatnonzero(np.isneginf(least))
        if len(fresh) and self.k < len(other.ids):
            least[fresh] = np.partition(scores[fresh], len(other.ids) - self.k, axis=1)[:, -self.k] - mine.loss
        i, j = np.nonzero(scores >= np.maximum(least - mine.loss, -2).astype(np.float32)[:, None])
        if len(i):
            self.found.append((may[i], other.ids[j], _products(mine, other, may[i], j)))
            self.waiting += len(i)

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, id, sim) of the best so far, which bound what is looked for from now on."""
        row, id_, sim = (np.concatenate(parts) for parts in zip(*self.found))
        order = np.lexsort((id_, -sim, row))
        start = np.searchsorted(row[order], np.arange(len(self.ids)))
        order = order[np.arange(len(order)) - start[row[order]] < self.k]
        row, id_, sim = row[order], id_[order], sim[order]
        size = np.bincount(row, minlength=len(self.ids))
        full = size == self.k
        self.least[full] = np.maximum(self.least[full], sim[np.cumsum(size)[full] - 1])
        self.found, self.waiting = [(row, id_, sim)], 0
        return row, id_, sim

    def rest(self) -> None:
        """Lets go of the vectors; they come again with the next pair of the block."""
        self.settle()
        self.block = None


def _searching(k: int, exclude_self: bool, itself: bool):
    """The best rows for each row of the left blocks of a task's pairs; of a block that waits for its next pairs only results are held."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, _Asked] = {}
        held: _Asked | None = None
        for batch in batches:
            for at, name in enumerate(batch.column("l_block").to_pylist()):
                if held is None or held.block.name != name:
                    if held is not None:
                        held.rest()
                    block = _Block(batch, at, "l")
                    if name not in seen:
                        seen[name] = _Asked(block, k, exclude_self)
                        if itself:
                            # a row's own neighbourhood tells early what can still matter; the rows come in their turn
                            first = _Asked(block, k, exclude_self)
                            first.meet(block)
                            seen[name].least = first.least
                    held = seen[name]
                    held.block = block
                held.meet(_Block(batch, at, "r"))
        for one in seen.values():
            row, id_, sim = one.settle()
            yield pa.RecordBatch.from_arrays([pa.array(one.ids[row]), pa.array(id_), pa.array(sim)], names=["query", "id", "sim"])

    return search


def nearest(asked: DataFrame, known: DataFrame, k: int, exclude_self: bool = False) -> DataFrame:
    """(query, id, sim): the ``k`` most similar rows of the blocks ``known`` for each row of the blocks ``asked``.

    Equal scores go by id. Of a block of queries that was in several tasks, each gives the best it saw.
    """
    return crossed(asked, known).mapInArrow(_searching(k, exclude_self, asked is known), "query long, id long, sim double")


def pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b, sim), ``a < b``, with cosine >= threshold among all rows of the blocks, each once."""
    widest = float(np.arccos(np.clip(threshold, -1.0, 1.0)))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Block | None = None
        for batch in batches:
            for at, name in enumerate(batch.column("l_block").to_pylist()):
                if held is None or held.name != name:
                    held = _Block(batch, at, "l")
                other = _Block(batch, at, "r")
                x, y = np.flatnonzero(held.least_angles(other) <= widest), np.flatnonzero(other.least_angles(held) <= widest)
                if not len(x) or not len(y):
                    continue
                i, j = np.nonzero(held.narrow[x] @ other.narrow[y].T >= np.float32(threshold - held.loss))
                i, j = x[i], y[j]
                keep = held.ids[i] < other.ids[j] if held.name == other.name else held.ids[i] != other.ids[j]
                i, j = i[keep], j[keep]
                sim = _products(held, other, i, j)
                near = sim >= threshold
                left, right = held.ids[i[near]], other.ids[j[near]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right)), pa.array(sim[near])], names=["a", "b", "sim"])

    return crossed(blocks, blocks, each_once()).mapInArrow(multiply, "a long, b long, sim double")
