"""Set-similarity join for low thresholds, over all pairs of blocks of sets.

Below a half, a prefix holds most items of a set and joins by item form nearly all pairs of sets. Here sets are
written once, in blocks of near sizes, and the tasks read the pairs of blocks from the files. The most frequent items
have a column each, and the product of two blocks counts those that two sets share; the others meet by item, which
few pairs of sets do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.session import written_table

from .blocks import crossed, each_once

BLOCK_ROWS = 1024
#: items that have a column, items of a block at most, and meetings by item that are counted at once
_COMMON, _ROOM, _MEETINGS = 1024, 1 << 19, 1 << 20
#: cells: the places of the frequent items in the table of rows by columns; items and rows: the others, by item
_PACKED = "block long, ids binary, kinds binary, sizes binary, cells binary, items binary, rows binary, least long, most long"


def _pack(common: np.ndarray):
    def block(name: int, held: list[tuple]) -> pd.DataFrame:
        ids, kinds, sizes, lists = zip(*held)
        items, rows = np.concatenate(lists).astype(np.int64), np.repeat(np.arange(len(ids)), sizes)
        column = np.minimum(np.searchsorted(common, items), len(common) - 1)
        frequent = common[column] == items
        cells, items, rows = rows[frequent] * len(common) + column[frequent], items[~frequent], rows[~frequent]
        order = np.argsort(items)
        packed = {"ids": ids, "kinds": kinds, "sizes": sizes, "cells": cells, "items": items[order], "rows": rows[order]}
        types = {"cells": np.int32, "rows": np.int16}
        return pd.DataFrame({
            "block": [name], **{k: [np.array(v, types.get(k, np.int64)).tobytes()] for k, v in packed.items()}, "least": [min(sizes)], "most": [max(sizes)]})

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks of rows (id, kind, n, items) that come in the order of n."""
        name, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for row in zip(batch["id"], batch["kind"], batch["n"], batch["items"]):
                if held and (len(held) >= BLOCK_ROWS or size + row[2] > _ROOM):
                    yield block(name, held)
                    name, held, size = name + 1, [], 0
                held.append(row)
                size += row[2]
        if held:
            yield block(name, held)

    return pack


class _Sets:
    """Row ``at`` of a batch of pairs of blocks, its left or right side."""

    def __init__(self, batch: pa.RecordBatch, at: int, side: str, columns: int):
        numbers = lambda name, kind=np.int64: np.frombuffer(batch.column(f"{side}_{name}")[at].as_buffer(), kind)
        self.ids, self.kinds, self.sizes, self.items = (numbers(c).copy() for c in ("ids", "kinds", "sizes", "items"))
        self.rows = numbers("rows", np.int16).astype(np.int64)
        self.name = batch.column(f"{side}_block")[at].as_py()
        self.table = np.zeros((len(self.ids), columns), np.float32)
        self.table.reshape(-1)[numbers("cells", np.int32)] = 1


def _shared(left: _Sets, right: _Sets) -> np.ndarray:
    """Numbers of shared items of all pairs of rows."""
    out = left.table @ right.table.T
    first = np.searchsorted(right.items, left.items)
    times = np.searchsorted(right.items, left.items, side="right") - first
    met = np.flatnonzero(times)
    first, times, rows = first[met], times[met], left.rows[met]
    ends, low = np.cumsum(times), 0
    while low < len(rows):
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + _MEETINGS, side="right")))
        each = times[low:high]
        place = np.arange(each.sum()) + np.repeat(first[low:high] - (ends[low:high] - each - done), each)
        pairs = np.repeat(rows[low:high] * len(right.ids), each) + right.rows[place]
        out += np.bincount(pairs, minlength=out.size).reshape(out.shape).astype(np.float32)
        low = high
    return out


def overlap_pairs(sets: DataFrame, threshold: float, other_than: bool) -> DataFrame:
    """Rows (a, b, jaccard), ``a < b``, for all pairs of sets (id, kind, n, items) with Jaccard >= threshold.

    Items are different 64-bit numbers. With ``other_than`` only sets of different kinds are paired, and none without a kind.
    """
    known = sets.where("kind IS NOT NULL") if other_than else sets
    rows = known.select("id", F.xxhash64("kind").alias("kind"), "n", "items")
    counts = rows.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    common = np.sort(np.array([r["item"] for r in counts.orderBy(F.desc("n"), "item").limit(_COMMON).collect()] or [0], np.int64))
    parts = max(4 * rows.sparkSession.sparkContext.defaultParallelism, rows.count() // (4 * BLOCK_ROWS))
    dealt = rows.repartitionByRange(parts, "n", F.xxhash64("id")).sortWithinPartitions("n", "id")
    blocks = written_table(dealt.mapInPandas(_pack(common), _PACKED), "set-blocks")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Sets | None = None
        for batch in batches:
            for at, name in enumerate(batch.column("l_block").to_pylist()):
                if held is None or held.name != name:
                    held = _Sets(batch, at, "l", len(common))
                other = _Sets(batch, at, "r", len(common))
                least = held.sizes[:, None] + other.sizes[None, :]
                least = least.astype(np.float32) * np.float32(threshold / (1 + threshold)) - np.float32(0.01)
                all_shared = _shared(held, other)
                i, j = np.nonzero(all_shared >= least)
                keep = held.ids[i] < other.ids[j] if held.name == other.name else held.ids[i] != other.ids[j]
                if other_than:
                    keep &= held.kinds[i] != other.kinds[j]
                i, j = i[keep], j[keep]
                shared = all_shared[i, j].astype(np.int64)
                jaccard = shared / (held.sizes[i] + other.sizes[j] - shared)
                near = jaccard >= threshold
                left, right = held.ids[i[near]], other.ids[j[near]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right)), pa.array(jaccard[near])], names=["a", "b", "jaccard"])

    sized = (F.col("l_most") >= F.col("r_least") * threshold - 1e-9) & (F.col("r_most") >= F.col("l_least") * threshold - 1e-9)
    return crossed(blocks, blocks, each_once() & sized).mapInArrow(multiply, "a long, b long, jaccard double")
