"""Pairs of sets that have a smallest digest of items in common, found without dealing items.

Near copies come in groups, and every pair of a group shares most of its items: dealt by item, it would be met once
for each. Sets that agree in the smallest digest of their items under one of a few seeds are compared as rows
instead, block by block. It is decided there whether they are a pair; who agrees under no seed is left to others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.session import written_table

SEEDS = 3
BLOCK_ROWS = 512
#: rows of a cell of postings that are compared at once
MOST_ROWS = 2048
#: numbers of a table of rows and items that are held at once
_ROOM = 1 << 22


def keys(items: Column) -> Column:
    """The smallest digest of the items under every seed, as small numbers."""

    def least(seed: int) -> Column:
        return F.array_min(F.transform(items, lambda x: F.xxhash64(x, F.lit(seed))))

    return F.array(*[F.pmod(k, F.lit((1 << 31) - 1)).cast("int") for k in map(least, range(SEEDS))])


def _cells(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """The rows of one cell each, of a partition sorted by the columns ``by`` that name it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.column_stack([batch.column(c).to_numpy() for c in by])
        cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1), len(names)]
        for low, high in zip(cuts, cuts[1:]):
            name = tuple(names[low])
            if held and name != last:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(low, high - low))
            last = name
    if held:
        yield pa.concat_batches(held)


def _shared(rows: np.ndarray, items: np.ndarray, m: int) -> np.ndarray:
    """How many items every two of ``m`` rows share."""
    _, column, count = np.unique(items, return_inverse=True, return_counts=True)
    more = count > 1
    rows, column = rows[more[column]], (np.cumsum(more) - 1)[column[more[column]]]
    out, wide = np.zeros((m, m), np.float32), int(more.sum())
    step = max(1, _ROOM // m)
    order = np.argsort(column, kind="stable") if wide > step else slice(None)
    rows, column = rows[order], column[order]
    for low in range(0, wide, step):
        part = slice(*np.searchsorted(column, [low, low + step])) if wide > step else slice(None)
        table = np.zeros((m, min(step, wide - low)), np.float32)
        table[rows[part], column[part] - low] = 1
        out += table @ table.T
    return out.astype(np.int64)


def _compare(threshold: float, other_than: bool):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches, ("seed", "key", "low", "high")):
            if cell.num_rows < 2:
                continue
            number = lambda name: cell.column(name).to_numpy()
            ids, own, kinds, seed = number("id"), number("own"), number("kind"), cell.column("seed")[0].as_py()
            lists = cell.column("items")
            ends = lists.offsets.to_numpy().astype(np.int64)
            sizes, items = np.diff(ends), lists.values.to_numpy()[ends[0] : ends[-1]]
            named = cell.column("keys").flatten().to_numpy().reshape(len(ids), SEEDS)
            shared = _shared(np.repeat(np.arange(len(ids)), sizes), items, len(ids))
            jaccard = shared / (sizes[:, None] + sizes[None, :] - shared)
            i, j = np.nonzero(np.triu(jaccard >= threshold, 1))
            keep = ids[i] != ids[j]
            if cell.column("low")[0].as_py() != cell.column("high")[0].as_py():
                keep &= own[i] != own[j]
            if other_than:
                keep &= kinds[i] != kinds[j]
            keep &= (named[i, :seed] != named[j, :seed]).all(axis=1)  # else an earlier seed has them
            i, j = i[keep], j[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j])), pa.array(jaccard[i, j])], names=["a", "b", "jaccard"])

    return compare


def pairs_in_groups(sets: DataFrame, threshold: float, other_than: bool, sent: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows (a, b, jaccard), ``a < b``, for all pairs of sets (id, kind, items, keys) that agree in a key, with Jaccard >= threshold.

    A group of more than ``BLOCK_ROWS`` sets is cut into blocks, whose pairs are cells of their own. ``sent`` marks the
    table of groups for the join that looks up their sizes.
    """
    known = sets.where("id IS NOT NULL" + (" AND kind IS NOT NULL" if other_than else ""))
    named = known.select(F.posexplode("keys").alias("seed", "key"))
    groups = named.groupBy("seed", "key").agg(F.count("*").alias("rows")).where("rows > 1")
    groups = written_table(groups.select("seed", "key", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks")), "groups")
    rows = known.select("id", F.xxhash64("kind").alias("kind"), "items", "keys", F.posexplode("keys").alias("seed", "key")).join(sent(groups), ["seed", "key"])
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = rows.select("seed", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "id", "kind", "items", "keys")
    cell = ["seed", "key", "low", "high"]
    return cells.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(_compare(threshold, other_than), "a long, b long, jaccard double")


def _runs_of_items(items: np.ndarray, rows: np.ndarray) -> Iterator[slice]:
    """Runs of whole items, sorted, that list at most MOST_ROWS rows between them, or of one item."""
    cuts = [0, *(np.flatnonzero(items[1:] != items[:-1]) + 1), len(items)]
    start, seen = 0, set()
    for low, high in zip(cuts, cuts[1:]):
        fresh = set(rows[low:high].tolist())
        if seen and len(seen | fresh) > MOST_ROWS:
            yield slice(start, low)
            start, seen = low, set()
        seen |= fresh
    yield slice(start, len(items))


def _meet(threshold: float, other_than: bool):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches, ("lead", "blocks", "low", "high")):
            if cell.num_rows < 2:
                continue
            items, names = cell.column("item").to_numpy(), cell.column("row").to_numpy()
            apart = cell.column("low")[0].as_py() != cell.column("high")[0].as_py()
            whole = len(np.unique(names)) <= MOST_ROWS
            for part in [slice(0, len(items))] if whole else _runs_of_items(items, names):
                rows, at, place = np.unique(names[part], return_index=True, return_inverse=True)
                if len(rows) < 2:
                    continue
                met = np.triu(_shared(place, items[part], len(rows)), 1)
                i, j = np.nonzero(met)
                met = met[i, j]
                take = pc.take(cell.slice(part.start, part.stop - part.start), pa.array(at))
                number = lambda name: take.column(name).to_numpy()
                ids, n, tail, kinds, own, df, item = (number(c) for c in ("id", "n", "tail", "kind", "own", "last_df", "last_item"))
                keys = take.column("keys").flatten().to_numpy().reshape(len(rows), SEEDS)
                keep = (ids[i] != ids[j]) & (keys[i] != keys[j]).all(axis=1)
                keep &= (n[j] >= n[i] * threshold - 1e-9) & (n[i] >= n[j] * threshold - 1e-9)
                if apart:
                    keep &= own[i] != own[j]
                if other_than:
                    keep &= kinds[i] != kinds[j]
                i, j, met = i[keep], j[keep], met[keep]
                # items shared outside the prefixes follow the prefix that ends first, so its tail bounds them
                first = (df[i] < df[j]) | ((df[i] == df[j]) & (item[i] < item[j]))
                need = (n[i] + n[j]) * (threshold / (1 + threshold)) - 1e-9
                least = np.ceil(need - np.where(first, tail[i], tail[j])).astype(np.int64)
                low = ids[i] < ids[j]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.where(low, rows[i], rows[j])), pa.array(np.where(low, rows[j], rows[i])), pa.array(met), pa.array(least)],
                    names=["p", "q", "met", "least"])

    return meet


def met_in_cells(postings: DataFrame, threshold: float, hot: int, other_than: bool) -> DataFrame:
    """Rows (p, q, met, least): how many items of a cell two rows share, and how many they must share in all cells.

    Postings are (row, id, kind, n, keys, tail, last_df, last_item, df, item, lead): an item among the first of a set of
    ``n``, how many it has after these, and the last of these. Sets that agree in a key, or whose sizes are too far
    apart, are no rows here. Items are dealt by their ``lead``, so that near copies meet in few cells; one
    listed by more than ``hot`` sets goes to a cell for every two blocks of its sets.
    """
    known = postings.where("kind IS NOT NULL") if other_than else postings
    known = known.withColumn("kind", F.xxhash64("kind")).withColumn("blocks", F.ceil(F.col("df") / hot).cast("int"))
    known = known.withColumn("own", F.pmod(F.xxhash64("row"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = ["lead", "blocks", "low", "high"]
    placed = known.select(
        "lead", "blocks", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "item", "own",
        "row", "id", "kind", "n", "keys", "tail", "last_df", "last_item")
    return placed.repartition(*cell).sortWithinPartitions(*cell, "item").mapInArrow(_meet(threshold, other_than), "p long, q long, met long, least long")
