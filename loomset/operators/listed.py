"""Which sets share enough items with others to be in any pair, before an item is dealt with its set.

A set with a partner of Jaccard >= t shares at least t of its own items. Most sets of a corpus do not reach that
with all other sets together, and need neither be written nor joined. To find them, chunks of rows send 32 bits of
every item's hash to the bucket that the rest of the hash names, and get back how many of a row's items another row
lists too. Two items that agree in all these bits count as shared, so a set may be kept in vain but never lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: items of a chunk, rows for each bucket, and the fewest and most buckets
_CHUNK_ITEMS, _BUCKET_ROWS, _BUCKETS = 1 << 21, 8192, (64, 1 << 13)
#: of a chunk's own row (bucket below 0) the ids and sizes; of another the items' hashes, and how many each row has
_SENT = "bucket int, chunk long, first binary, second binary"


def _mixed(items: np.ndarray) -> np.ndarray:
    x = items.view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _packed(numbers: np.ndarray) -> bytes:
    """Bytes if that is enough, else 32 bits each; the length of the whole tells which."""
    return numbers.astype(np.uint8 if not len(numbers) or numbers.max() < 256 else np.uint32).tobytes()


def _unpacked(field: bytes, n: int) -> np.ndarray:
    return np.frombuffer(field, np.uint8 if len(field) == n else np.uint32).astype(np.int64)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, sizes, items) of runs of rows that hold about _CHUNK_ITEMS items."""
    lists = batch.column("items")
    ends, items, ids = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(), batch.column("id").to_numpy()
    low = 0
    while low < len(ids):
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + _CHUNK_ITEMS, side="right")) - 1)
        high = min(high, len(ids))
        yield ids[low:high], np.diff(ends[low : high + 1]), items[ends[low] : ends[high]]
        low = high


def _deal(buckets: int):
    bits = np.uint64(buckets.bit_length() - 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, sizes, items in _chunks(batch):
                mixed = _mixed(items)
                bucket = (mixed >> (np.uint64(64) - bits)).astype(np.uint16)
                order = np.argsort(bucket, kind="stable")  # rows stay in their order within a bucket
                tails = (mixed >> (np.uint64(32) - bits)).astype(np.uint32)[order]
                rows = np.repeat(np.arange(len(ids)), sizes)[order]
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                own = [(-1 - name % buckets, name, ids.astype(np.int64).tobytes(), sizes.astype(np.int64).tobytes())]
                for b in np.flatnonzero(np.diff(cuts)):
                    low, high = cuts[b], cuts[b + 1]
                    own.append((int(b), name, tails[low:high].tobytes(), _packed(np.bincount(rows[low:high], minlength=len(ids)))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*own), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    names=["bucket", "chunk", "first", "second"])
                name += 1

    return deal


def _runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[list[dict]]:
    """Rows that follow each other with one value in the column ``by``."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0][by] != row[by]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the rows of every chunk, how many of their items of a bucket another row lists; rows of a chunk itself pass."""
    for run in _runs(batches, "bucket"):
        if run[0]["bucket"] >= 0:
            tails = np.concatenate([np.frombuffer(r["first"], np.uint32) for r in run]).astype(np.uint64)
            order = np.sort((tails << np.uint64(32)) | np.arange(len(tails), dtype=np.uint64))
            equal = np.diff(order >> np.uint64(32)) == 0
            shared = np.zeros(len(tails), np.int64)
            shared[(order & np.uint64(0xFFFFFFFF)).astype(np.int64)] = np.append(equal, False) | np.append(False, equal)
            low = 0
            for r in run:
                n = len(r["first"]) // 4
                each = np.frombuffer(r["second"], np.uint8)
                each = each if each.sum(dtype=np.int64) == n else np.frombuffer(r["second"], np.uint32)
                row = np.repeat(np.arange(len(each)), each)
                r["first"], r["second"] = None, _packed(np.bincount(row, shared[low : low + n], minlength=len(each)).astype(np.int64))
                low += n
        yield pa.RecordBatch.from_pylist(run, schema=pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("first", pa.binary()), ("second", pa.binary())]))


def _keep(threshold: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, "chunk"):
            own = next(r for r in run if r["bucket"] < 0)
            ids, sizes = np.frombuffer(own["first"], np.int64), np.frombuffer(own["second"], np.int64)
            shared = np.zeros(len(ids), np.int64)
            for r in run:
                if r["bucket"] >= 0:
                    shared += _unpacked(r["second"], len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids[(sizes > 0) & (shared >= np.ceil(sizes * threshold - 1e-9))])], names=["id"])

    return keep


def may_pair(sets: DataFrame, threshold: float) -> DataFrame:
    """The ids (id) of rows (id, items) of which at least the share ``threshold`` of the items is in other rows too."""
    rows = sets.select(F.col("id").cast("long").alias("id"), "items").where("id IS NOT NULL AND size(items) > 0")
    fewest, most = _BUCKETS
    buckets = min(most, max(fewest, 1 << (max(sets.select("id").count() // _BUCKET_ROWS, 1) - 1).bit_length()))
    dealt = rows.mapInArrow(_deal(buckets), _SENT).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    back = dealt.mapInArrow(_count, _SENT).repartition(buckets, "chunk").sortWithinPartitions("chunk")
    return back.mapInArrow(_keep(threshold), "id long")
