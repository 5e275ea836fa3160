"""Operator 12: line dedup that can be undone, on sharded cuckoo filters and exact reference counts.

An index is three tables in the shared folder. ``refs`` holds each (key, doc_id) once: which document has
which line. ``counts`` holds, for every key, in how many documents it stands and the largest of them: exact,
one row per key. ``filters`` holds one cuckoo filter per shard of keys, the set of the frequent ones, those
in ``min_docs`` documents or more. Inserting documents raises counts, deleting documents lowers them, and
keys that cross the bound go into their shard's filter or out of it; after deleting what was inserted, the
index gives the same decisions as before. Lines are asked of the filters first, and only those that a filter
knows, a share of 1 in 8,000 by mistake, go on to the exact table, which decides.

A key stands for its line by two 64-bit hashes. A frequent line is counted before it is shuffled; lines are
dealt to filters by shard and a part of their document's hash, as many parts as the shard's lines need; and
the keys in a third of all documents meet their counts by a broadcast of at most HOT_SHARE rows. Every
version of the index is a set of written tables, so a lost executor costs one step.

Defined results: a null or empty text is one empty line. Rows of one doc_id are one document: a line in two
of them counts once, and what is dropped is dropped from each. A row without doc_id holds no line for the
counts and loses none. Lines are split at \\n alone, and strip and lower-case only the ASCII white space and
A-Z. Inserting a document that is there already adds only the lines that it did not have; deleting an id that
is not there does nothing. Other columns are not read. One text must fit a worker.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm import flat
from loomset.llm.cuckoo import CuckooFilter
from loomset.llm.tables import bounded_batches, joined_by_key, text_rows, written_table

MIN_DOCS = 3
MIN_POINTS = 20
#: keys of one shard when the index is made; lines that one task asks of one filter
SHARD_KEYS, ASKED_LINES = 1 << 17, 1 << 18
_SECOND_BASE = 0xC2B2AE3D27D4EB4F | 1
_KEY = ["low", "high"]

_FIRST_BYTE = np.ones(256, bool)
_FIRST_BYTE[0x80:0xC0] = False


class Lines(NamedTuple):
    """Spans of whole lines, the range of each row's lines, and which lines have a key: its two hashes."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    keyed: np.ndarray
    low: np.ndarray
    high: np.ndarray


def lines_of(texts: flat.Texts, min_points: int = MIN_POINTS) -> Lines:
    """All lines of some texts, an empty text being one; a key has ``min_points`` code points or more."""
    data, offsets = texts
    breaks = np.flatnonzero(data == 0x0A)
    per_row = np.searchsorted(breaks, offsets)
    first = per_row + np.arange(len(offsets))
    row_starts = first[:-1]
    start, end = np.empty(int(first[-1]), np.int64), np.empty(int(first[-1]), np.int64)
    start[row_starts], end[first[1:] - 1] = offsets[:-1], offsets[1:]
    after = np.ones(len(start), bool)
    after[row_starts] = False
    start[after] = breaks + 1
    before = np.ones(len(start), bool)
    before[first[1:] - 1] = False
    end[before] = breaks
    # strip: from the first byte that is no white space to the last
    inked = np.flatnonzero(flat.NOT_SPACE[data])
    a, b = np.searchsorted(inked, start), np.searchsorted(inked, end)
    some = b > a
    left, right = start.copy(), start.copy()
    left[some], right[some] = inked[a[some]], inked[b[some] - 1] + 1
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_FIRST_BYTE[data], out=points[1:])
    keyed = np.flatnonzero(points[right] - points[left] >= min_points)
    lower = flat.lowered(texts).data
    low = flat.hashes(lower, left[keyed], right[keyed])
    high = flat.hashes(lower, left[keyed], right[keyed], _SECOND_BASE)
    return Lines(start, end, first, keyed, low, high)


def _keys_of(min_points: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in flat.slices(batches):
            lines = lines_of(flat.texts_of(part.column("text")), min_points)
            row = np.searchsorted(lines.first, lines.keyed, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines.low.view(np.int64)), pa.array(lines.high.view(np.int64)), part.column("doc_id").take(pa.array(row))],
                names=[*_KEY, "doc_id"],
            )

    return each


def line_keys(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """(low, high, doc_id): every key of every document that has an id, once."""
    rows = text_rows(docs).where("doc_id IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(_keys_of(min_points), "low bigint, high bigint, doc_id bigint").distinct()


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().view(np.uint64)


def _updated(min_docs: int):
    """A shard's filter after some of its keys became frequent and others ceased to be."""

    def each(had: pa.Table, changed: pa.Table) -> pa.Table:
        shard = (had if had.num_rows else changed).column("shard")[0].as_py()
        low, high = _numbers(changed, "low"), _numbers(changed, "high")
        was, now = changed.column("was").to_numpy() >= min_docs, changed.column("now").to_numpy() >= min_docs
        stored = CuckooFilter.read(had.column("filter")[0].as_py()) if had.num_rows else CuckooFilter(1)
        if (was & ~now).any():
            stored.remove(low[was & ~now], high[was & ~now])
        fresh = now & ~was
        if fresh.any() and not ((stored.table > 0).mean() < 0.9 and stored.add(low[fresh], high[fresh])):
            # too full: made anew, larger, from the shard's rows of the exact table
            stored = CuckooFilter.of(low[now], high[now])
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "filter": pa.array([stored.to_bytes()], pa.binary()),
            "n_keys": pa.array([int(now.sum())], pa.int64()),
        })

    return each


def _ask(lines: pa.Table, filters: pa.Table) -> pa.Table:
    """The lines that their shard's filter knows."""
    if not filters.num_rows or not lines.num_rows:
        return lines.slice(0, 0).select([*_KEY, "doc_id"])
    stored = CuckooFilter.read(filters.column("filter")[0].as_py())
    known = stored.contains(_numbers(lines, "low"), _numbers(lines, "high"))
    return lines.select([*_KEY, "doc_id"]).filter(pa.array(known))


def _rest(with_text: bool, min_points: int):
    """Whole texts without their lines of the keys in ``drops``: counts, digest and, if asked for, the text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in flat.slices(batches):
            texts = flat.texts_of(part.column("text"))
            lines = lines_of(texts, min_points)
            drops = part.column("drops")
            dropped = np.zeros(len(lines.start), bool)
            n = np.array(drops.value_lengths().fill_null(0))
            if n.sum():
                # a dropped line is one whose (row, low, high) is on the list of its row
                row = np.searchsorted(lines.first, lines.keyed, "right") - 1
                listed = np.repeat(np.arange(len(n)), n)
                values = drops.flatten()
                want = _triples(listed, *(values.field(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in (0, 1)))
                maybe = np.flatnonzero(np.isin(lines.low, want["low"]))
                found = np.isin(_triples(row[maybe], lines.low[maybe], lines.high[maybe]), want)
                dropped[lines.keyed[maybe[found]]] = True
            data, out, digests, gone = texts.data, [], [], flat.run_sums(dropped.astype(np.int64), lines.first)
            for k in range(part.num_rows):
                if not gone[k]:
                    kept = data[texts.offsets[k] : texts.offsets[k + 1]].tobytes()
                else:
                    at = np.arange(lines.first[k], lines.first[k + 1])
                    at = at[~dropped[at]]
                    kept = b"\n".join(data[a:b].tobytes() for a, b in zip(lines.start[at], lines.end[at]))
                digests.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    out.append(kept.decode())
            arrays = [part.column("doc_id"), pa.array(np.diff(lines.first)), pa.array(gone), pa.array(digests, pa.string())]
            names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
            if with_text:
                arrays, names = [*arrays, pa.array(out, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return each


def _triples(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    out = np.empty(len(row), dtype=[("row", np.int64), ("low", np.uint64), ("high", np.uint64)])
    out["row"], out["low"], out["high"] = row, low, high
    return out


class LineIndex(NamedTuple):
    """A version of the index; every change gives a new one and leaves the old one as it is."""

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS
    min_points: int = MIN_POINTS

    @classmethod
    def empty(cls, spark: SparkSession, shards: int, min_docs: int = MIN_DOCS, min_points: int = MIN_POINTS) -> LineIndex:
        table = lambda ddl, name: written_table(spark.createDataFrame([], ddl), name)
        return cls(
            table("low bigint, high bigint, doc_id bigint", "refs"), table("low bigint, high bigint, n_docs bigint, largest bigint", "counts"),
            table("shard int, filter binary, n_keys bigint", "filters"), shards, min_docs, min_points,
        )

    @classmethod
    def of(cls, docs: DataFrame, min_docs: int = MIN_DOCS, min_points: int = MIN_POINTS) -> LineIndex:
        """An index of ``docs`` with as many shards as their keys need."""
        refs = written_table(line_keys(docs, min_points), "refs")
        shards = max(docs.sparkSession.sparkContext.defaultParallelism, -(-refs.count() // SHARD_KEYS))
        return cls.empty(docs.sparkSession, shards, min_docs, min_points)._with(refs, refs, first=True)

    def _shard(self):
        return F.pmod(F.xxhash64(*_KEY), F.lit(self.shards)).cast("int").alias("shard")

    def _with(self, refs: DataFrame, changed: DataFrame, gone: bool = False, first: bool = False) -> LineIndex:
        """The index with ``refs``, after ``changed`` came or went."""
        delta = changed.groupBy(*_KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
        if first:
            counts = delta.select(*_KEY, F.col("n").alias("n_docs"), F.col("last").alias("largest"), F.lit(0).cast("bigint").alias("was"), F.lit(True).alias("moved"))
        else:
            both = self.counts.join(delta, _KEY, "full")
            was = F.coalesce("n_docs", F.lit(0))
            now = was - F.coalesce("n", F.lit(0)) if gone else was + F.coalesce("n", F.lit(0))
            # of a key whose largest document went, the next one is looked up below
            largest = F.when(F.col("last") == F.col("largest"), None).otherwise(F.col("largest")) if gone else F.greatest("largest", "last")
            counts = both.select(*_KEY, now.alias("n_docs"), largest.alias("largest"), was.alias("was"), F.col("n").isNotNull().alias("moved"))
        counts = written_table(counts, "counts")
        across = counts.where(f"(was >= {self.min_docs}) <> (n_docs >= {self.min_docs})").select(self._shard()).distinct()
        touched = counts.where(f"was >= {self.min_docs} OR n_docs >= {self.min_docs}").select(
            self._shard(), *_KEY, "was", F.col("n_docs").alias("now")
        ).join(across, "shard", "left_semi")
        same = self.filters.join(across, "shard", "left_anti")
        remade = self.filters.join(across, "shard", "left_semi").groupBy("shard").cogroup(touched.groupBy("shard")).applyInArrow(
            _updated(self.min_docs), "shard int, filter binary, n_keys bigint"
        )
        filters = written_table(same.unionByName(remade), "filters")
        counts = counts.where("n_docs > 0")
        if gone:
            lost = counts.where("largest IS NULL").select(*_KEY)
            found = refs.join(lost, _KEY, "left_semi").groupBy(*_KEY).agg(F.max("doc_id").alias("next"))
            counts = counts.join(found, _KEY, "left").withColumn("largest", F.coalesce("largest", "next"))
            counts = written_table(counts.select(*_KEY, "n_docs", "largest"), "counts")
        return self._replace(refs=refs, counts=counts.select(*_KEY, "n_docs", "largest"), filters=filters)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with the lines of ``docs`` as well."""
        fresh = written_table(line_keys(docs, self.min_points).join(self.refs, [*_KEY, "doc_id"], "left_anti"), "refs")
        more = self._with(self.refs.unionByName(fresh), fresh)
        keys = more.counts.count()
        return more._dealt_anew(-(-keys // SHARD_KEYS)) if keys > 4 * SHARD_KEYS * self.shards else more

    def _dealt_anew(self, shards: int) -> LineIndex:
        """The same index with its filters over more shards."""
        wide = self._replace(shards=shards)
        keys = self.counts.where(F.col("n_docs") >= self.min_docs).select(
            wide._shard(), *_KEY, F.lit(0).cast("bigint").alias("was"), F.col("n_docs").alias("now")
        )
        none = self.filters.where("shard < 0").groupBy("shard")
        made = none.cogroup(keys.groupBy("shard")).applyInArrow(_updated(self.min_docs), "shard int, filter binary, n_keys bigint")
        return wide._replace(filters=written_table(made, "filters"))

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents whose doc_id is in ``ids``."""
        names = ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        went = written_table(self.refs.join(names, "doc_id", "left_semi").select(*_KEY, "doc_id"), "gone")
        left = written_table(self.refs.join(names, "doc_id", "left_anti").select(*_KEY, "doc_id"), "refs")
        return self._with(left, went, gone=True)

    def known(self, refs: DataFrame) -> DataFrame:
        """Those of ``refs`` (low, high, doc_id) that their shard's filter knows: all frequent keys, and few others."""
        lines = refs.select(self._shard(), *_KEY, "doc_id")
        sizes = lines.groupBy("shard").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / ASKED_LINES).cast("int"))
        sizes = written_table(sizes.join(self.filters.where("n_keys > 0").select("shard"), "shard", "left_semi"), "sizes")
        part = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias("part")
        dealt = joined_by_key(lines, sizes, "shard", "n", "inner").select("shard", part, *_KEY, "doc_id")
        every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        copies = self.filters.join(sizes, "shard").select("shard", every, "filter")
        return dealt.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInArrow(
            _ask, "low bigint, high bigint, doc_id bigint"
        )

    def drops(self) -> DataFrame:
        """(doc_id, drops): the keys whose lines each document loses. Only documents that lose some are listed."""
        frequent = written_table(self.counts.where(F.col("n_docs") >= self.min_docs), "frequent")
        exact = joined_by_key(written_table(self.known(self.refs), "known"), frequent, _KEY, "n_docs", "inner")
        return exact.where("doc_id <> largest").groupBy("doc_id").agg(F.collect_list(F.struct(*_KEY)).alias("drops"))

    def cleaned(self, docs: DataFrame, with_text: bool = False) -> DataFrame:
        """(doc_id, n_lines, n_dropped, kept_sha256[, kept_text]) for each row of ``docs``, which the index should hold."""
        bounded_batches(docs.sparkSession)
        rows = text_rows(docs)
        joined = rows.where("doc_id IS NOT NULL").join(self.drops(), "doc_id", "left").select("doc_id", "text", "drops")
        nothing = F.lit(None).cast("array<struct<low:bigint,high:bigint>>")
        rest = rows.where("doc_id IS NULL").select("doc_id", "text", nothing.alias("drops"))
        schema = "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string" + (", kept_text string" if with_text else "")
        return joined.unionByName(rest).mapInArrow(_rest(with_text, self.min_points), schema)


def line_dedup_report(docs: DataFrame, min_docs: int = MIN_DOCS, min_points: int = MIN_POINTS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) for each row, from an index of all of ``docs``."""
    return LineIndex.of(docs, min_docs, min_points).cleaned(docs)
