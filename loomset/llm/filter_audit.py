"""Operator 11: what each filter removes in every order of filters, from sorted posting lists.

The rows of a part are sorted by id and cut into id ranges. A block is one range: its ids, and for every
filter the ascending places of the rows that fail it. Unions and differences of these lists are merged by
galloping and only their sizes leave the task; as ranges are disjoint, the sizes of a part are sums over
its ranges, so no part is ever in one place.

Defined results: a null text is empty, a null lang the part of the empty string. Repeated rows are rows of
their own: each is counted, and two with one id are no copies of each other by filter E, which asks for a
smaller id. A row without an id has no smaller one and is nobody's smaller one. A document is good or toxic
if any row of labels with its id says 1; without an id it is neither. Without documents there are no parts
and no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm import flat
from loomset.llm.tables import bounded_batches, joined_by_key, parts_for, written_table

FILTERS = "ABCDE"
#: rows of one task that makes posting lists; a block is one Arrow batch of it, or what a part has there
TASK_ROWS = 1 << 18
#: keys that gallop from one starting place
_STRIDE = 64

#: fixed values: the bytes that filter D looks for, and A-Z
_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"#$%&*|")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[0x41:0x5B] = True
_FIRST_BYTE = np.ones(256, bool)
_FIRST_BYTE[0x80:0xC0] = False


def _text_flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in flat.slices(batches):
        texts = flat.texts_of(part.column("text"))
        words = flat.words_of(texts, flat.NOT_SPACE)
        count = np.diff(words.first)
        row = np.repeat(np.arange(len(count)), count)
        # equal words of one row meet after sorting by a hash of row and word
        mark = flat.mixed(flat.word_hashes(texts, words) ^ flat.mixed(row.astype(np.uint64)))
        order = np.argsort(mark)
        new = np.ones(len(order), bool)
        new[1:] = mark[order][1:] != mark[order][:-1]
        distinct = np.bincount(row[order][new], minlength=len(count))
        per_row = [flat.run_sums(table[texts.data].astype(np.int64), texts.offsets) for table in (_CAPITAL, _FIRST_BYTE, _SIGNS)]
        capitals, points, signs = per_row
        fails = (count < 200) + 2 * (100 * distinct < 50 * count) + 4 * (100 * capitals > 3 * points) + 8 * (signs > 0)
        yield pa.RecordBatch.from_arrays(
            [part.column(n) for n in ("doc_id", "part", "content")] + [pa.array(fails, pa.int32())],
            names=["doc_id", "part", "content", "fails"],
        )


def failing_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, part, fails) for each document; bit k of ``fails`` says that it fails filter k of ABCDE."""
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"), F.unhex(F.sha2(text, 256)).alias("content"),
    )
    rows = written_table(rows.mapInArrow(_text_flags, "doc_id bigint, part string, content binary, fails int"), "flags")
    firsts = rows.where("doc_id IS NOT NULL").groupBy("content").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copied = joined_by_key(rows, written_table(firsts, "firsts"), "content", "n")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return copied.select("doc_id", "part", (F.col("fails") + F.when(later, 16).otherwise(0)).alias("fails"))


def gallop(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For ascending keys, how many of the ascending ``values`` are smaller than each.

    The first key of every stride is looked up; the others set out from there in steps that double until
    they pass their key, and halve the last step to find it. All keys move together.
    """
    if not len(keys) or not len(values):
        return np.zeros(len(keys), np.int64)
    low = np.repeat(np.searchsorted(values, keys[::_STRIDE]), _STRIDE)[: len(keys)]
    step = 1
    high = low.copy()
    moving = np.flatnonzero(low < len(values))
    while len(moving):
        ahead = values[high[moving]] < keys[moving]
        moving = moving[ahead]
        low[moving] = high[moving] + 1
        high[moving] = np.minimum(high[moving] + step, len(values))
        moving = moving[high[moving] < len(values)]
        step *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        less = values[middle] < keys[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
        open_ = open_[low[open_] < high[open_]]
    return low


def found_in(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the ascending keys are among the ascending values."""
    at = gallop(values, keys)
    inside = at < len(values)
    inside[inside] = values[at[inside]] == keys[inside]
    return inside


def merged(lists: list[np.ndarray]) -> np.ndarray:
    """The union of ascending lists: each shorter list gallops through what the longer ones gave."""
    lists = sorted(lists, key=len, reverse=True)
    out = lists[0]
    for more in lists[1:]:
        at = gallop(out, more)
        inside = at < len(out)
        inside[inside] = out[at[inside]] == more[inside]
        out = np.insert(out, at[~inside], more[~inside])
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per part and id range: ids, and for each filter and label the ascending places that have it."""
    for batch in batches:
        part = batch.column("part").to_pylist()
        fails = batch.column("fails").to_numpy()
        marks = fails | batch.column("marks").to_numpy() << len(FILTERS)
        cuts = [k for k in range(1, len(part)) if part[k] != part[k - 1]]
        bounds = [(a, b) for a, b in zip([0, *cuts], [*cuts, len(part)]) if b > a]
        lists = [[np.flatnonzero(marks[a:b] >> k & 1).astype(np.int32) for a, b in bounds] for k in range(len(FILTERS) + 2)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part[a] for a, _ in bounds], pa.string()),
                pa.array([batch.column("doc_id").slice(a, b - a).to_pylist() for a, b in bounds], pa.list_(pa.int64())),
                pa.array(lists_of_places(lists), pa.list_(pa.list_(pa.int32()))),
            ],
            names=["part", "ids", "places"],
        )


def lists_of_places(lists: list[list[np.ndarray]]) -> list[list[np.ndarray]]:
    """From one list of blocks for each filter to one list of filters for each block."""
    return [list(block) for block in zip(*lists)]


def posting_lists(rows: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(part, ids, places) of every id range of every part.

    ``rows`` are (doc_id, part, fails). ``ids`` are the range's ids in ascending order; ``places`` holds, for
    A to E, good and toxic, the ascending places in ``ids`` of the rows that fail that filter or carry that label.
    """
    spark = rows.sparkSession
    if labels is not None:
        says = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
            (F.max(F.when(F.col("quality") == 1, 1).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, 2).otherwise(0))).alias("marks")
        )
        named = rows.where("doc_id IS NOT NULL").join(says, "doc_id", "left").select(*rows.columns, F.coalesce("marks", F.lit(0)).alias("marks"))
        rows = named.unionByName(rows.where("doc_id IS NULL").withColumn("marks", F.lit(0)))
    else:
        rows = rows.withColumn("marks", F.lit(0))
    rows = written_table(rows, "marked")
    parts = parts_for(spark, rows.count(), TASK_ROWS)
    # the third key lets rows of one id, or without one, fall into several ranges
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(parts, "part", "doc_id", "row")
    return dealt.sortWithinPartitions("part", "doc_id", "row").select("part", "doc_id", "fails", "marks").mapInArrow(
        _blocks, "part string, ids array<bigint>, places array<array<int>>"
    )


def _combinations() -> list[tuple[int, int]]:
    """(set of earlier filters, filter) for all sets that the filter is not in."""
    n = len(FILTERS)
    return [(s, f) for f in range(n) for s in range(1 << n) if not s >> f & 1]


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of differences for every filter after every set of earlier ones, for each block."""
    pairs, n = _combinations(), len(FILTERS)
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("part", "before", "filter", "n_rows", "failing", "removed", "good", "toxic")}
        for b in range(batch.num_rows):
            places = [np.asarray(p, np.int64) for p in batch.column("places")[b].values.to_numpy(zero_copy_only=False)]
            n_rows, part = len(batch.column("ids")[b]), batch.column("part")[b].as_py()
            empty = np.zeros(0, np.int64)
            union = {0: empty}
            for size in range(1, n):
                for chosen in combinations(range(n), size):
                    last = chosen[-1]
                    key = sum(1 << c for c in chosen)
                    union[key] = merged([union[key ^ 1 << last], places[last]])
            for before, f in pairs:
                gone = places[f][~found_in(places[f], union[before])]
                for name, value in zip(out, (
                    part, before, f, n_rows, len(places[f]), len(gone),
                    int(found_in(gone, places[n]).sum()), int(found_in(gone, places[n + 1]).sum()),
                )):
                    out[name].append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["part"], pa.string())] + [pa.array(out[k], pa.int64()) for k in list(out)[1:]], names=list(out)
        )


_SIZES = "part string, before bigint, filter bigint, n_rows bigint, failing bigint, removed bigint, good bigint, toxic bigint"


def _steps() -> list[tuple]:
    """(filter_order, step, filter, set before) of every step of every order; 600 rows."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(FILTERS[k] for k in order), step, f, before))
            before |= 1 << f
    return out


def interaction_audit(lists: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row for each part, order of the five filters and step, from the posting lists of all ranges. Only the
    80 sizes of a block are shuffled; 600 rows of orders are joined to the 80 of a part.
    """
    spark = lists.sparkSession
    sums = lists.mapInArrow(_sizes, _SIZES).groupBy("part", "before", "filter").agg(
        *(F.sum(c).alias(c) for c in ("n_rows", "failing", "removed", "good", "toxic"))
    )
    sums = written_table(sums, "sizes")
    steps = spark.createDataFrame(_steps(), "filter_order string, step int, filter bigint, before bigint")
    weight = steps.groupBy("filter", "before").agg(F.count("*").alias("orders"))
    shapley = sums.join(F.broadcast(weight), ["filter", "before"]).groupBy("part", "filter").agg(
        F.sum(F.col("removed") * F.col("orders")).alias("shapley")
    )
    others = (1 << len(FILTERS)) - 1
    alone = sums.where(F.col("before") == others - F.pow(F.lit(2), F.col("filter")).cast("bigint")).select(
        "part", "filter", F.col("removed").alias("unique_fails")
    )
    # kept after a step: all rows less what the steps up to it removed
    before = sums.join(F.broadcast(steps), ["filter", "before"])
    gone = before.groupBy("part", "filter_order").agg(F.sort_array(F.collect_list(F.struct("step", "removed"))).alias("all"))
    upto = F.aggregate(F.filter("all", lambda x: x["step"] <= F.col("step")), F.lit(0).cast("bigint"), lambda s, x: s + x["removed"])
    return (
        before.join(gone, ["part", "filter_order"]).join(shapley, ["part", "filter"]).join(alone, ["part", "filter"])
        .select(
            "part", "filter_order", "step", (F.col("n_rows") - upto).alias("kept"), "removed",
            (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails",
            F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley",
        )
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over whole documents."""
    return interaction_audit(posting_lists(failing_rows(docs), labels))
