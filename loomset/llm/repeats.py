"""Removal of passages that an earlier document has too, by prefix-free parsing.

A document is cut into phrases where a rolling hash triggers. A phrase owns the 50-byte strings that
start in it and carries the 49 bytes after them, so equal phrases hold equal strings, and the parse of a
document is its list of phrases. The dictionary keeps each phrase once, with its first document: in
any later document all strings of the phrase are repeated, which settles copies and long passages without
looking at their bytes again.

What is left are strings that two different phrases of the dictionary share. Each string belongs to the
anchor, the least hash of 16 bytes in it, so equal strings have equal anchors. Strings whose anchor stands
in one document alone are unique. The others meet by their anchor, and there the suffixes of the
dictionary, sorted on their first 50 bytes, stand in the order of the corpus: equal neighbours are one
string, and its first document is the least among them.

An anchor may stand in many contexts, as in a short frequent line; each document then adds strings of its own to it. The
first pass counts them, and the strings of an anchor with more than ``HOT`` meet by the hash of their 50 bytes instead,
one by one, so they are spread over all buckets; there they are compared like the others.

Documents are dealt once into groups of a few MB. A group asks about each phrase and anchor once, however
many of its documents hold it, and each answer goes to the group. So a passage that a third of all
documents share is one short row per group, and no table of all strings is ever formed. The three passes
over the groups read one shuffle of the texts.

Defined cases: a null text is empty; a text of fewer than 50 bytes keeps everything; a row without an id
neither loses bytes nor makes others lose any; rows with the same id do not remove each other's bytes;
other columns are carried along untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loomset.llm.flat import Texts, distinct, hashes, mixed, ragged_range, texts_of, window_hashes
from loomset.llm.tables import Packed, parts_for, text_bytes

WIDTH = 50
GRAM = 16
#: a phrase holds this many strings on average
PHRASE = 128
GROUP_BYTES = 4 << 20
#: more strings than this of one anchor are spread over the buckets
HOT = 1 << 15
_SEGMENT = 1 << 17
_PLACE = np.uint64((1 << 18) - 1)
_SECOND_BASE = 0xC2B2AE3D27D4EB4F


class Parse(NamedTuple):
    """Runs of strings of one anchor within a phrase, and the phrases."""

    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    row: np.ndarray
    phrase: np.ndarray
    phrase_key: np.ndarray
    phrase_check: np.ndarray
    phrase_row: np.ndarray


def parse(texts: Texts, has_id: np.ndarray, width: int = WIDTH) -> Parse:
    data, offsets = texts
    n = len(data) - width + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return Parse(empty, empty, empty.astype(np.uint64), empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty)
    # the strings that lie within a row that has an id
    steps = np.zeros(len(data) + 1, np.int32)
    inside = np.where(has_id, np.maximum(np.diff(offsets) - width + 1, 0), 0)
    np.add.at(steps, offsets[:-1], (inside > 0).astype(np.int32))
    np.add.at(steps, offsets[:-1] + inside, -(inside > 0).astype(np.int32))
    valid = np.cumsum(steps, dtype=np.int32)[:n] > 0
    heads, anchors, triggers = [], [], []
    for low in range(0, n, _SEGMENT):
        high = min(low + _SEGMENT, n)
        grams = window_hashes(data[low : high + width - 1], GRAM)
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        size, over = 1, width - GRAM + 1
        while 2 * size <= over:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if over > size:
            least = np.minimum(least[: size - over], least[over - size :])
        place = (least & _PLACE).astype(np.int64)
        here = valid[low:high]
        trigger = here & (grams[: high - low] % np.uint64(PHRASE) == 0)
        trigger[1:] |= here[1:] & ~here[:-1]
        trigger[0] = here[0] and (low == 0 or not valid[low - 1] or trigger[0])
        head = trigger.copy()
        head[0] = here[0]
        head[1:] |= here[1:] & (place[1:] != place[:-1])
        head = np.flatnonzero(head)
        heads.append(head + low)
        anchors.append(mixed(grams[place[head]]))
        triggers.append(np.flatnonzero(trigger) + low)
    start, anchor, begin = np.concatenate(heads), np.concatenate(anchors), np.concatenate(triggers)
    last = np.flatnonzero(valid & ~np.append(valid[1:], False)) + 1  # ends of the stretches of valid starts
    until = last[np.searchsorted(last, start, "right")] if len(start) else start
    count = np.minimum(np.append(start[1:], n), until) - start
    until = last[np.searchsorted(last, begin, "right")] if len(begin) else begin
    end = np.minimum(np.append(begin[1:], n), until) + width - 1
    key = hashes(data, begin, end)
    check = hashes(data, begin, end, base=_SECOND_BASE)
    row = np.searchsorted(offsets, start, "right") - 1
    return Parse(
        start, count, anchor, row, np.searchsorted(begin, start, "right") - 1, key, check,
        np.searchsorted(offsets, begin, "right") - 1,
    )


class Group(NamedTuple):
    """The rows of a group in a fixed order, so that each pass sees the same numbers."""

    table: pa.Table
    ids: np.ndarray
    texts: Texts
    parsed: Parse


def _group(table: pa.Table, width: int) -> Group:
    table = table.combine_chunks()
    null = table.column("id").is_null().to_numpy(zero_copy_only=False)
    ids = table.column("id").fill_null(0).to_numpy()
    order = np.lexsort((ids, null))
    tied = np.flatnonzero((ids[order][1:] == ids[order][:-1]) & (null[order][1:] == null[order][:-1]))
    if len(tied):
        texts = table.column("text")
        order = np.array(sorted(order.tolist(), key=lambda i: (null[i], ids[i], texts[i].as_py() or "")), np.int64)
    table = table.take(pa.array(order)).combine_chunks()
    column = table.column("text")
    texts = texts_of(column.chunk(0) if column.num_chunks else pa.array([], pa.string()))
    ids, has_id = ids[order], ~null[order]
    return Group(table, ids, texts, parse(texts, has_id, width))


def _flat(column: pa.ChunkedArray, kind) -> np.ndarray:
    """All numbers of a list column in one array."""
    parts = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in column.chunks]
    return np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)


def _by_bucket(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cut)):
        yield int(b), order[cut[b] : cut[b + 1]]


_ASKED = pa.schema([
    ("bucket", pa.int32()), ("g", pa.int32()), ("anchor", pa.list_(pa.int32())), ("place", pa.list_(pa.int32())),
    ("n", pa.list_(pa.int32())), ("key", pa.list_(pa.int64())), ("check", pa.list_(pa.int64())), ("first", pa.list_(pa.int64())),
])
_ASKED_DDL = (
    "bucket int, g int, anchor array<int>, place array<int>, n array<int>, key array<bigint>, check array<bigint>, first array<bigint>"
)
_ANSWER = pa.schema([
    ("g", pa.int32()), ("bucket", pa.int32()), ("anchor", pa.list_(pa.int32())), ("hot", pa.list_(pa.int32())),
    ("key", pa.list_(pa.int64())), ("first", pa.list_(pa.int64())), ("run", pa.list_(pa.int32())), ("firsts", pa.list_(pa.int64())),
])
_ANSWER_DDL = (
    "g int, bucket int, anchor array<int>, hot array<int>, key array<bigint>, first array<bigint>, run array<int>, firsts array<bigint>"
)
_RUNS = pa.schema([
    ("bucket", pa.int32()), ("g", pa.int32()), ("run", pa.list_(pa.int32())), ("count", pa.list_(pa.int32())),
    ("first", pa.list_(pa.int64())), ("bytes", pa.binary()),
])
_RUNS_DDL = "bucket int, g int, run array<int>, count array<int>, first array<bigint>, bytes binary"


def _short(anchor: np.ndarray) -> np.ndarray:
    """32 bits of an anchor; with its bucket they tell anchors apart well enough to rule strings out."""
    return (anchor >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _first_of(values: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows equal in all values: which class each row is in, and the least id of each class."""
    order = np.lexsort((ids, *values))
    new = np.ones(len(ids), bool)
    if len(ids):
        new[1:] = np.any([v[order][1:] != v[order][:-1] for v in values], axis=0)
    number = np.empty(len(ids), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, ids[order][new]


def _ask(buckets: int, width: int):
    """What a group has: its anchors and phrases, each once."""

    def each(table: pa.Table) -> pa.Table:
        group = _group(table, width)
        p = group.parsed
        g = table.column("g")[0].as_py()
        anchor = distinct(p.anchor)
        number, first = _first_of([p.phrase_key, p.phrase_check], group.ids[p.phrase_row])
        key, check = np.empty(len(first), np.uint64), np.empty(len(first), np.uint64)
        key[number], check[number] = p.phrase_key, p.phrase_check
        # strings of each anchor, those of a phrase once; a single run has no more than ``most``
        once = np.empty(len(first), np.int64)
        once[number] = np.arange(len(number))
        counted = np.isin(p.phrase, once)
        strings = np.bincount(np.searchsorted(anchor, p.anchor[counted]), p.count[counted], len(anchor)).astype(np.int64)
        most = width - GRAM + 1
        rows = []
        for b, at in _by_bucket((anchor % np.uint64(buckets)).astype(np.int64), buckets):
            many = np.flatnonzero(strings[at] > most)
            rows.append((b, g, _short(anchor[at]), many, strings[at][many], [], [], []))
        for b, at in _by_bucket((key % np.uint64(buckets)).astype(np.int64), buckets):
            rows.append((b, g, [], [], [], key[at].view(np.int64), check[at].view(np.int64), first[at]))
        return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_ASKED)], schema=_ASKED)

    return each


def _owner(table: pa.Table, column: str) -> np.ndarray:
    """For each number of a list column, the row of the table it stands in."""
    return np.repeat(np.arange(table.num_rows), [n or 0 for n in pc.list_value_length(table.column(column)).to_pylist()])


def _answers(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_ANSWER)], schema=_ANSWER)


def _answer_first(width: int, hot_strings: int):
    """Anchors that several groups have, which of them are hot, and phrases that another group has in an earlier document."""

    def each(table: pa.Table) -> pa.Table:
        groups, bucket = np.array(table.column("g").to_pylist(), np.int64), table.column("bucket")[0].as_py()
        rows = []
        anchor, owner = _flat(table.column("anchor"), np.int32), _owner(table, "anchor")
        _, number, count = np.unique(anchor, return_inverse=True, return_counts=True)
        strings = np.full(len(anchor), width - GRAM + 1)
        begin = np.searchsorted(owner, np.arange(len(groups)))
        strings[begin[_owner(table, "place")] + _flat(table.column("place"), np.int64)] = _flat(table.column("n"), np.int64)
        hot = (np.bincount(number, strings) > hot_strings)[number] if len(anchor) else np.zeros(0, bool)
        shared = count[number] > 1 if len(anchor) else np.zeros(0, bool)
        kept, of, hot = anchor[shared], owner[shared], hot[shared]
        cut = np.searchsorted(of, np.arange(len(groups) + 1))
        for k in np.flatnonzero(np.diff(cut)):
            mine = slice(cut[k], cut[k + 1])
            rows.append((groups[k], bucket, kept[mine], kept[mine][hot[mine]], [], [], [], []))
        key, first, owner = _flat(table.column("key"), np.int64), _flat(table.column("first"), np.int64), _owner(table, "key")
        number, least = _first_of([key, _flat(table.column("check"), np.int64)], first)
        later = least[number] < first if len(key) else np.zeros(0, bool)
        key, least, of = key[later], least[number][later] if len(number) else first, owner[later]
        cut = np.searchsorted(of, np.arange(len(groups) + 1))
        for k in np.flatnonzero(np.diff(cut)):
            rows.append((groups[k], bucket, [], [], key[cut[k] : cut[k + 1]], least[cut[k] : cut[k + 1]], [], []))
        return _answers(rows)

    return each


def _told(group: Group, answers: pa.Table, buckets: int, column: str) -> np.ndarray:
    """Runs whose anchor is in this list of the answers."""
    short = _flat(answers.column(column), np.int32).view(np.uint32).astype(np.uint64)
    if not len(short):
        return np.zeros(len(group.parsed.anchor), bool)
    bucket = np.array(answers.column("bucket").to_pylist(), np.uint64)[_owner(answers, column)]
    table = distinct(short * np.uint64(buckets) + bucket)
    own = (group.parsed.anchor >> np.uint64(32)) * np.uint64(buckets) + group.parsed.anchor % np.uint64(buckets)
    return table[np.minimum(np.searchsorted(table, own), len(table) - 1)] == own


def _live(group: Group, answers: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs whose strings are repeated for their phrase's sake, and runs to be compared string by string."""
    p = group.parsed
    ids = group.ids[p.phrase_row]
    number, first = _first_of([p.phrase_key, p.phrase_check], ids)
    key = _flat(answers.column("key"), np.int64).view(np.uint64)
    if len(key):
        order = np.argsort(key)
        told = _flat(answers.column("first"), np.int64)[order]
        key = key[order]
        place = np.minimum(np.searchsorted(key, p.phrase_key), len(key) - 1)
        least = np.where(key[place] == p.phrase_key, np.minimum(told[place], first[number]), first[number])
    else:
        least = first[number]
    repeated = (least < ids)[p.phrase] if len(p.phrase) else np.zeros(0, bool)
    # anchors of several groups, or of several documents here
    shared = _told(group, answers, buckets, "anchor")
    own_ids = group.ids[p.row]
    class_of, lowest = _first_of([p.anchor], own_ids)
    highest = np.full(len(lowest), np.iinfo(np.int64).min)
    np.maximum.at(highest, class_of, own_ids)
    shared |= (highest > lowest)[class_of]
    return repeated, shared & ~repeated


def _distinct_runs(group: Group, live: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Live runs, the number of the byte string of each among those of the group, and the first id of each."""
    p = group.parsed
    at = np.flatnonzero(live)
    value = hashes(group.texts.data, p.start[at], p.start[at] + p.count[at] + width - 1)
    number, first = _first_of([value, p.anchor[at], p.count[at]], group.ids[p.row[at]])
    return at, number, first


def _ask_strings(buckets: int, width: int):
    """The bytes of the runs that have to be compared, each byte string once, by anchor."""

    def each(table: pa.Table, answers: pa.Table) -> pa.Table:
        group = _group(table, width)
        p = group.parsed
        _, live = _live(group, answers, buckets)
        at, number, first = _distinct_runs(group, live, width)
        one = np.empty(len(first), np.int64)
        one[number] = at
        g = table.column("g")[0].as_py() if table.num_rows else 0
        hot = _told(group, answers, buckets, "hot")[one]
        data, rows = group.texts.data, []
        cool = np.flatnonzero(~hot)
        for b, at in _by_bucket((p.anchor[one[cool]] % np.uint64(buckets)).astype(np.int64), buckets):
            runs = cool[at]
            size = p.count[one[runs]]
            where = ragged_range(p.start[one[runs]], size + width - 1)
            rows.append((b, g, runs, size, first[runs], data[where].tobytes()))
        # a string of a hot anchor goes alone, by its hash; it is told from a run by a number below 0
        size = p.count[one]
        string = ragged_range((np.cumsum(size) - size)[hot], size[hot])
        start, least = ragged_range(p.start[one][hot], size[hot]), np.repeat(first[hot], size[hot])
        order = np.argsort(start)
        string, start, least = string[order], start[order], least[order]
        for b, at in _by_bucket((hashes(data, start, start + width) % np.uint64(buckets)).astype(np.int64), buckets):
            where = ragged_range(start[at], np.full(len(at), width))
            rows.append((b, g, -1 - string[at], np.ones(len(at), np.int64), least[at], data[where].tobytes()))
        return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_RUNS)], schema=_RUNS)

    return each


def _same_strings(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the places, sorted on their first ``width`` bytes, and where a new string begins in it."""
    words = -(-width // 8)
    padded = np.zeros((len(at), 8 * words), np.uint8)
    padded[:, :width] = data[at[:, None] + np.arange(width)]
    columns = padded.view(">u8").astype(np.uint64)
    order = np.lexsort([columns[:, k] for k in range(words - 1, -1, -1)])
    new = np.ones(len(at), bool)
    new[1:] = (columns[order][1:] != columns[order][:-1]).any(axis=1)
    return order, new


def _answer_strings(width: int):
    """The first document of each string that is shared, for the groups whose own first one is later."""

    def each(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        groups, bucket = np.array(table.column("g").to_pylist(), np.int64), table.column("bucket")[0].as_py()
        run, count, first = (_flat(table.column(c), np.int64) for c in ("run", "count", "first"))
        owner = _owner(table, "run")
        data = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("bytes").to_pylist()])
        begin = np.cumsum(count + width - 1) - (count + width - 1)
        at = ragged_range(begin, count)
        of = np.repeat(np.arange(len(run)), count)
        least = first[of]
        # a hash of its own means a string of its own; the others are sorted by their bytes
        value = window_hashes(data, width)[at]
        order = np.argsort(value)
        same = value[order][1:] == value[order][:-1]
        maybe = np.zeros(len(at), bool)
        maybe[order[1:][same]] = maybe[order[:-1][same]] = True
        some = np.flatnonzero(maybe)
        if len(some):
            order, new = _same_strings(data, at[some], width)
            head = np.flatnonzero(new)
            lowest = np.minimum.reduceat(least[some][order], head)
            least[some[order]] = np.repeat(lowest, np.diff(np.append(head, len(order))))
        earlier = np.zeros(len(run), bool)
        np.logical_or.at(earlier, of, least < first[of])
        rows = []
        kept = np.flatnonzero(earlier)
        cut = np.searchsorted(owner[kept], np.arange(len(groups) + 1))
        strings = np.cumsum(count) - count
        for k in np.flatnonzero(np.diff(cut)):
            mine = kept[cut[k] : cut[k + 1]]
            rows.append((groups[k], bucket, [], [], [], [], run[mine], least[ragged_range(strings[mine], count[mine])]))
        return _answers(rows)

    return each


def _whole_characters(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans shrunk so that no character is cut."""
    inside = lambda at: (at < len(data)) & ((data[np.minimum(at, len(data) - 1)] & 0xC0) == 0x80)
    for _ in range(3):
        start = start + inside(start)
        end = end - inside(end)
    return start, np.maximum(end, start)


def _remove(buckets: int, width: int):
    def each(table: pa.Table, answers: pa.Table) -> pa.Table:
        group = _group(table, width)
        p, (data, offsets) = group.parsed, group.texts
        repeated, live = _live(group, answers, buckets)
        at, number, first = _distinct_runs(group, live, width)
        # the first document of each string of each distinct run: the group's own, unless told of an earlier one
        size = np.zeros(len(first), np.int64)
        size[number] = p.count[at]
        begin = np.cumsum(size) - size
        least = np.repeat(first, size)
        run = _flat(answers.column("run"), np.int64)
        if len(run):
            alone, own = run < 0, np.maximum(run, 0)
            where = ragged_range(np.where(alone, -1 - run, begin[own]), np.where(alone, 1, size[own]))
            least[where] = np.minimum(least[where], _flat(answers.column("firsts"), np.int64))
        strings = ragged_range(p.start[at], p.count[at])
        later = least[ragged_range(begin[number], p.count[at])] < np.repeat(group.ids[p.row[at]], p.count[at])
        steps = np.zeros(len(data) + 1, np.int32)
        np.add.at(steps, p.start[repeated], 1)
        np.add.at(steps, p.start[repeated] + p.count[repeated] + width - 1, -1)
        np.add.at(steps, strings[later], 1)
        np.add.at(steps, strings[later] + width, -1)
        covered = np.cumsum(steps[:-1], dtype=np.int32) > 0
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begins, ends = covered.copy(), covered.copy()
        begins[1:] &= ~covered[:-1] | edge[1:-1]
        ends[:-1] &= ~covered[1:] | edge[1:-1]
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        spans = np.diff(np.searchsorted(begins, offsets))
        sums = np.append(0, np.cumsum(covered, dtype=np.int32))
        removed = sums[offsets[1:]] - sums[offsets[:-1]]
        # the text that goes on keeps whole characters
        start, end = _whole_characters(data, begins, ends) if len(begins) else (begins, ends)
        stay = np.ones(len(data), bool)
        stay[ragged_range(start, end - start)] = False
        digests, texts = [], []
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            digests.append(hashlib.sha256(data[a:b][~covered[a:b]].tobytes()).hexdigest())
            texts.append(data[a:b][stay[a:b]].tobytes().decode("utf-8", "replace"))
        null = group.table.column("text").is_null().to_pylist()
        texts = [None if gone_ else text for gone_, text in zip(null, texts)]
        return pa.Table.from_arrays(
            [
                group.table.column("row"), pa.array(np.diff(offsets), pa.int64()), pa.array(removed.astype(np.int64)),
                pa.array(spans, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string()),
            ],
            names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
        )

    return each


_REMOVED = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"


def _removed(docs: DataFrame, width: int = WIDTH, group_bytes: int = GROUP_BYTES, hot_strings: int = HOT) -> tuple[Packed, DataFrame]:
    spark = docs.sparkSession
    size = text_bytes(docs)
    # groups hold a few MB; a bucket answers for two groups' worth of anchors and phrases
    groups = max(2 * spark.sparkContext.defaultParallelism, -(-size // group_bytes))
    buckets = max(2 * spark.sparkContext.defaultParallelism, groups // 2)
    parts = parts_for(spark, size, 4 * group_bytes)
    packed = Packed.of(docs)
    dealt = packed.rows.where("doc_id IS NOT NULL").select(
        F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int").alias("g"), F.col("doc_id").alias("id"), "text", "row",
    ).repartition(parts, "g")
    asked = dealt.groupBy("g").applyInArrow(_ask(buckets, width), _ASKED_DDL)
    known = asked.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_answer_first(width, hot_strings), _ANSWER_DDL)
    strings = dealt.groupBy("g").cogroup(known.groupBy("g")).applyInArrow(_ask_strings(buckets, width), _RUNS_DDL)
    answers = known.unionByName(strings.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_answer_strings(width), _ANSWER_DDL))
    made = StructType([packed.field, *StructType.fromDDL(_REMOVED).fields])
    removed = dealt.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(_remove(buckets, width), made)
    # a row without an id neither loses nor removes anything, and so has no need to meet others
    text = F.coalesce("text", F.lit(""))
    rest = packed.rows.where("doc_id IS NULL").select(
        "row", F.octet_length(text).cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"), F.col("text").alias("kept_text"),
    )
    return packed, removed.unionByName(rest)


def repeated_passages(docs: DataFrame, **settings) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept_sha256, kept_text) for each document.

    ``row`` holds the columns of the document. A byte is removed if a string of ``width`` bytes that
    covers it also starts in a document with a smaller doc_id. ``kept_sha256`` is of the bytes that are
    left; ``kept_text`` is the text without the removed spans, where a character that a span would cut stays.
    """
    packed, found = _removed(docs, **settings)
    return found.withColumn("row", packed.named())


def without_repeats(docs: DataFrame, **settings) -> DataFrame:
    """The documents with their repeated passages removed, with all their columns; n_chars follows the text."""
    packed, found = _removed(docs, **settings)
    out = packed.unpacked(found, "kept_text")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
