"""Benchmark decontamination: test suffixes looked up in suffix arrays of the training texts.

Each Arrow slice of documents is a shard. Its words become ids of the benchmark's vocabulary, its
suffixes are sorted on their first words, and every benchmark suffix is found by binary search. A
window is ``width`` consecutive words of an item; an item of fewer words, but not none, is one window.
The documents are not shuffled. The benchmark is shipped in blocks of bounded size.

Defined cases: a null or wordless text has no words and is clean; an item with a null or wordless
text matches nothing; an item with a text and no id is searched like any other, its matches have a null item_id, and only
the list of items leaves it out; a row without an id is judged like any other; repeated rows give repeated results; other
columns are not read. A match ends at the end of its document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from loomset.llm.flat import LETTER_OR_DIGIT, Texts, hashes, lowered, ragged_range, slices, texts_of, words_of
from loomset.llm.tables import Packed, text_bytes, text_rows, written_table

WIDTH = 10
BLOCK_BYTES = 4 << 20
#: meetings of a place of a text and a benchmark item that are held at once, unless one text has more
MEETINGS = 1 << 20

_MATCH = "struct<item_id:bigint,doc_word:bigint,item_word:bigint,n_words:bigint>"
_FOUND = f"n_words bigint, hit array<bigint>, matches array<{_MATCH}>"
_ARROW_MATCH = pa.struct([(n, pa.int64()) for n in ("item_id", "doc_word", "item_word", "n_words")])
_ARROW_FOUND = [("n_words", pa.int64()), ("hit", pa.list_(pa.int64())), ("matches", pa.list_(_ARROW_MATCH))]


def _suffix_keys(ids: np.ndarray, at: np.ndarray, until: np.ndarray, width: int) -> np.ndarray:
    """The first ``width`` word ids from each place, as byte strings in their order; 0 from the first unknown word on."""
    key = np.zeros((len(at), width), ">u4")
    alive = np.ones(len(at), bool)
    for k in range(width):
        place = at + k
        alive &= place < until
        word = ids[np.where(alive, place, 0)]
        alive &= word > 0
        key[:, k] = np.where(alive, word, 0)
    return np.ascontiguousarray(key).view(f"S{4 * width}").ravel()


class TestSuffixes:
    """The windows of one block of benchmark items: distinct window keys, and where each stands."""

    __test__ = False

    def __init__(self, rows: list[tuple[int | None, str]], width: int = WIDTH):
        self.width = width
        # items by their place in this list, those without an id at the last
        self.ids = [*sorted({i for i, _ in rows if i is not None}), None]
        place = {i: k for k, i in enumerate(self.ids)}
        texts = lowered(texts_of(pa.array([text for _, text in rows], pa.large_string())))
        words = words_of(texts, LETTER_OR_DIGIT)
        self.vocabulary, ids = np.unique(hashes(texts.data, words.start, words.end), return_inverse=True)
        ids = ids.astype(np.int64) + 1
        count = np.diff(words.first)
        windows = np.where(count >= width, count - width + 1, np.minimum(count, 1))
        item = np.repeat(np.arange(len(rows)), windows)
        at = ragged_range(words.first[:-1], windows)
        length = np.minimum(count, width)[item]
        keys = _suffix_keys(ids, at, at + length, width)
        self.keys, inverse = np.unique(keys, return_inverse=True)
        by_key = np.argsort(inverse, kind="stable")
        self.key_first = np.searchsorted(inverse[by_key], np.arange(len(self.keys) + 1))
        self.item = np.array([place[i] for i, _ in rows], np.int64)[item[by_key]] if len(rows) else np.zeros(0, np.int64)
        self.item_word = (at - words.first[item])[by_key]
        self.length = np.zeros(len(self.keys), np.int64)
        self.length[inverse] = length
        # a key of fewer words is a prefix: the strings that start with it end before this one
        tops = self.keys.copy().view(np.uint8).reshape(len(self.keys), 4 * width) if len(self.keys) else np.zeros((0, 4 * width), np.uint8)
        tops[np.arange(4 * width)[None, :] >= 4 * self.length[:, None]] = 0xFF
        self.tops = np.ascontiguousarray(tops).view(f"S{4 * width}").ravel()
        # a suffix can only match if it starts as some window starts
        first = ids[at] if len(at) else at
        pair = np.where(length > 1, ids[np.minimum(at + 1, max(len(ids) - 1, 0))], 0) if len(at) else at
        self.single = np.unique(first[length == 1])
        self.pairs = np.unique((first * (len(self.vocabulary) + 1) + pair)[length > 1])

    def word_ids(self, values: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(values), np.int64)
        place = np.minimum(np.searchsorted(self.vocabulary, values), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[place] == values, place + 1, 0)

    def starts(self, ids: np.ndarray, until: np.ndarray) -> np.ndarray:
        """Places of the shard at which a window may begin."""
        following = np.append(ids[1:], 0)
        following[np.arange(1, len(ids) + 1) >= until] = 0
        known = np.flatnonzero(ids)
        pair = ids[known] * (len(self.vocabulary) + 1) + following[known]
        hit = np.zeros(len(known), bool)
        if len(self.pairs):
            hit = self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] == pair
        if len(self.single):
            hit |= np.isin(ids[known], self.single)
        return known[hit]


def _matches(test: TestSuffixes, texts: Texts, with_items: bool = True, most: int | None = None):
    """Words of each row, hit words as (row, word), and the longest match of each (row, item).

    The last is empty if not asked for, and None if it takes more than ``most`` meetings of a place and an item.
    """
    words = words_of(texts, LETTER_OR_DIGIT)
    n_words = np.diff(words.first)
    ids = test.word_ids(hashes(texts.data, words.start, words.end))
    row_of = np.repeat(np.arange(len(n_words)), n_words)
    until = words.first[1:][row_of]
    nothing = n_words, np.zeros((0, 2), np.int64), np.zeros((0, 5), np.int64)
    at = test.starts(ids, until) if len(ids) else np.zeros(0, np.int64)
    if not len(at):
        return nothing
    keys = _suffix_keys(ids, at, until[at], test.width)
    order = np.argsort(keys, kind="stable")
    array = keys[order]
    low = np.searchsorted(array, test.keys, "left")
    count = np.searchsorted(array, test.tops, "right") - low
    found = np.flatnonzero(count > 0)
    if not len(found):
        return nothing
    key = np.repeat(found, count[found])
    place = at[order[ragged_range(low[found], count[found])]]
    span = test.length[key]
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, place, 1)
    np.add.at(cover, place + span, -1)
    hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    hit = np.stack([row_of[hit], hit - words.first[row_of[hit]]], axis=1)
    if not with_items:
        return n_words, hit, nothing[2]
    if most is not None and (count[found] * (test.key_first[found + 1] - test.key_first[found])).sum() > most:
        return n_words, hit, None
    # chains of windows that go on word by word in document and item are one longer match
    repeat = test.key_first[key + 1] - test.key_first[key]
    source = ragged_range(test.key_first[key], repeat)
    item, item_word = test.item[source], test.item_word[source]
    place, span = np.repeat(place, repeat), np.repeat(span, repeat)
    row = row_of[place]
    doc_word = place - words.first[row]
    by = np.lexsort((doc_word, doc_word - item_word, item, row))
    row, item, doc_word, item_word, span = (x[by] for x in (row, item, doc_word, item_word, span))
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (doc_word[1:] != doc_word[:-1] + 1) | (item_word[1:] != item_word[:-1] + 1)
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(row))) - 1 + span[begin]
    row, item, doc_word, item_word = (x[begin] for x in (row, item, doc_word, item_word))
    by = np.lexsort((item_word, doc_word, -length, item, row))
    row, item, doc_word, item_word, length = (x[by] for x in (row, item, doc_word, item_word, length))
    longest = np.ones(len(row), bool)
    longest[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    table = np.stack([row, item, doc_word, item_word, length], axis=1)[longest]
    return n_words, hit, table


def _runs(words: np.ndarray) -> list[int]:
    """Ascending word numbers as start, end, start, end, ..."""
    cut = np.flatnonzero(np.diff(words) != 1)
    return np.stack([words[np.append(0, cut + 1)], words[np.append(cut, len(words) - 1)] + 1], axis=1).ravel().tolist()


def _joined(a: list[int], b: list[int]) -> list[int]:
    """Two lists of runs as one."""
    out: list[int] = []
    for start, end in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _search(test: TestSuffixes, names: list[str], with_items: bool):
    item_ids = pa.array(test.ids, pa.int64())

    def search(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n_words, hit, table = _matches(test, lowered(texts_of(part.column("text"))), with_items, MEETINGS if part.num_rows > 1 else None)
        if table is None:
            half = part.num_rows // 2
            yield from search(part.slice(0, half))
            yield from search(part.slice(half))
            return
        cut = np.searchsorted(hit[:, 0], np.arange(len(n_words) + 1))
        spans = [_runs(hit[a:b, 1]) if b > a else [] for a, b in zip(cut[:-1], cut[1:])]
        values = [item_ids.take(pa.array(table[:, 1])), *(pa.array(table[:, k]) for k in (2, 3, 4))]
        first = pa.array(np.searchsorted(table[:, 0], np.arange(len(n_words) + 1)), pa.int32())
        found = pa.ListArray.from_arrays(first, pa.StructArray.from_arrays(values, fields=list(_ARROW_MATCH)))
        if "hit" in part.schema.names:
            spans = [_joined(a, b) for a, b in zip(part.column("hit").to_pylist(), spans)]
            found = pa.array([a + b for a, b in zip(part.column("matches").to_pylist(), found.to_pylist())], found.type)
        yield pa.RecordBatch.from_arrays(
            [part.column(n) for n in names] + [pa.array(n_words), pa.array(spans, pa.list_(pa.int64())), found],
            schema=pa.schema([part.schema.field(n) for n in names] + [pa.field(n, t) for n, t in _ARROW_FOUND]),
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, size=16 << 20):
            yield from search(part)

    return each


def _matched(rows: DataFrame, kept: list[StructField], benchmark: DataFrame, width: int, block_bytes: int, with_items: bool = True) -> DataFrame:
    """The columns ``kept`` of rows with a text, and what is found in the text."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where(
        "text IS NOT NULL"
    )
    blocks = max(1, -(-text_bytes(items) // block_bytes))
    names, text, found = [f.name for f in kept], StructField("text", StringType()), StructType.fromDDL(_FOUND).fields
    for k in range(blocks):
        block = [(r[0], r[1]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()]
        more = [text] if k < blocks - 1 and "text" not in names else []
        rows = rows.mapInArrow(_search(TestSuffixes(block, width), [*names, *(f.name for f in more)], with_items), StructType([*kept, *more, *found]))
        if k < blocks - 1:
            rows = written_table(rows, "benchmark-matches")
    return rows


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, hit, matches) for each document.

    ``hit`` lists the runs of words inside a window as start, end, start, end, ...; ``matches`` holds
    the longest verbatim match with each item whose windows occur, and where it begins in both.
    Items are sent to the tasks in blocks of about ``block_bytes``; with more than one block the
    documents are written to the shared folder between blocks.
    """
    return _matched(text_rows(docs), [StructField("doc_id", LongType())], benchmark, width, block_bytes)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns and without a shuffle."""
    packed = Packed.of(docs)
    found = _matched(packed.rows.select("row", "text"), [packed.field, StructField("text", StringType())], benchmark, width, block_bytes, False)
    return packed.unpacked(found.where(F.size("hit") == 0))


def contamination_report(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, longest_match (words)."""
    found = benchmark_matches(docs, benchmark, **settings)
    n_hit = F.expr("aggregate(transform(hit, (x, i) -> IF(i % 2 = 0, -x, x)), 0L, (s, x) -> s + x)")
    items = F.expr("array_sort(array_distinct(transform(filter(matches, m -> m.item_id IS NOT NULL), m -> CAST(m.item_id AS STRING))))")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (F.size("hit") > 0).alias("contaminated"),
        F.expr("coalesce(array_max(transform(matches, m -> m.n_words)), 0L)").alias("longest_match"),
    )


def items_digest(items: list[int]) -> str:
    """What items_sha256 holds for these items."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
