"""Language-model scores of whole documents: word counts of the corpus and causal self-attention.

The base score uses the counts of all training words. The model's score of a word mixes the chance the
counts give it, one share for unknown words included, with the chance that the attention model of
:mod:`loomset.llm.attention` gives its subwords, ending where the next word begins. The counts of words, of tokens
and of tokens after tokens cover all training documents. The attention model starts from a fit on the driver, on a
sample of at most twice ``sample_bytes`` drawn by document. From there every partition goes on with windows of all
its training documents, and the changes are averaged, so text and steps grow with the input.

Every text is encoded once and written as ids, which all later passes read. Rows are dealt into groups of a few MB of
text. A group asks for the counts of its distinct words, by
64-bit hash, and of its distinct token pairs, and gets its answers as lists in the order of its questions; so a word of
every document is one entry per group, and the words of the corpus are never in one place.

Defined cases: a null or empty text is its end alone; rows without an id train; a word never seen in
training has count 0; repeated rows count as often as they stand there; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm import attention, flat
from loomset.llm.flat import NOT_SPACE, lowered, mixed, ragged_range, run_sums, slices, texts_of, word_hashes, words_of
from loomset.llm.tables import parts_for, text_bytes, text_rows, written_table

GROUP_BYTES = 4 << 20
SAMPLE_BYTES = 4 << 20
#: weight of the counts against the subwords; of 0.9, 0.5 and 0.3 it gives held-out texts the best score
CORPUS_WEIGHT = 0.5
#: speed of that training, lower than the start's as the model is near its place
RATE = 0.003
_ROWS_OF_WEIGHTS = 512
#: words, and ids of words, that a worker keeps at most from slice to slice
_KNOWN_WORDS, _KNOWN_IDS = 1 << 19, 1 << 22


class Subwords:
    """Ids of words, each with a space before it, from a byte-level BPE rank file."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks, self.pattern = ranks, pattern

    def _made(self) -> _Made:
        """Encoder and known words, made once for a worker process; of one rank file at a time."""
        key = (self.ranks, self.pattern)
        if key not in _MADE:
            _MADE.clear()
            _MADE[key] = _Made(self)
        return _MADE[key]

    @property
    def _encoder(self):
        return self._made().encoder

    def pieces(self) -> dict[bytes, int]:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.ranks.splitlines()) if a}

    def begins_word(self) -> np.ndarray:
        """Which tokens begin with a space."""
        pieces = self.pieces()
        out = np.zeros(max(pieces.values()) + 1, bool)
        out[[i for p, i in pieces.items() if p[:1] == b" "]] = True
        return out

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        # words without white space of any script never share a piece with their neighbours, so they go through together;
        # each begins with the token that holds its space
        odd = [i for i, w in enumerate(words) if len(w.split()) != 1] if len(" ".join(words).split()) != len(words) else []
        strange = set(odd)
        plain = [w for i, w in enumerate(words) if i not in strange] if odd else words
        ids = np.array(self._encoder.encode_ordinary(" " + " ".join(plain)) if plain else [], np.int64)
        begin = np.flatnonzero(self._made().begins[ids])
        if len(begin) != len(plain):
            raise ValueError("the pattern joins words")
        if not odd:
            return ids, np.append(begin, len(ids))
        own = {i: self._encoder.encode_ordinary(" " + words[i]) for i in odd}
        parts, at = [], iter(np.split(ids, begin[1:]) if len(plain) else [])
        for i in range(len(words)):
            parts.append(np.array(own[i], np.int64) if i in strange else next(at))
        return np.concatenate(parts), np.append(0, np.cumsum([len(x) for x in parts])).astype(np.int64)

    def encode_new(self, value: np.ndarray, spelled: Callable[[np.ndarray], list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`encode`, of words by ascending hashes; only those not known from before are spelled, by their places."""
        return self._made().known.of(value, lambda new: self.encode(spelled(new)))


class _Made:
    """An encoder, which of its tokens begin a word, and the words it met."""

    def __init__(self, words: Subwords):
        import tiktoken

        self.encoder = tiktoken.Encoding("subwords", pat_str=words.pattern, mergeable_ranks=words.pieces(), special_tokens={})
        self.begins, self.known = words.begins_word(), _Known()


_MADE: dict[tuple[bytes, str], _Made] = {}


class _Known:
    """Ids of words by the words' hashes. Where they would be too many, only the last slice's are kept."""

    def __init__(self):
        self._forget()

    def _forget(self) -> None:
        self.value, self.start, self.count, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _keep(self, value: np.ndarray, start: np.ndarray, count: np.ndarray, ids: np.ndarray) -> bool:
        fits = len(value) <= _KNOWN_WORDS and len(ids) <= _KNOWN_IDS
        if fits:
            self.value, self.start, self.count, self.ids = value, start, count, ids
        return fits

    def of(self, value: np.ndarray, encode: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given by ascending hashes, and their ranges; ``encode`` gets the places of new ones."""
        at = np.searchsorted(self.value, value)
        old = np.append(self.value, np.uint64(0))[at] == value
        old &= at < len(self.value)
        new = np.flatnonzero(~old)
        ids, first = encode(new)
        ids = np.append(self.ids, ids.astype(np.uint32))
        start, count = np.empty(len(value), np.int64), np.empty(len(value), np.int64)
        start[old], start[new] = self.start[at[old]], first[:-1] + len(self.ids)
        count[old], count[new] = self.count[at[old]], np.diff(first)
        own = ids[ragged_range(start, count)]
        ranges = np.append(0, np.cumsum(count))
        place = at[new]
        both = [np.insert(a, place, b[new]) for a, b in ((self.value, value), (self.start, start), (self.count, count))]
        if not self._keep(*both, ids) and not self._keep(value, ranges[:-1], count, own):
            self._forget()
        return own.astype(np.int64), ranges


class _Read:
    """Words of some rows, and which of the distinct words each is."""

    def __init__(self, column: pa.Array):
        self.texts = lowered(texts_of(column))
        self.words = words_of(self.texts, NOT_SPACE)
        self.value, self.at, self.number = _apart(word_hashes(self.texts, self.words))

    def subwords(self, encoder: Subwords) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct words, and their ranges."""
        return encoder.encode_new(self.value, self._spelled)

    def _spelled(self, places: np.ndarray) -> list[str]:
        """Some of the distinct words."""
        start = self.words.start[self.at[places]]
        size = self.words.end[self.at[places]] - start
        # a space before each; no word holds one
        joined = np.full(int(size.sum()) + len(places), 0x20, np.uint8)
        joined[ragged_range(np.cumsum(size + 1) - size, size)] = self.texts.data[ragged_range(start, size)]
        return joined.tobytes().decode().split(" ")[1:]

    def streams(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words in order, where each word begins among them, and the ranges of the rows."""
        count = np.diff(first)[self.number]
        begin = np.append(0, np.cumsum(count))
        return ids[ragged_range(first[:-1][self.number], count)], begin, begin[self.words.first]


_CODED_DDL = "doc_id bigint, held_out boolean, salt bigint, ids binary, sizes binary"


def _encode(encoder: Subwords, wide: bool):
    """Each text as the ids of its subwords and the number of them in each word, in a byte; 255 goes on in the next byte."""
    kind = np.uint32 if wide else np.uint16

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId() if TaskContext.get() else 0, 0
        # the larger a slice, the fewer words are spelled again
        for part in slices(batches, size=8 << 20):
            read = _Read(part.column("text"))
            ids, begin, first = read.streams(*read.subwords(encoder))
            whole, rest = np.divmod(np.diff(begin), 255)
            more = np.append(0, np.cumsum(whole + 1))
            sizes = np.full(int(more[-1]), 255, np.uint8)
            sizes[more[1:] - 1] = rest
            # what a row without an id is dealt by, written with it and so the same ever after
            salt = flat.mixed(np.arange(done, done + part.num_rows, dtype=np.uint64) + (np.uint64(task) << np.uint64(40)))
            done += part.num_rows
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(salt.view(np.int64)), _binary(ids.astype(kind), first), _binary(sizes, more[read.words.first])],
                names=["doc_id", "held_out", "salt", "ids", "sizes"],
            )

    return each


def _binary(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """The values of each row as bytes."""
    ends = (first * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())])


class _Coded:
    """Encoded rows: all ids, where each word begins among them, the rows' ranges of words and ids, and the distinct words."""

    def __init__(self, ids: pa.Array, sizes: pa.Array, wide: bool, with_words: bool = True):
        data, at = texts_of(ids)
        width = 4 if wide else 2
        self.ids = data.view(np.uint32 if wide else np.uint16).astype(np.int64)
        self.first = at // width
        count, place = texts_of(sizes)
        ends = np.flatnonzero(count < 255)
        self.begin = np.append(0, np.cumsum(count, dtype=np.int64)[ends])
        self.first_word = np.searchsorted(ends, place)
        if with_words:
            # equal words have equal ids
            value = flat.hashes(data, self.begin[:-1] * width, self.begin[1:] * width)
            self.value, _, self.number = _apart(value)

    @classmethod
    def of(cls, table: pa.Table, wide: bool) -> _Coded:
        return cls(_column(table, "ids"), _column(table, "sizes"), wide)


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        return column.chunk(0) if column.num_chunks else pa.array([], column.type)
    return column


def _asked(group: _Coded, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """The distinct words of a group by bucket, each list in the order of the hashes."""
    bucket = (group.value % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cut)):
        yield int(b), order[cut[b] : cut[b + 1]]


_QUESTIONS = pa.schema([
    ("bucket", pa.int32()), ("g", pa.int32()), ("word", pa.list_(pa.int64())), ("n", pa.list_(pa.int32())),
    ("pair", pa.list_(pa.int64())), ("m", pa.list_(pa.int32())),
])
_QUESTIONS_DDL = "bucket int, g int, word array<bigint>, n array<int>, pair array<bigint>, m array<int>"
_ANSWERS = pa.schema([
    ("g", pa.int32()), ("bucket", pa.int32()), ("c", pa.list_(pa.int64())), ("known", pa.int64()), ("total", pa.int64()),
    ("together", pa.list_(pa.int64())), ("seen", pa.list_(pa.int64())),
])
_ANSWERS_DDL = "g int, bucket int, c array<bigint>, known bigint, total bigint, together array<bigint>, seen array<bigint>"


def _before(ids: np.ndarray, first: np.ndarray, tokens: int) -> np.ndarray:
    """The token before each, the vocabulary's size at the start of a text."""
    before = np.append(tokens, ids)[:-1]
    before[first[:-1][np.diff(first) > 0]] = tokens
    return before


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, ascending, and which of them each key is; as np.unique, by one sort of keys with their places."""
    bits = max(len(keys) - 1, 1).bit_length()
    if not len(keys) or int(keys.max()) >> (63 - bits):
        return np.unique(keys, return_inverse=True)
    packed = keys << bits
    packed |= np.arange(len(keys))
    packed.sort()
    place = packed & ((1 << bits) - 1)
    packed >>= bits
    new = np.ones(len(packed), bool)
    new[1:] = packed[1:] != packed[:-1]
    number = np.empty(len(keys), np.int64)
    number[place] = np.cumsum(new) - 1
    return packed[new], number


def _apart(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different hashes, ascending, a place of each, and which of them each is; by one sort of first bits with places."""
    places = np.uint64((1 << max(len(hashes) - 1, 1).bit_length()) - 1)
    packed = hashes & ~places
    packed |= np.arange(len(hashes), dtype=np.uint64)
    packed.sort()
    packed &= places
    order = packed.view(np.int64)
    ordered = hashes[order]
    if (ordered[1:] < ordered[:-1]).any():  # some differ in their last bits only
        order = np.argsort(hashes)
        ordered = hashes[order]
    head, run = _runs(ordered)
    number = np.empty(len(hashes), np.int64)
    number[order] = run
    return ordered[head], order[head], number


def _pairs_asked(keys: np.ndarray, vocabulary: attention.Vocabulary, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """The distinct pairs of a group by bucket, ascending; a token and a class after it are in one bucket."""
    bucket = (mixed(vocabulary.contexts(keys).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cut)):
        yield int(b), order[cut[b] : cut[b + 1]]


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and the run of each value."""
    new = np.append(True, sorted_values[1:] != sorted_values[:-1])[: len(sorted_values)]
    return np.flatnonzero(new), np.cumsum(new) - 1


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _ask(buckets: int, wide: bool, vocabulary: attention.Vocabulary):
    def each(table: pa.Table) -> pa.Table:
        group = _Coded.of(table, wide)
        trains = ~_column(table, "held_out").to_numpy(zero_copy_only=False)
        weight = np.repeat(trains, np.diff(group.first_word))
        count = np.bincount(group.number, weight, len(group.value)).astype(np.int64)
        g = table.column("g")[0].as_py()
        asked = {b: (group.value[at].view(np.int64), count[at]) for b, at in _asked(group, buckets)}
        ids, first = group.ids, group.first
        keys, number = _distinct(vocabulary.keys(_before(ids, first, len(vocabulary.klass)), ids))
        count = np.bincount(number, np.repeat(trains, np.diff(first)), len(keys)).astype(np.int64)
        pairs = {b: (keys[at], count[at]) for b, at in _pairs_asked(keys, vocabulary, buckets)}
        none = ([], [])
        return _table([(b, g, *asked.get(b, none), *pairs.get(b, none)) for b in sorted({*asked, *pairs})], _QUESTIONS)

    return each


def _summed(table: pa.Table, what: str, count: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different values of a list column and their sums, which one each asked value is, and the ranges of the rows."""
    asked, n = _column(table, what), _column(table, count).flatten().to_numpy()
    cut = asked.offsets.to_numpy() - asked.offsets[0].as_py()
    value, number = np.unique(asked.flatten().to_numpy(), return_inverse=True)
    return value, np.bincount(number, n, len(value)).astype(np.int64), number, cut


def _answer(vocabulary: attention.Vocabulary):
    """Counts over all groups, to each group in the order it asked; the first row also has the bucket's totals."""

    def each(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        _, total, number, cut = _summed(table, "word", "n")
        keys, together, pair, ends = _summed(table, "pair", "m")
        head, context = _runs(vocabulary.contexts(keys))
        seen = np.add.reduceat(together, head) if len(head) else together
        bucket = table.column("bucket")[0].as_py()
        groups = table.column("g").to_pylist()
        facts = [(int((total > 0).sum()), int(total.sum()))] + [(0, 0)] * (len(groups) - 1)
        rows = []
        for k, g in enumerate(groups):
            mine = pair[ends[k] : ends[k + 1]]
            own = context[mine]  # told once for each token and class
            rows.append((g, bucket, total[number[cut[k] : cut[k + 1]]], *facts[k], together[mine], seen[own[_runs(own)[0]]]))
        return _table(rows, _ANSWERS)

    return each


def _token_counts(tokens: int, wide: bool):
    """How often each token stands in the texts; the number of texts as token -1."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(tokens, np.int64), 0
        for part in batches:
            total += np.bincount(texts_of(part.column("ids")).data.view(np.uint32 if wide else np.uint16), minlength=tokens)
            rows += part.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, at)), pa.array(np.append(rows, total[at]))], names=["token", "n"])

    return each


_CHANGES = "name string, part int, n binary, change binary"


def _go_on(wide: bool, model: attention.Model, vocabulary: attention.Vocabulary, batch: int = 128):
    """The model trained further on a partition's texts: the change of each row of weights, and its number of windows."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, windows = attention.Model.__new__(attention.Model), 0
        own.weights = {k: v.copy() for k, v in model.weights.items()}
        for part in slices(batches, "ids"):
            coded = _Coded(part.column("ids"), part.column("sizes"), wide, with_words=False)
            ids, first = coded.ids, coded.first
            if len(ids):
                here = int((np.diff(first) // attention.STRIDE + 1).sum())
                attention.train(ids, first, vocabulary, steps=-(-here // batch), batch=batch, rate=RATE, seed=windows + 1, model=own)
                windows += here
        if windows:
            rows = []
            for name, now in own.weights.items():
                change = (now - model.weights[name]).reshape(len(now), -1)
                n = np.where((change != 0).any(axis=1), windows, 0).astype(np.float64)
                for k, low in enumerate(range(0, len(now), _ROWS_OF_WEIGHTS)):
                    at = slice(low, low + _ROWS_OF_WEIGHTS)
                    if n[at].any():
                        rows.append((name, k, n[at].tobytes(), change[at].astype(np.float32).tobytes()))
            kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["name", "part", "n", "change"]
            )

    return each


def _averaged(table: pa.Table) -> pa.Table:
    """The mean change of each row of weights over the partitions that changed it, by their windows."""
    total = change = 0.0
    for n, own in zip(table.column("n").to_pylist(), table.column("change").to_pylist()):
        n = np.frombuffer(n, np.float64)
        total = total + n
        change = change + np.frombuffer(own, np.float32).reshape(len(n), -1) * n[:, None]
    mean = (change / np.maximum(total, 1)[:, None]).astype(np.float32)
    return pa.table({
        "name": table.column("name").slice(0, 1), "part": table.column("part").slice(0, 1),
        "n": pa.array([total.tobytes()]), "change": pa.array([mean.tobytes()]),
    })


def trained_on(train_ids: DataFrame, wide: bool, model: attention.Model, vocabulary: attention.Vocabulary) -> attention.Model:
    """The model after every partition of ``train_ids`` (ids, sizes) went on with it and the changes were averaged, in two levels."""
    changes = train_ids.select("ids", "sizes").mapInArrow(_go_on(wide, model, vocabulary), _CHANGES)
    out = attention.Model.__new__(attention.Model)
    out.weights = {k: v.copy() for k, v in model.weights.items()}
    some = changes.withColumn("some", F.pmod(F.spark_partition_id(), F.lit(64))).groupBy("name", "part", "some").applyInArrow(_averaged, _CHANGES)
    for r in some.groupBy("name", "part").applyInArrow(_averaged, _CHANGES).collect():
        rows = out.weights[r["name"]][r["part"] * _ROWS_OF_WEIGHTS :][:_ROWS_OF_WEIGHTS]
        rows += np.frombuffer(r["change"], np.float32).reshape(rows.shape)
    return out


_SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)


def _score(buckets: int, wide: bool, model: attention.Model, vocabulary: attention.Vocabulary, ends: int, weight: float):
    def each(table: pa.Table, answers: pa.Table) -> pa.Table:
        group = _Coded.of(table, wide)
        given = dict(zip(answers.column("bucket").to_pylist(), range(answers.num_rows)))
        lists, together, seen = (_column(answers, c) for c in ("c", "together", "seen"))
        count = np.zeros(len(group.value), np.int64)
        for b, at in _asked(group, buckets):
            count[at] = lists[given[b]].values.to_numpy()
        count = count[group.number]
        words = group.first_word
        rows = len(words) - 1
        total, different = answers.column("all_tokens")[0].as_py(), answers.column("all_distinct")[0].as_py()
        floor = np.log10(total + different + 1.0)
        base = np.log10(count + 1.0) - floor
        end = np.log10(ends + 1.0) - floor
        known = run_sums((count > 0).astype(np.int64), words) + int(ends > 0)
        ids, begin, first = group.ids, group.begin, group.first
        before = _before(ids, first, len(vocabulary.klass))
        keys, number = _distinct(vocabulary.keys(before, ids))
        pairs = np.zeros((2, len(keys)), np.int64)
        for b, at in _pairs_asked(keys, vocabulary, buckets):
            pairs[0, at] = together[given[b]].values.to_numpy()
            pairs[1, at] = seen[given[b]].values.to_numpy()[_runs(vocabulary.contexts(keys[at]))[1]]
        shares = vocabulary.shares(before, ids, pairs[0, number], pairs[1, number])
        token, starts = attention.token_scores(model, vocabulary, ids, first, shares=shares)
        # positions of a row: its tokens, then its end
        shift = np.repeat(np.arange(rows), np.diff(words))
        place = begin[:-1] + shift
        sums = np.append(0.0, np.cumsum(token))
        after = begin[1:] + shift
        spelled = sums[after] - sums[place] - starts[place] + starts[after]
        # an end is no word and has its count alone; ln to log10
        ln10 = np.log(10)
        mixed = np.logaddexp(np.log(weight) + base * ln10, np.log1p(-weight) + spelled) / ln10
        return pa.table(
            {
                "doc_id": table.column("doc_id"), "held_out": table.column("held_out"), "n_tokens": pa.array(np.diff(words) + 1),
                "n_known": pa.array(known), "train_tokens": pa.array(np.full(rows, total)),
                "base_score": pa.array(run_sums(base, words) + end), "score": pa.array(run_sums(mixed, words) + end),
            }
        )

    return each


def _draw(seed: str):
    """A number from 0 to 1 for each document, by its id; by the text for a row without one."""
    key = F.xxhash64(F.lit(seed), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    return F.pmod(key, F.lit(1 << 40)) / float(1 << 40)


def training_sample(train: DataFrame, sample_bytes: int, size: int) -> list[str]:
    """Texts drawn by document, each document once; at most twice ``sample_bytes`` of them, or the first drawn one."""
    drawn = train.where("text IS NOT NULL").withColumn("at", _draw("sample")).where(F.col("at") < sample_bytes / max(size, 1))
    sizes = drawn.groupBy("at").agg(F.max(F.octet_length("text")).alias("size")).orderBy("at").limit(sample_bytes // 32 + 1).collect()
    if not sizes:
        return []
    sums = np.cumsum([r["size"] for r in sizes])
    last = sizes[max(int(np.searchsorted(sums, 2 * sample_bytes, "right")), 1) - 1]["at"]
    return [r["text"] for r in drawn.where(F.col("at") <= last).groupBy("at").agg(F.min("text").alias("text")).orderBy("at").collect()]


def language_model_scores(
    docs: DataFrame, ranks_path: str, pattern: str, folds: int = 7, held_fold: int = 2, sample_bytes: int = SAMPLE_BYTES,
    corpus_weight: float = CORPUS_WEIGHT, steps: int = 800, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each document, scores in log10.

    Documents with crc32(doc_id) mod ``folds`` = ``held_fold`` are held out of all training. Tokens are
    white-space words, lower-cased A-Z, and one end per text.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as file:
        encoder = Subwords(file.read(), pattern)
    size = text_bytes(docs)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held_fold, F.lit(False))
    rows = text_rows(docs).select("doc_id", F.col("text"), held.alias("held_out"))

    # every text is encoded once; what follows reads ids
    begins = encoder.begins_word()
    tokens = len(begins)
    wide = tokens > 1 << 16
    coded = written_table(rows.mapInArrow(_encode(encoder, wide), _CODED_DDL), "ids")
    train, train_ids = rows.where("NOT held_out"), coded.where("NOT held_out")

    # tokens of all training documents, and how many ends train
    counts, ends = np.zeros(tokens, np.int64), 0
    counted = train_ids.select("ids").mapInArrow(_token_counts(tokens, wide), "token bigint, n bigint")
    for token, n in counted.groupBy("token").agg(F.sum("n")).collect():
        if token < 0:
            ends = n
        else:
            counts[token] = n
    words = attention.Vocabulary.of_counts(counts, begins)

    # the model starts on the driver and goes on where the texts are
    sample = _Read(pa.array(training_sample(train, sample_bytes, size), pa.large_string()))
    ids, _, first = sample.streams(*sample.subwords(encoder))
    model = attention.train(ids, first, words, steps=steps)
    key = F.coalesce("doc_id", "salt")
    model = trained_on(train_ids, wide, model, words)

    groups = max(2 * spark.sparkContext.defaultParallelism, -(-size // group_bytes))
    buckets = max(2 * spark.sparkContext.defaultParallelism, groups // 4)
    parts = parts_for(spark, size, 4 * group_bytes)
    g = F.pmod(F.xxhash64(key), F.lit(groups)).cast("int")
    dealt = coded.select(g.alias("g"), "doc_id", "held_out", "ids", "sizes").repartition(parts, "g")
    asked = dealt.groupBy("g").applyInArrow(_ask(buckets, wide, words), _QUESTIONS_DDL)
    answers = asked.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_answer(words), _ANSWERS_DDL)
    # every group gets at least the totals
    totals = answers.agg(
        (F.coalesce(F.sum("total"), F.lit(0)) + ends).alias("all_tokens"),
        (F.coalesce(F.sum("known"), F.lit(0)) + int(ends > 0)).alias("all_distinct"),
    )
    none = F.array().cast("array<bigint>")
    every = spark.range(groups).select(
        F.col("id").cast("int").alias("g"), F.lit(-1).alias("bucket"), *(none.alias(c) for c in ("c", "together", "seen"))
    )
    told = answers.select("g", "bucket", "c", "together", "seen").unionByName(every).crossJoin(totals)
    return dealt.groupBy("g").cogroup(told.groupBy("g")).applyInArrow(
        _score(buckets, wide, model, words, ends, corpus_weight), _SCORED
    )
