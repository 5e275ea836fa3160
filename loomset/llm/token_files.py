"""Token ids as Arrow files of equal-length sequences.

Documents are sorted by doc_id over the whole table and encoded whole, with an end id after each. Every
task writes one shard: an Arrow file of the stream layout with a footer, whose batches hold two
fixed-size lists per row, ``length`` ids and as many mask bits. A reader maps the file and takes any row
of any batch without copying; only the last row of a shard is padded, with mask bits 0. Ids take two
bytes where the vocabulary allows it. The manifest says where each document stands.

A shard is written under the name of its task attempt, and the manifest, which Spark commits, names the
files that count, so a lost executor leaves at most a file that nobody reads.

White space ends a token in this tokenizer, so a text's ids are those of its words; distinct words of a
slice, or distinct parts of plain words, go through it once. Defined cases: a null or empty text has the end id alone; rows without an id come
first; rows of one id are ordered by their text's hash, repeated rows have the same ids; other columns
are not read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomset.llm.flat import NOT_SPACE, Texts, hashes, ragged_range, run_sums, slices, texts_of, words_of
from loomset.llm.tables import parts_for, scratch_path, text_bytes, text_rows, written_table

LENGTH = 2048
SHARD_BYTES = 64 << 20
_ROWS = 256


def file_system(uri: str):
    """(file system, path) of a folder that all executors see."""
    from pyarrow import fs

    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme: where Spark itself would put it, so that all executors mean the same one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


#: fixed values: the normalizer and pre-tokenizer for which a word of plain characters is split here
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

#: kinds of bytes: 1 letters, 2 digits, 3 other printable ASCII, 4 what only the whole tokenizer may judge
_KIND = np.full(256, 4, np.int8)
_KIND[0x21:0x7F] = 3
_KIND[0x30:0x3A] = 2
_KIND[0x61:0x7B] = _KIND[0x41:0x5B] = 1
_KIND[ord("'")] = 4


def _plain_parts(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and spans with a flag: parts of plain words as the pre-tokenizer cuts them, other words whole.

    Plain characters are printable ASCII without the apostrophe, and the letters from U+00C0 to U+00FF, whose
    lower case is 32 further on. A word with a less-than sign and a bar may hold a special token and is not plain.
    """
    data, offsets = texts
    words = words_of(texts, NOT_SPACE)
    kind = _KIND[data]
    if len(data) > 1:
        latin = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        kind[:-1][latin] = 1
        kind[1:][latin] = 1
        kind[:-1][(data[:-1] == 0x3C) & (data[1:] == 0x7C)] = 4
    lower = data.copy()
    lower[(data >= 0x41) & (data <= 0x5A)] += 0x20
    if len(data) > 1:
        lower[1:][latin & (data[1:] <= 0x9E)] += 0x20
    odd = run_sums((kind == 4).astype(np.int32), np.append(words.start, len(data)))[: len(words.start)] if len(data) else np.zeros(0, np.int32)
    # white space is of kind 4 too, and stands between the words
    odd = odd - (np.append(words.start[1:], len(data)) - words.end) > 0
    begins = np.zeros(len(data) + 1, bool)
    begins[words.start] = True
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.start[~odd]] = 1
    inside[words.end[~odd]] -= 1
    plain = np.cumsum(inside[:-1]) > 0
    change = np.zeros(len(data) + 1, bool)
    change[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    begins[:-1] |= change[:-1] & plain
    start = np.flatnonzero(begins[:-1])
    word = np.searchsorted(words.start, start, "right") - 1
    end = np.minimum(np.append(start[1:], len(data)), words.end[word]) if len(start) else start
    return lower, start, end, odd[word] if len(start) else np.zeros(0, bool)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordTokens:
    """Ids of texts, word by word; built in the tasks from the tokenizer's JSON.

    The parts of a plain word go to the library's model as they are, each distinct part once as long as a
    cache of ``parts_kept`` parts holds it; any other word goes through the whole tokenizer.
    """

    def __init__(self, spec: str, parts_kept: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        self.parts_kept, self.parts = parts_kept, {}
        parts = json.loads(spec)
        steps = (parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}, {}]
        self.splits_here = (
            parts["normalizer"] == _NORMALIZER and len(steps) == 2
            and (steps[0].get("pattern"), steps[0].get("behavior"), steps[0].get("invert")) == ({"Regex": _SPLIT}, "Removed", True)
            and (steps[1].get("type"), steps[1].get("add_prefix_space"), steps[1].get("use_regex")) == ("ByteLevel", False, False)
        )
        self.splits_here &= all("<|" in t["content"] for t in parts["added_tokens"])
        self.letters = _byte_letters()

    def _part(self, part: str) -> list[int]:
        ids = self.parts.get(part)
        if ids is None:
            ids = [t.id for t in self.model.tokenize(part if part.isascii() else "".join([self.letters[b] for b in part.encode()]))]
            if len(self.parts) >= self.parts_kept:
                self.parts.clear()
            self.parts[part] = ids
        return ids

    def rows(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, each with the end id, and the range of each row."""
        texts = texts_of(column)
        if self.splits_here:
            lower, start, end, whole = _plain_parts(texts)
            lower = np.where(np.repeat(whole, np.diff(np.append(start, len(lower)))), texts.data[start[0] :], lower[start[0] :]) if len(start) else lower
            end, origin = (end - start[0], start[0]) if len(start) else (end, 0)
        else:
            words = words_of(texts, NOT_SPACE)
            lower, start, end, whole, origin = texts.data, words.start, words.end, np.ones(len(words.start), bool), 0
        begin = start - origin
        _, at, number = np.unique(hashes(lower, begin, end) ^ whole.astype(np.uint64), return_index=True, return_inverse=True)
        size = (end - begin)[at]
        own = lower[ragged_range(begin[at], size)]
        spelled = pa.LargeStringArray.from_buffers(
            len(at), pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int64)), pa.py_buffer(own)
        ).to_pylist()
        ids = [
            self.tokenizer.encode(w, add_special_tokens=False).ids if odd else self._part(w)
            for w, odd in zip(spelled, whole[at].tolist())
        ]
        count = np.array([len(x) for x in ids], np.int64)
        first = np.append(0, np.cumsum(count)).astype(np.int64)
        ids = np.array([i for x in ids for i in x], np.int64)
        place = np.append(0, np.cumsum(count[number])).astype(np.int64)
        begin = place[np.searchsorted(start, texts.offsets)]
        n = len(texts.offsets) - 1
        out = np.full(place[-1] + n, end_id, np.int64)
        row = np.repeat(np.arange(n), np.diff(begin))
        out[np.arange(place[-1]) + row] = ids[ragged_range(first[:-1][number], count[number])]
        return out, begin + np.arange(n + 1)


class _Shard:
    """Writes one file row by row of ``length`` ids."""

    def __init__(self, sink, kind: pa.DataType, length: int):
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.kind, self.length, self.rest = kind, length, np.zeros(0, kind.to_pandas_dtype())

    def add(self, ids: np.ndarray, last: bool = False) -> None:
        ids = np.concatenate([self.rest, ids.astype(self.rest.dtype)])
        whole = len(ids) // (_ROWS * self.length) * (_ROWS * self.length)
        for at in range(0, whole, _ROWS * self.length):
            self._batch(ids[at : at + _ROWS * self.length], _ROWS * self.length)
        self.rest = ids[whole:]
        if last:
            if len(self.rest):
                padded = np.zeros(-(-len(self.rest) // self.length) * self.length, ids.dtype)
                padded[: len(self.rest)] = self.rest
                self._batch(padded, len(self.rest))
            self.writer.close()

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        self.writer.write_batch(
            pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)],
                schema=self.schema,
            )
        )


_MANIFEST = "doc_id bigint, shard int, path string, offset bigint, n_tokens bigint"


def _write(spec: str, end_id: int, folder: str, length: int, bits: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, tokens, offset = None, None, 0
        for part in slices(batches):
            if shard is None:
                system, base = file_system(folder)
                system.create_dir(base, recursive=True)
                name = f"shard-{context.partitionId():06d}-{context.taskAttemptId()}.arrow"
                sink = system.open_output_stream(f"{base}/{name}")
                shard, tokens = _Shard(sink, pa.uint16() if bits == 16 else pa.uint32(), length), WordTokens(spec)
            ids, first = tokens.rows(part.column("text"), end_id)
            shard.add(ids)
            n = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(np.full(n, context.partitionId(), np.int32)),
                    pa.array([f"{folder}/{name}"] * n), pa.array(first[:-1] + offset), pa.array(np.diff(first)),
                ],
                names=["doc_id", "shard", "path", "offset", "n_tokens"],
            )
            offset += int(first[-1])
        if shard is not None:
            shard.add(np.zeros(0, np.int64), last=True)
            sink.close()

    return each


def write_token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, folder: str | None = None, length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write all documents as token files; returns the manifest (doc_id, shard, path, start, offset, n_tokens).

    ``offset`` counts ids from the start of the shard, ``start`` those of all documents before this one.
    """
    from tokenizers import Tokenizer

    spark: SparkSession = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    folder = qualified(spark, folder or scratch_path(spark, "tokens"))
    bits = 16 if max(Tokenizer.from_str(spec).get_vocab_size() - 1, end_id) < 1 << 16 else 32
    parts = parts_for(spark, text_bytes(docs), shard_bytes)
    rows = text_rows(docs)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    manifest = written_table(rows.mapInArrow(_write(spec, end_id, folder, length, bits), _MANIFEST), "manifest")
    # a row for each shard: as many as tasks wrote files
    shards = manifest.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    starts = shards.select("shard", before.alias("before"))
    return manifest.join(F.broadcast(starts) if parts <= 100_000 else starts, "shard").select(
        "doc_id", "shard", "path", (F.col("before") + F.col("offset")).alias("start"), "offset", "n_tokens"
    )


class TokenFile:
    """Random access to the sequences of one file, without copying where the file can be mapped."""

    def __init__(self, path: str):
        system, name = file_system(path)
        local = system.type_name == "local"
        self.source = pa.memory_map(name) if local else system.open_input_file(name)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.at, self.batch = -1, None

    def _column(self, batch: int, name: str) -> np.ndarray:
        if batch != self.at:
            self.at, self.batch = batch, self.reader.get_batch(batch)
        return self.batch.column(name).flatten().to_numpy(zero_copy_only=name == "ids")

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of one row."""
        at = row % _ROWS * self.length
        return tuple(self._column(row // _ROWS, c)[at : at + self.length] for c in ("ids", "mask"))

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids from ``start`` up to ``end`` of the shard's stream."""
        size, parts = _ROWS * self.length, []
        while start < end:
            stop = min(end, (start // size + 1) * size)
            parts.append(self._column(start // size, "ids")[start % size : stop - start // size * size])
            start = stop
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    path, file = None, None
    for batch in batches:
        sums = []
        for name, offset, n in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "n_tokens"))):
            if name != path:
                path, file = name, TokenFile(name)
            sums.append(zlib.crc32(file.ids(offset, offset + n).astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def token_file_report(docs: DataFrame, tokenizer_path: str, **settings) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, read back from the files written."""
    return write_token_files(docs, tokenizer_path, **settings).mapInArrow(
        _read_back, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
