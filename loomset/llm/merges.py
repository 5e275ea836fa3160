"""SentencePiece encoding and decoding for merge-type vocabularies.

The symbols of a unit start as its characters. An agenda holds the adjacent pairs that make a piece;
the pair of the highest score goes first, of equals the leftmost, and the merged symbol enters its two
new pairs. The agendas of all distinct units of a slice run side by side as numpy rows; a very long
unit has a heap of its own. :func:`round_trip_report` compares the ids of the distinct units of each slice with the
sentencepiece library and fails if they differ; :func:`library_agrees` compares whole texts, batch by batch.

Defined cases: a null or empty text has no ids and decodes to the empty text; a literal space sign is a
space, as in the library; characters outside the vocabulary become bytes; texts are encoded whole;
repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.flat import ragged_range, slices
from loomset.llm.pieces import Encoded, Pieces, Units, read_pieces, units_of, with_bytes
from loomset.llm.tables import bounded_batches, text_rows

#: units of more characters have a heap of their own
SIDE_BY_SIDE = 64
_NONE = np.int32(2**31 - 1)
_BITS = 21


class Merger:
    """The pairs of symbols that make a piece, by code, with the rank of the piece's score."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._known: dict[int, tuple[int, int]] | None = None
        size = len(pieces.score)
        symbol = lambda s: pieces.text.get(s, size + ord(s) if len(s) == 1 else -1)
        pairs = {}
        for piece, number in pieces.text.items():
            for k in range(1, len(piece)):
                left, right = symbol(piece[:k]), symbol(piece[k:])
                if left >= 0 and right >= 0:
                    pairs[left << _BITS | right] = number
        self.code = np.array(sorted(pairs), np.int64)
        self.piece = np.array([pairs[c] for c in self.code.tolist()], np.int32)
        _, rank = np.unique(-pieces.score, return_inverse=True)
        self.rank = rank.astype(np.int32)[self.piece] if len(self.piece) else np.zeros(0, np.int32)
        single = sorted((ord(p), number) for p, number in pieces.text.items() if len(p) == 1)
        self.char = np.array([c for c, _ in single], np.int64)
        self.char_piece = np.array([n for _, n in single], np.int64)

    def symbols(self, chars: np.ndarray) -> np.ndarray:
        """A character's piece, or its code point beyond the vocabulary."""
        if not len(self.char):
            return chars + len(self.pieces.score)
        at = np.minimum(np.searchsorted(self.char, chars), len(self.char) - 1)
        return np.where(self.char[at] == chars, self.char_piece[at], chars + len(self.pieces.score))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of each pair; rank _NONE if it makes no piece."""
        code = left << _BITS | right
        if not len(self.code):
            return np.full(len(code), _NONE), np.zeros(len(code), np.int32)
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[at] == code, self.rank[at], _NONE), self.piece[at]

    def _merge_rows(self, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Run the agendas of all rows; returns which places still hold a symbol."""
        n, width = ids.shape
        alive = np.arange(width)[None, :] < length[:, None]
        rank = np.full((n, width), _NONE, np.int32)
        piece = np.zeros((n, width), np.int32)
        pair = alive[:, 1:]
        rank[:, :-1][pair], piece[:, :-1][pair] = self.look_up(ids[:, :-1][pair], ids[:, 1:][pair])
        after = np.tile(np.arange(1, width + 1, dtype=np.int16), (n, 1))
        before = np.tile(np.arange(-1, width - 1, dtype=np.int16), (n, 1))
        rows = np.arange(n)
        while len(rows):
            part = rank[rows]
            at = part.argmin(axis=1)
            open_ = part[np.arange(len(rows)), at] < _NONE
            rows, at = rows[open_], at[open_]
            if not len(rows):
                break
            gone = after[rows, at]
            following = after[rows, gone]
            ids[rows, at] = piece[rows, at]
            alive[rows, gone] = False
            rank[rows, gone] = _NONE
            after[rows, at] = following
            has = following < length[rows]
            r, a, f = rows[has], at[has], following[has]
            before[r, f] = a
            rank[r, a], piece[r, a] = self.look_up(ids[r, a], ids[r, f])
            rank[rows[~has], at[~has]] = _NONE
            back = before[rows, at]
            has = back >= 0
            r, a, b = rows[has], at[has], back[has]
            rank[r, b], piece[r, b] = self.look_up(ids[r, b], ids[r, a])
        return alive

    def _merge_one(self, symbols: list[int]) -> list[int]:
        """One long unit, with a heap."""
        symbols = list(symbols)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = np.array(symbols, np.int64)
        rank, piece = self.look_up(left[:-1], left[1:])
        agenda = [(int(r), i, symbols[i], symbols[i + 1], int(p)) for i, (r, p) in enumerate(zip(rank, piece)) if r != _NONE]
        heapq.heapify(agenda)
        if self._known is None:
            self._known = dict(zip(self.code.tolist(), zip(self.rank.tolist(), self.piece.tolist())))

        def enter(i: int, j: int) -> None:
            rank, piece = self._known.get(symbols[i] << _BITS | symbols[j], (None, 0))
            if rank is not None:
                heapq.heappush(agenda, (rank, i, symbols[i], symbols[j], piece))

        while agenda:
            _, i, a, b, p = heapq.heappop(agenda)
            j = after[i] if symbols[i] == a else n
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = p, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                enter(i, after[i])
            if before[i] >= 0:
                enter(before[i], i)
        return [s for s in symbols if s >= 0]

    def encode(self, units: Units) -> Encoded:
        """Token ids of the distinct units."""
        data, offsets = units.texts
        n = len(offsets) - 1
        if not n:
            return Encoded(np.zeros(0, np.int64), np.zeros(1, np.int64))
        chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
        leads = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        first = leads[offsets]
        symbols, length = self.symbols(chars), np.diff(first)
        count = np.zeros(n, np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        low = 0
        for high in (4, 6, 8, 10, 12, 16, 24, 32, SIDE_BY_SIDE):
            rows = np.flatnonzero((length > low) & (length <= high))
            low = high
            for k in range(0, len(rows), 1 << 14):
                some = rows[k : k + (1 << 14)]
                ids = np.zeros((len(some), high), np.int64)
                inside = np.arange(high)[None, :] < length[some][:, None]
                ids[inside] = symbols[ragged_range(first[some], length[some])]
                alive = self._merge_rows(ids, length[some])
                count[some] = alive.sum(axis=1)
                found.append((some, ids[alive]))
        for row in np.flatnonzero(length > SIDE_BY_SIDE):
            merged = np.array(self._merge_one(symbols[first[row] : first[row + 1]].tolist()), np.int64)
            count[row] = len(merged)
            found.append((np.array([row]), merged))
        place = np.append(0, np.cumsum(count))
        out = np.zeros(place[-1], np.int64)
        for rows, ids in found:
            out[ragged_range(place[rows], count[rows])] = ids
        return with_bytes(out, place, self.pieces)


def _row_ids(units: Units, encoded: Encoded) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all rows, and their ranges."""
    count = np.diff(encoded.first)[units.number]
    ids = encoded.ids[ragged_range(encoded.first[:-1][units.number], count)]
    return ids, np.append(0, np.cumsum(count))[units.first]


def _encode(merger: Merger):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            units = units_of(part.column("text"), merger.pieces)
            ids, first = _row_ids(units, merger.encode(units))
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "ids"])

    return each


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids) for each document."""
    return text_rows(docs).mapInArrow(_encode(Merger(read_pieces(model_path))), "doc_id bigint, ids array<int>")


def _library(pieces: Pieces):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=pieces.model)


def _decoder(pieces: Pieces):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = _library(pieces)
        for batch in batches:
            texts = lib.decode([x or [] for x in batch.column("ids").to_pylist()]) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return each


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) for each row of (doc_id, ids); null ids are an empty text."""
    bounded_batches(encoded.sparkSession)
    rows = encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decoder(read_pieces(model_path)), "doc_id bigint, text string")


def _check_units(units: Units, encoded: Encoded, lib) -> None:
    """Fails if the library has other ids for a unit, or for a unit's text after the space the library adds itself."""
    texts = pa.LargeStringArray.from_buffers(
        len(units.texts.offsets) - 1, pa.py_buffer(units.texts.offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(units.texts.data))
    ).to_pylist()
    theirs = lib.encode([t[1:] for t in texts], num_threads=1)
    for k, text in enumerate(texts):
        if text == " ":  # the library adds no space to an empty text
            theirs[k] = lib.encode("a ")[len(lib.encode("a")) :]
    count = np.fromiter(map(len, theirs), np.int64, len(theirs))
    flat = np.fromiter((i for x in theirs for i in x), np.int64, int(count.sum()))
    if np.array_equal(count, np.diff(encoded.first)) and np.array_equal(flat, encoded.ids):
        return
    for text, a, b, other in zip(texts, encoded.first[:-1], encoded.first[1:], theirs):
        if encoded.ids[a:b].tolist() != other:
            raise ValueError(f"{text[:200]!r} has ids {encoded.ids[a:b].tolist()[:50]}, in the library {other[:50]}")


def _round_trip(merger: Merger, with_ids: bool = False):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = _library(merger.pieces)
        digits = [b"%d," % i for i in range(len(merger.pieces.score))]
        for part in slices(batches):
            units = units_of(part.column("text"), merger.pieces)
            encoded = merger.encode(units)
            _check_units(units, encoded, lib)
            ids, first = _row_ids(units, encoded)
            flat, cut = encoded.ids.tolist(), encoded.first.tolist()
            spelled = np.empty(len(cut) - 1, object)
            spelled[:] = [b"".join([digits[i] for i in flat[a:b]]) for a, b in zip(cut[:-1], cut[1:])]
            spelled = spelled[units.number]
            sha_ids, sha_text = [], []
            for row in range(part.num_rows):
                own = b"".join(spelled[units.first[row] : units.first[row + 1]].tolist())
                sha_ids.append(hashlib.sha256(own[:-1]).hexdigest())
                text = lib.decode(ids[first[row] : first[row + 1]].tolist())
                sha_text.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(first)), pa.array(sha_ids, pa.string()), pa.array(sha_text, pa.string())]
                + ([pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32)))] if with_ids else []),
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids,
            )

    return each


def round_trip_report(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of the text decoded from them; ids too if asked for.

    Fails if the sentencepiece library gives other ids for a unit of a text.
    """
    merger = Merger(read_pieces(model_path))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return text_rows(docs).mapInArrow(_round_trip(merger, with_ids), schema)


def _compare(merger: Merger):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = _library(merger.pieces)
        for part in slices(batches):
            units = units_of(part.column("text"), merger.pieces)
            ids, first = _row_ids(units, merger.encode(units))
            theirs = lib.encode([t or "" for t in part.column("text").to_pylist()], num_threads=1)
            same = [ids[a:b].tolist() == other for a, b, other in zip(first[:-1], first[1:], theirs)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(same)], names=["doc_id", "agrees"])

    return each


def library_agrees(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, agrees): whether the sentencepiece library gives the same ids, compared in Arrow batches."""
    return text_rows(docs).mapInArrow(_compare(Merger(read_pieces(model_path))), "doc_id bigint, agrees boolean")

