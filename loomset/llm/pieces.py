"""SentencePiece vocabularies: their tables, and texts cut into units that no piece crosses.

A unit is a run of spaces with the characters after it up to the next space. As long as no piece has a
space sign after another character, which is checked when a model is read, encoding a text is encoding
its units one by one. Distinct units of a slice are encoded once.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from loomset.llm.flat import Texts, hashes, ragged_range, texts_of

_SIGN = "▁"


class Pieces(NamedTuple):
    """A vocabulary; ``text`` holds the pieces that text can match, with a space for the space sign."""

    model: bytes
    text: dict[str, int]
    score: np.ndarray
    byte_ids: np.ndarray
    unknown: int
    whole_units: bool


def read_pieces(path: str) -> Pieces:
    """Read a model file on the driver; the result goes to the tasks."""
    import sentencepiece

    with open(path, "rb") as file:
        model = file.read()
    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    text, byte_ids = {}, np.full(256, -1, np.int64)
    for i in range(lib.get_piece_size()):
        piece = lib.id_to_piece(i)
        if lib.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
        elif not lib.is_control(i) and not lib.is_unknown(i):
            text[piece.replace(_SIGN, " ")] = i
    score = np.array([lib.get_score(i) for i in range(lib.get_piece_size())])
    return Pieces(model, text, score, byte_ids, lib.unk_id(), all(" " not in p.lstrip(" ") for p in text))


class Units(NamedTuple):
    """The distinct units of some rows: bytes, and for each unit of the rows which one it is."""

    texts: Texts
    number: np.ndarray
    first: np.ndarray


def units_of(column: pa.Array, pieces: Pieces) -> Units:
    """Cut each text, with the space the model puts before it, into units. An empty text has none."""
    if pa.types.is_string(column.type) and pc.any(pc.match_substring(column, _SIGN)).as_py():
        column = pc.replace_substring(column, _SIGN, " ")
    data, offsets = texts_of(column)
    filled = offsets[:-1][np.diff(offsets) > 0]
    data = np.insert(data, filled, np.uint8(0x20))
    offsets = offsets + np.append(0, np.cumsum(np.diff(offsets) > 0))
    if not len(data):
        return Units(Texts(data, np.zeros(1, np.int64)), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = edge[:-1].copy()
    if pieces.whole_units:
        space = data == 0x20
        begins[1:] |= space[1:] & ~space[:-1]
    start = np.flatnonzero(begins)
    end = np.append(start[1:], len(data))
    value = hashes(data, start, end)
    _, at, number = np.unique(value, return_index=True, return_inverse=True)
    size = (end - start)[at]
    own = data[ragged_range(start[at], size)]
    return Units(Texts(own, np.append(0, np.cumsum(size))), number, np.searchsorted(start, offsets))


class Encoded(NamedTuple):
    """Token ids of the distinct units: those of unit u are ``ids[first[u]:first[u + 1]]``."""

    ids: np.ndarray
    first: np.ndarray


def with_bytes(symbols: np.ndarray, first: np.ndarray, pieces: Pieces) -> Encoded:
    """Symbols as token ids; a character outside the vocabulary becomes its UTF-8 bytes, or unknown."""
    size = len(pieces.score)
    outside = np.flatnonzero(symbols >= size)
    if not len(outside):
        return Encoded(symbols, first)
    chars = (symbols[outside] - size).tolist()
    spelled = [
        [int(pieces.byte_ids[b]) for b in chr(c).encode()] if pieces.byte_ids[0] >= 0 else [pieces.unknown] for c in chars
    ]
    count = np.ones(len(symbols), np.int64)
    count[outside] = [len(s) for s in spelled]
    place = np.append(0, np.cumsum(count))
    ids = np.zeros(place[-1], np.int64)
    inside = symbols < size
    ids[place[:-1][inside]] = symbols[inside]
    ids[ragged_range(place[:-1][outside], count[outside])] = [i for s in spelled for i in s]
    return Encoded(ids, place[first])
