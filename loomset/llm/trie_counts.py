"""Token counts under a unigram vocabulary, by dynamic programming on a trie of pre-tokens.

The distinct pre-tokens of a slice go into a trie. A node's forward score is that of the best way to
split the string from the root into pieces, and it is computed once for all pre-tokens that share the
prefix; the node where a pre-token ends holds its token count. A piece's score is its log-probability
as the vocabulary file states it. Of equal scores the longest last piece wins.

Defined cases: a null or empty text has no tokens; a character that is no piece scores 10 less than
the lowest piece and counts one token per byte where the vocabulary has bytes, else one; texts are
counted whole; repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomset.llm.flat import Texts, powers, run_sums, slices, texts_of
from loomset.llm.pieces import Pieces, read_pieces, units_of
from loomset.llm.tables import text_rows

#: pre-tokens of more bytes are split one by one, not in the trie
IN_TRIE = 48

#: fixed values: an odd base and its inverse modulo 2**64, for hashes of the bytes from the root to a node
_BASE = 0x9E3779B97F4A7C15
_POWER, _INVERSE = powers(_BASE, 256), powers(pow(_BASE, -1, 1 << 64), 256)

_CHAR_BYTES = np.ones(256, np.int8)
_CHAR_BYTES[0x80:0xC0] = 0
_CHAR_BYTES[0xC0:0xE0], _CHAR_BYTES[0xE0:0xF0], _CHAR_BYTES[0xF0:] = 2, 3, 4


class PieceScores:
    """Pieces by the hash of their bytes."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        spelled = {p.encode(): pieces.score[i] for p, i in pieces.text.items()}
        self.spelled = spelled
        value = np.array([sum((b + 1) * pow(_BASE, k, 1 << 64) for k, b in enumerate(p)) % (1 << 64) for p in spelled], np.uint64)
        order = np.argsort(value)
        self.value, self.score = value[order], np.array(list(spelled.values()))[order]
        # a small table of the leading bits tells most strings that are no piece
        self.leading = np.zeros(1 << 22, bool)
        self.leading[(value >> np.uint64(42)).astype(np.int64)] = True
        self.longest = max(map(len, spelled), default=0)
        self.unknown = float(pieces.score.min()) - 10
        self.bytes = pieces.byte_ids[0] >= 0

    def look_up(self, value: np.ndarray) -> np.ndarray:
        """Scores of strings by hash; nan for what is no piece."""
        out = np.full(len(value), np.nan)
        maybe = np.flatnonzero(self.leading[(value >> np.uint64(42)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.value, value[maybe]), len(self.value) - 1)
        hit = self.value[at] == value[maybe]
        out[maybe[hit]] = self.score[at[hit]]
        return out

    def _one(self, text: bytes) -> int:
        """Tokens of one long pre-token."""
        n = len(text)
        best, tokens = [-np.inf] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for end in range(1, n + 1):
            if end < n and text[end] & 0xC0 == 0x80:
                continue
            start = end - 1
            while text[start] & 0xC0 == 0x80:
                start -= 1
            for at in range(max(0, end - self.longest), end):
                if best[at] > -np.inf:
                    score = self.spelled.get(text[at:end])
                    if score is not None and best[at] + score > best[end]:
                        best[end], tokens[end] = best[at] + score, tokens[at] + 1
            if text[start:end] not in self.spelled and best[start] + self.unknown > best[end]:
                best[end], tokens[end] = best[start] + self.unknown, tokens[start] + (end - start if self.bytes else 1)
        return tokens[n]

    def count(self, texts: Texts) -> np.ndarray:
        """Tokens of each distinct pre-token."""
        data, offsets = texts
        size = np.diff(offsets)
        out = np.zeros(len(size), np.int64)
        for k in np.flatnonzero(size > IN_TRIE):
            out[k] = self._one(data[offsets[k] : offsets[k + 1]].tobytes())
        rows = np.flatnonzero((size > 0) & (size <= IN_TRIE))
        if not len(rows):
            return out
        # the root, then a level of nodes for each byte
        levels = [dict(parent=np.zeros(1, np.int64), value=np.zeros(1, np.uint64), best=np.zeros(1), tokens=np.zeros(1, np.int64), rest=np.zeros(1, np.int8), char=np.ones(1, np.int8))]
        node = np.zeros(len(rows), np.int64)
        for depth in range(1, int(size[rows].max()) + 1):
            here = size[rows] >= depth
            rows, node = rows[here], node[here]
            code, node = np.unique(node * 256 + data[offsets[rows] + depth - 1], return_inverse=True)
            levels.append(self._level(levels, depth, code >> 8, (code & 255).astype(np.uint8)))
            ends = size[rows] == depth
            out[rows[ends]] = levels[-1]["tokens"][node[ends]]
        return out

    def _level(self, levels: list[dict], depth: int, parent: np.ndarray, byte: np.ndarray) -> dict:
        """Forward scores of the nodes ``depth`` bytes below the root."""
        above = levels[depth - 1]
        lead = _CHAR_BYTES[byte] > 0
        rest = np.where(lead, _CHAR_BYTES[byte] - 1, above["rest"][parent] - 1).astype(np.int8)
        char = np.where(lead, _CHAR_BYTES[byte], above["char"][parent]).astype(np.int8)
        value = above["value"][parent] + (byte.astype(np.uint64) + np.uint64(1)) * _POWER[depth - 1]
        best, tokens = np.full(len(parent), -np.inf), np.zeros(len(parent), np.int64)
        whole = rest == 0
        reach = min(depth, self.longest)
        path = [parent]
        for back in range(2, max(reach, 4) + 1):
            if back > depth:
                break
            path.append(levels[depth - back + 1]["parent"][path[-1]])
        alone = np.zeros(len(parent), bool)
        for back in range(reach, 0, -1):
            start = levels[depth - back]
            at = path[back - 1]
            score = self.look_up((value - start["value"][at]) * _INVERSE[depth - back])
            alone |= whole & (char == back) & ~np.isnan(score)
            total = start["best"][at] + score
            better = whole & (total > best)
            best[better], tokens[better] = total[better], start["tokens"][at][better] + 1
        for back in range(1, min(depth, 4) + 1):
            at = path[back - 1]
            odd = np.flatnonzero(whole & (char == back) & ~alone)
            total = levels[depth - back]["best"][at[odd]] + self.unknown
            odd, total = odd[total > best[odd]], total[total > best[odd]]
            best[odd] = total
            tokens[odd] = levels[depth - back]["tokens"][at[odd]] + (back if self.bytes else 1)
        return dict(parent=parent, value=value, best=best, tokens=tokens, rest=rest, char=char)


def _count(scores: PieceScores):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            units = units_of(part.column("text"), scores.pieces)
            tokens = run_sums(scores.count(units.texts)[units.number], units.first)
            n_bytes = np.diff(texts_of(part.column("text")).offsets)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n_bytes), pa.array(np.diff(units.first)), pa.array(tokens)],
                names=["doc_id", "n_bytes", "n_pretokens", "n_tokens"],
            )

    return each


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_pretokens, n_tokens) for each document, texts whole."""
    return text_rows(docs).mapInArrow(
        _count(PieceScores(read_pieces(model_path))), "doc_id bigint, n_bytes bigint, n_pretokens bigint, n_tokens bigint"
    )
