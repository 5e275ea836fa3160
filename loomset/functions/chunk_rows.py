"""``chunk_text(text, max_tokens)``: the greedy chunk fold as a table function for SQL."""

from __future__ import annotations

import math
from collections.abc import Iterator

import regex
from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from . import patterns as P
from .chunks import TOKENS_PER_WORD

_WORD, _SENTENCE = (regex.compile(p) for p in (P.WORD_RUN, rf"(?<=[.!?]){P.WS}+(?=[A-Z])"))
# \s of these is that of ASCII
_BREAKS = [regex.compile(p.replace(r"\s", r"[ \t\n\x0b\f\r]")) for p in P.CLAUSE_BREAKS]


def _tokens(text: str) -> int:
    return math.floor(sum(1 for _ in _WORD.finditer(text)) * TOKENS_PER_WORD)


def _strip(parts) -> list[str]:
    return [s for s in (p.strip(P.WS_CHARS) for p in parts) if s]


def _clauses(sentence: str) -> list[str]:
    """Clauses keep their delimiter; one of fewer than three words joins the clause before it."""
    parts = [sentence]
    for pattern in _BREAKS:
        parts = [p for part in parts for p in _cut_after(pattern, part)]
    done: list[str] = []
    for clause in _strip(parts):
        if done and sum(1 for _ in _WORD.finditer(clause)) < 3:
            done[-1] += " " + clause
        else:
            done.append(clause)
    return done


def _cut_after(pattern, text: str) -> Iterator[str]:
    at = 0
    for found in pattern.finditer(text):
        yield text[at : found.end()]
        at = found.end()
    yield text[at:]


def _windows(text: str, max_tokens: int) -> Iterator[str]:
    size, words = max(1, int(max_tokens / TOKENS_PER_WORD)), _WORD.findall(text)
    for at in range(0, max(len(words), 1), size):
        yield " ".join(words[at : at + size])


def _pieces(text: str, max_tokens: int) -> Iterator[str]:
    """Sentences; a too long one as clauses, a too long clause as word windows, in document order."""
    for sentence in _strip(_SENTENCE.split(text)):
        for part in [sentence] if _tokens(sentence) <= max_tokens else _clauses(sentence):
            yield from [part] if _tokens(part) <= max_tokens else _windows(part, max_tokens)


def chunks(text: str, max_tokens: int = 480) -> Iterator[str]:
    """The chunks of :func:`loomset.functions.chunks.chunk_greedy`, one by one."""
    if not text.strip(P.WS_CHARS):
        return
    if _tokens(text) <= max_tokens:
        yield text.strip(P.WS_CHARS)
        return
    held: list[str] = []
    load = 0
    for piece in _pieces(text, max_tokens):
        cost = _tokens(piece)
        if held and load + cost > max_tokens:
            yield " ".join(held)
            held, load = [], 0
        held.append(piece)
        load += cost
    if held:
        yield " ".join(held)


@udtf(returnType="chunk_no bigint, chunk string", useArrow=True)
class ChunkText:
    """Rows (chunk_no, chunk) of one text; none for a null or blank one."""

    def eval(self, text: str, max_tokens: int):
        for number, chunk in enumerate(chunks(text, max_tokens), 1) if text is not None else ():
            yield number, chunk


def register(spark: SparkSession, name: str = "chunk_text") -> None:
    """``SELECT doc_id, c.* FROM documents, LATERAL chunk_text(text, 480) c`` works in this session from now on."""
    spark.udtf.register(name, ChunkText)
