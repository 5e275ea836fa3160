"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of 0 to ``DEPTH`` bytes within a word, the space before it
included. A byte that a context has seen costs its share of the context's count plus its different bytes;
one it has not seen costs the escape, the different bytes' share, and is then coded in the next shorter
context, at last as one of 256. The statistics are frozen after training, so the cost of a word is exact
and the same wherever it stands; the distinct words of a slice are coded once. A text's code length in a
language is the sum over its words, and the language with the shortest one wins.

The trees are fitted on a sample of about ``sample_bytes`` of text per language, drawn by document, so that copies of a
text are drawn one by one; rows without an id are drawn among their distinct texts. Every language with a letter in its
texts gets at least one of them.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so is every text when
nothing can be learned; of equal code lengths the first language in order wins; rows without an id and
repeated rows are judged like any other and train unless they are held out, each document and each text
without an id once; rows without a language do not train; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from loomset.llm.flat import NOT_SPACE, Texts, lowered, ragged_range, slices, texts_of, word_hashes, words_of
from loomset.llm.tables import Packed, bounded_batches, text_rows

DEPTH = 4
SAMPLE_BYTES = 2 << 20
UNDETERMINED = "und"


def _distinct_words(column: pa.Array) -> tuple[Texts, np.ndarray, np.ndarray]:
    """The distinct words, each between two spaces; which one each word is, and the ranges of the rows."""
    texts = lowered(texts_of(column))
    words = words_of(texts, NOT_SPACE)
    _, at, number = np.unique(word_hashes(texts, words), return_index=True, return_inverse=True)
    size = (words.end - words.start)[at]
    offsets = np.append(0, np.cumsum(size + 2)).astype(np.int64)
    data = np.full(offsets[-1], 0x20, np.uint8)
    data[ragged_range(offsets[:-1] + 1, size)] = texts.data[ragged_range(words.start[at], size)]
    return Texts(data, offsets), number, words.first


def _grams(words: Texts, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each context length: where a byte has such a context, and the number of context and byte."""
    data, offsets = words
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    code = np.zeros(len(data), np.int64)
    shifted = data.astype(np.int64)
    for k in range(depth + 1):
        # k bytes of context before the byte; a mark above them tells lengths apart
        code[k:] |= shifted[: len(data) - k] << (8 * k)
        at = np.flatnonzero(place >= max(k, 1))
        yield at, code[at] | (1 << (8 * (k + 1)))


def _count(depth: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            langs = part.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                rows = pa.array([x == lang for x in langs])
                words, number, _ = _distinct_words(part.column("text").filter(rows))
                times = np.bincount(number, minlength=len(words.offsets) - 1)
                weight = np.repeat(times, np.diff(words.offsets))
                for at, code in _grams(words, depth):
                    value, of = np.unique(code, return_inverse=True)
                    n = np.bincount(of, weight[at], len(value)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(value)), pa.array(value), pa.array(n)], names=["lang", "gram", "n"])

    return each


class Trees:
    """The frozen trees of all languages, as costs in bits by gram."""

    def __init__(self, counts: pa.Table, depth: int):
        self.depth = depth
        self.langs = sorted(set(counts.column("lang").to_pylist()))
        lang = np.searchsorted(self.langs, counts.column("lang").to_pylist()) if self.langs else np.zeros(0, np.int64)
        gram, n = counts.column("gram").to_numpy(), counts.column("n").to_numpy().astype(float)
        width = len(self.langs)
        self.context: list[tuple[np.ndarray, np.ndarray]] = []
        self.cost: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(depth + 1):
            own = (gram >> (8 * (k + 1))) == 1
            g, of, count = gram[own], lang[own], n[own]
            context, number = np.unique(g >> 8, return_inverse=True)
            total, different = np.zeros((len(context), width)), np.zeros((len(context), width))
            np.add.at(total, (number, of), count)
            np.add.at(different, (number, of), 1)
            known = total > 0
            escape = np.zeros((len(context), width))
            escape[known] = -np.log2(different[known] / (total + different)[known])
            self.context.append((context, escape.astype(np.float32)))
            value, at = np.unique(g, return_inverse=True)
            cost = escape[np.searchsorted(context, value >> 8)] + self._shorter(value, k)
            cost[at, of] = -np.log2(count / (total + different)[number, of])
            self.cost.append((value, cost.astype(np.float32)))

    def _shorter(self, gram: np.ndarray, k: int) -> np.ndarray:
        """Bits of the bytes of these grams in the next shorter context."""
        if k == 0:
            return np.full((len(gram), len(self.langs)), 8.0)
        return self._bits(gram & ((1 << (8 * k)) - 1) | (1 << (8 * k)), k - 1)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def _bits(self, gram: np.ndarray, k: int) -> np.ndarray:
        value, cost = self.cost[k]
        at, hit = self._find(value, gram)
        out = np.zeros((len(gram), len(self.langs)), np.float32)
        out[hit] = cost[at[hit]]
        miss = np.flatnonzero(~hit)
        if len(miss):
            context, escape = self.context[k]
            at, hit = self._find(context, gram[miss] >> 8)
            out[miss] = self._shorter(gram[miss], k)
            out[miss[hit]] += escape[at[hit]]
        return out

    def word_bits(self, words: Texts) -> np.ndarray:
        """Code length of each word, with the space after it, in each language."""
        sums = np.zeros((len(words.data) + 1, len(self.langs)))
        bits = np.zeros((len(words.data), len(self.langs)), np.float32)
        place = np.arange(len(words.data)) - np.repeat(words.offsets[:-1], np.diff(words.offsets))
        for k, (at, code) in enumerate(_grams(words, self.depth)):
            # a byte is coded in the longest context that the word allows it
            own = place[at] >= k if k == self.depth else place[at] == k
            if k == 0:
                continue
            bits[at[own]] = self._bits(code[own], k)
        np.cumsum(bits, axis=0, out=sums[1:])
        return sums[words.offsets[1:]] - sums[words.offsets[:-1]]


_PREDICTED = "lang_pred string, score double, bits_per_byte double"


def _predict(trees: Trees, kept: list[str]):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n = part.num_rows
            letters = part.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
            pred, score, rate = np.array([UNDETERMINED] * n, object), np.zeros(n), np.full(n, np.nan)
            if trees.langs:
                words, number, first = _distinct_words(part.column("text"))
                each_word = trees.word_bits(words)[number]
                sums = np.zeros((len(each_word) + 1, len(trees.langs)))
                np.cumsum(each_word, axis=0, out=sums[1:])
                bits = sums[first[1:]] - sums[first[:-1]]
                best = bits.argmin(axis=1)
                least = bits[np.arange(n), best]
                chance = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                size = np.diff(np.append(0, np.cumsum(np.diff(words.offsets)[number] - 1))[first])
                pred[letters] = np.array(trees.langs, object)[best[letters]]
                score[letters] = chance[letters]
                rate[letters] = least[letters] / np.maximum(size[letters], 1)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in kept] + [pa.array(pred, pa.string()), pa.array(score), pa.array(rate, from_pandas=True)],
                names=[*kept, "lang_pred", "score", "bits_per_byte"],
            )

    return each


def fit_trees(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES, depth: int = DEPTH) -> Trees:
    """Trees from the text and non-null lang of ``docs``; only a sample of bounded size is counted."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL"
    )
    key = F.pmod(F.xxhash64(F.lit("language"), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(1 << 40))
    rows = rows.select("lang", "text", key.alias("at"))
    once = rows.groupBy("lang", "at").agg(F.max(F.octet_length("text")).alias("size"), F.max(F.col("text").rlike("\\p{L}")).alias("usable"))
    share, least = F.lit(0.0), F.lit(-1)
    for lang, size, first in once.groupBy("lang").agg(F.sum("size"), F.min(F.when(F.col("usable"), F.col("at")))).collect():
        share = F.when(F.col("lang") == lang, sample_bytes / max(size, 1)).otherwise(share)
        least = F.when(F.col("lang") == lang, -1 if first is None else first).otherwise(least)
    drawn = rows.where((F.col("at") / float(1 << 40) < share) | (F.col("at") == least)).distinct().select("text", "lang")
    counts = drawn.mapInArrow(_count(depth), "lang string, gram bigint, n bigint")
    return Trees(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow(), depth)


def predict(rows: DataFrame, kept: list[StructField], trees: Trees) -> DataFrame:
    """The columns ``kept`` of ``rows``, which have a text, and (lang_pred, score, bits_per_byte)."""
    bounded_batches(rows.sparkSession)
    names = [f.name for f in kept]
    asked = rows.select(*names, *([] if "text" in names else ["text"]), F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("has_letter"))
    return asked.mapInArrow(_predict(trees, names), StructType([*kept, *StructType.fromDDL(_PREDICTED).fields]))


def held_out(folds: int, fold: int):
    """Whether a document is kept from training: crc32 of its id as text, modulo ``folds``, is ``fold``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def language_report(docs: DataFrame, folds: int = 4, fold: int = 2, **settings) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each document, learned from those that are not held out."""
    trees = fit_trees(docs.where(~held_out(folds, fold)), **settings)
    found = predict(text_rows(docs), [StructField("doc_id", LongType())], trees)
    return found.select("doc_id", held_out(folds, fold).alias("held_out"), "lang_pred", "score")


def with_known_language(docs: DataFrame, folds: int = 4, fold: int = 2, **settings) -> DataFrame:
    """The documents whose language can be told, with all their columns; the others have no letter or no text."""
    trees = fit_trees(docs.where(~held_out(folds, fold)), **settings)
    packed = Packed.of(docs)
    found = predict(packed.rows, [packed.field, StructField("text", StringType())], trees)
    return packed.unpacked(found.where(F.col("lang_pred") != UNDETERMINED))
