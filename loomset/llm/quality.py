"""Quality classifier: logistic regression on hashed word n-grams, trained by following the regularised leader.

Tokens are runs of letters and digits, lower-cased A-Z, and runs of other characters; features are hashed
single tokens and pairs, pairs of equal tokens as one, valued by their share of the text. Training takes labelled documents one by one
in the order of a hash, over a few rounds, with per-coordinate rates; a bounded sample of ``sample_rows``
labels is used. A score is the logistic function of a sparse dot product over the whole text, computed in
the tasks without shuffling a document.

Defined cases: a null, empty or white text scores the bias alone; labels that are null or belong to no document
do not train; with nothing to learn from every score is 0.5; rows without an id are scored and do not train;
repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.flat import LETTER_OR_DIGIT, NOT_SPACE, lowered, mixed, slices, texts_of, word_hashes, words_of
from loomset.llm.language_id import held_out
from loomset.llm.tables import bounded_batches, text_rows

BITS = 18
SAMPLE_ROWS = 4000
#: shares of a text are small numbers; this brings a feature of one text in thirty to one
SCALE = 30.0

_OTHER = NOT_SPACE & ~LETTER_OR_DIGIT


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of single tokens and of pairs, in order, and the ranges of the rows in both."""
    texts = lowered(texts_of(column))
    n = len(texts.offsets) - 1
    start, value = [], []
    for kind, inside in enumerate((LETTER_OR_DIGIT, _OTHER)):
        words = words_of(texts, inside)
        start.append(words.start)
        value.append(word_hashes(texts, words) + np.uint64(kind))
    start, value = np.concatenate(start), np.concatenate(value)
    order = np.argsort(start, kind="stable")
    start, value = start[order], value[order]
    first = np.searchsorted(start, texts.offsets)
    row = np.repeat(np.arange(n), np.diff(first))
    same = np.flatnonzero(row[1:] == row[:-1])
    pair = mixed(value[same] * np.uint64(0x9E3779B97F4A7C15) + value[same + 1])
    # a token said twice running is one feature, whatever the token
    pair[value[same] == value[same + 1]] = mixed(np.array([BITS], np.uint64))[0]
    shift = np.uint64(64 - BITS)
    return (mixed(value) >> shift).astype(np.int64), (pair >> shift).astype(np.int64), first, np.searchsorted(row[same], np.arange(n + 1))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        single, pair, first, first_pair = features(part.column("text"))
        buckets, values = [], []
        for i in range(part.num_rows):
            own = np.concatenate([single[first[i] : first[i + 1]], pair[first_pair[i] : first_pair[i + 1]]])
            bucket, count = np.unique(own, return_counts=True)
            buckets.append(bucket)
            values.append(count * (SCALE / max(first[i + 1] - first[i], 1)))
        yield pa.RecordBatch.from_arrays(
            [part.column("label"), part.column("at"), pa.array(buckets, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float64()))],
            names=["label", "at", "bucket", "value"],
        )


class Leader:
    """Weights after following the regularised leader over the examples."""

    def __init__(self, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 1e-3):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        size = (1 << BITS) + 1  # the last is the bias
        self.z, self.n = np.zeros(size), np.zeros(size)

    def _weights(self, at) -> np.ndarray:
        z = self.z[at]
        strong = np.abs(z) > self.l1
        return np.where(strong, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2), 0.0)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        at, value = np.append(at, len(self.z) - 1), np.append(value, 1.0)
        weight = self._weights(at)
        chance = 1 / (1 + np.exp(-np.clip(weight @ value, -35, 35)))
        slope = (chance - label) * value
        root = np.sqrt(self.n[at])
        self.z[at] += slope - (np.sqrt(self.n[at] + slope * slope) - root) / self.alpha * weight
        self.n[at] += slope * slope

    def weights(self) -> np.ndarray:
        return self._weights(slice(None))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, rounds: int = 3) -> np.ndarray:
    """Weights from labelled documents, of which at most ``sample_rows`` reach the driver as vectors.

    A row of labels counts if its label equals 0 or 1, as number or text; others are passed over. Equal rows of
    labels are one, and a doc_id that stands in several documents gives the first text in byte order. Documents
    are drawn by the hash of doc_id and label.
    """
    bounded_batches(docs.sparkSession)
    mark = F.expr(f"try_cast(`{label}` AS double)")
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), mark.alias("label")).where(
        "doc_id IS NOT NULL AND label IN (0.0, 1.0)"
    ).select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    # at most sample_rows short rows
    drawn = F.broadcast(marked.withColumn("at", F.xxhash64(F.lit("label"), "doc_id", "label")).orderBy("at", "doc_id", "label").limit(sample_rows))
    rows = text_rows(docs).join(drawn, "doc_id").groupBy("doc_id", "label", "at").agg(F.min("text").alias("text"))
    found = rows.select("text", "label", "at").mapInArrow(
        _vectors, "label int, at bigint, bucket array<bigint>, value array<double>").toArrow().combine_chunks()
    leader = Leader()
    order = np.argsort(found.column("at").to_numpy(), kind="stable")
    buckets, values, marks = found.column("bucket"), found.column("value"), found.column("label").to_numpy()
    for _ in range(rounds):
        for i in order:
            leader.learn(buckets[i].values.to_numpy(), values[i].values.to_numpy(), int(marks[i]))
    return leader.weights()


def _score(weights: np.ndarray):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            single, pair, first, first_pair = features(part.column("text"))
            total = np.zeros(part.num_rows)
            for bucket, cut in ((single, first), (pair, first_pair)):
                sums = np.append(0.0, np.cumsum(weights[bucket]))
                total += sums[cut[1:]] - sums[cut[:-1]]
            total *= SCALE / np.maximum(np.diff(first), 1)
            score = 1 / (1 + np.exp(-np.clip(total + weights[-1], -35, 35)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return each


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) for each document."""
    return text_rows(docs).mapInArrow(_score(weights), "doc_id bigint, score double")


def quality_report(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, **settings) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each document, learned from labels that are not held out."""
    weights = train(docs, labels.where(~held_out(folds, fold)), **settings)
    return scored(docs, weights).select(
        "doc_id", held_out(folds, fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
