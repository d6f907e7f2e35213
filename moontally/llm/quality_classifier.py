"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal, sparse dot products.

Features of a text are hashed into ``2**bits`` places: each word, each pair of neighbouring words,
and each pair of word shapes (classes of a word's first and last two bytes) with a mark if the second word
repeats the first. A feature's value is its count over the number of all features of the text, times
``SCALE``; so a score needs one pass over the words and no per-text table.

Defined cases: a null or empty text has no features and gets the score of the bias alone. Labelled
rows without a text, without a 0/1 label or whose id is not in the documents are not learned from. Repeated rows are
scored one by one. Without labelled rows every score is 0.5. Columns of the input other than
the id and the text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import small_batches

SCALE = 30.0
_NONE = np.uint64(0)
_SHAPES = np.zeros(256, dtype=np.uint64)
_SHAPES[33:127] = np.arange(33, 127)
for _low, _high, _as in ((48, 58, 3), (65, 91, 2), (97, 123, 1), (128, 256, 1)):
    _SHAPES[_low:_high] = _as


def features(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of all features of all texts, n + 1 offsets of the texts in them)."""
    data, starts, ends, cuts = K.words(texts)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(len(cuts), np.int64)
    words = K.hashes(data, starts, ends)
    shapes = _SHAPES[data[starts]] | (_SHAPES[data[ends - 1]] << np.uint64(8))
    shapes |= _SHAPES[data[np.maximum(ends - 2, starts)]] << np.uint64(16)
    pairs = K.mix(words[:-1] * np.uint64(3) + words[1:])
    repeats = (words[:-1] == words[1:]).astype(np.uint64)
    looks = K.mix((shapes[:-1] << np.uint64(25)) + (shapes[1:] << np.uint64(1)) + repeats + np.uint64(1 << 60))
    # three features a word; the last word of a text starts no pair and leaves two places out
    places = np.stack([words, np.append(pairs, _NONE), np.append(looks, _NONE)], axis=1) >> np.uint64(64 - bits)
    whole = np.ones((len(words), 3), dtype=bool)
    whole[cuts[1:][cuts[1:] > cuts[:-1]] - 1, 1:] = False
    counts = np.maximum(3 * np.diff(cuts) - 2, 0)
    return places[whole].astype(np.int64), np.concatenate([[0], np.cumsum(counts)])


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss; the last coordinate is the bias."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, places: np.ndarray, label: float) -> None:
        at, counts = np.unique(places, return_counts=True)
        values = np.append(counts * (SCALE / max(len(places), 1)), 1.0)
        at = np.append(at, len(self.z) - 1)
        weights = self.weights(at)
        gradient = (sigmoid(weights @ values) - label) * values
        step = (np.sqrt(self.n[at] + gradient**2) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += gradient - step * weights
        self.n[at] += gradient**2


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def train(
    labelled: DataFrame, text: str, label: str, order: str, *,
    epochs: int = 2, bits: int = 18,
    alpha: float = 1.0, beta: float = 1.0, l1: float = 0.0, l2: float = 0.0,
) -> np.ndarray:
    """Weights (``2**bits`` and the bias) learned from ``labelled``, a bounded sample (see ``sample``).

    Learning goes by the hash of the id ``order``. One task learns the rows as a stream; it holds the
    weights and one batch.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(text).isNotNull() & F.col(label).isin(0, 1))
    rows = rows.select(F.xxhash64(order).alias("_at"), F.col(order).alias("_id"), F.col(text).alias("_text"), F.col(label).cast("double").alias("_label"))
    rows = rows.withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    rows = rows.repartition(1).sortWithinPartitions("_epoch", "_at", "_id")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ftrl(2**bits, alpha, beta, l1, l2)
        for batch in batches:
            labels = batch.column("_label").to_numpy(zero_copy_only=False)
            for start, texts in K.slices(batch.column("_text")):
                places, cuts = features(texts, bits)
                for i in range(len(texts)):
                    model.learn(places[cuts[i] : cuts[i + 1]], labels[start + i])
        weights = model.weights(slice(None)).astype(np.float32)
        yield pa.RecordBatch.from_pydict({"weights": pa.array([weights.tobytes()], pa.binary())})

    learned = rows.mapInArrow(learn, "weights binary").first()
    return np.frombuffer(learned["weights"], dtype=np.float32) if learned else np.zeros(2**bits + 1, dtype=np.float32)


def scorer(spark, weights: np.ndarray):
    """A function from a text column to its scores, for use in tasks. The weights, whose size is set by ``bits``, are broadcast."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(weights)
    bits = int(np.log2(len(weights) - 1))

    def scores(column: pa.Array) -> np.ndarray:
        table = shared.value.astype(np.float64)
        out = [np.zeros(0)]
        for _, texts in K.slices(column):
            places, cuts = features(texts, bits)
            n = np.diff(cuts)
            # each text is summed by itself, so its score does not depend on its neighbours
            sums = np.add.reduceat(np.append(table[places], 0.0), cuts[:-1]) if len(n) else np.zeros(0)
            out.append(sigmoid(np.where(n > 0, sums, 0.0) * (SCALE / np.maximum(n, 1)) + table[-1]))
        return np.concatenate(out)

    return scores


def score(docs: DataFrame, doc_id: str, text: str, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) of every row."""
    scores = scorer(docs.sparkSession, weights)
    kind = docs.schema[doc_id].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(batch.column(1)))], names=["doc_id", "score"])

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(scored, f"doc_id {kind}, score double")


def accept(docs: DataFrame, text: str, weights: np.ndarray, threshold: float) -> DataFrame:
    """The rows whose text scores at least ``threshold``, with all their columns."""
    scores = scorer(docs.sparkSession, weights)
    place = docs.columns.index(text)

    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(place)) >= threshold))

    return docs.mapInArrow(accepted, docs.schema)


def sample(labels: DataFrame, order: str, most_rows: int) -> DataFrame:
    """At most ``most_rows`` rows, those of the smallest hashes of ``order``."""
    return labels.orderBy(F.xxhash64(order), order).limit(most_rows)
