"""Ranked lexical search with hashed max-sketches.

A term's impact in a document is its weight w times a part that depends on the document alone, so a document's
sketch needs no statistics of terms: each of its terms falls by hash into one of ``WIDTH`` coordinates, and a coordinate
holds the largest part of its terms. For a batch of queries, the sum of w * sketch[coordinate] over an item's terms is at least the
score, whatever shares a coordinate. These bounds are one matrix product for a block of documents and all items.

A task takes blocks of documents. For each item it goes down the bounds, computes scores from the terms themselves and stops at the first
bound below the item's ``top``-th score so far, which later blocks start from. It gives out at most ``top`` rows an item.
These meet in two steps, first by item and ``BUCKETS`` buckets of tasks, so no task gets all rows of an item.

The corpus is read twice: for N, L and the documents of each item term, and for the search. Items are taken in batches
of about ``BATCH_TERMS`` terms or ``BATCH_ITEMS`` items at most, each of which reads the corpus: only a batch's terms are on the driver and in the tasks.

Terms are runs of ASCII letters and digits and characters outside ASCII, A-Z lower-cased, known by 64-bit hashes. Scores are
64-bit integers; bounds are 32-bit floats, raised by ``_SLACK``.

Defined cases: null, empty and termless texts are no documents (N does not count them). Repeated rows, and rows with one id, are
documents of their own. Documents without an id are counted, and rank behind others of equal score. An
item without terms, or that no document scores on, has no rows. Items that share an id are ranked one by one.
Columns of the inputs other than the ids and texts are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkernel as K
from .common import small_batches, stash

TOP = 20
#: Coordinates of a sketch; a power of two.
WIDTH = 2048
#: Documents and items whose bounds are computed at a time, and entries of the documents' table of item terms.
BLOCK = 512
ITEM_BLOCK = 1024
ENTRIES = 1 << 22
#: Documents scored for an item before the threshold is looked at again.
CHUNK = 32
#: Terms and items of a batch, about.
BATCH_TERMS = 1 << 16
BATCH_ITEMS = 1 << 12
BUCKETS = 64
_SLACK = np.float32(1.001)
#: ASCII letters and digits, and the bytes of characters outside ASCII.
INSIDE = np.array([chr(i).isalnum() or i > 127 for i in range(128)] + [True] * 128)


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each term, n + 1 offsets of the texts' terms)."""
    data, starts, ends, cuts = K.matches(texts, INSIDE)
    return K.hashes(data, starts, ends), cuts


def counted(hashes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, occurrences) of each distinct term of each text, by text."""
    owner = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))) if len(hashes) else np.zeros(0, np.int64)
    return owner[first], hashes[first], np.diff(np.append(first, len(hashes)))


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def parts(tf: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """The factor of a term's weight: of ``tf`` occurrences in texts of ``lengths`` terms."""
    m = 100 - 25 + (25 * lengths * documents) // total
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Queries:
    """Items of one batch: ``vocabulary`` (sorted hashes) and each item's places in it, with weights times repeats."""

    def __init__(self, items: list[int], hashes: list[np.ndarray]):
        self.items = items
        self.vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        self.places, self.repeats = [], []
        for own in hashes:
            distinct, repeats = np.unique(own, return_counts=True)
            self.places.append(np.searchsorted(self.vocabulary, distinct))
            self.repeats.append(repeats)

    def weigh(self, documents: int, total: int, holding: np.ndarray) -> None:
        self.documents, self.total = documents, total
        weights = np.array([weight(documents, int(n)) for n in holding], dtype=np.int64)
        self.weights = [weights[p] * r for p, r in zip(self.places, self.repeats)]

    def found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the hashes are in the vocabulary, their places there)."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[at] == hashes)
        return hit, at[hit]


class Search:
    """The best documents of each item, over blocks of documents."""

    def __init__(self, queries: Queries, top: int, width: int):
        self.queries, self.top, self.width = queries, top, width
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in queries.items]
        self.least = np.ones(len(queries.items), dtype=np.int64)  # scores that still count
        self.scored = 0
        vocabulary = (queries.vocabulary & np.uint64(width - 1)).astype(np.int64)
        self.matrices = []
        for a in range(0, len(queries.items), ITEM_BLOCK):
            own = range(a, min(a + ITEM_BLOCK, len(queries.items)))
            matrix = np.zeros((width, len(own)), dtype=np.float32)
            for i in own:
                np.add.at(matrix[:, i - a], vocabulary[queries.places[i]], queries.weights[i])
            self.matrices.append(matrix)

    def block(self, ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, owner: np.ndarray, hashes: np.ndarray, tf: np.ndarray) -> None:
        part = parts(tf, lengths[owner], self.queries.documents, self.queries.total)
        sketch = np.zeros((len(ids), self.width), dtype=np.float32)
        order = np.argsort(part, kind="stable")  # of equal places the last, largest, stays
        places = owner * self.width + (hashes & np.uint64(self.width - 1)).astype(np.int64)
        sketch.ravel()[places[order]] = part[order]
        hit, at = self.queries.found(hashes)
        exact = np.zeros((len(ids), len(self.queries.vocabulary)), dtype=np.int32)
        exact[owner[hit], at] = part[hit]
        for k, matrix in enumerate(self.matrices):
            bounds = (sketch @ matrix) * _SLACK
            first = k * ITEM_BLOCK
            for j in np.flatnonzero((bounds >= self.least[first : first + matrix.shape[1]]).any(axis=0)).tolist():
                self.descend(first + j, bounds[:, j], exact, ids, nulls)

    def descend(self, item: int, bounds: np.ndarray, exact: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        rows = np.flatnonzero(bounds >= self.least[item])
        rows = rows[np.argsort(-bounds[rows], kind="stable")]
        places, weights = self.queries.places[item], self.queries.weights[item]
        for a in range(0, len(rows), CHUNK):
            own = rows[a : a + CHUNK]
            if bounds[own[0]] < self.least[item]:
                break
            scores = exact[own[:, None], places] @ weights
            self.scored += len(own)
            kept = scores >= self.least[item]
            if kept.any():
                scores, own = scores[kept], own[kept]
                scores, who, none = (np.concatenate(x) for x in zip(self.best[item], (scores, ids[own], nulls[own])))
                order = np.lexsort((who, none, -scores))[: self.top]
                self.best[item] = scores[order], who[order], none[order]
                if len(order) == self.top:
                    self.least[item] = max(1, scores[order[-1]])


def item_terms(items: DataFrame) -> DataFrame:
    """(item, hashes) of items (item, text) that have terms."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, cuts = terms(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["item", "hashes"])

    return items.select("item", "text").mapInArrow(split, "item long, hashes array<long>").where(F.size("hashes") > 0)


def statistics(docs: DataFrame, queries: Queries) -> tuple[int, int, np.ndarray]:
    """(documents with terms, their terms, documents that hold each term of the vocabulary)."""
    spark = docs.sparkSession
    size = len(queries.vocabulary)
    shared = spark.sparkContext.broadcast(queries)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size + 2, dtype=np.int64)
        for batch in batches:
            for _, texts in K.slices(batch.column(0)):
                hashes, cuts = terms(texts)
                lengths = np.diff(cuts)
                out[size] += (lengths > 0).sum()
                out[size + 1] += lengths.sum()
                hit, at = shared.value.found(hashes)
                owner = np.searchsorted(cuts, hit, side="right")
                out[:size] += np.bincount(np.unique(owner * size + at) % size, minlength=size)
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out[some])], names=["place", "n"])

    sums = docs.select("text").mapInArrow(partial, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    out = np.zeros(size + 2, dtype=np.int64)
    for row in sums.collect():  # at most a row for each term of the batch
        out[row.place] = row.n
    return int(out[size]), int(out[size + 1]), out[:size]


def best_of_tasks(docs: DataFrame, queries: Queries, top: int, width: int) -> DataFrame:
    """(item, doc_id, score): the best ``top`` rows of each item in each task."""
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(shared.value, top, width)
        for batch in batches:
            for start, texts in K.slices(batch.column(1)):
                hashes, cuts = terms(texts)
                lengths = np.diff(cuts)
                column = batch.column(0).slice(start, len(texts))
                nulls = pc.is_null(column).to_numpy(zero_copy_only=False)
                ids = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
                step = max(1, min(BLOCK, ENTRIES // len(shared.value.vocabulary)))
                for a in range(0, len(texts), step):
                    own = cuts[a : a + step + 1]
                    found = counted(hashes[own[0] : own[-1]], own - own[0])
                    search.block(ids[a : a + step], nulls[a : a + step], lengths[a : a + step], *found)
        for item, (scores, who, none) in zip(shared.value.items, search.best):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(scores), item)), pa.array(who, mask=none), pa.array(scores)], names=["item", "doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(searched, "item long, doc_id long, score long")


def search(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, top: int = TOP, width: int = WIDTH, batch_terms: int = BATCH_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents with a score above zero; ids of documents are longs."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    items = stash(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), F.col(item_text).alias("text")))
    split = stash(item_terms(items))
    total, some = split.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0)), F.count("*")).first()
    batches = max(-(-total // batch_terms), -(-some // BATCH_ITEMS))
    found = spark.createDataFrame([], "item long, doc_id long, score long")
    for k in range(batches):
        rows = split.where(F.pmod(F.xxhash64("item"), F.lit(batches)) == k).collect()  # about batch_terms
        if not rows:
            continue
        queries = Queries([r.item for r in rows], [np.array(r.hashes, dtype=np.int64).view(np.uint64) for r in rows])
        documents, length, holding = statistics(docs, queries)
        if length:
            queries.weigh(documents, length, holding)
            found = found.unionByName(best_of_tasks(docs, queries, top, width))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = found.withColumn("_bucket", F.pmod(F.spark_partition_id(), F.lit(BUCKETS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item", "_bucket").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
