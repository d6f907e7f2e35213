"""Quality rules: base counts, and distances of a text's histograms to those of its language.

``references`` adds up, over all documents of each language, the histogram of
character classes and the counts of all words, and keeps the most common words. A language has a reference if its documents hold
``REFERENCE_WORDS`` words; of more than ``LANGUAGES`` such languages, those with most words have one. ``rules`` compares
a text with every reference and takes the nearest: the Jensen-Shannon distance (base 2, 0 to 1) of its character
classes, and of its common words with one more place for all other words. Short texts have ragged
histograms, so each comparison waits for a least length. Words are compared in lower case (A-Z only) by 64-bit
hashes; equal 5-word windows of a text are found by 64-bit hashes, too.

Defined cases: a null or empty text has no words and fails the base rules. A text is compared with all references, whatever
its own language, which may be null or have none. Without references no text is compared. Repeated rows are judged one by one.
Texts are read whole. Columns of the input other than those named are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textkernel as K
from .common import small_batches, stash

#: Words of a language from which it has a reference, and how many languages have one at most: what tasks are sent has a bound.
REFERENCE_WORDS = 5_000
LANGUAGES = 500
COMMON_WORDS = 40
#: Texts with fewer code points in words, or fewer words, are not compared.
LEAST_CHARS, LEAST_WORDS = 200, 60
#: Distances beyond a limit fail a text. Limits are (a, b): a + b / sqrt(length), as ragged as short texts are.
CHARS_LIMIT, WORDS_LIMIT = (0.22, 2.0), (0.3, 1.0)
WINDOW = 5
SYMBOLS = b"#*$%&|<>"

#: Character classes: other, lower, upper, digit, sentence mark, symbol, other mark. Bytes that go on a character are not counted.
CLASSES = 7
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[33:127] = 6
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123], _CLASS[192:256] = 3, 2, 1, 1
_CLASS[list(b".,;:'\"?!()-")] = 4
_CLASS[list(SYMBOLS)] = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def class_counts(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """For each text, how many characters outside white space fall in each class."""
    counted = (data > 32) & ((data & 0xC0) != 0x80) | (data < 9) | ((data > 13) & (data < 32))
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))[counted]
    return np.bincount(text * CLASSES + _CLASS[data[counted]], minlength=(len(cuts) - 1) * CLASSES).reshape(-1, CLASSES)


def references(docs: DataFrame, text: str, lang: str, least: int = REFERENCE_WORDS, common: int = COMMON_WORDS) -> DataFrame:
    """(lang, kind, key, n): character classes (kind 0), common words (1) and all words (2) of each language with ``least`` words.

    Every document of a language counts. Tasks send the counts of the distinct words of a batch, which Spark adds
    up before and after the shuffle; the most common are limited in each task before they meet.
    """
    small_batches(docs.sparkSession)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = pc.dictionary_encode(batch.column(0))
            names, of_batch = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            for start, texts in K.slices(batch.column(1), 8 << 20):
                data, starts, ends, cuts = K.words(texts)
                _, bounds = K.raw(texts)
                code = of_batch[start : start + len(texts)]
                words = K.hashes(_LOWER[data], starts, ends)
                classes = class_counts(data, bounds)
                for i in np.unique(code):
                    mine = np.repeat(code == i, np.diff(cuts))
                    keys, n = np.unique(words[mine], return_counts=True)
                    sums = classes[code == i].sum(axis=0)
                    key = np.concatenate([np.arange(CLASSES), keys.view(np.int64), [0]])
                    kind = np.repeat([0, 1, 2], [CLASSES, len(keys), 1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[i]] * len(key)), pa.array(kind, pa.int32()), pa.array(key), pa.array(np.concatenate([sums, n, [n.sum()]]))],
                        names=["lang", "kind", "key", "n"],
                    )

    rows = docs.select(F.col(lang), F.col(text)).where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sums = rows.mapInArrow(counts, "lang string, kind int, key long, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key"))
    few = stash(sums.withColumn("_rank", rank).where(F.col("_rank") <= max(common, CLASSES)).drop("_rank"))
    enough = few.where((F.col("kind") == 2) & (F.col("n") >= least)).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    return few.join(enough.select("lang"), "lang", "left_semi")


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts ``p`` to the counts ``q``; 0 for rows without counts."""
    total = p.sum(axis=1, keepdims=True)
    p = p / np.maximum(total, 1)
    q = q / max(q.sum(), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        to_p = np.where(p > 0, p * np.log2(p / m), 0.0).sum(axis=1)
        to_q = np.where(q > 0, q * np.log2(q / m), 0.0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((to_p + to_q) / 2, 0, 1)), 0.0)


def beyond(distances: np.ndarray, length: np.ndarray, least: int, limit: tuple[float, float]) -> np.ndarray:
    return (length >= least) & (distances > limit[0] + limit[1] / np.sqrt(np.maximum(length, 1)))


def repeated(words: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """For each text, its words that lie in a window found twice or more in it."""
    n = len(words) - WINDOW + 1
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    if n <= 0:
        return np.zeros(len(cuts) - 1, np.int64)
    windows = K.mix(text[:n].astype(np.uint64))
    for i in range(WINDOW):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    windows = K.mix(windows)
    inside = text[:n] == text[WINDOW - 1 :]
    order = np.argsort(windows[inside], kind="stable")
    ordered = windows[inside][order]
    twin = np.zeros(len(ordered), dtype=bool)
    same = ordered[1:] == ordered[:-1]
    twin[1:] |= same
    twin[:-1] |= same
    at = np.flatnonzero(inside)[order[twin]]
    edges = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + WINDOW, minlength=len(words) + 1)
    return np.bincount(text[np.cumsum(edges)[:-1] > 0], minlength=len(cuts) - 1)


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


class Judge:
    """The rules over one slice of texts, given the references as rows."""

    def __init__(self, rows: list[tuple[str, int, int, int]]):
        self.languages = sorted({x[0] for x in rows})
        self.known = np.unique(np.array([x[2] for x in rows if x[1] == 1], dtype=np.int64).view(np.uint64))
        self.classes, self.common = {}, {}
        for lang in self.languages:
            classes = np.zeros(CLASSES)
            for of, kind, key, n in rows:
                if of == lang and kind == 0:
                    classes[key] = n
            words = np.array([(key, n) for a, kind, key, n in rows if a == lang and kind == 1], dtype=np.int64).reshape(-1, 2)
            every = sum(n for a, kind, _, n in rows if a == lang and kind == 2)
            place = np.searchsorted(self.known, words[:, 0].copy().view(np.uint64))
            self.classes[lang] = classes
            self.common[lang] = place, np.append(words[:, 1], every - words[:, 1].sum()).astype(float)

    def nearest(self, classes: np.ndarray, words: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least distances of character classes and of common words; 0 without references."""
        n = len(cuts) - 1
        if not self.languages:
            return np.zeros(n), np.zeros(n)
        by_class = np.min([distance(classes.astype(float), self.classes[x]) for x in self.languages], axis=0)
        text = np.repeat(np.arange(n), np.diff(cuts))
        place = np.minimum(np.searchsorted(self.known, words), max(len(self.known) - 1, 0))
        hit = self.known[place] == words if len(self.known) else np.zeros(len(words), bool)
        size = max(len(self.known), 1)
        counts = np.bincount(text[hit] * size + place[hit], minlength=n * size).reshape(n, size)
        by_word = []
        for place, reference in self.common.values():
            mine = counts[:, place].astype(float)
            by_word.append(distance(np.column_stack([mine, np.diff(cuts) - mine.sum(axis=1)]), reference))
        return by_class, np.min(by_word, axis=0)


COLUMNS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "base_failed": "boolean", "chars_distance": "double", "words_distance": "double", "kept": "boolean",
}


def rules(docs: DataFrame, doc_id: str, text: str, reference: DataFrame) -> DataFrame:
    """(doc_id, counts, distances, verdicts) of every row. The references, of a bounded number of languages and words, are
    sent to the tasks."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast([tuple(x) for x in reference.select("lang", "kind", "key", "n").collect()])
    kind = docs.schema[doc_id].dataType.simpleString()

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch in batches:
            for start, texts in K.slices(batch.column(1)):
                data, starts, ends, cuts = K.words(texts)
                _, bounds = K.raw(texts)
                classes = class_counts(data, bounds)
                n_words = np.diff(cuts)
                chars = classes.sum(axis=1)
                repeats = repeated(K.hashes(data, starts, ends), cuts)
                lines = [repeated_lines(x) if x else 0 for x in texts.to_pylist()]
                by_class, by_word = judge.nearest(classes, K.hashes(_LOWER[data], starts, ends), cuts)
                failed = (n_words < 10) | (100 * repeats > 20 * n_words)
                odd = beyond(by_class, chars, LEAST_CHARS, CHARS_LIMIT) | beyond(by_word, n_words, LEAST_WORDS, WORDS_LIMIT)
                values = [n_words, chars, classes[:, 5], np.array(lines, np.int64), repeats, failed, by_class, by_word, ~failed & ~odd]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), *map(pa.array, values)], names=["doc_id", *COLUMNS])

    schema = f"doc_id {kind}, " + ", ".join(f"{name} {of}" for name, of in COLUMNS.items())
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(judged, schema)
