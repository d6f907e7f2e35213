"""Phrases of a corpus by collocation strength, counted in hash-container tries.

Texts are lower-cased (A-Z), split into pieces at marks and line ends, and pieces into words. A word is its 64-bit hash.
Each task counts runs of words in a ``HatTrie`` per length, led by the language; subtrees that a task has no room for leave it as sorted
runs, and so do all at its end. Runs are dealt by language and prefix (pairs by their first word, or, after a hot word, by the
first bits of the second, too; longer runs by three words), and each prefix partition is merged by a sum. A phrase cannot be more frequent than its parts, so lengths are counted in turn: words, pairs of frequent words,
then runs of three and four words whose pairs are all frequent (a word counts as first of a pair only where a word of its
piece follows). What is frequent is handed to the next
pass as a bitmap of hashes of at most ``BITS`` bits (16 MB): a wrong bit costs work, never a count, since every length's counts are held
against the least count again.

A phrase of two to four words that occurs ``LEAST`` times is scored at each cut as ``2 * a / (l + r)`` in millionths, a its count, l and r those of its parts;
the lowest cut counts. It goes if a longer candidate holds it and has 80 percent of its occurrences. Scores are exact
(decimals of 38 digits). The words of the phrases that can be among a language's first are looked up in a last
pass over the texts.

Defined cases: a null text has no words, a null language is ``und``. Repeated rows, and rows with equal or null ids, count
each time: ids are not read. Texts without words and empty tables give no phrases. Columns of the input other than those named are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textkernel as K
from .common import small_batches, stash
from .hat_trie import HatTrie, Rows

LEAST = 30
LONGEST = 4
FIRST = 2000
#: Percent of a phrase's occurrences that a longer one must have for the phrase to go.
HELD = 80
#: A word with one of so many occurrences of all words is hot: the pairs it leads are dealt by ``BRANCH_BITS`` bits of the second word, too.
HOT = 2000
BRANCH_BITS = 8
#: Bits of the largest bitmap.
BITS = 1 << 27
_BLANK = np.isin(np.arange(256), [0x20, 0x09])
_BREAK = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
_ODD = np.uint64(0xD6E8FEB86659FD93)
_IDS = [f"w{i + 1}" for i in range(LONGEST)]


def pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start and end of each word, n + 1 offsets of the texts' words, number of the piece of each word)."""
    data, starts, ends, cuts = K.matches(texts, ~(_BLANK | _BREAK))
    breaks = np.flatnonzero(_BREAK[data])
    owner = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    return data, starts, ends, cuts, np.searchsorted(breaks, starts) + owner


def key(langs: np.ndarray, *ids: np.ndarray) -> np.ndarray:
    """One hash of a language's hash and word ids."""
    out = langs
    for column in ids:
        out = K.mix(out * _ODD + column)
    return out


def lang_hash(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 1)


class Bitmap:
    """Hashes that may be frequent."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(len(words) * 64 - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys & self.mask
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap(grams: DataFrame, width: int) -> Bitmap:
    """The bitmap of grams (lang, w1..., n) of ``width`` words: sixteen bits or more for each, ``BITS`` at most."""
    bits = min(BITS, max(1 << 16, 1 << (16 * grams.count()).bit_length()))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(bits // 64, dtype=np.uint64)
        for batch in batches:
            names = pc.dictionary_encode(batch.column(0))
            hashes = np.array([lang_hash(x) for x in names.dictionary.to_pylist()], dtype=np.uint64)
            ids = [batch.column(i + 1).to_numpy().view(np.uint64) for i in range(width)]
            at = key(hashes[names.indices.to_numpy()], *ids) & np.uint64(bits - 1)
            np.bitwise_or.at(out, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out[some].view(np.int64))], names=["place", "word"])

    rows = grams.select("lang", *_IDS[:width]).mapInArrow(marked, "place long, word long").groupBy("place").agg(F.bit_or("word").alias("word"))
    found = rows.toArrow()  # bits / 64 rows at most
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[found["place"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return Bitmap(words)


class Words:
    """The words of some texts: hash of the language, id and piece of each. ``langs`` numbers languages and goes on growing."""

    def __init__(self, names: list[str], texts: pa.Array, langs: dict[str, int]):
        self.data, self.starts, self.ends, cuts, self.piece = pieces(texts)
        self.ids = K.hashes(self.data, self.starts, self.ends)
        numbers = np.array([langs.setdefault(x, len(langs)) for x in names], dtype=np.uint64)
        hashes = np.array([lang_hash(x) for x in langs], dtype=np.uint64)
        self.lang = np.repeat(numbers, np.diff(cuts))
        self.own = hashes[self.lang.astype(np.int64)]
        self.together = self.piece[1:] == self.piece[:-1]  # a word and the next one

    def rows(self, at: np.ndarray, width: int) -> np.ndarray:
        """(language number, ids) of the runs of ``width`` words that begin at the places ``at``."""
        return np.stack([self.lang[at], *(self.ids[at + i] for i in range(width))], axis=1)

    def spelled(self, place: int) -> str:
        return self.data[self.starts[place] : self.ends[place]].tobytes().decode()


def single(words: Words, known: tuple) -> dict[int, np.ndarray]:
    """Every word, with 1 if a word of its piece follows and 2 if one stands before."""
    role = np.zeros(len(words.ids), dtype=np.uint64)
    role[:-1] += words.together
    role[1:] += np.uint64(2) * words.together
    return {2: np.concatenate([words.rows(np.arange(len(role)), 1), role[:, None]], axis=1)}


def paired(words: Words, known: tuple) -> dict[int, np.ndarray]:
    """Pairs whose first word is followed, and whose second is preceded, often enough."""
    first, second = (x.has(key(words.own, words.ids)) for x in known)
    return {2: words.rows(np.flatnonzero(words.together & first[:-1] & second[1:]), 2)}


def longer(words: Words, known: tuple) -> dict[int, np.ndarray]:
    """Runs of three and four words whose pairs are all frequent."""
    pairs = words.together & known[0].has(key(words.own[:-1], words.ids[:-1], words.ids[1:]))
    out = {}
    for width in range(3, LONGEST + 1):
        good = np.logical_and.reduce([pairs[i : max(0, len(pairs) - width + 2) + i] for i in range(width - 1)])
        out[width] = words.rows(np.flatnonzero(good), width)
    return out


def counted(docs: DataFrame, rows_of: Callable, known: tuple = (), width: int = LONGEST, hot: np.ndarray | None = None) -> DataFrame:
    """Runs (lang, w1, ..., n), ``width`` ids at most, of what ``rows_of`` finds in docs (lang, text).

    With ``hot``, a column ``branch`` parts what follows the words in it by the leading bits of the second id.
    """
    shared = docs.sparkSession.sparkContext.broadcast((known, hot))
    names = ["lang", *_IDS[:width], "n", *["branch"] * (hot is not None)]

    def batch_of(langs: list[str], rows: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        ids = [pa.array(rows[:, i + 1].view(np.int64)) if i + 1 < rows.shape[1] else pa.nulls(len(rows), pa.int64()) for i in range(width)]
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()).take(pa.array(rows[:, 0].astype(np.int64))), *ids, pa.array(counts), *branches(rows)], names=names)

    def branches(rows: np.ndarray) -> list[pa.Array]:
        if hot is None:
            return []
        return [pa.array(np.where(np.isin(rows[:, 1], shared.value[1]), rows[:, 2] >> np.uint64(64 - BRANCH_BITS), np.uint64(0)).astype(np.int64))]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[int, HatTrie] = {}
        langs: dict[str, int] = {}

        def out(found: Iterator[Rows]) -> Iterator[pa.RecordBatch]:
            for rows, counts in found:
                for a in range(0, len(rows), 1 << 15):
                    yield batch_of(list(langs), rows[a : a + (1 << 15)], counts[a : a + (1 << 15)])

        for batch in batches:
            for start, texts in K.slices(batch.column(1)):
                words = Words(batch.column(0).slice(start, len(texts)).to_pylist(), texts, langs)
                if len(words.ids):
                    for k, rows in rows_of(words, shared.value[0]).items():
                        yield from out(tries.setdefault(k, HatTrie(rows.shape[1])).add(rows))
        for trie in tries.values():
            yield from out(trie.finish())

    return docs.select("lang", "text").mapInArrow(runs, ", ".join(["lang string", *(f"{x} long" for x in names[1:])]))


def dealt(runs: DataFrame, prefix: list[str]) -> DataFrame:
    """The runs by language and prefix: a grouping by more columns merges each prefix partition where it is."""
    return runs.repartition("lang", *prefix)


def frequent(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(grams (lang, ids, f) that occur ``least`` times, totals (lang, n))."""
    role = F.when(F.col("w2") % 2 == 1, F.col("n")), F.when(F.col("w2") >= 2, F.col("n"))
    words = dealt(counted(docs, single, width=2), ["w1"]).groupBy("lang", "w1")
    words = words.agg(F.sum("n").alias("n"), *(F.coalesce(F.sum(x), F.lit(0)).alias(name) for x, name in zip(role, ("followed", "preceded"))))
    # rare words count for the totals alone
    id_or_rest = F.when(F.col("n") >= least, F.col("w1")).alias("w1")
    words = stash(words.groupBy("lang", id_or_rest).agg(F.sum("n").alias("n"), F.sum("followed").alias("followed"), F.sum("preceded").alias("preceded")))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    words = words.where("w1 is not null")
    roles = tuple(bitmap(words.where(F.col(name) >= least), 1) for name in ("followed", "preceded"))
    total = totals.agg(F.sum("n")).first()[0] or 0
    hot = words.where(F.col("n") * HOT >= total).select("w1").collect()  # HOT rows at most
    hot = np.array([r.w1 for r in hot], dtype=np.int64).view(np.uint64)
    sums = dealt(counted(docs, paired, roles, 2, hot), ["w1", "branch"]).groupBy("lang", "w1", "branch", "w2").agg(F.sum("n").alias("n"))
    pairs = stash(sums.where(F.col("n") >= least))
    sums = dealt(counted(docs, longer, (bitmap(pairs, 2),)), _IDS[:3]).groupBy("lang", *_IDS).agg(F.sum("n").alias("n"))
    long_ones = stash(sums.where(F.col("n") >= least))
    grams = words.select("lang", F.array("w1").alias("ids"), F.col("n").alias("f"))
    grams = grams.unionByName(pairs.select("lang", F.array("w1", "w2").alias("ids"), F.col("n").alias("f")))
    return grams.unionByName(long_ones.select("lang", F.array_compact(F.array(*_IDS)).alias("ids"), F.col("n").alias("f"))), totals


def spelling(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, word) of the ids in ``wanted`` (lang, w1)."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, 1))

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        seen: dict[int, str] = {}
        for batch in batches:
            for start, texts in K.slices(batch.column(1)):
                words = Words(batch.column(0).slice(start, len(texts)).to_pylist(), texts, langs)
                places = np.flatnonzero(shared.value.has(key(words.own, words.ids)))
                distinct, first = np.unique(words.ids[places], return_index=True)
                seen.update((w, words.spelled(i)) for w, i in zip(distinct.tolist(), places[first].tolist()) if w not in seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.fromiter(seen, np.uint64, len(seen)).view(np.int64)), pa.array(list(seen.values()), pa.string())], names=["id", "word"])

    found = docs.select("lang", "text").mapInArrow(spelled, "id long, word string").distinct()
    return found.join(wanted.select(F.col("w1").alias("id")).distinct(), "id", "left_semi")


def part(ids: str, start: Column, length: Column) -> Column:
    return F.slice(F.col(ids), start, length)


def scored(grams: DataFrame) -> DataFrame:
    """(lang, ids, a, l, r, score) of every candidate, at its lowest cut."""
    phrases = grams.where(F.size("ids") > 1)
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
    cuts = cuts.select("lang", "ids", F.col("f").alias("a"), "cut", part("ids", F.lit(1), F.col("cut")).alias("left"),
                       part("ids", F.col("cut") + 1, F.size("ids") - F.col("cut")).alias("right"))
    left = grams.select("lang", F.col("ids").alias("left"), F.col("f").alias("l"))
    right = grams.select("lang", F.col("ids").alias("right"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    wide = "cast({} as decimal(20, 0))"
    score = F.expr(f"(2000000 * {wide.format('a')}) div ({wide.format('l')} + {wide.format('r')})")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r"))
    return cuts.groupBy("lang", "ids", "a").agg(lowest.alias("_low")).select("lang", "ids", "a", "_low.l", "_low.r", "_low.score")


def held(grams: DataFrame) -> DataFrame:
    """(lang, ids, most) of every phrase inside a longer candidate: the occurrences of the most frequent of these."""
    longer = grams.where(F.size("ids") > 2)
    size = F.size("ids")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda at: F.slice("ids", at, k))))
    return longer.select("lang", F.explode(spans).alias("ids"), "f").groupBy("lang", "ids").agg(F.max("f").alias("most"))


def phrases(docs: DataFrame, text: str, lang: str, least: int = LEAST, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``first`` phrases."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    grams, totals = frequent(docs, least)
    alone = scored(grams).join(held(grams), ["lang", "ids"], "left")
    wide = "cast({} as decimal(20, 0))"
    gone = F.expr(f"100 * {wide.format('most')} >= {HELD} * {wide.format('a')}")
    alone = alone.where(F.col("most").isNull() | ~gone).drop("most")
    by_lang = Window.partitionBy("lang")
    order = [F.col("score").desc(), F.col("a").desc()]
    near = stash(alone.withColumn("rank", F.rank().over(by_lang.orderBy(*order))).where(F.col("rank") <= first).drop("rank"))
    wanted = stash(near.select("lang", F.explode("ids").alias("w1")).distinct())
    spelled = near.select("lang", "ids", F.posexplode("ids").alias("at", "id")).join(spelling(docs, wanted), "id")
    spelled = spelled.groupBy("lang", "ids").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("_words"))
    spelled = spelled.select("lang", "ids", F.array_join(F.col("_words.word"), " ").alias("phrase"))
    named = near.join(spelled, ["lang", "ids"]).withColumn("rank", F.row_number().over(by_lang.orderBy(*order, "phrase")))
    named = named.where(F.col("rank") <= first).join(totals, "lang")
    return named.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
