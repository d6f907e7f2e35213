"""Substring dedup: suffix automata of reference shards give the matching statistics of later documents.

A window of ``window`` words is old if its word sequence also starts in a document with a smaller id. Words
covered by old windows are removed: the maximal spans in which documents match earlier ones over at least the threshold.

Whole-corpus automata sent to every task would grow with the square of the corpus (every shard meets every document), so references are dealt into
shards that only meet the texts which can match them:

* A window's key is the least hash of its runs of ``ANCHOR`` words. Equal windows have equal keys. A piece is a run of
  neighbouring windows with one key, given by its first window and their number.
* Keys that occur in one document only are dropped after a count. What is left is brought together by key and content: of equal pieces the
  earliest document keeps its own, and every later one is old throughout. Other places of a piece in its earliest document
  get the spans found for the first place.
* The distinct pieces of a key are a reference shard. In the order of their earliest documents each is
  streamed through the suffix automaton of those before it, which gives the windows that match (length of
  match at least ``window``), and is then added to it.
* Shards over ``SHARD_WORDS`` words do not go into one automaton. Their pieces are cut again by another hash of the runs, which
  windows around one frequent run do not have in common, and so give smaller shards with automata of their own.
* What ``CUTS`` such hashes leave crowded (runs of one word in many lengths) is grouped by window digest, and the least
  document id of each decides. This is exact, too.

Only pieces, positions and the texts of keys with several distinct pieces are shuffled, and the documents
by their id. Nothing is collected.

Defined cases: a null text has no words. Rows with a null id keep all words and are no reference. Rows with equal ids are
no reference for each other. Texts are read whole. Columns of the input other than the id and the text
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import small_batches, stash

WINDOW = 50
ANCHOR = 8
SHARD_WORDS = 100_000
CUTS = 3
_ODD = 0xD6E8FEB86659FD93


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each run of ``width`` neighbours."""
    done, have = values, 1
    while 2 * have <= width:
        done = np.minimum(done[:-have], done[have:])
        have *= 2
    rest = width - have
    return np.minimum(done[: len(done) - rest], done[rest:]) if rest else done


def pieces(words: np.ndarray, cuts: np.ndarray, window: int, cut: int = 0) -> tuple[np.ndarray, ...]:
    """(key, digest, text, first word within the text, windows) of every piece of texts given as word hashes; ``cut`` picks the hash of runs."""
    n = len(words) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, none
    anchor = min(ANCHOR, window)
    runs = np.zeros(len(words) - anchor + 1, dtype=np.uint64)
    for i in range(anchor):
        runs = runs * np.uint64(_ODD) + words[i : i + len(runs)]
    keys = sliding_least(K.mix(runs ^ K.mix(np.uint64([cut]))) if cut else K.mix(runs), window - anchor + 1)
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    inside = text[:n] == text[window - 1 :]
    edge = np.ones(n, dtype=bool)
    edge[1:] = (keys[1:] != keys[:-1]) | (text[1:n] != text[: n - 1]) | (inside[1:] != inside[:-1])
    starts = np.flatnonzero(edge)
    count = np.diff(np.append(starts, n))
    starts, count = starts[inside[starts]], count[inside[starts]]
    digests = np.empty(len(starts), dtype=np.uint64)
    # sums of hashes times powers, from one start to the next within blocks that the powers cover
    step, at = len(K._INVERSE) - 1, 0
    while at < len(starts):
        origin = starts[at]
        upto = int(np.searchsorted(starts, origin + step))
        stops = starts[at:upto] + count[at:upto] + window - 1
        block = words[origin : stops.max()]
        if len(block) < len(K._POW):
            sums = np.zeros(len(block) + 1, dtype=np.uint64)
            np.cumsum(K.mix(block + np.uint64(1)) * K._POW[: len(block)], out=sums[1:])
            s = starts[at:upto] - origin
            digests[at:upto] = (sums[stops - origin] - sums[s]) * K._INVERSE[s]
        else:  # a very long piece: on its own
            upto = at + 1
            digests[at] = xxhash.xxh64_intdigest(words[origin : stops[0]].tobytes())
        at = upto
    of = text[starts]
    return keys[starts].view(np.int64), K.mix(digests).view(np.int64), of, starts - cuts[of], count


def tags(texts: pa.Array) -> np.ndarray:
    """What tells apart texts under one id: the same number as Spark's xxhash64 of a text."""
    return np.array([xxhash.xxh64_intdigest(x or b"", 42) for x in texts.cast(pa.binary()).to_pylist()], dtype=np.uint64).view(np.int64)


class Automaton:
    """A suffix automaton of several sequences, grown one at a time."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def _split(self, state: int, word, child: int) -> int:
        """The part of ``child`` that is reached from ``state`` with no longer suffix, as a state of its own."""
        copy = len(self.next)
        self.next.append(dict(self.next[child]))
        self.link.append(self.link[child])
        self.length.append(self.length[state] + 1)
        self.link[child] = copy
        while state >= 0 and self.next[state].get(word) == child:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list) -> None:
        follow, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            child = follow[last].get(word)
            if child is not None:
                last = child if length[child] == length[last] + 1 else self._split(last, word, child)
                continue
            new = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            state = last
            while state >= 0 and word not in follow[state]:
                follow[state][word] = new
                state = link[state]
            if state >= 0:
                child = follow[state][word]
                link[new] = child if length[child] == length[state] + 1 else self._split(state, word, child)
            last = new

    def matches(self, words: list, least: int) -> list[int]:
        """Ends (exclusive) of the matches of at least ``least`` words."""
        follow, link, length = self.next, self.link, self.length
        state = size = 0
        out = []
        for at, word in enumerate(words, 1):
            child = follow[state].get(word)
            while child is None and state:
                state = link[state]
                size = length[state]
                child = follow[state].get(word)
            if child is None:
                size = 0
            else:
                state, size = child, size + 1
            if size >= least:
                out.append(at)
        return out


def spans_of(ends: list[int], window: int) -> list[tuple[int, int]]:
    """Maximal spans covered by windows with these ends, in order."""
    out: list[tuple[int, int]] = []
    for end in ends:
        if out and end - window <= out[-1][1]:
            out[-1] = out[-1][0], end
        else:
            out.append((end - window, end))
    return out


def shard_matches(rows: list[tuple], window: int) -> Iterator[tuple[int, int, int]]:
    """(row, start, stop) of old spans. rows: (id, words) of a shard's distinct pieces, by id."""
    automaton, waiting = Automaton(), []
    for i, (doc, words) in enumerate(rows):
        if waiting and waiting[0][0] != doc:  # pieces of one document are no reference for each other
            for _, before in waiting:
                automaton.add(before)
            waiting = []
        ends = automaton.matches(words, window) if len(automaton.next) > 1 else []
        if len(ends) <= len(words) - window:  # else each of its windows is known
            waiting.append((doc, words))
        for start, stop in spans_of(ends, window):
            yield i, start, stop


def piece_table(docs: DataFrame, window: int, cut: int = 0) -> DataFrame:
    """(key, digest, doc_id, tag, start, n): the pieces of every text by the hash ``cut``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in K.slices(batch.column(1)):
                data, starts, ends, cuts = K.words(texts)
                key, digest, of, at, n = pieces(K.hashes(data, starts, ends), cuts, window, cut)
                ids = batch.column(0).slice(start, len(texts)).take(pa.array(of))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(digest), ids, pa.array(tags(texts)[of]), pa.array(at, pa.int64()), pa.array(n, pa.int64())],
                    names=["key", "digest", "doc_id", "tag", "start", "n"],
                )

    return docs.mapInArrow(found, f"key long, digest long, doc_id {kind}, tag long, start long, n long")


def piece_texts(docs: DataFrame, first: DataFrame, window: int) -> DataFrame:
    """Adds to pieces (key, digest, doc_id, tag, start, n) their words, joined by spaces."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = first.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("key", "digest", "start", "n")).alias("_wanted"))
    joined = docs.withColumn("tag", F.xxhash64(F.coalesce("text", F.lit("")))).join(wanted, ["doc_id", "tag"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column(2)
                sizes = pc.list_value_length(lists).to_numpy()
                wanted = lists.flatten()
                split = [x.split() for x in part.column(1).cast(pa.binary()).to_pylist()]
                rows = np.repeat(np.arange(part.num_rows), sizes)
                starts, counts = (wanted.field(i).to_numpy() for i in (2, 3))
                texts = [b" ".join(split[r][s : s + n + window - 1]) for r, s, n in zip(rows, starts, counts)]
                yield pa.RecordBatch.from_arrays(
                    [wanted.field(0), wanted.field(1), part.column(0).take(pa.array(rows)), part.column(3).take(pa.array(rows)), wanted.field(2), wanted.field(3), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["key", "digest", "doc_id", "tag", "start", "n", "words"],
                )

    schema = f"key long, digest long, doc_id {kind}, tag long, start long, n long, words string"
    return joined.select("doc_id", "text", "_wanted", "tag").mapInArrow(cut, schema)


def automaton_spans(shards: DataFrame, window: int) -> DataFrame:
    """(key, digest, doc_id, tag, at, _from, _to): old spans within pieces (at: a piece's start) of their earliest documents, by the automaton of their shard."""
    kind = shards.schema["doc_id"].dataType.simpleString()
    rows = shards.select("key", "doc_id", "tag", "start", "words", "digest").repartition("key").sortWithinPartitions("key", "doc_id", "start")

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list = []

        def shard() -> Iterator[tuple]:
            found = shard_matches([(x[1], x[4].split(b" ")) for x in rest], window)
            return ((rest[i][1], rest[i][0], rest[i][5], rest[i][2], rest[i][3], a, b) for i, a, b in found)

        names = ["doc_id", "key", "digest", "tag", "at", "_from", "_to"]
        for batch in batches:
            out = []
            columns = [batch.column(i).cast(pa.binary()) if i == 4 else batch.column(i) for i in range(6)]
            for row in zip(*(x.to_pylist() for x in columns)):
                if rest and rest[0][0] != row[0]:
                    out += shard()
                    rest = []
                rest.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], batch.column(1).type if i == 0 else pa.int64()) for i in range(7)], names=names)
        if rest:
            out = list(shard())
            ids = pa.array([x[0] for x in out])
            if out:
                yield pa.RecordBatch.from_arrays([ids, *(pa.array([x[i] for x in out], pa.int64()) for i in range(1, 7))], names=names)

    return rows.mapInArrow(matched, f"doc_id {kind}, key long, digest long, tag long, at long, _from long, _to long")


def window_spans(shards: DataFrame, window: int) -> DataFrame:
    """The same spans for shards that no cut makes smaller: the least id of each distinct window decides."""
    words = F.split("words", " ")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - window),
        lambda i: F.struct(i.alias("i"), F.md5(F.array_join(F.slice(words, i + 1, F.lit(window)), " ")).alias("w")),
    )
    rows = shards.select("key", "digest", "doc_id", "tag", "start", F.explode(windows).alias("_x")).select("*", "_x.i", "_x.w").drop("_x")
    least = rows.groupBy("key", "w").agg(F.min("doc_id").alias("_least"))
    old = rows.join(least, ["key", "w"]).where("_least < doc_id")
    begin = F.col("i").cast("long")
    return old.select("doc_id", "key", "digest", "tag", F.col("start").alias("at"), begin.alias("_from"), (begin + window).alias("_to"))


def recut_spans(shards: DataFrame, window: int, shard_words: int, cut: int) -> DataFrame:
    """The same spans for crowded shards: their pieces as documents of their own, cut by the next hash.

    Equal windows are in pieces of one shard, so what is old among its pieces is old among all documents.
    """
    spans = old_spans(shards.select("doc_id", F.col("words").alias("text")), window, shard_words, cut)
    spans = spans.select("doc_id", F.col("tag").alias("_piece"), F.col("start").alias("_from"), F.col("stop").alias("_to"))
    owners = shards.withColumn("_piece", F.xxhash64("words")).drop("words", "n").withColumnRenamed("start", "at")
    return owners.join(spans, ["doc_id", "_piece"]).select("doc_id", "key", "digest", "tag", "at", "_from", "_to")


def old_spans(docs: DataFrame, window: int, shard_words: int, cut: int = 0) -> DataFrame:
    """(doc_id, tag, start, stop) in words: spans covered by old windows. docs: (doc_id, text)."""
    table = stash(piece_table(docs, window, cut))
    shared = table.groupBy("key").agg(F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high")).where("_low < _high").select("key")
    met = stash(table.join(shared, "key"))
    place = F.struct("doc_id", "tag", "start", "n")
    distinct = stash(met.groupBy("key", "digest").agg(F.min(place).alias("_first")).select("key", "digest", "_first.*"))
    first = distinct.select("key", "digest", F.col("doc_id").alias("_first"))
    copies = met.join(first, ["key", "digest"]).where("doc_id > _first")
    copies = copies.select("doc_id", "tag", "start", (F.col("start") + F.col("n") + (window - 1)).alias("stop"))
    sizes = distinct.groupBy("key").agg(F.count("*").alias("_pieces"), F.sum(F.col("n") + (window - 1)).alias("_words"))
    mixed = distinct.join(sizes.where("_pieces > 1"), "key")
    texts = stash(piece_texts(docs, mixed.drop("_pieces"), window).join(sizes, "key"))
    own = automaton_spans(texts.where(F.col("_words") <= shard_words), window)
    crowded = texts.where(F.col("_words") > shard_words).drop("_pieces", "_words")
    if not crowded.isEmpty():
        own = own.unionByName(recut_spans(crowded, window, shard_words, cut + 1) if cut + 1 < CUTS else window_spans(crowded, window))
    found = stash(own)
    # what is old in a piece's first place is old in its other places under that document id
    held = distinct.select("key", "digest", F.col("doc_id").alias("_first"), F.col("tag").alias("_tag"), F.col("start").alias("_at"))
    places = met.join(held, ["key", "digest"]).where("doc_id = _first AND (tag != _tag OR start != _at)").drop("_first", "_tag", "_at")
    again = places.join(found.select("key", "digest", "_from", "_to").distinct(), ["key", "digest"])
    again = again.select("doc_id", "tag", (F.col("start") + F.col("_from")).alias("start"), (F.col("start") + F.col("_to")).alias("stop"))
    found = found.select("doc_id", "tag", (F.col("at") + F.col("_from")).alias("start"), (F.col("at") + F.col("_to")).alias("stop"))
    # repeated rows of a document find the same spans
    return copies.unionByName(found).unionByName(again).distinct()


def remove_repeats(docs: DataFrame, doc_id: str, text: str, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; kept is the words left, joined by one space."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    known = docs.where("doc_id is not null")
    spans = old_spans(known, window, shard_words).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))
    joined = docs.withColumn("tag", F.xxhash64(F.coalesce("text", F.lit("")))).join(spans, ["doc_id", "tag"], "left")

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in K.slices(batch.column(1)):
                split = [(x or b"").split() for x in texts.cast(pa.binary()).to_pylist()]
                lists = batch.column(2).slice(start, len(texts))
                removed, kept = [], []
                for i, words in enumerate(split):
                    keep = None
                    if lists[i].is_valid:
                        rows = lists[i].values
                        edges = np.bincount(rows.field(0).to_numpy(), minlength=len(words) + 1) - np.bincount(rows.field(1).to_numpy(), minlength=len(words) + 1)
                        keep = np.flatnonzero(np.cumsum(edges)[:-1] == 0).tolist()
                    own = words if keep is None else [words[k] for k in keep]
                    removed.append(len(words) - len(own))
                    kept.append(b" ".join(own))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array([len(x) for x in split], pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    schema = f"doc_id {kind}, n_words long, n_removed long, kept string"
    return joined.select("doc_id", "text", "_spans").mapInArrow(left, schema)
