"""Packing token sequences by cost: descending documents go to the cheapest sequence with room.

The cost of a piece of n tokens is ``LINEAR * n + QUADRATIC * n * n``: dense layers and attention. A task reads its
documents in pools of about ``POOL`` tokens. A pool's sequences have exactly as much room as its tokens need: as many full
ones as go in, and for what is left one sequence for each binary digit, since sequences whose length
is a power of two are not padded. So nothing is padded, however the input is split into tasks.

Within a pool, pieces are placed in descending cost, each whole in the cheapest sequence that has room for
it. If none has, the piece is cut: its beginning fills the cheapest sequence that has any room, and the rest waits for its own turn.
Documents longer than a sequence are cut into whole sequences first.

Nothing is shuffled: pools are balanced, so are their union's sequences, and a lost executor costs only its own tasks. A task holds
one pool, or one document if that is longer.

Ids come from the tokenizer, which cuts at white space whatever stands around it, and before a mark that ends a word after an
ASCII letter, so the ids of a text are those of these parts. A
task has its distinct parts encoded once and looks them up by a 64-bit hash; parts over ``LONG_WORD`` bytes are encoded where
they stand. ``words_stand_alone`` checks the tokenizer.

Defined cases: null and empty texts are documents of the end id alone. Repeated rows and rows with equal or null ids are
documents of their own. An empty table gives no rows. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import small_batches

CAPACITY = 4096
#: Costs by tokens and by their square: attention costs as much as the dense layers of width 1024 at 6 * 1024 tokens.
LINEAR = 1.0
QUADRATIC = 1 / 6144
#: Tokens from which a pool is packed.
POOL = 1 << 22
#: Entries after which a task starts its table of words anew.
TABLE_ENTRIES = 1_000_000
LONG_WORD = 256
_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
_MARK = np.isin(np.arange(256), list(b".,;:!?"))


def words_stand_alone(tokenizer) -> bool:
    """Whether texts with white space between words give the ids of the words."""
    words = ["It's", "áb", "́c", "<|endoftext|>x", "12,5", "é--É", "ﬁ", "ΑΣ", "'s", " x"]
    alone = [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    gaps = [" ", "  ", "\n", "\t ", "\r\n", "\x0b\x0c"]
    spaced = all(tokenizer.encode(gap + gap.join(words) + gap, add_special_tokens=False).ids == sum(alone, []) for gap in gaps)
    marks = [[tokenizer.encode(x, add_special_tokens=False).ids for x in ("It's", mark, f"It's{mark}")] for mark in ".,;:!?"]
    return spaced and all(a + b == both for a, b, both in marks)


def parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Like ``textkernel.words``, with a mark at the end of a word, after an ASCII letter, as a part of its own."""
    data, starts, ends, cuts = K.words(texts)
    marked = np.flatnonzero((ends - starts > 1) & _MARK[data[ends - 1]])
    marked = marked[_LETTER[data[ends[marked] - 2]]]
    before = ends[marked] - 1
    return data, np.insert(starts, marked + 1, before), np.insert(ends, marked, before), cuts + np.searchsorted(marked, cuts)


class Table:
    """Ids of distinct words by the hash of a word."""

    def __init__(self, tokenizer, most: int = TABLE_ENTRIES):
        self.tokenizer, self.most = tokenizer, most
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.starts, self.counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids: list[np.ndarray] = []
        self.used = 0

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def add(self, keys: np.ndarray, words: list[str]) -> None:
        found = self.encode_words(words)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((x for ids in found for x in ids), np.uint32, counts.sum())
        starts = self.used + np.cumsum(counts) - counts
        keys, starts, counts = (np.concatenate(x) for x in ((self.keys, keys), (self.starts, starts), (self.counts, counts)))
        order = np.argsort(keys, kind="stable")
        self.keys, self.starts, self.counts = keys[order], starts[order], counts[order]
        self.ids.append(flat)
        self.used += len(flat)
        if len(self.ids) > 64:
            self.ids = [np.concatenate(self.ids)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end, n + 1 offsets of the texts in them)."""
        data, starts, ends, cuts = parts(texts)
        hashes = K.hashes(data, starts, ends)
        long = np.flatnonzero(ends - starts > LONG_WORD)
        hashes[long] = hashes[0] if len(hashes) else 0  # stand-ins, replaced below
        distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == distinct[known]
        if (~known).sum() + len(self.keys) > self.most:
            self.clear()
            known[:] = False
        new = np.flatnonzero(~known)
        if len(new):
            self.add(distinct[new], [data[starts[i] : ends[i]].tobytes().decode() for i in first[new]])
        at = np.searchsorted(self.keys, distinct)
        flat = np.concatenate([np.zeros(0, np.uint32), *self.ids])
        begins, counts = self.starts[at][place], self.counts[at][place]
        if len(long):
            own = self.encode_words([data[starts[i] : ends[i]].tobytes().decode() for i in long])
            counts[long] = [len(x) for x in own]
            begins[long] = len(flat) + np.cumsum(counts[long]) - counts[long]
            flat = np.concatenate([flat, np.array([x for ids in own for x in ids], dtype=np.uint32)])
        upto = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat(begins - upto[:-1], counts) + np.arange(upto[-1])
        return flat[places], upto[cuts]


def rooms(tokens: int, capacity: int) -> list[int]:
    """Lengths of the sequences of a pool: full ones, and a power of two for each binary digit of the rest."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def cost(tokens: int) -> float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


def place(lengths: list[int], capacity: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; documents have at least one token."""
    room = np.array(rooms(sum(lengths), capacity), dtype=np.int64)
    left, costs = room.copy(), np.zeros(len(room))
    waiting = []
    for i, n in enumerate(lengths):
        waiting += [(-min(capacity, n - at), i, at) for at in range(0, n, capacity)]
    heapq.heapify(waiting)
    while waiting:
        n, i, at = heapq.heappop(waiting)
        n = -n
        open_costs = np.where(left >= n, costs, np.inf)
        to = int(open_costs.argmin())
        if left[to] < n:  # no sequence has room for all of it
            to = int(np.where(left > 0, costs, np.inf).argmin())
            fits = int(left[to])
            heapq.heappush(waiting, (fits - n, i, at + fits))
            n = fits
        yield i, at, n, to, int(room[to] - left[to])
        left[to] -= n
        costs[to] += cost(n)


def pack(docs: DataFrame, doc_id: str, text: str, tokenizer: str, end: int, capacity: int = CAPACITY, pool: int = POOL) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every piece.

    ``ids`` are little-endian unsigned 32-bit integers. ``tokenizer`` is a file of the tokenizers library, read on the
    driver; ``end`` follows each document's ids. ``capacity`` is a power of two.
    """
    from tokenizers import Tokenizer

    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read()
    if not words_stand_alone(Tokenizer.from_str(model)):
        raise ValueError("ids of this tokenizer depend on more than a word")
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        table = Table(Tokenizer.from_str(shared.value))
        base, names, held, tokens = TaskContext.get().partitionId() << 40, [], [], 0
        used = 0

        def emptied() -> Iterator[pa.RecordBatch]:
            ids = pa.concat_arrays(names)
            pieces = np.array(list(place([len(x) for x in held], capacity)), dtype=np.int64).reshape(-1, 5)
            pieces = pieces[np.lexsort((pieces[:, 4], pieces[:, 3]))]
            lengths = np.array([len(x) for x in held], dtype=np.int64)
            for a in range(0, len(pieces), 4096):
                which, start, length, sequence, offset = pieces[a : a + 4096].T
                own = pa.array([held[i][s : s + n].tobytes() for i, s, n in zip(which, start, length)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(which)), *map(pa.array, (start, length)), own, *map(pa.array, (lengths[which], base + used + sequence, offset))],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

        for batch in batches:
            for at, texts in K.slices(batch.column(1)):
                ids, cuts = table.encode(texts)
                ids = np.insert(ids, cuts[1:], np.uint32(end)).astype("<u4")
                cuts = cuts + np.arange(len(cuts))
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    held.append(ids[a:b])
                    tokens += int(b - a)
                    if tokens >= pool:
                        names.append(batch.column(0).slice(at, i + 1).slice(held_from(names, held, i)))
                        yield from emptied()
                        used += len(rooms(tokens, capacity))
                        names, held, tokens = [], [], 0
                rest = len(held) - sum(map(len, names))
                if rest:
                    names.append(batch.column(0).slice(at + len(texts) - rest, rest))
        if held:
            yield from emptied()

    def held_from(names: list, held: list, last: int) -> int:
        return last + 1 - (len(held) - sum(map(len, names)))

    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(packed, schema)
