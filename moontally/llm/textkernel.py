"""Vectorised words and word hashes of Arrow text columns, for code that runs inside tasks.

A word is a maximal run of bytes other than space and \\x09-\\x0D, so UTF-8 text is never cut
inside a character. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes hashed at a time, which bounds the temporary arrays.
STEP = 1 << 20
#: Words over this many bytes are hashed one by one.
LONG_WORD = 1 << 16
_ODD = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POW = _powers(_ODD, STEP + LONG_WORD + 1)
_INVERSE = _powers(pow(_ODD, -1, 2**64), STEP + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def mix_inside(h: np.ndarray) -> np.ndarray:
    """``mix``, in the array itself."""
    part = np.empty_like(h)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        h ^= np.right_shift(h, np.uint64(shift), out=part)
        if factor > 1:
            h *= np.uint64(factor)
    return h


def slices(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Parts of about ``most`` bytes, cut between texts, with the index of their first text."""
    ends = np.cumsum(lengths(texts))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end and the n + 1 offsets of the texts in them."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[cuts[0] : cuts[-1]], cuts - cuts[0]


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start of each word, end of each word, n + 1 offsets of the texts' words)."""
    data, cuts = raw(texts)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    solid = ~blank
    first = np.empty(len(data), dtype=bool)
    last = np.empty(len(data), dtype=bool)
    if len(data):
        first[0], last[-1] = True, True
        first[1:], last[:-1] = blank[:-1], blank[1:]
        inner = cuts[(cuts > 0) & (cuts < len(data))]
        first[inner], last[inner - 1] = True, True
    starts = np.flatnonzero(solid & first)
    ends = np.flatnonzero(solid & last) + 1
    return data, starts, ends, np.searchsorted(starts, cuts)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    out = np.empty(len(starts), dtype=np.uint64)
    long = np.flatnonzero(ends - starts > LONG_WORD)
    step_ends = np.minimum(ends, starts + LONG_WORD) if len(long) else ends
    at = 0
    while at < len(starts):
        origin = starts[at]
        upto = int(np.searchsorted(starts, origin + STEP))
        piece = data[origin : step_ends[upto - 1]]
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(_TABLE[piece] * _POW[: len(piece)], out=sums[1:])
        s = starts[at:upto] - origin
        out[at:upto] = (sums[step_ends[at:upto] - origin] - sums[s]) * _INVERSE[s]
        at = upto
    for i in long:
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return mix(out)


#: Lower-cases A-Z and leaves other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def matches(texts: pa.Array, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Like ``words``, lower-cased, for the maximal runs of bytes for which ``inside`` (256 truth values) holds.

    All bytes of a character outside ASCII must be inside or all outside.
    """
    data, cuts = raw(texts)
    data = LOWER[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    solid = inside[data]
    edge[cuts] = True
    if len(data):
        edge[1:-1] |= solid[1:] != solid[:-1]
    places = np.flatnonzero(edge)
    kept = solid[places[:-1]] if len(places) > 1 else np.zeros(0, dtype=bool)
    starts, ends = places[:-1][kept], places[1:][kept]
    return data, starts, ends, np.searchsorted(starts, cuts)
