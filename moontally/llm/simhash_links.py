"""SimHash near-duplicates: segment popcounts as coordinates, a grid join, exact verification.

A fingerprint's 64 bits fall into 32 segments of two. Their bit counts are a point in 32 dimensions,
and the Manhattan distance of two points is at most the number of differing bits. The point is held in 64 bits
again, each count as a bar of ones (0, 1, 3), so the Manhattan distance is the number of
differing bits of two points.

Grid: the dimensions form six groups. Points within a distance of three agree in at least three whole groups, so each point goes to
one cell per choice of three groups, keyed by its coordinates there, and fingerprints that can link
meet in a cell. In a cell, points within the distance are verified on the fingerprints, and only links that
join the cell's fingerprints into trees are given out: at most one less than there are members.

Cells with over ``CELL`` members are not compared pair by pair. Their fingerprints send
all values within one bit (near) and within two bits (far) of themselves; two fingerprints within three bits share a value that
is near to one of them. So all members of a value link to its least near member.

Equal fingerprints are one member, with the least document id, until the end.

Defined cases: a null or empty text has fingerprint zero, linked like any other. Rows with equal ids
are equal members. Texts are read whole. A null id takes part and gets the component's least id that is not
null. Columns of the input other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import small_batches, stash
from .components import components

SHINGLE = 3
BITS = 3
GROUPS = 6
CELL = 4096
_LOW = 0x5555555555555555


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def shingle_hashes(text: bytes) -> list[int]:
    """XXH64 (seed 42) of each three-word shingle of a lower-cased text; of all words if there are fewer."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return [xxhash.xxh64_intdigest(joined, 42)]
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-SHINGLE]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a : b - 1], 42) for a, b in zip(starts, ends[SHINGLE - 1 :])]


def majority(hashes: np.ndarray) -> np.uint64:
    """The bits that are set in over half of the 64-bit hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.asarray(hashes[at : at + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0]


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """Signed 64-bit fingerprints: a bit is set if it is set in over half of a text's shingle hashes."""
    return np.array([majority(np.array(shingle_hashes(text), dtype="<u8")) for text in texts], dtype=np.uint64).view(np.int64)


def mark(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, fingerprint as a signed long) of every row."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in K.slices(batch.column(1)):
                values = fingerprints([x or b"" for x in texts.cast(pa.binary()).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(values)], names=["doc_id", "mark"]
                )

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(marked, f"doc_id {kind}, mark long")


def point(mark: Column) -> Column:
    """The segment counts of a fingerprint: each pair of bits, sorted."""
    next_bit = F.shiftrightunsigned(mark, 1)
    either = mark.bitwiseOR(next_bit).bitwiseAND(F.lit(_LOW))
    both = mark.bitwiseAND(next_bit).bitwiseAND(F.lit(_LOW))
    return either.bitwiseOR(F.shiftleft(both, 1))


def grid_masks() -> list[int]:
    """For each choice of three of the six groups of segments, the bits of these groups."""
    cuts = [round(32 * i / GROUPS) for i in range(GROUPS + 1)]
    groups = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [signed(sum(groups[g] for g in choice)) for choice in combinations(range(GROUPS), GROUPS - BITS)]


def trees(marks: np.ndarray, points: np.ndarray, bits: int = BITS, names: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the members of one cell that are within reach of each other, a tree for each part.

    Members are called by their fingerprints or ``names``.
    """
    values, bars = marks.view(np.uint64), points.view(np.uint64)
    names = marks if names is None else names
    left = np.arange(len(values))
    out = []
    while len(left):
        edge, left = [left[0]], left[1:]
        while edge and len(left):
            at = edge.pop()
            near = np.flatnonzero(np.bitwise_count(bars[left] ^ bars[at]) <= bits)
            near = near[np.bitwise_count(values[left[near]] ^ values[at]) <= bits]
            found = left[near]
            out += [(int(names[at]), int(names[x])) for x in found]
            edge += found.tolist()
            left = np.delete(left, near)
    return out


def cell_links(cells: DataFrame) -> DataFrame:
    """(one, other): trees of the cells' links. Cells have at most ``CELL`` members."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for last, batch in flagged(batches):
            rows = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            rows = rows if rest is None else np.concatenate([rest, rows])
            change = np.flatnonzero((rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])) + 1
            bounds = [0, *change.tolist(), len(rows)]
            if not last:
                rest = rows[bounds[-2] :]
                bounds.pop()
            out = []
            for a, b in zip(bounds, bounds[1:]):
                if b - a > 1:
                    out += trees(rows[a:b, 2].copy(), rows[a:b, 3].copy())
            pairs = np.array(out, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["one", "other"])

    cells = cells.select("grid", "cell", "mark", "point").repartition("grid", "cell").sortWithinPartitions("grid", "cell", "mark")
    return cells.mapInArrow(linked, "one long, other long")


def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """The batches that have rows, each with whether it is the last."""
    held = None
    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield False, held
            held = batch
    if held is not None:
        yield True, held


def crowd_links(marks: DataFrame) -> DataFrame:
    """(one, other) for fingerprints of crowded cells, by shared values near to one of a pair. Grows in proportion to them."""
    one_bit = [signed(1 << i) for i in range(64)]
    near = F.array(*(F.lit(x) for x in [0, *one_bit]))
    bits = F.array(*(F.lit(x) for x in one_bit))
    values = marks.select("mark", F.explode(near).alias("_a"), F.lit(True).alias("near"))
    values = values.select("mark", F.col("mark").bitwiseXOR(F.col("_a")).alias("value"), "near")
    far = marks.select("mark", F.posexplode(bits).alias("_i", "_a")).select("mark", "_i", "_a", F.posexplode(bits).alias("_j", "_b"))
    far = far.where(F.col("_i") < F.col("_j"))
    far = far.select("mark", F.col("mark").bitwiseXOR(F.col("_a")).bitwiseXOR(F.col("_b")).alias("value"), F.lit(False).alias("near"))
    values = values.unionByName(far)
    least = values.groupBy("value").agg(F.min(F.when(F.col("near"), F.col("mark"))).alias("_least")).where("_least is not null")
    return values.join(least, "value").where("mark != _least").select(F.col("mark").alias("one"), F.col("_least").alias("other")).distinct()


def link(marks: DataFrame, cell: int = CELL) -> DataFrame:
    """(one, other) over distinct fingerprints ``mark``: enough links for the components of all within three bits."""
    masks = grid_masks()
    cells = marks.select("mark", point(F.col("mark")).alias("point"), F.posexplode(F.array(*(F.lit(x) for x in masks))).alias("grid", "_mask"))
    cells = cells.select("grid", F.col("point").bitwiseAND(F.col("_mask")).alias("cell"), "mark", "point")
    sizes = cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).where("n > 1")
    met = stash(cells.join(sizes, ["grid", "cell"]).select(F.col("grid").cast("long").alias("grid"), "cell", "mark", "point", "n"))
    crowded = met.where(F.col("n") > cell).select("mark").distinct()
    return cell_links(met.where(F.col("n") <= cell)).unionByName(crowd_links(crowded))


def near_duplicates(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, mark, component_id) of every row; component_id is the least id reachable by links."""
    marks = stash(mark(docs, doc_id, text))
    firsts = stash(marks.groupBy("mark").agg(F.min("doc_id").alias("first")))
    roots = components(link(firsts.select("mark")), "one", "other")
    labelled = firsts.join(roots, F.col("mark") == F.col("node"), "left").withColumn("root", F.coalesce("root", "mark"))
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    named = labelled.join(least, "root").select("mark", "component_id")
    return marks.join(named, "mark").select("doc_id", "mark", "component_id")
