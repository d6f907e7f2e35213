"""Embedding near-duplicates: tiled comparison in the order of principal components.

Unit vectors are turned into the basis of principal components, most variance first. Of a pair, the leading products are
added up, and what is left is at most the product of the norms of the two suffixes; a pair whose bound is
below the threshold is not looked at again. The bound is itself a product (leading components with the
suffix norm put on end), so a tile of pairs is bounded by one small matrix product. What remains after the last
bound is compared on the given vectors in double precision.

Equal vectors are one member, with a number and a count. Members are dealt into tiles by hash, and a task compares one pair of
tiles, at most ``TILE`` members each on average. It gives out the number of links of each member and links that join linked
members into trees, never all pairs. All pairs of tiles are compared, so the work grows with the square of the distinct vectors, divided by what the
bounds save; the result is exact.

Defined cases: vectors that are null, zero, or hold null or non-finite components, and rows with a null id, link with nothing.
Shorter vectors are continued with zeros. Rows with equal ids are different vectors with the same
id. Columns of the input other than the id and the vector are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash
from .components import components

THRESHOLD = 0.9
TILE = 8192
#: Tiles there are at least, so that there is work for several tasks.
LEAST_TILES = 10
#: Numbers of leading components after which pairs are bounded.
LEADING = (8, 16, 32)
STRIP = 512
_SLACK = 1e-4


def matrix(vectors: pa.Array, size: int) -> np.ndarray:
    """Rows of doubles, continued with zeros to ``size``, each times a power of two that brings its largest component near 1:
    squares of very small or large components neither vanish nor overflow."""
    out = np.zeros((len(vectors), size))
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(size) < lengths[:, None]] = values
    _, exponents = np.frexp(np.abs(out).max(axis=1, initial=0))
    return np.ldexp(out, -exponents[:, None])


def moments(members: DataFrame, size: int) -> np.ndarray:
    """The sum of the outer products of all unit vectors, ``size`` by ``size``, added up by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                x = matrix(batch.column(0).slice(at, 4096), size)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], names=["place", "value"])

    sums = members.select("vector").mapInArrow(partial, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(size * size)
    for row in sums.collect():
        out[row.place] = row.value
    return out.reshape(size, size)


def bounded(one: np.ndarray, other: np.ndarray, upto: int) -> np.ndarray:
    """Upper bounds of the cosines of all pairs from ``upto`` leading components."""
    a, b = ((np.column_stack([x[:, :upto], np.linalg.norm(x[:, upto:], axis=1)])).astype(np.float32) for x in (one, other))
    return a @ b.T


def linked_pairs(one: np.ndarray, other: np.ndarray, basis: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (row of one, row of other) of pairs with a cosine of at least ``threshold``, by strips of ``one``."""
    norms = [np.linalg.norm(x, axis=1) for x in (one, other)]
    turned = [(x / n[:, None]) @ basis for x, n in zip((one, other), norms)]
    for at in range(0, len(one), STRIP):
        rows, cols = np.arange(at, min(at + STRIP, len(one))), np.arange(len(other))
        open_pairs = np.ones((len(rows), len(cols)), dtype=bool)
        for upto in (k for k in LEADING if k < basis.shape[0]):
            open_pairs &= bounded(turned[0][rows], turned[1][cols], upto) >= threshold - _SLACK
            r, c = open_pairs.any(axis=1), open_pairs.any(axis=0)
            rows, cols, open_pairs = rows[r], cols[c], open_pairs[r][:, c]
            if not len(rows):
                break
        if len(rows):
            cosines = (one[rows] @ other[cols].T) / (norms[0][rows][:, None] * norms[1][cols])
            r, c = np.nonzero(open_pairs & (cosines >= threshold))
            yield rows[r], cols[c]


def compare(left: pa.Table, right: pa.Table | None, basis: np.ndarray, threshold: float) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Numbers of links by member, and links that join linked members, of one pair of tiles (None: a tile with itself)."""
    size = basis.shape[0]
    one = matrix(left["vector"].combine_chunks(), size)
    other = one if right is None else matrix(right["vector"].combine_chunks(), size)
    shift = 0 if right is None else len(one)
    tables = [left] if right is None else [left, right]
    ids, counts = (np.concatenate([t[c].to_numpy() for t in tables]) for c in ("number", "n"))
    links = np.zeros(len(ids), dtype=np.int64)
    part = np.arange(len(ids))
    trees = []
    for rows, cols in linked_pairs(one, other, basis, threshold):
        cols = cols + shift
        apart = rows != cols
        rows, cols = rows[apart], cols[apart]
        np.add.at(links, rows, counts[cols])
        if right is not None:
            np.add.at(links, cols, counts[rows])
        for row, start, stop in zip(*runs(rows)):
            parts = np.unique(np.append(part[cols[start:stop]], part[row]))
            if len(parts) > 1:
                trees += [(int(ids[parts[0]]), int(ids[x])) for x in parts[1:]]
                part[np.isin(part, parts)] = parts[0]
    some = np.flatnonzero(links)
    return dict(zip(ids[some].tolist(), links[some].tolist())), trees


def runs(values: np.ndarray) -> tuple[list, list, list]:
    """(value, start, stop) of each run of equal values."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, int)
    return values[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(values)][: len(starts)]


def near_duplicates(rows: DataFrame, vec_id: str, vector: str, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; component_id is the least id reachable by links."""
    spark = rows.sparkSession
    rows = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("vector", F.when(good, F.col("vector")))
    members = rows.where("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("member"), F.count("*").alias("n"))
    members = stash(members.withColumn("number", F.monotonically_increasing_id()))
    total, size = members.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not total:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    values, basis = np.linalg.eigh(moments(members, size))
    shared = spark.sparkContext.broadcast(basis[:, np.argsort(-values)])
    tiles = max(LEAST_TILES, -(-total // tile))

    own = F.pmod(F.xxhash64("number"), F.lit(tiles))
    dealt = members.withColumn("tile", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    dealt = dealt.select(
        F.least("tile", "_other").alias("one"), F.greatest("tile", "_other").alias("other"), F.col("tile"), "number", "n",
        F.col("vector").cast("array<float>" if exact_as_float(members) else "array<double>").alias("vector"),
    )

    def compared(key: tuple, table: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        first = table.filter(pc.equal(table["tile"], key[0]))
        second = None if key[0] == key[1] else table.filter(pc.equal(table["tile"], key[1]))
        links, trees = ({}, [])
        if len(first) and (second is None or len(second)):
            links, trees = compare(first, second, shared.value, threshold)
        a = [*links.keys(), *(x for x, _ in trees)]
        b = [*(None for _ in links), *(x for _, x in trees)]
        n = [*links.values(), *(None for _ in trees)]
        return pa.table({"number": pa.array(a, pa.int64()), "other": pa.array(b, pa.int64()), "links": pa.array(n, pa.int64())})

    keyed = dealt.groupBy("one", "other")
    found = stash(keyed.applyInArrow(lambda key, x: compared(tuple(k.as_py() for k in key), x), "number long, other long, links long"))
    links = found.where("links is not null").groupBy("number").agg(F.sum("links").alias("links"))
    roots = components(found.where("other is not null"), "number", "other")
    known = members.join(links, "number", "left").join(roots, F.col("number") == F.col("node"), "left")
    known = known.withColumn("root", F.coalesce("root", "number"))
    least = known.groupBy("root").agg(F.min("member").alias("component_id"))
    known = known.join(least, "root").select("vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    joined = rows.join(known, "vector", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def exact_as_float(members: DataFrame) -> bool:
    """Whether all components are 32-bit numbers, which halves what the tiles send."""
    odd = F.exists("vector", lambda x: x.cast("float").cast("double") != x)
    return members.where(odd).isEmpty()
