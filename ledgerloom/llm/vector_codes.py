"""Vector codes: every vector is cut into parts, and each part is replaced by its nearest codebook entry.

Codebooks are fitted by Lloyd's rounds over all vectors, exactly and in whole numbers, with two trees:

1. The vectors are stored in blocks.  For each part position a block holds a balanced tree of its
   parts (an order of the rows, cut in halves along the widest side) and, from it, the box and the
   sum of every node.
2. The entries of a codebook form a second tree of boxes.  A walk goes down both trees at once.  The
   largest distance between two boxes bounds what the nearest entry can cost; entry nodes whose smallest
   distance lies above that bound are dropped for the whole part node.
3. A part node with one entry left is assigned as a whole: its stored sum and count go to that entry,
   and its parts are not looked at.  What is still open in the leaves is compared part by part.
4. A task returns a sum and a count for each entry; Spark adds them up, and the new entries (16 x 64 of
   them, a fixed bound) go back to the tasks.

Bounds are kept unless strictly worse, so ties reach the exact comparison and go to the lower index.

Components are ``floor(256 * x)``.  Blocks with components beyond ``SAFE`` are computed in unbounded
whole numbers, node by node left out; results are the same.

Defined cases: vectors that are null or empty, or hold null or non-finite numbers, take no part; so do
vectors whose length is not that of the vector with the smallest ``vec_id`` or is no multiple of
the number of parts; of rows that share an id, a codebook starts from the smallest vector, and all
are encoded; rows without an id are encoded but start no codebook; fewer ids than entries make smaller
codebooks; an error beyond a long is null, and so is a label's sum beyond a long; an empty table, or one
without a single id, gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK = 5000  # vectors
LEAF = 16  # parts of a leaf
SAFE = 1 << 24  # squared distances of up to 2**12 components stay below 2**63
LIMB = 40  # bits of unbounded sums that travel in one long
SALTS = 64
PAIRS = 1 << 15  # part nodes and entries that are compared part by part at a time


class Tree(NamedTuple):
    """Balanced tree over the rows of ``x`` (parts, rows, components): node ``i`` of level ``k`` holds
    ``order[:, cuts[k][i]:cuts[k][i + 1]]``; ``low`` and ``high`` are the boxes of each level."""

    order: np.ndarray
    cuts: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]


def _cuts(n: int, leaf: int) -> list[np.ndarray]:
    levels = [np.array([0, n])]
    while np.diff(levels[-1]).max() > leaf:
        c = levels[-1]
        middle = (c[:-1] + c[1:] + 1) // 2
        levels.append(np.unique(np.concatenate((c, middle))))
    return levels


def _reduced(function, x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return function.reduceat(x, cuts[:-1], axis=1)


def tree_order(x: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """For each part position the rows in the order of the tree's leaves."""
    parts, n, _ = x.shape
    order = np.broadcast_to(np.arange(n), (parts, n)).copy()
    for cuts in _cuts(n, leaf)[:-1]:
        own = np.take_along_axis(x, order[:, :, None], axis=1)
        side = (_reduced(np.maximum, own, cuts) - _reduced(np.minimum, own, cuts)).argmax(axis=2)
        node = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        along = np.take_along_axis(own, side[:, node][:, :, None], axis=2)[:, :, 0]
        order = np.take_along_axis(order, np.lexsort((along, np.broadcast_to(node, along.shape)), axis=1), axis=1)
    return order


def tree(x: np.ndarray, order: np.ndarray, leaf: int) -> Tree:
    own, cuts = np.take_along_axis(x, order[:, :, None], axis=1), _cuts(x.shape[1], leaf)
    low, high = [_reduced(np.minimum, own, cuts[-1])], [_reduced(np.maximum, own, cuts[-1])]
    for upper, lower in zip(cuts[-2::-1], cuts[:0:-1]):  # a node's box from those of its halves
        first = np.searchsorted(lower, upper)
        low.insert(0, _reduced(np.minimum, low[0], first))
        high.insert(0, _reduced(np.maximum, high[0], first))
    return Tree(order, cuts, low, high)


def _children(cuts: list[np.ndarray], level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First child and number of children (one or two) of nodes of a level."""
    at = np.searchsorted(cuts[level + 1], cuts[level])
    return at[nodes], np.diff(at)[nodes]


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number of the ranges ``first .. first + count``, and the range it is from."""
    which = np.repeat(np.arange(len(first)), count)
    return np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + first[which], which


class Walk:
    """The nearest entry of each part of a block, for all part positions at once."""

    def __init__(self, x: np.ndarray, points: Tree, entries: np.ndarray):
        self.x, self.points, self.entries = x, points, entries
        own = tree_order(entries, 1)
        self.codes = tree(entries, own, 1)
        #: ``whole``: (part position, node's first row, behind its last, entry); ``code`` of the rest by row.
        self.whole: list[np.ndarray] = []
        self.open: list[np.ndarray] = []
        self._down()

    def _down(self) -> None:
        parts = len(self.x)
        p, a, b = np.arange(parts), np.zeros(parts, np.int64), np.zeros(parts, np.int64)
        level_a = level_b = 0
        last_a, last_b = len(self.points.cuts) - 1, len(self.codes.cuts) - 1
        while len(p):
            p, a, b = self._pruned(level_a, level_b, p, a, b)
            if level_b == last_b:
                p, a, b = self._settled(level_a, p, a, b)
            if level_a == last_a and level_b == last_b:
                starts = np.flatnonzero(np.diff(p * len(self.points.cuts[-1]) + a, prepend=-1))
                cuts = starts[np.unique(np.searchsorted(starts, np.arange(0, len(p), PAIRS)).clip(max=len(starts) - 1))] if len(p) else starts
                for low, high in zip(cuts, [*cuts[1:], len(p)]):  # nodes stay whole
                    self._leaves(p[low:high], a[low:high], b[low:high])
                return
            if level_b < last_b:
                b, which = _spread(*_children(self.codes.cuts, level_b, b))
                p, a, level_b = p[which], a[which], level_b + 1
            if level_a < last_a:
                a, which = _spread(*_children(self.points.cuts, level_a, a))
                p, b, level_a = p[which], b[which], level_a + 1

    def _pruned(self, level_a: int, level_b: int, p, a, b):
        low, high = self.points.low[level_a][p, a], self.points.high[level_a][p, a]
        below, above = self.codes.low[level_b][p, b], self.codes.high[level_b][p, b]
        gap = np.maximum(np.maximum(below - high, low - above), 0)
        nearest = (gap * gap).sum(axis=1)
        reach = np.maximum(above - low, high - below)
        farthest = (reach * reach).sum(axis=1)
        node = p * (len(self.points.cuts[level_a]) - 1) + a
        order = np.argsort(node, kind="stable")
        first = np.flatnonzero(np.diff(node[order], prepend=-1))
        bound = np.repeat(np.minimum.reduceat(farthest[order], first), np.diff(first, append=len(order)))
        keep = order[nearest[order] <= bound]
        return p[keep], a[keep], b[keep]

    def _settled(self, level_a: int, p, a, b):
        """Take out part nodes with one entry left."""
        node = p * (len(self.points.cuts[level_a]) - 1) + a
        first = np.flatnonzero(np.diff(node, prepend=-1))
        alone = np.repeat(np.diff(first, append=len(node)) == 1, np.diff(first, append=len(node)))
        cuts, entry = self.points.cuts[level_a], self.codes.order
        q = p[alone]
        self.whole.append(np.stack((q, cuts[a[alone]], cuts[a[alone] + 1], entry[q, b[alone]])))
        return p[~alone], a[~alone], b[~alone]

    def _leaves(self, p, a, b) -> None:
        cuts = self.points.cuts[-1]
        row, which = _spread(cuts[a], cuts[a + 1] - cuts[a])
        p, entry = p[which], self.codes.order[p, b][which]
        away = self.x[p, self.points.order[p, row]] - self.entries[p, entry]
        far = (away * away).sum(axis=1)
        order = np.lexsort((entry, far, row, p))
        p, row, entry = p[order], row[order], entry[order]
        first = np.flatnonzero((np.diff(p, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
        self.open.append(np.stack((p[first], row[first], entry[first])))

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """``(parts, entries)`` counts and ``(parts, entries, components)`` sums."""
        parts, k, d = self.entries.shape
        counts, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, d), np.int64)
        own = np.take_along_axis(self.x, self.points.order[:, :, None], axis=1)
        total = np.zeros((parts, own.shape[1] + 1, d), np.int64)
        np.cumsum(own, axis=1, out=total[:, 1:])
        for p, low, high, entry in self.whole:
            np.add.at(counts, (p, entry), high - low)
            np.add.at(sums, (p, entry), total[p, high] - total[p, low])
        for p, row, entry in self.open:
            np.add.at(counts, (p, entry), 1)
            np.add.at(sums, (p, entry), own[p, row])
        return counts, sums

    def assigned(self) -> np.ndarray:
        """The entry of each row, ``(parts, rows)``."""
        along = np.empty(self.x.shape[:2], np.int64)
        for whole in self.whole:
            p, low, high, entry = whole
            row, which = _spread(low, high - low)
            along[p[which], row] = entry[which]
        for p, row, entry in self.open:
            along[p, row] = entry
        out = np.empty_like(along)
        np.put_along_axis(out, self.points.order, along, axis=1)
        return out


def _plain_assigned(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Without trees, in unbounded whole numbers."""
    out = np.zeros(x.shape[:2], np.int64)
    for p in range(len(x)):
        for i, own in enumerate(x[p]):
            far = ((entries[p] - own) ** 2).sum(axis=1)
            out[p, i] = min(range(len(far)), key=lambda e: (far[e], e))
    return out


def _plain_sums(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = _plain_assigned(x, entries)
    counts, sums = np.zeros(entries.shape[:2], np.int64), np.zeros(entries.shape, object)
    for p in range(len(x)):
        for i, e in enumerate(found[p]):
            counts[p, e] += 1
            sums[p, e] += x[p, i]
    return counts, sums


def whole_numbers(v: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * v)``, exactly; as unbounded whole numbers where they are large."""
    if not len(v) or np.abs(v).max() < SAFE / scale:
        return np.floor(v * scale).astype(np.int64)  # a power of two: the product is exact
    return np.array([int(np.floor(x * scale)) if abs(x) < 2**40 else int(x) * scale for x in v.ravel()], object).reshape(v.shape)


def _in_parts(v: np.ndarray, parts: int) -> np.ndarray:
    """``(rows, dimension)`` to ``(parts, rows, components)``."""
    return np.ascontiguousarray(v.reshape(len(v), parts, -1).transpose(1, 0, 2))


def _vectors(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _blocks(kept: DataFrame, dimension: int, parts: int) -> DataFrame:
    """Stored blocks: ``ids`` and ``labels`` of their rows, the vectors, and the trees' orders."""

    def build(batches):
        for batch in batches:
            v = _vectors(batch.column("vector"), dimension)
            x = whole_numbers(v)
            order = np.zeros((0, 0), np.int16) if x.dtype == object else tree_order(_in_parts(x, parts)).astype(np.int16)
            row = {
                "vec_ids": batch.column("vec_id").to_pylist(),
                "labels": batch.column("label").to_pylist(),
                "vectors": v.tobytes(),
                "trees": order.tobytes(),
            }
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("vec_ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())), ("vectors", pa.binary()), ("trees", pa.binary()),
            ]))

    def cut(batches):  # batches of any size to blocks
        for batch in batches:
            blocks = -(-batch.num_rows // BLOCK)
            for b in range(blocks):
                low, high = (batch.num_rows * i // blocks for i in (b, b + 1))
                yield batch.slice(low, high - low)

    schema = "vec_ids array<long>, labels array<string>, vectors binary, trees binary"
    return stored(kept.mapInArrow(lambda batches: build(cut(batches)), schema), "vector-blocks")


def _opened(batch: pa.RecordBatch, dimension: int, parts: int):
    """Of each block the parts and their tree; no tree where numbers are unbounded."""
    for i in range(batch.num_rows):
        v = np.frombuffer(batch.column("vectors")[i].as_py(), np.float64).reshape(-1, dimension)
        x = _in_parts(whole_numbers(v), parts)
        order = np.frombuffer(batch.column("trees")[i].as_py(), np.int16).reshape(parts, -1).astype(np.int64)
        yield i, x, None if x.dtype == object else tree(x, order, LEAF)


def _limbs(value: int) -> list[int]:
    """``value`` as numbers of ``LIMB`` bits, lowest first; the last one has the sign."""
    out = []
    while not -(1 << LIMB) < value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def _round(blocks: DataFrame, entries: np.ndarray, dimension: int) -> np.ndarray:
    """The entries after one round of assigning and averaging."""
    parts = entries.shape[0]

    def add(batches):
        for batch in batches:
            for _, x, points in _opened(batch, dimension, parts):
                if points is None or entries.dtype == object:
                    counts, sums = _plain_sums(x.astype(object), entries.astype(object))
                else:
                    counts, sums = Walk(x, points, entries).sums()
                rows = [
                    (p, e, i, k, int(counts[p, e]), limb)
                    for p, e in zip(*(i.tolist() for i in np.nonzero(counts)))
                    for i, total in enumerate(sums[p, e].tolist())
                    for k, limb in enumerate(_limbs(total))
                ]
                names = ("part", "entry", "component", "limb", "n", "total")
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    partial = blocks.mapInArrow(add, "part long, entry long, component long, limb long, n long, total long")
    # A row for each entry, component and limb: a bounded result, whatever the number of vectors.
    totals = partial.groupBy("part", "entry", "component", "limb").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    added: dict[tuple[int, int, int], list[int]] = {}
    for r in totals.collect():
        own = added.setdefault((r["part"], r["entry"], r["component"]), [0, 0])
        own[0] += int(r["total"]) << LIMB * r["limb"]
        own[1] = max(own[1], r["n"])  # every row has the lowest limb
    new = entries.astype(object)
    for place, (total, n) in added.items():
        new[place] = total // n
    return new


def _as_array(entries: list) -> np.ndarray:
    small = all(abs(c) < SAFE for part in entries for entry in part for c in entry)
    return np.array(entries, np.int64 if small else object)


def fit_codebooks(blocks: DataFrame, start: np.ndarray, dimension: int, rounds: int = ROUNDS) -> np.ndarray:
    """``(parts, entries, components)`` after the rounds."""
    entries = start
    for _ in range(rounds):
        entries = _as_array(_round(blocks, entries, dimension).tolist())
    return entries


def _digest(entries: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(c) for part in entries.tolist() for entry in part for c in entry).encode()).hexdigest()


def encode_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, label, code, error, codebooks_sha256`` for ``vectors (vec_id, embedding, label)``; ``code``
    is one byte a part."""
    spark = vectors.sparkSession
    schema = "vec_id long, label string, code binary, error long, codebooks_sha256 string"
    if entries > 256:
        raise ValueError("a code is one byte a part")
    plain = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.col("label").cast("string").alias("label"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = plain.filter(F.coalesce(finite, F.lit(False)) & (F.size("vector") > 0))
    by_id = kept.filter("vec_id is not null").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    first = by_id.orderBy("vec_id").limit(1).collect()
    dimension = len(first[0]["vector"]) if first else 0
    if not dimension or dimension % parts:
        return spark.createDataFrame([], schema)
    kept = kept.filter(F.size("vector") == dimension)
    smallest = kept.filter("vec_id is not null").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    start = smallest.orderBy("vec_id").limit(entries).collect()
    start = _in_parts(whole_numbers(np.array([r["vector"] for r in start])), parts)
    blocks = _blocks(kept, dimension, parts)
    final = fit_codebooks(blocks, _as_array(start.tolist()), dimension, rounds)
    sha = _digest(final)

    def encode(batches):
        for batch in batches:
            for i, x, points in _opened(batch, dimension, parts):
                if points is None or final.dtype == object:
                    x, own = x.astype(object), final.astype(object)
                    codes = _plain_assigned(x, own)
                else:
                    own, codes = final, Walk(x, points, final).assigned()
                away = x - np.take_along_axis(own, codes[:, :, None], axis=1)
                error = (away * away).sum(axis=(0, 2)).tolist()
                codes = codes.T.astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_ids")[i].values, batch.column("labels")[i].values,
                     pa.array([c.tobytes() for c in codes], pa.binary()),
                     pa.array([e if e < 2**63 else None for e in error], pa.int64()), pa.array([sha] * len(codes))],
                    names=["vec_id", "label", "code", "error", "codebooks_sha256"],
                )

    return blocks.mapInArrow(encode, schema)


def with_label_error(codes: DataFrame) -> DataFrame:
    """Add ``label_error``, the sum of the errors of all rows with the same label."""
    codes = stored(codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS))), "vector-codes")
    whole = F.sum(F.col("error").cast("decimal(38,0)"))
    unknown = F.max(F.col("error").isNull())
    sums = codes.groupBy("label").agg(F.when(~unknown, whole).alias("sum"))
    sums = sums.select(
        F.col("label").alias("_label"), F.expr("try_cast(sum as bigint)").alias("label_error"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
    )  # a frequent label's rows are dealt over the salts
    on = codes["label"].eqNullSafe(sums["_label"]) & (codes["salt"] == sums["_salt"])
    return codes.join(sums, on, "left").drop("salt", "_label", "_salt")
