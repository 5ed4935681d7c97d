"""Digest trees: whether two tables hold the same rows, and where they do not, without comparing them.

Every row belongs to a leaf by a hash of its key.  A leaf's digest is the number of its rows and two sums of row hashes, so it does not
depend on order or partitioning and tells repeated rows apart.  Digests add up: a node's is the sum of
its sixteen children's.  Two tables are compared from the root down; only children of nodes that differ are looked at, and
only the rows of leaves that differ are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 4  # sixteen children
ROWS_PER_LEAF = 4096
DEEPEST = 7
FEW = 1_000  # leaves whose numbers are handed to the scan


def depth_for(rows: int) -> int:
    depth = 0
    while depth < DEEPEST and ROWS_PER_LEAF << (BITS * depth) < rows:
        depth += 1
    return depth


def _hash(columns: list[str], salt: int = 0) -> Column:
    """A NULL is told from a missing column by its own mark."""
    marked = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*marked, F.lit(salt))


def with_leaf(df: DataFrame, key: list[str], depth: int) -> DataFrame:
    leaf = F.shiftrightunsigned(_hash(key), 64 - BITS * depth) if depth else F.lit(0).cast("bigint")
    return df.withColumn("leaf", leaf)


def tree(rows: DataFrame, columns: list[str], depth: int) -> DataFrame:
    """``level, node, n, a, b`` of rows with a ``leaf``; level 0 is the root."""
    sums = [F.sum(_hash(columns, s).cast("decimal(38,0)")).alias(n) for s, n in ((1, "a"), (2, "b"))]
    level = rows.groupBy(F.col("leaf").alias("node")).agg(F.count("*").alias("n"), *sums)
    # Each leaf counts once on every level above it; leaves are few beside rows.
    every = level.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    node = F.expr(f"shiftright(node, {BITS} * ({depth} - level))")
    return every.withColumn("node", node).groupBy("level", "node").agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("n", "a", "b")])


def depth_of(stored_tree: DataFrame) -> int:
    return stored_tree.agg(F.max("level")).first()[0] or 0


def differing_leaves(one: DataFrame, other: DataFrame, depth: int) -> DataFrame | None:
    """``leaf`` numbers whose digests differ; None if the roots are equal, which is one small read."""
    nodes = None
    for level in range(depth + 1):
        sides = []
        for side, tag in ((one, "x"), (other, "y")):
            own = side.filter(F.col("level") == level)
            if nodes is not None:
                own = own.withColumn("_up", F.shiftright("node", BITS)).join(nodes, "_up", "left_semi")
            sides.append(own.select("node", F.struct("n", "a", "b").alias(tag)))
        found = sides[0].join(sides[1], "node", "full").filter(~F.col("x").eqNullSafe(F.col("y")))
        if level == 0 and not found.limit(1).count():
            return None
        nodes = found.select(F.col("node").alias("_up"))
    return nodes.withColumnRenamed("_up", "leaf")


def of_leaves(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """The rows of some leaves; of a table sorted by leaf few row groups are read for few leaves."""
    few = [r[0] for r in leaves.limit(FEW + 1).collect()]
    if len(few) <= FEW:
        return rows.filter(F.col("leaf").isin(few))
    return rows.join(leaves, "leaf", "left_semi")
