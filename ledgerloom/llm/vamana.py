"""Approximate nearest neighbours by a robust-pruned directed graph (Subramanya et al., 2019).

Vectors are dealt into shards by a hash.  Each shard's graph starts random; then every point
searches it greedily from the medoid, and what the search met is pruned: the nearest candidate
becomes a neighbour and removes those that lie ``alpha`` times nearer to it than to the point, so
edges point in different directions.  Back edges are pruned alike.  Two passes, the second with
the relaxed ``alpha``.  A shard's graph is one stored row.  Queries go in blocks to every shard,
search it with a beam, and the exact distances of what the beams found are merged.

Graphs hold single precision, of vectors shifted to the shard's mean and scaled in double precision,
and take distances from differences, so neither the origin nor the unit matters.  A query further
than ``FAR`` times the shard's extent from its mean is compared with the whole shard in double precision.

Equal vectors are one point of the graph.  Their ids are looked up behind the search, of each
point the ``k + 1`` smallest, which is all that can be among the ``k`` nearest.

Defined cases: vectors that are null, zero, empty, or hold null or non-finite numbers take no part;
vectors of different lengths are never compared; rows that repeat an id and a vector count once;
rows without an id are no candidates and no queries; fewer candidates than ``k`` are all returned;
an empty table gives an empty result; neighbours whose distance overflows a double are not returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

SHARD_POINTS = 4096
BLOCK_QUERIES = 2048
DEGREE = 32
BUILD_BEAM, SEARCH_BEAM = 64, 128
ALPHA = 1.2
EXPANDED = 4  # points that a beam opens at a time
SALTS = 256
FAR = 1000


def _squared(x: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its own list of points."""
    apart = x[ids] - q[:, None, :]
    return np.einsum("bmd,bmd->bm", apart, apart)


class Graph:
    """The directed graph of one shard; ``edges`` is padded with -1."""

    def __init__(self, x: np.ndarray, edges: np.ndarray | None = None, start: int | None = None):
        x = x.astype(np.float64)
        self.unit = np.abs(x).max(initial=0) or 1.0
        self.mean = (x / self.unit).mean(axis=0)
        self.extent = np.abs(x / self.unit - self.mean).max(initial=0) or 1.0
        self.x = self.scaled(x).astype(np.float32)
        self.start = int(np.argmin(((self.x - self.x.mean(axis=0)) ** 2).sum(axis=1))) if start is None else start
        self.edges = edges

    def scaled(self, q: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (q.astype(np.float64) / self.unit - self.mean) / self.extent

    def search(self, q: np.ndarray, beam: int) -> np.ndarray:
        """For each query the ``beam`` best points that it met, nearest first; -1 pads."""
        q = self.scaled(q)
        far = np.abs(q).max(axis=1, initial=0) > FAR
        found = self._search(np.where(far[:, None], 0, q).astype(np.float32), beam)
        for i in np.flatnonzero(far):
            # Less the part that is equal for all points: |x|^2 - 2 x q.
            own, top = self.x.astype(np.float64), np.abs(q[i]).max()
            nearness = (own * own).sum(axis=1) / top - 2 * (own @ (q[i] / top)) if np.isfinite(top) else np.zeros(len(own))
            order = nearness.argsort(kind="stable")[: found.shape[1]]
            found[i, : len(order)] = order
        return found

    def _search(self, q: np.ndarray, beam: int) -> np.ndarray:
        """Of queries that are scaled."""
        n, rows = len(self.x), np.arange(len(q))[:, None]
        if n <= beam:  # the beam holds every point
            ids = np.tile(np.arange(n), (len(q), 1))
            return np.take_along_axis(ids, _squared(self.x, q, ids).argsort(axis=1, kind="stable"), axis=1)
        ids = np.full((len(q), beam), -1)
        near = np.full((len(q), beam), np.inf, np.float32)
        opened = np.zeros((len(q), beam), bool)
        seen = np.zeros((len(q), n + 1), bool)
        ids[:, 0], seen[:, self.start] = self.start, True
        near[:, 0] = _squared(self.x, q, ids[:, :1])[:, 0]
        while True:
            waiting = np.where(opened, np.inf, near)
            if not np.isfinite(waiting).any():
                return ids
            top = np.argpartition(waiting, EXPANDED, axis=1)[:, :EXPANDED]
            top_ids = np.where(np.isfinite(np.take_along_axis(waiting, top, axis=1)), np.take_along_axis(ids, top, axis=1), -1)
            opened[rows, top] = True
            met = np.where(top_ids[:, :, None] >= 0, self.edges[top_ids], -1).reshape(len(q), -1)
            met.sort(axis=1)
            fresh = (met >= 0) & ~seen[rows, met]
            fresh[:, 1:] &= met[:, 1:] != met[:, :-1]
            seen[rows, np.where(fresh, met, n)] = True
            far = np.where(fresh, _squared(self.x, q, met), np.inf).astype(np.float32)
            ids, near = np.concatenate((ids, met), axis=1), np.concatenate((near, far), axis=1)
            opened = np.concatenate((opened, ~fresh), axis=1)
            best = near.argsort(axis=1, kind="stable")[:, :beam]
            ids, near, opened = ids[rows, best], near[rows, best], opened[rows, best]
            ids[np.isinf(near)] = -1

    def prune(self, points: np.ndarray, candidates: np.ndarray, alpha: float) -> np.ndarray:
        """Robust pruning of each point's candidates (-1 pads) to at most ``DEGREE`` neighbours."""
        far = _squared(self.x, self.x[points], candidates)
        far[(candidates < 0) | (candidates == points[:, None])] = np.inf
        order = far.argsort(axis=1, kind="stable")
        rows = np.arange(len(points))[:, None]
        candidates, far = candidates[rows, order], far[rows, order]
        alive = np.isfinite(far)
        alive[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
        y = self.x[candidates] - self.x[points][:, None, :]  # seen from the point, so that near ones stay apart
        norms = np.einsum("bmd,bmd->bm", y, y)
        between = norms[:, :, None] - 2 * np.matmul(y, y.transpose(0, 2, 1)) + norms[:, None, :]
        out = np.full((len(points), DEGREE), -1)
        for r in range(DEGREE):
            has = alive.any(axis=1)
            if not has.any():
                break
            best = alive.argmax(axis=1)
            out[has, r] = candidates[has, best[has]]
            alive &= alpha * alpha * between[rows[:, 0], best] > far
            alive[rows[:, 0], best] = False
        return out

    def _pruned(self, points: np.ndarray, candidates: np.ndarray, alpha: float) -> None:
        step = max(1, (1 << 22) // candidates.shape[1] ** 2)
        for at in range(0, len(points), step):
            own = points[at : at + step]
            self.edges[own] = self.prune(own, candidates[at : at + step], alpha)

    def _add_back_edges(self, points: np.ndarray, alpha: float) -> None:
        targets = self.edges[points]
        source = np.repeat(points, DEGREE)[targets.ravel() >= 0]
        targets = targets.ravel()[targets.ravel() >= 0]
        order = np.argsort(targets, kind="stable")
        source, targets = source[order], targets[order]
        own, first, counts = np.unique(targets, return_index=True, return_counts=True)
        by_count = np.argsort(counts, kind="stable")  # so that lists of like length share a matrix
        for part in np.array_split(by_count, max(1, len(own) // 256)):
            if len(part):
                longest = counts[part].max()
                at = first[part][:, None] + np.minimum(np.arange(longest), counts[part][:, None] - 1)
                both = np.concatenate((self.edges[own[part]], source[at]), axis=1)
                self._pruned(own[part], both, alpha)

    def build(self, seed: int = 1) -> Graph:
        n = len(self.x)
        rng = np.random.default_rng(seed)
        self.edges = rng.integers(0, n, (n, DEGREE))
        if n <= BUILD_BEAM:
            return self
        batch = int(np.clip((1 << 22) // n, 16, 512))
        for alpha in (1.0, ALPHA):
            order = rng.permutation(n)
            for at in range(0, n, batch):
                points = order[at : at + batch]
                met = self._search(self.x[points], BUILD_BEAM)
                self._pruned(points, np.concatenate((met, self.edges[points]), axis=1), alpha)
                self._add_back_edges(points, alpha)
        return self


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, and finite throughout."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def build_index(points: DataFrame) -> DataFrame:
    """``dimension, shard, start, ids, vectors, edges``: one stored row per shard."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("point")
        x = _matrix(group.column("vector"))
        graph = Graph(x).build()
        row = {
            "dimension": group.column("dimension")[0].as_py(),
            "shard": group.column("shard")[0].as_py(),
            "start": graph.start,
            "ids": group.column("point").to_numpy().astype(np.int64).tobytes(),
            "vectors": x.astype(np.float64).tobytes(),
            "edges": graph.edges.astype(np.int32).tobytes(),
        }
        return pa.Table.from_pylist([row])

    schema = "dimension long, shard long, start long, ids binary, vectors binary, edges binary"
    return stored(points.groupBy("dimension", "shard").applyInArrow(build, schema), "graphs")


def search_index(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, point, score``: of each shard the ``k`` nearest points that the beam found."""
    sizes = queries.groupBy("dimension").agg(F.ceil(F.count("*") / BLOCK_QUERIES).alias("n"))
    asked = queries.join(F.broadcast(sizes), "dimension")  # a row for each length of vector
    blocks = asked.groupBy("dimension", F.pmod(F.xxhash64("query_id"), F.col("n")).alias("block")).agg(
        F.collect_list(F.struct("query_id", "vector")).alias("queries")
    )
    shards = index.groupBy("dimension").agg(F.collect_list("shard").alias("shards"))
    sent = blocks.join(shards, "dimension").select("dimension", F.explode("shards").alias("shard"), "queries")

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                d = row.column("dimension")[0].as_py()
                ids = np.frombuffer(row.column("ids")[0].as_py(), np.int64)
                x = np.frombuffer(row.column("vectors")[0].as_py(), np.float64).reshape(-1, d)
                edges = np.frombuffer(row.column("edges")[0].as_py(), np.int32).reshape(len(x), -1)
                graph = Graph(x, edges, row.column("start")[0].as_py())
                asked = row.column("queries").flatten()
                names = asked.field("query_id").to_numpy()
                q = _matrix(asked.field("vector")).astype(np.float64)
                step = int(np.clip((1 << 22) // len(x), 16, 512))
                for at in range(0, len(q), step):
                    found = graph.search(q[at : at + step], SEARCH_BEAM)
                    exact = np.sqrt(((x[found] - q[at : at + step, None, :]) ** 2).sum(axis=2))
                    exact[found < 0] = np.inf
                    best = np.lexsort((ids[found], exact), axis=1)[:, :k]
                    near, who = np.take_along_axis(exact, best, axis=1), ids[np.take_along_axis(found, best, axis=1)]
                    real = np.isfinite(near)
                    query = np.repeat(names[at : at + step], real.sum(axis=1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query), pa.array(who[real]), pa.array(near[real])], names=["query_id", "point", "score"]
                    )

    return sent.join(index, ["dimension", "shard"]).mapInArrow(search, "query_id long, point long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, shard_points: int = SHARD_POINTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query among ``vectors (vec_id, embedding)`` the
    ``k`` nearest others that were found, by Euclidean distance, ties to the smaller id."""
    plain = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    plain = stored(plain.withColumn("query", F.coalesce(is_query, F.lit(False))).distinct(), "vectors")

    same = plain.groupBy("vector").agg(F.min("vec_id").alias("point"), F.count("*").alias("n"))
    same = stored(same, "points")
    n_shards = max(1, -(-same.count() // shard_points))
    points = same.select(
        "point", "vector", F.size("vector").cast("bigint").alias("dimension"), F.pmod(F.xxhash64("point"), F.lit(n_shards)).alias("shard")
    )
    # The k + 1 smallest ids of each point; many equal vectors are first cut down within salts.
    copies = plain.join(same.filter("n > 1").select("vector", "point"), "vector").select("point", "vec_id")
    copies = copies.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    for by in (["point", "salt"], ["point"]):
        order = W.partitionBy(*by).orderBy("vec_id")
        copies = copies.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1).drop("_n")
    members = same.filter("n = 1").select("point", F.col("point").alias("vec_id")).unionByName(copies.select("point", "vec_id"))

    queries = plain.filter("query").select(F.col("vec_id").alias("query_id"), "vector", F.size("vector").cast("bigint").alias("dimension"))
    found = search_index(build_index(points), queries, k + 1)
    pairs = found.join(members, "point").filter("query_id <> vec_id")
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
