"""Nearest neighbours by inner product: stable projections, kd-tree cells, chi-square stopping."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Projected dimensions (even, for the closed form of the chi-square distribution). More of them stop earlier and cost more per vector.
DIMS = 24
#: Vectors of a kd-tree leaf, and of one tree (a tree is what one task holds).
LEAF, TREE = 512, 50_000
#: Queries that one task takes to a tree.
BATCH = 5_000
#: Projected neighbours verified between two looks at the stopping test.
ROUND = 256


def chi_square(x: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.minimum(x / 2, 700)
    term, total = np.ones_like(half), np.ones_like(half)
    for k in range(1, dims // 2):
        term = term * half / k
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_quantile(share: float, dims: int = DIMS) -> float:
    """The value below which ``share`` of the distribution lies, by halving."""
    low, high = 0.0, 10.0 * dims + 1000
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(np.array([mid]), dims)[0] < share else (low, mid)
    return high


def _leaves(points: np.ndarray, order: np.ndarray) -> list[np.ndarray]:
    """kd-tree: halve at the median of the widest side down to leaves of ``LEAF`` points."""
    out, todo = [], [order]
    while todo:
        part = todo.pop()
        if len(part) <= LEAF:
            out.append(part)
            continue
        own = points[part]
        side = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        cut = len(part) // 2
        part = part[np.argpartition(own[:, side], cut)]
        todo += [part[:cut], part[cut:]]
    return out


class Tree:
    """A kd-tree over projected vectors that gives a query its projected neighbours one after the other."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, matrix: np.ndarray, lift: float):
        norm = np.einsum("ij,ij->i", vectors, vectors)
        points = np.hstack((vectors, np.sqrt(np.maximum(lift - norm, 0))[:, None])) @ matrix
        leaves = _leaves(points, np.arange(len(ids)))
        order = np.concatenate(leaves)  # a leaf is a slice
        self.ids, self.vectors, self.points = ids[order], vectors[order], points[order]
        self.square = np.einsum("ij,ij->i", self.points, self.points)
        self.ends = np.cumsum([0] + [len(x) for x in leaves])
        self.low = np.minimum.reduceat(self.points, self.ends[:-1])
        self.high = np.maximum.reduceat(self.points, self.ends[:-1])

    def search(self, query: np.ndarray, projected: np.ndarray, lift: float, k: int, own_id: int, limit: float):
        """The ``k`` best found: (ids, scores, vectors verified), ties to the smaller id.

        Leaves are opened by their distance; a point comes up once no closed leaf can hold a nearer one, and its original
        vector is verified. The search ends at the first point whose squared projected distance is ``limit`` times the
        squared distance of the k-th best, as an unseen vector that near would have been projected closer with the chance
        that ``limit`` is the quantile of.
        """
        gap = np.maximum(np.maximum(self.low - projected, projected - self.high), 0)
        near = np.einsum("ij,ij->i", gap, gap)
        order = np.argsort(near, kind="stable")
        ids, scores = np.zeros(0, np.int64), np.zeros(0)
        both, bound, seen = float(query @ query) + lift, np.inf, 0
        rows, far = np.zeros(0, np.int64), np.zeros(0)  # opened, not yet up
        at, step = 0, 4
        own = float(projected @ projected)
        while (at < len(order) and near[order[at]] < bound) or len(rows):
            if at < len(order) and near[order[at]] < bound:
                slices = [slice(self.ends[x], self.ends[x + 1]) for x in order[at : at + step]]
                off = np.concatenate([self.square[x] - 2 * (self.points[x] @ projected) for x in slices]) + own
                opened = np.concatenate([np.arange(x.start, x.stop) for x in slices])
                use = (off < bound) & (self.ids[opened] != own_id)
                rows, far = np.concatenate((rows, opened[use])), np.concatenate((far, off[use]))
                at, step = at + step, min(step * 2, 64)
            up = far <= near[order[at]] if at < len(order) else np.ones(len(far), bool)
            turn = rows[up][np.argsort(far[up], kind="stable")]
            reach = np.sort(far[up])
            for part in range(0, len(turn), ROUND):
                some = turn[part : part + ROUND][: np.searchsorted(reach[part : part + ROUND], bound)]
                if not len(some):
                    break
                seen += len(some)
                got, got_ids = self.vectors[some] @ query, self.ids[some]
                if len(ids) >= k:
                    better = got >= scores[k - 1]
                    got, got_ids = got[better], got_ids[better]
                    if not len(got):
                        continue
                ids, scores = np.concatenate((ids, got_ids)), np.concatenate((scores, got))
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
                if len(ids) >= k:
                    bound = limit * max(both - 2 * scores[k - 1], 1e-9 * both)
            waits = ~up & (far < bound)
            rows, far = rows[waits], far[waits]
        return ids, scores, seen


def neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 20, stop: float = 0.95, seed: int = 7, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest by largest inner product, ties to the smaller vec_id.

    ``queries`` are rows of the same table; a query is not its own candidate. Scores are inner products in double
    precision of the original vectors. Null or zero vectors, and such with null or non-finite components, take no part, nor
    do those whose length is not the commonest, nor those without id. Rows of one id with the same vector count once; an id
    with several vectors is a candidate by each of them and asks with the smallest. Other columns are not read; empty tables
    give an empty result; with fewer candidates than ``k`` all are returned.

    1. A vector x becomes (x, sqrt(M - |x|^2)) and a query (q, 0), M being the largest |x|^2: larger inner products are
       then smaller distances. Both are multiplied by one Gaussian matrix into ``DIMS`` dimensions.
    2. Equal vectors are one entry: of their ids only the k + 1 smallest can be among a query's nearest.
    3. Entries are dealt by hash into kd-trees of about ``TREE`` vectors, queries into batches of about ``BATCH``; a task
       has one of each, whatever the size of the table. Each query asks every tree and verifies projected neighbours one
       after the other, until the chi-square probability that a vector as near as the k-th found had been projected closer
       than the next one reaches ``stop``: of the vectors at the k-th distance 1 - stop are missed, of nearer ones fewer.
    4. The trees' lists are cut to the best k of each query.
    """
    usable = F.expr(
        f"{vec_col} is not null and size({vec_col}) > 0 and forall({vec_col}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        f" and exists({vec_col}, x -> x <> 0)"
    )
    sizes = vectors.filter(usable).groupBy(F.size(vec_col).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1)
    row = sizes.first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    spark = vectors.sparkSession
    if row is None:
        return spark.createDataFrame([], schema)
    dims = int(row["d"])
    clean = lambda df: df.filter(usable & (F.size(vec_col) == dims) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    own = clean(vectors)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    top = own.agg(F.max(norm).alias("m"), F.count("*").alias("n")).first()
    lift, trees = float(top["m"]), int(top["n"] // TREE + 1)
    limit = chi_square_quantile(stop)
    matrix = np.random.default_rng(seed).standard_normal((dims + 1, DIMS))

    one_each = own.dropDuplicates(["id", "v"])
    by_vector = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id")
    # the rank limit is applied before the shuffle too, so a vector that many rows share stays small
    entries = one_each.withColumn("r", F.row_number().over(by_vector)).filter(F.col("r") <= k + 1).select("id", "v")
    asked = clean(queries).groupBy(F.col("id").alias("query_id")).agg(F.min("v").alias("q"))
    batches = int(asked.count() // BATCH + 1)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    dealt = entries.withColumn("tree", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(trees))).withColumn("batch", every(batches))
    asks = asked.withColumn("batch", F.pmod(F.xxhash64("query_id", F.lit(seed)), F.lit(batches))).withColumn("tree", every(trees))

    def rows_of(column):
        column = column.combine_chunks()
        return np.asarray(column.flatten(), np.float64).reshape(len(column), dims)

    def search(key, left, right):
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            tree = Tree(left.column("id").to_numpy(), rows_of(left.column("v")), matrix, lift)
            q, q_ids = rows_of(right.column("q")), right.column("query_id").to_numpy()
            projected = q @ matrix[:-1]
            for i in range(len(q)):
                ids, scores, _ = tree.search(q[i], projected[i], lift, k, int(q_ids[i]), limit)
                out[0].append(np.full(len(ids), q_ids[i]))
                out[1].append(ids)
                out[2].append(scores)
        cols = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table({"query_id": pa.array(cols[0].astype(np.int64)), "vec_id": pa.array(cols[1].astype(np.int64)), "score": pa.array(cols[2].astype(np.float64))})

    found = dealt.groupBy("tree", "batch").cogroup(asks.groupBy("tree", "batch")).applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
