"""Approximate nearest neighbours by inner product: stable projections in a kd-tree.

Largest inner product becomes least distance by one more coordinate that gives
vectors the same length (and queries zero there). Vectors are parted in shells
of nearly equal length first, each with a tree of its own, so that few long
vectors don't flatten the distances of all others; a query is scaled to the
length of each shell, which changes no order. A few Gaussian (2-stable)
projections of a vector keep its distances in this sense: for points at
distance d, the squared projected distance over d**2 follows a chi-square law
with as many degrees of freedom as projections. A kd-tree over the projected
points hands out leaves in order of their distance from the query; their
vectors are verified by true inner products, until a point nearer than the
k-th found so far would have shown up by then with probability `TAU`.

On Spark the upper levels of the trees (fitted on a bounded sample) deal the
vectors to cells. A query first visits its own cell and the nearest one of the
largest shell, which bound its k-th distance; then it visits just the cells for
which the test still doesn't hold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetflow.llm.common import pieces, read_table, ship_package, written

PROJECTIONS = 8
TAU = 0.3                  # probability at which the search stops (README: recall and share visited)
CELL_ROWS = 4_096          # vectors of a cell, about
MAX_CELLS = 4_096          # the upper trees that are broadcast have no more leaves, and one a shell
SHELLS = 2                 # shells of length each time that the squared length doubles
SAMPLE_ROWS = 20_000       # vectors that the upper tree is fitted on
GROUP_QUERIES = 8_192      # queries that visit a cell together
LEAF_ROWS = 64
PAIRS = 16_384             # pairs that are scored at a time
SEED = 5


def chi_square_quantile(p: float, degrees: int) -> float:
    """For an even number of degrees, by bisection of the closed form."""
    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i)
                                          for i in range(degrees // 2))
    low, high = 0.0, 1e4
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


class Tree:
    """A kd-tree as boxes: one row of lower and upper bounds for each leaf, cut at medians."""

    def __init__(self, points: np.ndarray, leaves: int):
        dims = points.shape[1]
        self.cuts: list[tuple[int, float]] = []      # heap order: children of i are 2i+1, 2i+2
        boxes = [(np.full(dims, -np.inf), np.full(dims, np.inf))]
        groups = [points]
        while len(groups) < leaves:
            next_boxes, next_groups = [], []
            for (low, high), g in zip(boxes, groups, strict=True):
                spread = np.ptp(g, axis=0) if len(g) else np.zeros(dims)
                axis = int(spread.argmax())
                cut = float(np.median(g[:, axis])) if len(g) else 0.0
                self.cuts.append((axis, cut))
                left_high, right_low = high.copy(), low.copy()
                left_high[axis] = min(high[axis], cut)
                right_low[axis] = max(low[axis], cut)
                next_boxes += [(low, left_high), (right_low, high)]
                next_groups += [g[g[:, axis] <= cut], g[g[:, axis] > cut]]
            boxes, groups = next_boxes, next_groups
        self.low = np.array([b[0] for b in boxes])
        self.high = np.array([b[1] for b in boxes])

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        axes = np.array([a for a, _ in self.cuts], np.int64)
        cuts = np.array([c for _, c in self.cuts])
        while len(node) and node[0] < len(self.cuts):
            right = points[np.arange(len(points)), axes[node]] > cuts[node]
            node = 2 * node + 1 + right
        return node - len(self.cuts)

    def distances(self, queries: np.ndarray) -> np.ndarray:
        """Least squared distance of each query to each leaf's box."""
        out = np.zeros((len(queries), len(self.low)))
        for d in range(queries.shape[1]):
            q = queries[:, d, None]
            out += np.square(np.maximum(self.low[None, :, d] - q, 0)
                             + np.maximum(q - self.high[None, :, d], 0))
        return out


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def projection(dims: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dims + 1, PROJECTIONS))


def lifted(vectors: np.ndarray, squared_length: float) -> np.ndarray:
    """The vectors with the coordinate that gives them all the same length."""
    v = vectors.astype(np.float64)
    rest = np.maximum(squared_length - np.square(v).sum(axis=1, keepdims=True), 0)
    return np.concatenate((v, np.sqrt(rest)), axis=1)


def shell_of(vectors: np.ndarray) -> np.ndarray:
    """Numbers of the shells of length that vectors belong to; those without a finite one are in the last."""
    squared = np.square(vectors.astype(np.float64)).sum(axis=1)
    return shell_number(squared)


def shell_number(squared: np.ndarray) -> np.ndarray:
    mantissa, exponent = np.frexp(squared * 1.3)        # unit vectors lie inside a shell, not on its edge
    part = np.floor((mantissa - 0.5) * 2 * SHELLS)
    return np.where((squared > 0) & np.isfinite(squared), exponent * SHELLS + part, 1 << 20).astype(np.int64)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, the same for equal rows wherever they stand."""
    return (a.astype(np.float64) * b.astype(np.float64)).sum(axis=-1)


def scaled(queries: np.ndarray, squared_length: float) -> tuple[np.ndarray, np.ndarray]:
    """The factors that bring queries to this squared length, and the queries in that length.

    Queries and vectors whose squared length is zero or infinite have the factor zero.
    """
    norms = np.square(queries).sum(axis=1)
    factor = np.sqrt(np.divide(squared_length, norms, out=np.zeros(len(norms)), where=norms > 0))
    factor[~np.isfinite(factor)] = 0
    return factor, queries * factor[:, None]


def reach(factor: np.ndarray, squared_length: float, kth: np.ndarray) -> np.ndarray:
    """Squared distance, after scaling, of a vector whose inner product with the query is `kth`.

    Without a k-th, or where the squares of lengths have no finite value, no distance is too far.
    """
    known = (kth > -np.inf) & (factor > 0)
    away = 2 * (squared_length - np.where(known, kth, 0) * factor)
    return np.where(known, np.maximum(away, 0), np.inf)


class Forest:
    """A tree for each shell of length; cells are numbered through all of them."""

    def __init__(self, shells: list[tuple[int, int, float]], sample: np.ndarray, dims: int):
        """`shells`: number, rows and largest squared length of each; `sample`: vectors of any shell."""
        self.matrix = projection(dims)
        self.numbers = np.array([s for s, _, _ in shells])
        self.squared = [float(most) if math.isfinite(most) else 0.0 for _, _, most in shells]
        self.main = int(np.argmax([n for _, n, _ in shells]))
        total = sum(n for _, n, _ in shells)
        at = shell_of(sample)
        self.trees, self.offsets = [], [0]
        for (number, n, _), squared in zip(shells, self.squared, strict=True):
            wanted = min(n / CELL_ROWS, MAX_CELLS * n / total / 2)
            cells = 1 << max(0, math.ceil(math.log2(max(wanted, 1))))
            self.trees.append(Tree(lifted(sample[at == number], squared) @ self.matrix, cells))
            self.offsets.append(self.offsets[-1] + cells)
        self.cell_squared = np.repeat(self.squared, np.diff(self.offsets))

    def cell_of(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros(len(vectors), np.int64)
        place = np.minimum(np.searchsorted(self.numbers, shell_of(vectors)), len(self.numbers) - 1)
        for i in np.unique(place):
            rows = np.flatnonzero(place == i)
            points = lifted(vectors[rows], self.squared[i]) @ self.matrix
            out[rows] = self.offsets[i] + self.trees[i].leaf_of(points)
        return out

    def first(self, queries: np.ndarray, home: np.ndarray) -> np.ndarray:
        """Which cells each query visits first: its own, and the nearest of the largest shell."""
        out = np.zeros((len(queries), self.offsets[-1]), bool)
        rows = np.arange(len(queries))
        out[rows, home] = True
        _, q = scaled(queries, self.squared[self.main])
        far = self.trees[self.main].distances(q @ self.matrix[:-1])
        out[rows, self.offsets[self.main] + far.argmin(axis=1)] = True
        return out

    def open(self, queries: np.ndarray, kth: np.ndarray, stop: float) -> np.ndarray:
        """Cells where a better vector than the k-th would lie near enough for the test to go on."""
        out = []
        lengths = np.sqrt(np.square(queries).sum(axis=1))
        for tree, squared in zip(self.trees, self.squared, strict=True):
            factor, q = scaled(queries, squared)
            # No inner product exceeds the product of the lengths; the margin is for rounding.
            beyond = (factor > 0) & (kth > lengths * math.sqrt(squared) * (1 + 1e-9))
            far = tree.distances(q @ self.matrix[:-1])
            out.append((far <= stop * reach(factor, squared, kth)[:, None]) & ~beyond[:, None])
        return np.concatenate(out, axis=1)


def search_group(queries: np.ndarray, query_ids: np.ndarray, bounds: np.ndarray,
                 vectors: np.ndarray, vec_ids: np.ndarray, squared_length: float,
                 k: int, stop: float) -> tuple[np.ndarray, np.ndarray]:
    """(query row, vector row) of the k best of each query in one group of vectors.

    `bounds` is each query's k-th best inner product so far (-inf if none).
    """
    matrix = projection(queries.shape[1])
    points = lifted(vectors, squared_length) @ matrix
    q = queries.astype(np.float64)
    factor, near_q = scaled(q, squared_length)
    at = near_q @ matrix[:-1]
    leaves = 1 << max(0, math.ceil(math.log2(max(len(vectors) / LEAF_ROWS, 1))))
    tree = Tree(points, leaves)
    leaf = tree.leaf_of(points)
    by_leaf = np.argsort(leaf, kind="stable")
    ends = np.searchsorted(leaf[by_leaf], np.arange(leaves), side="right")
    starts = np.concatenate(([0], ends[:-1]))
    far = tree.distances(at)
    order = np.argsort(far, axis=1, kind="stable")
    norms = np.square(q).sum(axis=1)
    v = vectors.astype(np.float64)

    best = np.full((len(q), k), -np.inf)
    rows = np.full((len(q), k), -1)
    kth = bounds.astype(np.float64).copy()
    # The products below are summed in another order than the scores; this is more than they differ.
    margin = np.where(factor > 0, 1e-12 * np.sqrt(norms) * math.sqrt(squared_length), np.inf)
    active = np.arange(len(q))
    for rank in range(leaves):
        # A point nearer than the k-th would be this far in projection with probability 1 - TAU.
        radius = reach(factor[active], squared_length, kth[active])
        active = active[far[active, order[active, rank]] <= stop * radius]
        if not len(active):
            break
        visited = order[active, rank]
        turn = np.argsort(visited, kind="stable")
        for one in np.split(turn, np.flatnonzero(np.diff(visited[turn])) + 1):
            who, which = active[one], by_leaf[starts[visited[one[0]]]:ends[visited[one[0]]]]
            if not len(which):
                continue
            near = q[who] @ v[which].T >= (kth - margin)[who, None]
            near &= vec_ids[which][None, :] != query_ids[who][:, None]
            if not near.any():
                continue
            score = np.full(near.shape, -np.inf)
            x, y = np.nonzero(near)
            for i in range(0, len(x), PAIRS):
                a, b = x[i:i + PAIRS], y[i:i + PAIRS]
                score[a, b] = inner(q[who[a]], v[which[b]])
            score[score < kth[who, None]] = -np.inf
            both = np.concatenate((best[who], score), axis=1)
            index = np.concatenate((rows[who], np.broadcast_to(which, score.shape)), axis=1)
            ids = np.where(index >= 0, vec_ids[index], np.iinfo(np.int64).max)
            top = np.lexsort((ids, -both), axis=1)[:, :k]
            best[who] = np.take_along_axis(both, top, 1)
            rows[who] = np.where(np.isinf(best[who]), -1, np.take_along_axis(index, top, 1))
            kth[who] = np.maximum(kth[who], best[who][:, -1])
    found, place = np.nonzero(rows >= 0)
    return found, rows[found, place]


RESULT = "query_id long, vec_id long, score double"


def _search(k: int, stop: float):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        left = left.sort_values("query_id")
        q, v = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
        query_ids, vec_ids = left["query_id"].to_numpy(), right["vec_id"].to_numpy()
        a, b = search_group(q, query_ids, left["bound"].to_numpy(), v, vec_ids,
                            float(right["squared"].iloc[0]), k, stop)
        return pd.DataFrame({"query_id": query_ids[a], "vec_id": vec_ids[b],
                             "score": inner(q[a], v[b])})
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(spark: SparkSession, vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id",
            vector_col: str = "embedding", k: int = 20, tau: float = TAU) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k largest inner products found.

    `is_query` is a condition on `vec_id`. A query is no neighbour of its own
    id. Rows with a null id, or a vector that is null, zero or holds null or
    non-finite components, take no part. Vectors with different numbers of
    components are searched apart; a query with fewer than k candidates gets
    all; rows that repeat an id are one vector (the least of them). An empty
    table gives no rows. Vectors whose squared length is no positive finite
    double are verified without the test. Other columns are not read.

    Cells with too many vectors (equal ones cannot be cut apart) or visited by
    too many queries are split by a hash of either side, so no group outgrows
    CELL_ROWS vectors and GROUP_QUERIES queries by much. The driver sees the
    sample, and one count a shell and a cell.
    """
    ship_package(spark)
    rows = (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                           F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & usable(F.col("v"))))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    shapes = sorted(r.dims for r in rows.select(F.size("v").alias("dims")).distinct().collect())
    found = [_nearest_of(spark, rows.where(F.size("v") == dims), is_query, dims, k, tau) for dims in shapes]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found)


def _shells(rows: DataFrame, dims: int) -> list[tuple[int, int, float]]:
    """Number, rows and largest squared length of each shell (as many as lengths of doubles allow, at most)."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            squared = np.square(_matrix(batch.column("v"), dims)).sum(axis=1)
            shell = shell_number(squared)
            numbers, place = np.unique(shell, return_inverse=True)
            most = np.zeros(len(numbers))
            np.maximum.at(most, place, squared)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers), pa.array(np.bincount(place, minlength=len(numbers)).astype(np.int64)),
                 pa.array(most)], names=["shell", "n", "most"])

    found = rows.select("v").mapInArrow(measure, "shell long, n long, most double")
    return [tuple(r) for r in found.groupBy("shell").agg(
        F.sum("n").alias("n"), F.max("most").alias("most")).orderBy("shell").collect()]


def _nearest_of(spark: SparkSession, rows: DataFrame, is_query: Column, dims: int, k: int,
                tau: float) -> DataFrame:
    """`nearest` among rows (vec_id, v) of `dims` components."""
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(SAMPLE_ROWS).select("v")
    fitted = np.array([r.v for r in sample.collect()]).reshape(-1, dims)
    forest = Forest(_shells(rows, dims), fitted, dims)
    sent = spark.sparkContext.broadcast(forest)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4096):
            cell = sent.value.cell_of(_matrix(batch.column("v"), dims))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"),
                                              pa.array(cell, pa.int32())], names=["vec_id", "v", "cell"])

    dealt = written(spark, rows.mapInArrow(deal, "vec_id long, v array<double>, cell int"), "vectors")
    sizes = {r.cell: r["count"] for r in dealt.groupBy("cell").count().collect()}
    stop = chi_square_quantile(tau, PROJECTIONS)
    schema = "query_id long, v array<double>, bound double, cell int"

    def visits(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, 1024):
                if not batch.num_rows:
                    continue
                q = _matrix(batch.column("v"), dims)
                goes = sent.value.first(q, batch.column("cell").to_numpy(zero_copy_only=False))
                if not first:
                    bound = batch.column("bound").to_numpy(zero_copy_only=False)
                    goes = sent.value.open(q, bound, stop) & ~goes
                who, cell = np.nonzero(goes)
                at = pa.array(who)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id").take(at), batch.column("v").take(at),
                     batch.column("bound").take(at), pa.array(cell, pa.int32())],
                    names=["query_id", "v", "bound", "cell"])
        return run

    def searched(asking: DataFrame, first: bool, name: str) -> DataFrame:
        going = written(spark, asking.mapInArrow(visits(first), schema), f"{name}-visits")
        waiting = {r.cell: r["count"] for r in going.groupBy("cell").count().collect()}
        plan = [(c, -(-n // CELL_ROWS), -(-waiting[c] // GROUP_QUERIES), float(forest.cell_squared[c]))
                for c, n in sizes.items() if c in waiting]
        if not plan:
            return spark.createDataFrame([], RESULT)
        parts = F.broadcast(spark.createDataFrame(plan, "cell int, vector_parts int, query_parts int, squared double"))
        left = (going.join(parts, "cell")
                .withColumn("q", F.pmod(F.xxhash64("query_id"), F.col("query_parts")))
                .withColumn("p", F.explode(F.expr("sequence(0L, vector_parts - 1L)")))
                .select("cell", "p", "q", "query_id", "v", "bound"))
        right = (dealt.join(parts, "cell")
                 .withColumn("p", F.pmod(F.xxhash64("vec_id"), F.col("vector_parts")))
                 .withColumn("q", F.explode(F.expr("sequence(0L, query_parts - 1L)")))
                 .select("cell", "p", "q", "vec_id", "v", "squared"))
        found = (left.groupBy("cell", "p", "q").cogroup(right.groupBy("cell", "p", "q"))
                 .applyInPandas(_search(k, stop), RESULT))
        return written(spark, found, name)

    asking = dealt.where(is_query).select(F.col("vec_id").alias("query_id"), "v",
                                          F.lit(float("-inf")).alias("bound"), "cell")
    near = searched(asking, True, "near")
    bounds = _best(near, k).groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(float("-inf")).alias("reached"))
    asking = (asking.drop("bound").join(bounds, "query_id", "left")
              .select("query_id", "v", F.coalesce("reached", F.lit(float("-inf"))).alias("bound"), "cell"))
    rest = searched(asking, False, "rest")
    return _best(near.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


def op1_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found of every vector whose id is divisible by 20."""
    return nearest(spark, read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
