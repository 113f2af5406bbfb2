"""Whitening of embeddings by shifted CholeskyQR.

The centred rows X are orthogonalised without ever being moved: each pass sums
the Gram matrix of the rows as they are after the triangular solves so far,
factors it on the driver into R'R, and appends R to the solves. The first
factors are taken of Gram matrices shifted by a small multiple of their
identity, which keeps them positive definite however ill-conditioned X is; as
soon as the plain factor exists and the rows come out orthonormal, the passes
end. The product R of the factors has the singular values and right singular
vectors of X, to double precision, since no pass squares the condition number
of more than what the passes before have left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetflow.llm.common import read_table, ship_package, written

SCALE, SHIFT = 64, 1_000_000   # of an entry as a whole number
COMPONENTS = 16
PASSES = 8                     # over the rows, at most
ORTHONORMAL = 1e-8             # entries of the Gram matrix off the identity that end the passes
MOST_SHIFT = 1e-8              # relative to the Gram matrix
LEAST = 2.0 ** -36             # singular values below this share of the largest count as zero
EDGE = 1 << 61                 # whole numbers are held within -EDGE and EDGE before SHIFT
BLOCK = 4096                   # rows that are worked on at once

OUT = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("component", T.IntegerType()),
    T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
    T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
    T.StructField("identity_error", T.DoubleType())])


@dataclass
class Fit:
    """What is known of the vectors of one length."""

    n: int
    sums: list[int]
    factors: list[np.ndarray]                    # triangular, in the order of the solves
    trace: float = 0.0                           # of the covariance
    vectors: np.ndarray | None = None            # a column a component
    values: np.ndarray | None = None             # eigenvalues of the covariance, falling
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part of the mean is taken off exactly."""
        whole, rest = zip(*(divmod(s, self.n) for s in self.sums))
        return (x - np.array(whole, np.int64)).astype(float) - np.array(rest, float) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exact; None where a long can't hold it."""
        whole, rest = zip(*(divmod(s, self.n) for s in self.sums))
        apart = x - np.array(whole, np.int64)
        most = (np.abs(apart).max(initial=0).item() + 1) * self.n
        if most * most * len(whole) < 1 << 63:
            return ((self.n * apart - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = (sum((self.n * a - r) ** 2 for a, r in zip(row, rest)) for row in apart.tolist())
        return [d if d < 1 << 63 else None for d in exact]

    def solved(self, rows: np.ndarray) -> np.ndarray:
        """The rows times the inverse of each factor in turn, by substitution."""
        for r in self.factors:
            out = np.empty_like(rows)
            for j in range(r.shape[1]):
                out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
            rows = out
        return rows

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def whole_numbers(vector: Column) -> Column:
    """The entries as longs; null if the vector is null or holds null or non-finite ones."""
    v = vector.cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    edge = F.lit(EDGE).cast("long")
    return F.when(v.isNotNull() & ~bad, F.transform(v, lambda c: F.greatest(F.least(
        F.floor(c * F.lit(float(SCALE))), edge), -edge) + F.lit(SHIFT)))


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of each length but 0, some rows at a time: (rows' places, matrix)."""
    lists = batch.column(column)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    begin = lists.offsets.to_numpy()[:-1]
    values = lists.values.to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[lengths > 0]):
        places = np.flatnonzero(lengths == length)
        for start in range(0, len(places), BLOCK):
            at = places[start:start + BLOCK]
            yield at, values[begin[at][:, None] + np.arange(length)]


def _summed(fit_list: DataFrame, rows_of: Callable[[np.ndarray], np.ndarray | None],
            ) -> dict[int, np.ndarray]:
    """By length: the Gram matrix of `rows_of` of all vectors, and last their sum.

    A task sends one row of numbers for each row of the matrix; these are added
    up by Spark, entry by entry.
    """
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _blocks(batch, 0):
                rows = rows_of(x)
                if rows is not None:
                    part = np.vstack((rows.T @ rows, rows.sum(axis=0)))
                    length = x.shape[1]
                    sums[length] = sums[length] + part if length in sums else part
        for length, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()),
                 pa.array(total.tolist(), pa.list_(pa.float64()))], names=["length", "i", "row"])

    entries = (fit_list.mapInArrow(run, "length int, i int, row array<double>")
               .select("length", "i", F.posexplode("row").alias("j", "v"))
               .groupBy("length", "i", "j").agg(F.sum("v").alias("v")))
    out: dict[int, dict] = {}
    for length, i, j, v in entries.collect():
        out.setdefault(length, {})[i, j] = v
    found = {}
    for length, cells in out.items():
        size = 1 + max(i for i, _ in cells)
        found[length] = np.zeros((size, size - 1))
        for (i, j), v in cells.items():
            found[length][i, j] = v
    return found


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """An upper triangular R with R'R = gram, but for the shift where one is needed.

    The matrix is scaled to a unit diagonal first, so that dimensions of
    different size lose nothing. Dimensions without any variance stay zero.
    """
    size = len(gram)
    scale = np.sqrt(np.diag(gram))
    scale[scale == 0] = 1
    scaled = gram / scale[:, None] / scale
    np.fill_diagonal(scaled, 1)
    if not shifted:
        try:
            return np.linalg.cholesky(scaled).T * scale
        except np.linalg.LinAlgError:
            pass
    shift = min(11 * (n * size + size * (size + 1)) * 2.0 ** -53, MOST_SHIFT)
    return np.linalg.cholesky(scaled + shift * np.linalg.norm(scaled, 2) * np.eye(size)).T * scale


def _orthogonalised(fit_list: DataFrame, fits: dict[int, Fit], components: int) -> None:
    """Find the factors for each length of vectors, and from their product the components."""
    roots: dict[int, np.ndarray] = {}
    for step in range(PASSES):
        left = {length: fit for length, fit in fits.items() if length not in roots}
        if not left:
            break

        def rows_of(x, left=left):
            fit = left.get(x.shape[1])
            return fit.solved(fit.centred(x)) if fit else None

        for length, total in _summed(fit_list, rows_of).items():
            fit, gram = fits[length], total[:-1]
            if step == 0:
                fit.trace = float(np.trace(gram)) / fit.n
            off = np.abs(gram - np.diag(np.diag(gram) > 0)).max()
            if off <= ORTHONORMAL or step == PASSES - 1:
                # The last factor is a root of what is left; with an exact dependence it has no inverse.
                e, u = np.linalg.eigh(gram)
                roots[length] = (u * np.sqrt(np.maximum(e, 0))).T
            else:
                fit.factors.append(_factor(gram, fit.n, step == 0))
    for length, root in roots.items():
        fit = fits[length]
        for r in reversed(fit.factors):
            root = root @ r
        _, sigma, right = np.linalg.svd(root)
        rank = int((sigma > sigma[0] * LEAST).sum())
        keep = min(components, rank)
        fit.values = sigma[:keep] ** 2 / fit.n
        vectors = right[:keep].T
        # Of the two directions, the one whose largest entry is positive.
        most = np.abs(vectors).argmax(axis=0)
        fit.vectors = vectors * np.where(vectors[most, np.arange(keep)] < 0, -1.0, 1.0)


def fit_whitening(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS,
                  ) -> dict[int, Fit]:
    """The components of the distinct vectors in `vectors` (x array<long>), by their length."""
    ship_package(spark)
    fit_list = written(spark, vectors.select("x").distinct(), "whitening-fit")

    def sums(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for _, x in _blocks(batch, 0):
                n, high, low = found.setdefault(x.shape[1], [0, 0, 0])
                found[x.shape[1]] = [n + len(x), high + (x >> 31).sum(axis=0),
                                     low + (x & 0x7FFFFFFF).sum(axis=0)]
        for length, (n, high, low) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([length] * length, pa.int32()), pa.array(range(length), pa.int32()),
                 pa.array([n] * length), pa.array(high), pa.array(low)],
                names=["length", "i", "n", "high", "low"])

    wide = "decimal(38,0)"
    total = (fit_list.mapInArrow(sums, "length int, i int, n long, high long, low long")
             .groupBy("length", "i").agg(F.sum("n"), F.sum(F.col("high").cast(wide)),
                                         F.sum(F.col("low").cast(wide))).collect())
    fits: dict[int, Fit] = {}
    for length, i, n, high, low in sorted(total):
        fit = fits.setdefault(length, Fit(n, [], []))
        fit.sums.append((int(high) << 31) + int(low))
    _orthogonalised(fit_list, fits, components)

    def rows_of(x):
        fit = fits.get(x.shape[1])
        return fit.whitened(x) if fit and len(fit.values) else None

    for length, sums_of in _summed(fit_list, rows_of).items():
        fit, mean = fits[length], sums_of[-1] / fits[length].n
        covariance = sums_of[:-1] / fit.n - np.outer(mean, mean)
        fit.identity_error = float(np.abs(covariance - np.eye(len(mean))).max())
    return fits


def whiten(spark: SparkSession, rows: DataFrame, *, id_col: str = "vec_id",
           vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of `rows`.

    Rows whose vector is null or holds null or non-finite entries are left out.
    The fit is over each distinct vector once, the answer for every row, also
    for rows that repeat an id, a vector or both, and for null ids. Vectors of
    different lengths are fitted apart; an empty vector has no component and so
    no row. Components whose eigenvalue is zero, or below 2^-72 of the largest, have a
    null `whitened` and 0 explained; if all are, `explained` and
    `identity_error` are null. Entries beyond some 3.6e16 count as that much;
    a deviation that no long can hold is null. Other columns are left behind.
    An empty table gives no rows.

    The driver and the tasks hold a few matrices of length x length; rows are
    read once a pass, and only the distinct vectors are shuffled, after copies
    within a task have been merged.
    """
    numbers = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                          whole_numbers(F.col(f"`{vector_col}`")).alias("x")).where("x IS NOT NULL")
    fits = fit_whitening(spark, numbers, components)

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for at, x in _blocks(batch, 1):
                fit, shown = fits[x.shape[1]], min(components, x.shape[1])
                real = len(fit.values)
                white = np.zeros((len(x), shown))
                white[:, :real] = fit.whitened(x)
                explained = np.zeros(shown)
                explained[:real] = fit.values / fit.trace if real else 0
                size = len(x) * shown
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(np.repeat(at, shown))),
                    pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, fit.n)),
                    pa.array(fit.deviations(x), pa.int64()).take(
                        pa.array(np.repeat(np.arange(len(x)), shown))),
                    pa.array(white.ravel(), mask=np.tile(np.arange(shown) >= real, len(x))),
                    pa.array(np.tile(explained, len(x)), mask=np.full(size, not real)),
                    pa.array(np.full(size, fit.identity_error), mask=np.full(size, not real))],
                    names=OUT.fieldNames())

    return numbers.mapInArrow(run, OUT)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first components of every embedding, whitened."""
    return whiten(spark, read_table(spark, sf_dir, "embeddings"))
