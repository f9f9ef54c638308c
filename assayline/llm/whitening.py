"""Whitening of vectors by pivoted Cholesky and one-sided Jacobi."""

from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayline.llm.common import stage

COMPONENTS = 16
# An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
# Scaled entries beyond this count as it: whole numbers whose sums stay exact.
MOST = 1 << 40
# The covariance is solved on the driver, so its side is bounded.
MOST_DIMS = 2048
EPS = float(np.finfo(float).eps)

Batches = Iterator[pa.RecordBatch]


class Whitening(NamedTuple):
    """What whitens a vector: (x - centre - rest) @ directions."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray  # one column a component, unit length
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n. The whole part of the mean is taken off in whole
        numbers, so a large offset costs no digits."""
        whole, rest = mean_parts(self.sums, self.n)
        return (x - whole).astype(float) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.eigenvalues)


def mean_parts(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    whole = [s // n for s in sums]
    rest = [float(Fraction(s - w * n, n)) for s, w in zip(sums, whole, strict=True)]
    return np.array(whole, np.int64), np.array(rest)


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """L with L @ L.T = matrix, one column a pivot: the largest remaining
    diagonal entry is next, until what remains is rounding. With its rows in
    the order of the pivots L is lower triangular; rows are left in place, as
    rotations of columns don't look at their order."""
    size = len(matrix)
    left = np.diag(matrix).astype(float).copy()
    least = size * EPS * max(left.max(initial=0.0), 0.0)
    columns: list[np.ndarray] = []
    while len(columns) < size:
        pivot = int(left.argmax())
        if left[pivot] <= least:
            break
        made = np.array(columns).reshape(len(columns), size)
        column = (matrix[pivot] - made[:, pivot] @ made) / np.sqrt(left[pivot])
        column[left == -np.inf] = 0.0
        left -= column * column
        left[pivot] = -np.inf
        columns.append(column)
    return np.array(columns).reshape(len(columns), size).T.copy()


def rounds(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of columns, as rounds of pairs that share no column."""
    even = size + size % 2
    ring, made = list(range(even)), []
    for _ in range(even - 1):
        pairs = [
            (min(p, q), max(p, q))
            for p, q in zip(ring[: even // 2], reversed(ring[even // 2 :]), strict=True)
            if max(p, q) < size
        ]
        if pairs:
            made.append((np.array([p for p, _ in pairs]), np.array([q for _, q in pairs])))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return made


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(squared norms, normalised columns) of ``factor`` after rotations that
    make its columns orthogonal: the eigenvalues, falling, and eigenvectors
    of factor @ factor.T. The largest entry of a column is positive."""
    a = factor.copy()
    plan = rounds(a.shape[1])
    for _ in range(sweeps):
        worst = 0.0
        for p, q in plan:
            left, right = a[:, p], a[:, q]
            alpha, beta = (left * left).sum(0), (right * right).sum(0)
            gamma = (left * right).sum(0)
            scale = np.sqrt(alpha * beta)
            off = np.divide(np.abs(gamma), scale, out=np.zeros_like(scale), where=scale > 0)
            worst = max(worst, float(off.max()))
            turn = off > EPS
            zeta = np.divide(beta - alpha, 2 * gamma, out=np.zeros_like(gamma), where=turn)
            tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            tangent = np.where(turn, tangent, 0.0)
            cosine = 1 / np.hypot(1.0, tangent)
            sine = cosine * tangent
            a[:, p], a[:, q] = cosine * left - sine * right, sine * left + cosine * right
        if worst <= 8 * EPS:
            break
    norms = (a * a).sum(0)
    order = np.argsort(-norms, kind="stable")
    a, norms = a[:, order], norms[order]
    vectors = a / np.sqrt(norms)
    rows = np.abs(vectors).argmax(0) if vectors.size else np.empty(0, int)
    signs = np.sign(vectors[rows, np.arange(vectors.shape[1])])
    return norms, vectors * np.where(signs == 0, 1.0, signs)


def scaled(vector: Column) -> Column:
    """The whole numbers of a vector."""

    def entry(c: Column) -> Column:
        product = c * F.lit(float(SCALE))
        within = F.greatest(F.least(product, F.lit(float(MOST))), F.lit(float(-MOST)))
        return F.floor(within).cast("long") + F.lit(OFFSET).cast("long")

    return F.transform(vector, entry)


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _column_sums(dims: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        rows, sums = 0, np.zeros(dims, object)
        for batch in batches:
            x = _matrix(batch, dims)
            rows += len(x)
            # Halves, whose sums over a batch can't overflow.
            sums += (x >> 20).sum(0).astype(object) * (1 << 20) + (x & 0xFFFFF).sum(0)
        if rows:
            made = [(k, str(s), rows) for k, s in enumerate(sums)]
            columns = [pa.array(c) for c in zip(*made, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["place", "total", "n"])

    return run


def _products(of: Callable[[np.ndarray], np.ndarray], dims: int) -> Callable[[Batches], Batches]:
    """Sums of products of the columns that ``of`` makes, a matrix a task."""

    def run(batches: Batches) -> Batches:
        total = None
        for batch in batches:
            made = of(_matrix(batch, dims))
            total = made.T @ made + (0.0 if total is None else total)
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat))), pa.array(flat)], ["place", "part"]
            )

    return run


def _summed(fit: DataFrame, of: Callable, dims: int, side: int) -> np.ndarray:
    parts = fit.mapInArrow(_products(of, dims), "place long, part double")
    made = np.zeros(side * side)
    for place, value in parts.groupBy("place").agg(F.sum("part")).collect():
        made[place] = value
    made = made.reshape(side, side)
    return (made + made.T) / 2


def fit_whitening(fit: DataFrame, dims: int, most: int = COMPONENTS) -> Whitening | None:
    """Whitening of the vectors ``x`` in ``fit``; None where nothing varies."""
    totals = (
        fit.mapInArrow(_column_sums(dims), "place long, total string, n long")
        .groupBy("place")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")), F.sum("n"))
        .collect()
    )
    if not totals:
        return None
    n = totals[0][2]
    sums = [int(total) for _, total, _ in sorted(totals, key=lambda r: r[0])]
    none = Whitening(n, sums, np.empty(0), np.empty((dims, 0)), 0.0)
    scatter = _summed(fit, none.centred, dims, dims)
    trace = float(np.trace(scatter))
    values, vectors = one_sided_jacobi(pivoted_cholesky(scatter))
    count = int((values[:most] > dims * EPS * trace).sum())
    return none._replace(
        eigenvalues=values[:count] / n, components=vectors[:, :count], trace=trace / n
    )


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - sums)^2 of each row, exact; None beyond 63 bits."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], object)
    apart = x - whole
    widest = int(np.abs(apart).max(initial=0)) + 1
    if (n * widest) ** 2 * max(1, len(sums)) < 1 << 63:
        made = n * apart - rest.astype(np.int64)
        return (made * made).sum(1).tolist()
    wide = ((n * apart.astype(object) - rest) ** 2).sum(1)
    return [int(v) if v < 1 << 63 else None for v in wide]


def _rows(model: Whitening, error: float, dims: int, schema: pa.Schema):
    def run(batches: Batches) -> Batches:
        count = len(model.eigenvalues)
        explained = model.eigenvalues / model.trace
        for batch in batches:
            x = _matrix(batch, dims)
            of = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(of)).cast(schema.field(0).type),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(of), model.n)),
                    pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(of)),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(of), error)),
                ],
                schema=schema,
            )

    return run


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """Whitened coordinates of each vector along the main components.

    Entries are scaled to whole numbers, x = floor(64 * c) + 1000000. The fit
    list is each distinct x once.

    1. Distinct vectors: a grouping by the whole vector, combined in the map
       tasks, so a vector that a third of the rows share moves once a task.
    2. Exact sums of each dimension, then the scatter of the centred vectors:
       each task multiplies its own rows and gives one matrix, and the
       matrices are summed by a grouping. The driver gets dims^2 numbers, of
       at most ``MOST_DIMS`` dimensions; more raise a ValueError.
    3. Pivoted Cholesky of the scatter, then one-sided Jacobi on the columns
       of its triangular factor: rotated columns' squared norms are the
       eigenvalues, normalised columns the components. Eigenvalues that are
       rounding only (less than dims * 2^-52 of the trace) give no component.
    4. The covariance of the whitened fit list is summed likewise;
       ``identity_error`` is its largest distance from the identity.
    5. Each row is projected where it is read; rows aren't shuffled.

    Rows whose vector is null or holds a null, NaN or infinite entry give
    nothing, nor do rows of another length than most vectors of the fit list
    have (the longer of two lengths as frequent), as they lie in no common
    space. Entries beyond 2^40 / 64 count as that. Where all vectors are equal,
    or there are none, there is no component and no row. Null and repeated ids
    are rows like any other. ``deviation`` is null where it exceeds a long.

    Columns: id, component int, n long, deviation long, whitened double,
    explained double, identity_error double.
    """
    spark = vectors.sparkSession
    entries = F.col(vector_col).cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.filter(entries.isNotNull() & ~bad).select(
        F.col(id_col).alias("id"), scaled(entries).alias("x")
    )
    kind = vectors.select(id_col).schema[0].dataType
    out = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    distinct = stage(rows.filter(F.size("x") > 0).select("x").distinct(), "vectors")
    by_length = distinct.groupBy(F.size("x").alias("dims")).count()
    common = by_length.orderBy(F.desc("count"), F.desc("dims")).first()
    if common is None:
        return spark.createDataFrame([], out)
    dims = common["dims"]
    if dims > MOST_DIMS:
        raise ValueError(f"{dims} dimensions; at most {MOST_DIMS} are solved")
    fit = distinct.filter(F.size("x") == dims)
    model = fit_whitening(fit, dims, components)
    side = 0 if model is None else len(model.eigenvalues)
    if not side:
        return spark.createDataFrame([], out)
    covariance = _summed(fit, model.whitened, dims, side) / model.n
    error = float(np.abs(covariance - np.eye(side)).max())
    from pyspark.sql.pandas.types import to_arrow_schema

    return rows.filter(F.size("x") == dims).mapInArrow(
        _rows(model, error, dims, to_arrow_schema(out)), out
    )
