"""Operator 12: embedding whitening by pivoted Cholesky and one-sided Jacobi rotations.

Entries become whole numbers, so that counts, sums and scatter are exact, in any order of addition
and in every attempt of a task: a first pass gives n and the sums S, a second adds up products of
numbers centred at the whole number next to the mean. Partial sums leave a task as one row per pair of
dimensions, so what is shuffled and what reaches the driver follows the dimensions, not the rows.

The centred scatter A, now rounded to doubles once, is factored with pivoting on its largest remaining
diagonal entry, P' A P = L L'. Columns of L are then rotated in pairs until all are orthogonal. What is
rotated is the factor and not A, so small eigenvalues keep their relative accuracy: the squared
norms of the columns are the eigenvalues, and the columns divided by their norms, back in the order
before pivoting, are the components. Rows are projected where they are read.

Result per kept row and component, by falling eigenvalue (ties: by the largest entry's dimension); the
sign is such that a component's largest entry is positive. There are fewer components than asked for
where the rank is lower: none for a single row or equal rows.

Null vectors, and vectors with null or non-finite entries, are left out; so are those whose length
is not the commonest one (ties: the longest). Vectors are as long as they are: a task holds one batch of
rows and two square matrices. Null or repeated vec_ids and repeated rows: each row is fitted and
projected. Entries whose whole number is beyond `LARGEST` count as that. A deviation beyond a long is null. Empty table: no
rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelode.llm.common import query, stored, table

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = 2**50
# Rows that are multiplied at once.
BLOCK_ROWS = 4096
_EXACT = 2**53
_LONG = 2**63
_DIGITS = Context(prec=38)

WHITENED = "vec_id long, deviation long, whitened array<double>"


def whole(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers of all entries of a batch's usable vectors (flat), their lengths and their rows."""
    lists = batch.column("vector")
    offsets = lists.offsets.to_numpy()
    low, high = int(offsets[0]), int(offsets[-1])
    values = lists.values.slice(low, high - low).cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    offsets = offsets - low
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    sizes = np.diff(offsets)
    usable = (bad[offsets[1:]] == bad[offsets[:-1]]) & (sizes > 0) & ~np.asarray(lists.is_null())
    kept = np.repeat(usable, sizes)
    entries = np.clip(np.floor(SCALE * values[kept]) + SHIFT, -LARGEST, LARGEST).astype(np.int64)
    return entries, sizes[usable], np.flatnonzero(usable)


def rows_of(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, dims) whole numbers of the vectors of that length, and their rows in the batch."""
    entries, sizes, rows = whole(batch)
    same = sizes == dims
    return entries[np.repeat(same, sizes)].reshape(-1, dims), rows[same]


def _decimals(numbers) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in numbers], pa.decimal128(38))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length of vector and dimension: the number of vectors and the sum of entries."""
    held: dict[int, tuple[int, list[int]]] = {}
    for batch in batches:
        entries, sizes, _ = whole(batch)
        for dims in np.unique(sizes).tolist():
            part = entries[np.repeat(sizes == dims, sizes)].reshape(-1, dims)
            n, sums = held.get(dims, (0, [0] * dims))
            for i in range(0, len(part), BLOCK_ROWS):  # so many of the largest entries fit a long
                sums = [a + b for a, b in zip(sums, part[i:i + BLOCK_ROWS].sum(axis=0).tolist())]
            held[dims] = n + len(part), sums
    for dims, (n, sums) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([dims] * dims, pa.int32()), pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), _decimals(sums)],
            names=["dims", "i", "n", "total"])


def fit_list(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """Dimensions, number of vectors n, and the sum of each dimension, all exact."""
    parts = vectors.mapInArrow(_sums, "dims int, i int, n long, total decimal(38,0)")
    sums = parts.groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    # One row says which length is the commonest; then as many rows as it has dimensions.
    sums = stored(sums, "sums")
    first = sums.orderBy(F.desc("n"), F.desc("dims"), "i").limit(1).collect()
    if not first:
        return 0, 0, []
    rows = sums.where(F.col("dims") == first[0].dims).orderBy("i").collect()
    return first[0].dims, first[0].n, [int(r.total) for r in rows]


def products(y: np.ndarray) -> np.ndarray:
    """y'y of whole numbers, exact: in doubles where all sums fit, in Python's numbers where not."""
    largest = int(np.abs(y).max(initial=0))
    rows = _EXACT // max(largest * largest, 1)
    if rows < 1:
        wide = y.astype(object)
        return wide.T @ wide
    total = np.zeros((y.shape[1],) * 2, object)
    for i in range(0, len(y), min(rows, BLOCK_ROWS)):
        block = y[i:i + min(rows, BLOCK_ROWS)].astype(np.float64)
        total += (block.T @ block).astype(np.int64)
    return total


def scatter(vectors: DataFrame, dims: int, n: int, sums: list[int]) -> np.ndarray:
    """n times the centred scatter of the fit list, exact (Python's numbers)."""
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)  # next to the mean

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, rows = np.zeros((dims, dims), object), [], 0
        for batch in batches:
            held.append(rows_of(batch, dims)[0] - centre)
            rows += len(held[-1])
            if rows >= BLOCK_ROWS:
                total, held, rows = total + products(np.concatenate(held)), [], 0
        if held:
            total = total + products(np.concatenate(held))
        for i in range(dims):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * (dims - i), pa.int32()), pa.array(range(i, dims), pa.int32()), _decimals(total[i, i:])],
                names=["i", "j", "product"])

    parts = vectors.mapInArrow(run, "i int, j int, product decimal(38,0)")
    rows = stored(parts.groupBy("i", "j").agg(F.sum("product").alias("product")), "scatter").collect()
    about = np.array([s - n * int(c) for s, c in zip(sums, centre.tolist())], object)
    out = np.zeros((dims, dims), object)
    for i, j, product in rows:
        out[i, j] = out[j, i] = n * int(product) - about[i] * about[j]
    return out


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): L L' is `a` in that order of rows and columns. L has as many columns as the rank:
    it ends where what remains of every diagonal entry is rounding of the entry itself."""
    dims = len(a)
    rest, order, whole_diagonal = a.astype(np.float64).copy(), np.arange(dims), np.diag(a).astype(np.float64).copy()
    factor = np.zeros((dims, dims))
    noise = 8 * dims * np.finfo(float).eps
    for k in range(dims):
        remaining = np.where(np.diag(rest)[k:] > noise * whole_diagonal[k:], np.diag(rest)[k:], 0.0)
        at = k + int(np.argmax(remaining))
        if not remaining[at - k] > 0:
            return factor[:, :k], order
        if at != k:
            for m in (rest, rest.T, factor, order, whole_diagonal):
                m[[k, at]] = m[[at, k]]
        factor[k, k] = np.sqrt(rest[k, k])
        factor[k + 1:, k] = rest[k + 1:, k] / factor[k, k]
        rest[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def rotated(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor's columns, rotated in pairs until all are orthogonal to working precision.

    A sweep meets every pair once, in rounds of pairs without a column in common, which are
    rotated at once."""
    columns = factor.T.copy()
    n = len(columns)
    if n < 2:
        return columns.T
    seats = list(range(n)) + ([-1] if n % 2 else [])
    tolerance = np.finfo(float).eps * np.sqrt(factor.shape[0])
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:])) if a >= 0 and b >= 0]
            p, q = np.array(pairs).T
            one, two = columns[p], columns[q]
            a, b, c = (one * one).sum(1), (two * two).sum(1), (one * two).sum(1)
            size = np.sqrt(a) * np.sqrt(b)
            share = np.divide(np.abs(c), size, out=np.zeros_like(c), where=size > 0)
            worst = max(worst, float(share.max()))
            turn = share > tolerance
            zeta = np.divide(b - a, 2 * c, out=np.zeros_like(c), where=turn)
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            cos = 1 / np.hypot(1.0, t)
            sin = cos * t
            columns[p] = cos[:, None] * one - sin[:, None] * two
            columns[q] = sin[:, None] * one + cos[:, None] * two
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if worst <= tolerance:
            break
    return columns.T


def principal(a: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as rows) of a symmetric positive matrix, largest first."""
    factor, order = pivoted_cholesky(a)
    columns = rotated(factor)
    norms = np.sqrt((columns * columns).sum(axis=0))
    components = np.zeros((len(norms), len(a)))
    components[:, order] = (columns / norms).T
    largest = np.abs(components).argmax(axis=1)
    components *= np.sign(components[np.arange(len(norms)), largest])[:, None]
    by_size = np.lexsort((largest, -norms))[:most]
    return norms[by_size] ** 2, components[by_size]


class Whitening:
    """A fitted whitening: n, sums, variances (of the components), explained shares and components."""

    def __init__(self, dims: int, n: int, sums: list[int], scattered: np.ndarray, most: int = COMPONENTS):
        self.dims, self.n, self.sums = dims, n, sums
        # The exact n² V, divided once.
        covariance = np.array([[v / (n * n) for v in row] for row in scattered], np.float64).reshape(dims, dims)
        values, self.components = principal(covariance, most)
        self.variances = values
        total = sum(scattered[i, i] for i in range(dims)) / (n * n) if n else 0.0
        self.explained = values / total if len(values) else values


def fit(vectors: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """Whitening of frames with a column `vector`; None without a usable vector."""
    dims, n, sums = fit_list(vectors)
    return Whitening(dims, n, sums, scatter(vectors, dims, n, sums), most) if n else None


def project(vectors: DataFrame, model: Whitening) -> DataFrame:
    """A row per usable vector: vec_id, its exact deviation, and its whitened numbers."""
    dims, n, components = model.dims, model.n, model.components
    sums = np.array(model.sums, object)
    scales = np.sqrt(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        narrow = np.array(sums, np.int64) if max(map(abs, sums)) < _LONG // 4 else None
        for batch in batches:
            x, rows = rows_of(batch, dims)
            far = n * int(np.abs(x).max(initial=0)) >= _LONG // 4 or narrow is None
            off = n * x.astype(object) - sums if far else n * x - narrow  # n(x - mean), exact
            largest = int(np.abs(off).max(initial=0))
            wide = off.astype(object) if dims * largest * largest >= _LONG else off
            deviation = (wide * wide).sum(axis=1).tolist() if len(x) else []
            y = off.astype(np.float64) / n
            white = (y @ components.T / scales).ravel()
            k = len(scales)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)), pa.array([d if d < _LONG else None for d in deviation], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), pa.array(white))],
                names=["vec_id", "deviation", "whitened"])

    return vectors.mapInArrow(run, WHITENED)


def identity_error(whitened: DataFrame, n: int, components: int) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity, as measured on
    them: the mean first, then products of centred rows."""
    def of(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("whitened").flatten().to_numpy().reshape(-1, components)

    def totals(make):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = sum((make(of(batch)) for batch in batches), np.zeros(make(np.zeros((0, components))).shape))
            yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["i", "total"])
        # As many rows as numbers in `total`.
        rows = whitened.select("whitened").mapInArrow(run, "i int, total double").groupBy("i").agg(F.sum("total").alias("total")).collect()
        return np.array([r.total for r in sorted(rows)]) / n

    mean = totals(lambda y: y.sum(axis=0))
    covariance = totals(lambda y: (y - mean).T @ (y - mean)).reshape(components, components)
    return float(np.abs(covariance - np.eye(components)).max())


def whiten(vectors: DataFrame, column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """Row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    narrow = vectors.select(F.col("vec_id").cast("long"), F.col(column).cast("array<double>").alias("vector"))
    model = fit(narrow, most)
    if model is None or not len(model.variances):
        return narrow.where("false").selectExpr(
            "vec_id", "0 as component", "0L as n", "0L as deviation", "0D as whitened", "0D as explained", "0D as identity_error")
    rows = stored(project(narrow, model), "whitened")
    error = identity_error(rows, model.n, len(model.variances))
    explained = F.array(*[F.lit(float(v)) for v in model.explained])
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("_at")].alias("explained"), F.lit(error).alias("identity_error"))


@query("op12_embedding_whitening")
def op12(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
