"""Whitening of vectors: centred rows are orthogonalised by shifted CholeskyQR in distributed Gram passes, and R's SVD gives the components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import cut

#: Gram passes at most; how near to the identity the last Gram matrix must come; singular values below that share of the largest are none.
PASSES, CLOSE, NONE = 8, 1e-11, 1e-12
#: Entries of this size or more, scaled, can't be summed exactly; they raise an error.
LARGEST = float(1 << 40)


def _whole(vectors: DataFrame, id_col: str, vec_col: str, scale: int, offset: int) -> DataFrame:
    """(id, x) of usable rows: entries scaled, rounded down and shifted to whole numbers."""
    own = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    own = own.where(F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & (F.size("v") > 0))
    fits = lambda c: F.when(F.abs(c * scale) < LARGEST, F.floor(c * scale)).otherwise(F.raise_error(F.lit("an entry is too large to be summed exactly")).cast("long"))
    return own.select("id", F.transform("v", lambda c: fits(c) + F.lit(offset)).alias("x"))


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    """The last column, arrays of one length, as a matrix."""
    return batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, where the whole numbers are subtracted first, so that an offset costs no digits."""
    return (n * x - sums) / n


def solve_right(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """y times the inverse of the upper triangular r, column by column."""
    out = np.empty_like(y)
    for j in range(r.shape[0]):
        out[:, j] = (y[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _summed(fit: DataFrame, part, cells: str) -> np.ndarray:
    """The sum over all tasks of the matrix that part(batches) gives for each; it is as large as the vectors are wide, whatever the rows are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = part(batches)
        if total is not None:
            i, j = np.nonzero(np.ones_like(total, bool))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "value"])

    told = fit.select("x").mapInArrow(run, f"i int, j int, value {cells}").groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()
    out = np.zeros((told["i"].max() + 1, told["j"].max() + 1), np.int64 if cells == "long" else np.float64)
    out[told["i"], told["j"]] = told["value"]
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
    total = None
    for b in batches:
        if b.num_rows:
            own = np.vstack([np.append(_rows(b).sum(axis=0), b.num_rows)])
            total = own if total is None else total + own
    return total


def gram(fit: DataFrame, n: int, sums: np.ndarray, factors: list[np.ndarray], right: np.ndarray | None = None) -> np.ndarray:
    """The Gram matrix of the centred rows, solved by each factor in turn (and multiplied by `right`)."""

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = None
        for b in batches:
            if b.num_rows:
                y = centred(_rows(b), n, sums)
                for r in factors:
                    y = solve_right(y, r)
                y = y if right is None else y @ right
                total = y.T @ y if total is None else total + y.T @ y
        return total

    return _summed(fit, part, "double")


def shifted_cholesky_qr(fit: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the centred rows' QR factorisation.

    The first Gram matrix may be as ill-conditioned as the square of the rows; a shift of the size of its rounding error lets its Cholesky
    factor exist, and solving by that leaves rows that are far better conditioned. Each pass solves by all factors so far and adds one,
    until the Gram matrix is the identity; R is their product. Directions without variance shrink with each shift and never reach it.
    """
    d, factors, product = len(sums), [], np.eye(len(sums))
    for k in range(PASSES):
        g = gram(fit, n, sums, factors)
        size = float(np.trace(g))
        if k and np.abs(g - np.eye(d)).max() <= CLOSE:
            break
        if size == 0.0:
            return np.zeros((d, d)) if not k else product
        shift = 11.0 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * size
        r = None
        if k:
            try:
                r = np.linalg.cholesky(g).T
            except np.linalg.LinAlgError:
                pass
        while r is None:
            try:
                r = np.linalg.cholesky(g + shift * np.eye(d)).T
            except np.linalg.LinAlgError:
                shift *= 10
        factors.append(r)
        product = r @ product
    return product


def components(r: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Of R: the components as columns, their eigenvalues, falling, and the trace of the covariance. A component's largest entry is positive."""
    _, sigma, vt = np.linalg.svd(r)
    trace = float((sigma**2).sum() / n)
    keep = int((sigma > NONE * sigma[0]).sum()) if sigma[0] > 0 else 0
    v = vt[: min(most, keep)].T
    v = v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    return v, sigma[: v.shape[1]] ** 2 / n, trace


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """The exact sum of (n * x - sums)^2 of each row."""
    y = n * x - sums
    if int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] < 1 << 63:
        return (y * y).sum(axis=1)
    return np.array([sum(int(c) ** 2 for c in row) for row in y], object).astype(np.int64)  # raises where a long can't hold it


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, most: int = 16, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each usable vector and component.

    Fitted on each distinct vector of whole numbers once (copies don't count), applied to every row; n is how many there are. What a pass
    gathers is as large as the square of the vectors' width (4,096 numbers for 64), whatever the number of rows; tasks hold one batch.

    Vectors that are null or empty, or hold null or non-finite entries, are left out, as are those whose width isn't the commonest (of equals
    the larger). Null ids stay, and repeated rows are given each. Components without variance (less than 1e-24 of the largest) can't be
    whitened and are not given, so copies of one vector, or an empty table, give no row. An entry of 2**40 / scale or more raises an error.
    """
    own = _whole(vectors, id_col, vec_col, scale, offset)
    fit = cut(own.select("x").distinct(), "vectors")
    width = fit.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    empty = vectors.sparkSession.createDataFrame([], SCHEMA)
    if width is None:
        return empty
    width = width["width"]
    fit = fit.where(F.size("x") == width)
    *sums, n = (int(c) for c in _summed(fit, _sums, "long")[0])
    sums = np.array(sums, np.int64)
    v, e, trace = components(shifted_cholesky_qr(fit, n, sums), n, most)
    if not len(e):
        return empty
    by = v / np.sqrt(e)
    error = float(np.abs(gram(fit, n, sums, [], by) / n - np.eye(len(e))).max())
    explained, k = e / trace, len(e)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            x = _rows(b)
            each = np.repeat(np.arange(m), k)
            columns = [
                b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), pa.array(_deviations(x, n, sums)[each]),
                pa.array((centred(x, n, sums) @ by).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])

    return own.where(F.size("x") == width).mapInArrow(run, SCHEMA)
