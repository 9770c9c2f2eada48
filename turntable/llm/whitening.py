"""Whitening of embeddings by principal components, which contour integration finds interval by interval.

Sums and products of the rows are whole numbers, counted in tasks and added exactly, so the covariance does not depend on
how rows are dealt. Its size is that of a vector squared, whatever the number of rows. On it, eigenvalues are counted above
any shift by inertia, which cuts the range into intervals of few eigenvalues. In each, a quadrature of complex shifted
solves along a circle around the interval projects a random block onto the wanted space (FEAST), Rayleigh-Ritz extracts the
components, and the count by inertia tells whether any is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turntable.llm.common import map_batches, ready_workers
from turntable.sources.tables import materialise

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000  # the offset shifts all vectors alike, so that nothing here depends on it
LARGEST = 2.0**40  # of an entry, so that whole numbers made from it and their sums are exact
SLICE = 8  # eigenvalues of an interval
GAP = 1e-6  # share of an interval around a cut in which no eigenvalue may lie
NARROW = 1e-11  # share of the range that is not cut any more
NODES = 8  # of the quadrature on half a circle
ROUNDS = 12
NOTHING = 1e-13  # share of the whole variance below which a component is taken for rounding
_EXACT = 1 << 53
_LONG = 2**63 - 1


class WhiteningError(ArithmeticError):
    """The components that were found are not as many as the inertia counts."""


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of a symmetric matrix above `shift`, by the signs of a pivoted LDL' (Sylvester's law).

    Pivots are single entries, or pairs where the diagonal is small (Bunch and Kaufman); a pair has one
    eigenvalue of each sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    alpha, k, n, above = (1 + sqrt(17)) / 8, 0, len(a), 0
    while k < n:
        own = abs(a[k, k])
        r, below = k, 0.0
        if k + 1 < n:
            r = k + 1 + int(np.argmax(np.abs(a[k + 1 :, k])))
            below = abs(a[r, k])
        if max(own, below) == 0.0:
            k += 1
            continue
        pair = False
        if own < alpha * below:
            others = np.abs(a[r, k:])
            others[r - k] = 0.0
            widest = others.max()
            if own * widest < alpha * below**2:
                pair = abs(a[r, r]) < alpha * widest
                to = k + 1 if pair else k
                a[[to, r]] = a[[r, to]]
                a[:, [to, r]] = a[:, [r, to]]
        if pair:
            above += 1
            rest = a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(a[k : k + 2, k : k + 2], rest.T)
            k += 2
        else:
            above += int(a[k, k] > 0)
            rest = a[k + 1 :, k]
            a[k + 1 :, k + 1 :] -= np.outer(rest, rest / a[k, k])
            k += 1
    return above


def _filtered(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """The block's part along eigenvectors with eigenvalues between `low` and `high`, by quadrature on a circle."""
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for node, weight in zip(nodes, weights, strict=True):
        turn = radius * np.exp(0.5j * np.pi * (node + 1))
        out += 0.5 * weight * (turn * np.linalg.solve((centre + turn) * np.eye(len(matrix)) - matrix, block)).real
    return out


def _ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of a symmetric matrix within the space of a block, in ascending order."""
    basis, _ = np.linalg.qr(block)
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    return values, basis @ turned


def feast(matrix: np.ndarray, low: float, high: float, count: int) -> np.ndarray:
    """The `count` eigenvectors with eigenvalues between `low` and `high`, ascending."""
    n, size = len(matrix), min(len(matrix), ceil(1.5 * count) + 4)
    scale = np.abs(matrix).sum(axis=0).max()
    random = np.random.default_rng(12)
    while True:
        block = random.standard_normal((n, size))
        for _ in range(ROUNDS):
            values, block = _ritz(matrix, _filtered(matrix, block, low, high))
            inside = (values > low) & (values < high)
            left = np.linalg.norm(matrix @ block - block * values, axis=0)
            settled = inside & (left <= 1e-13 * scale * sqrt(n))
            if settled.sum() == count and inside.sum() == count:
                return block[:, settled]
        if size == n:
            raise WhiteningError(f"{settled.sum()} of {count} components found between {low} and {high}")
        size = min(n, 2 * size)


def _cut(matrix: np.ndarray, low: float, high: float) -> tuple[float, int] | None:
    """A shift between two bounds, near their middle, that no eigenvalue is close to, and the eigenvalues above it."""
    for place in (0.5, 0.45, 0.55, 0.4, 0.6, 0.35, 0.65, 0.3, 0.7):
        shift = low + place * (high - low)
        above = count_above(matrix, shift + GAP * (high - low))
        if above == count_above(matrix, shift - GAP * (high - low)):
            return shift, above
    return None


def _intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, count) that hold the `wanted` largest eigenvalues and few more, highest first.

    Cut in two until an interval holds no more than SLICE, or is so narrow that its eigenvalues count as equal,
    or has no place to be cut at.
    """
    top = 1.0001 * np.abs(matrix).sum(axis=0).max()
    floor = NOTHING * np.trace(matrix)
    out: list[tuple[float, float, int]] = []
    open_ones = [(floor, top, count_above(matrix, floor), 0)]
    while open_ones and sum(count for *_, count in out) < wanted:
        low, high, least, most = open_ones.pop()
        if least == most:
            continue
        cut = None
        if least - most > SLICE and high - low > NARROW * top:
            cut = _cut(matrix, low, high)
        if cut is None:
            out.append((low, high, least - most))
        else:
            open_ones += [(low, cut[0], least, cut[1]), (cut[0], high, cut[1], most)]
    return out


def principal_components(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and unit eigenvectors as columns; directions without variance are left out."""
    intervals = _intervals(matrix, wanted) if np.trace(matrix) > 0 else []
    if not intervals:
        return np.zeros(0), np.zeros((len(matrix), 0))
    found = [feast(matrix, *interval) for interval in intervals]
    values, vectors = _ritz(matrix, np.concatenate(found, axis=1))
    return values[::-1][:wanted], vectors[:, ::-1][:, :wanted]


class _Moments:
    """Exact number, sums and products of whole vectors of one length, about zero."""

    def __init__(self, size: int) -> None:
        self.n = 0
        self.sums = np.zeros(size, dtype=object)
        self.products = np.zeros((size, size), dtype=object)

    def add(self, rows: np.ndarray) -> None:
        """Add int64 rows. They are centred near their mean before they are multiplied, and moved back in whole numbers."""
        n = len(rows)
        centre = np.rint(rows.mean(axis=0)).astype(np.int64)
        near = rows - centre
        # Products of doubles are exact while their sums stay below 2^53; rows too far out are multiplied as whole numbers.
        far = np.abs(near).max(axis=1, initial=0) > int(sqrt(_EXACT // n))
        plain = near[~far].astype(np.float64)
        products = (plain.T @ plain).astype(np.int64).astype(object)
        for row in near[far].astype(object):
            products = products + np.outer(row, row)
        moved, sums = centre.astype(object), near.sum(axis=0).astype(object)
        cross = np.outer(sums, moved)
        self.products = self.products + products + cross + cross.T + n * np.outer(moved, moved)
        self.sums = self.sums + sums + n * moved
        self.n += n


def _whole(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, all of one length, as rows of floor(SCALE * entry)."""
    lists = batch.column("_vector")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    entries = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if np.abs(entries).max(initial=0.0) >= LARGEST:
        raise WhiteningError(f"an entry of {LARGEST} or more")
    return np.floor(SCALE * entries).astype(np.int64).reshape(batch.num_rows, -1)


def _moments(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """One task's moments as rows (cell, value): 0 the number of rows, then sums, then products above the diagonal."""
    own = _Moments(size)
    for batch in batches:
        if batch.num_rows:
            own.add(_whole(batch))
    if own.n:
        values = [own.n, *own.sums.tolist(), *own.products[np.triu_indices(size)].tolist()]
        cells = pa.array(range(len(values)), pa.int64())
        yield pa.record_batch([cells, pa.array([Decimal(value) for value in values], pa.decimal128(38, 0))], ["cell", "value"])


class Fit:
    """Number of rows, sums, and components of a table of vectors."""

    def __init__(self, size: int, cells: list[int], components: int) -> None:
        self.n, self.sums = cells[0], cells[1 : size + 1]
        products = np.zeros((size, size), dtype=object)
        products[np.triu_indices(size)] = cells[size + 1 :]
        exact = self.n * products - np.triu(np.outer(np.array(self.sums, dtype=object), np.array(self.sums, dtype=object)))
        upper = np.array([[entry / self.n**2 for entry in row] for row in exact.tolist()], dtype=np.float64).reshape(size, size)
        self.covariance = upper + np.triu(upper, 1).T
        self.values, self.vectors = principal_components(self.covariance, components)
        # Which of the two directions makes no difference; the largest entry is made positive, so that runs agree.
        if self.vectors.size:
            largest = np.abs(self.vectors).argmax(axis=0)
            self.vectors = self.vectors * np.sign(self.vectors[largest, np.arange(self.vectors.shape[1])])
        self.explained = [value / float(np.trace(self.covariance)) for value in self.values.tolist()]


def _valid(df: DataFrame, vector: str, id_column: str) -> DataFrame:
    """(_id, _vector) of rows whose vector is there and has only finite entries."""
    chosen = df.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{vector}`").cast("array<double>").alias("_vector"))
    finite: Column = F.forall("_vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return chosen.where(F.col("_vector").isNotNull() & (F.size("_vector") > 0) & finite)


def _summed(cells: DataFrame) -> dict[int, Decimal]:
    """Sums by cell of what the tasks give, a number of rows that depends on the length of a vector alone."""
    return {row.cell: row.value for row in cells.groupBy("cell").agg(F.sum("value").alias("value")).collect()}


def _length(valid: DataFrame) -> int | None:
    """The length that most vectors have, the longest of several."""
    sizes = valid.groupBy(F.size("_vector").alias("size")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.col("n").desc(), F.col("size").desc()).first()
    return None if first is None else first.size


def fit(valid: DataFrame, size: int, components: int) -> Fit:
    ready_workers(valid.sparkSession)
    cells = valid.select("_vector").mapInArrow(lambda batches: _moments(batches, size), "cell bigint, value decimal(38,0)")
    sums = _summed(cells)
    return Fit(size, [int(sums[cell]) for cell in range(len(sums))], components)


def _whitened(valid: DataFrame, model: Fit) -> DataFrame:
    """(_id, deviation, whitened) of each row; deviation is null above the largest long."""
    n, sums = model.n, model.sums
    centre = [round(total / n) for total in sums]
    shift = np.array(centre, dtype=np.int64)
    rest = [total - n * own for total, own in zip(sums, centre, strict=True)]
    turned = model.vectors / np.sqrt(model.values)
    part = np.array([own / n for own in rest])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = _whole(batch) - shift
        largest = n * int(np.abs(near).max()) + max(map(abs, rest))
        if largest**2 * len(rest) <= _LONG:
            deviations = ((n * near - np.array(rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        else:
            exact = ((n * near.astype(object) - np.array(rest, dtype=object)) ** 2).sum(axis=1)
            deviations = [value if value <= _LONG else None for value in exact.tolist()]
        made = (near - part) @ turned
        offsets = np.arange(len(made) + 1, dtype=np.int32) * made.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(made.ravel()))
        return pa.record_batch([batch.column("_id"), pa.array(deviations, pa.int64()), lists], ["_id", "deviation", "whitened"])

    kind = valid.schema["_id"].dataType.simpleString()
    return map_batches(valid, work, f"_id {kind}, deviation bigint, whitened array<double>")


def _products(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """One task's sums and products of whitened rows, in decimals, whose sums do not depend on any order."""
    sums, products = np.zeros(size), np.zeros((size, size))
    for batch in batches:
        rows = batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)
        sums += rows.sum(axis=0)
        products += rows.T @ rows
    values = [Decimal(f"{value:.15f}") for value in [*sums.tolist(), *products[np.triu_indices(size)].tolist()]]
    yield pa.record_batch([pa.array(range(len(values)), pa.int64()), pa.array(values, pa.decimal128(38, 15))], ["cell", "value"])


def _identity_error(rows: DataFrame, n: int, size: int) -> float:
    """The largest entry of the covariance of whitened rows less the identity."""
    cells = rows.select("whitened").mapInArrow(lambda batches: _products(batches, size), "cell bigint, value decimal(38,15)")
    sums = _summed(cells)
    values = np.array([float(sums[cell]) / n for cell in range(len(sums))])
    means, upper = values[:size], np.zeros((size, size))
    upper[np.triu_indices(size)] = values[size:]
    return float(np.abs(upper - np.triu(np.outer(means, means)) - np.eye(size)).max())


def whiten(df: DataFrame, vector: str = "embedding", id_column: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Rows (id, component, n, deviation, whitened, explained, identity_error) for each vector and component from 1.

    Left out are null and empty vectors, those with null or non-finite entries, and those of another length than most
    have (of several lengths equally often, the longest). The others are all fitted and returned, repeated rows and null ids too; other
    columns are not read. An entry c counts as x = floor(SCALE * c) + OFFSET; entries of LARGEST or more raise
    WhiteningError. n is the number of vectors, deviation the exact sum of (n * x - sum of x)^2, null above the largest
    long. Components are unit eigenvectors of the covariance of x, by falling eigenvalue e; whitened is the centred x along one,
    divided by sqrt(e), explained is e's share of the whole variance. Equal eigenvalues have some orthogonal eigenvectors.
    Directions without variance have no component, so vectors that are all equal, like an empty table, give no rows.
    identity_error is the largest entry of the covariance of whitened less the identity, over all rows.

    The covariance, one number for each pair of dimensions, is the only thing that reaches the driver.
    """
    valid = _valid(df, vector, id_column)
    size = _length(valid)
    kind = df.schema[id_column].dataType.simpleString()
    shape = f"`{id_column}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if size is None:
        return df.sparkSession.createDataFrame([], shape)
    valid = valid.where(F.size("_vector") == size)
    model = fit(valid, size, components)
    if not len(model.values):
        return df.sparkSession.createDataFrame([], shape)
    rows = materialise(_whitened(valid, model))
    error = _identity_error(rows, model.n, len(model.values))
    return rows.select("_id", "deviation", F.posexplode("whitened").alias("_place", "whitened")).select(
        F.col("_id").alias(id_column),
        (F.col("_place") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(F.lit(model.explained), F.col("_place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
