"""Whitening of vectors by their leading principal components, found by Jacobi-Davidson.

The covariance is never formed. All that is known of it are its products with
a few columns, each one pass over the distinct vectors: a task centres its
vectors, multiplies them by the columns and the result by the vectors again,
and sums; the tasks' sums are added in a bounded number of groups, and those in
the driver, which holds matrices of as many rows as a vector has entries,
whatever the number of vectors.

* The wanted eigenvectors, and some guards beyond them, are sought together.
* Rayleigh-Ritz in the subspace so far gives the nearest pairs; what keeps each
  from being an eigenpair is its residual.
* For each pair not yet good enough, the correction equation, projected away
  from all pairs at hand, is solved by some steps of MINRES. The equations go
  in lockstep, so a step of all of them is one pass.
* The corrections widen the subspace; when it is full, it is begun again from
  the best pairs. A leading pair whose residual is at the limit of double
  precision is locked and projected out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnsilver.llm.shared import small_batches, stored

#: Steps of the grid on which vectors are compared and fitted, and what is added.
STEPS, SHIFT = 64, 1_000_000
COMPONENTS = 16
GUARDS = 4
#: Bounds of the work of the driver and of one pass: columns of the subspace, MINRES steps.
SUBSPACE = 4 * (COMPONENTS + GUARDS)
INNER = 8
OUTER = 60
#: Components of less than this share of the largest variance do not count: they are noise.
LEAST_SHARE = 1e-10
#: Entries are below this in size, so that their places on the grid are exact as doubles.
LARGEST = 2.0**40
#: The sums of all tasks meet in so many, and those in the driver.
SLOTS = 64
BLOCK_ROWS = 4_096
BLOCK_BYTES = 4_000_000

Product = Callable[[np.ndarray], np.ndarray]


def fits(embedding: Column) -> Column:
    """Vectors that take part: not null, not empty, all entries numbers on the grid."""
    exact = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))
    return F.coalesce(exact & (F.size(embedding) > 0), F.lit(False))


def on_grid(embedding: Column) -> Column:
    """x of each entry, as long."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * STEPS).cast("long") + SHIFT)


# ------------------------------------------------------------------ the eigenproblem


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """The columns of ``block`` made orthonormal, and so to those of ``against``; dependent ones go."""
    for _ in range(2):
        block = block - against @ (against.T @ block)
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 1e-300] / norms[norms > 1e-300]
    if not block.shape[1]:
        return block
    left, sizes, _ = np.linalg.svd(block, full_matrices=False)
    block = left[:, sizes > 1e-10]
    block = block - against @ (against.T @ block)
    return np.linalg.qr(block)[0] if block.shape[1] else block


def minres(product: Product, shifts: np.ndarray, right: np.ndarray, away: np.ndarray, least: float, steps: int) -> np.ndarray:
    """For each column, x with P (V - shift) P x = right, about: P projects away from ``away``.

    One Lanczos step of all columns at a time (Paige and Saunders, 1975). Ends
    when all columns have come to ``least`` of their first residual.
    """

    def apart(block: np.ndarray) -> np.ndarray:
        return block - away @ (away.T @ block)

    right = apart(right)
    beta = np.linalg.norm(right, axis=0)
    first = np.where(beta > 0, beta, 1.0)
    v, before = right / first, np.zeros_like(right)
    x, w, w_before = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    beta = np.zeros_like(first)
    left = np.linalg.norm(right, axis=0)
    cos, cos_before = np.ones_like(first), np.ones_like(first)
    sin, sin_before = np.zeros_like(first), np.zeros_like(first)
    going = left > 0
    for _ in range(steps):
        if not going.any():
            break
        p = apart(product(v) - v * shifts)
        alpha = (v * p).sum(0)
        p = p - v * alpha - before * beta
        p = apart(p)
        after = np.linalg.norm(p, axis=0)
        # The new column of the tridiagonal matrix, turned by the two rotations before.
        epsilon = sin_before * beta
        delta = cos_before * beta
        bar = cos * alpha - sin * delta
        delta = sin * alpha + cos * delta
        size = np.hypot(bar, after)
        going &= size > 0
        safe = np.where(size > 0, size, 1.0)
        cos_before, sin_before = cos, sin
        cos, sin = bar / safe, after / safe
        step = np.where(going, left * cos, 0.0)
        w, w_before = (v - w * delta - w_before * epsilon) / safe, w
        x = x + w * step
        left = np.where(going, -left * sin, left)
        going &= (np.abs(left) > least * first) & (after > 1e-14 * np.abs(shifts))
        before, v, beta = v, p / np.where(after > 0, after, 1.0), after
    return apart(x)


def jacobi_davidson(product: Product, size: int, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors.

    ``product`` multiplies the matrix by columns; nothing else is asked of it.
    Residuals end at what rounding in double precision leaves.
    """
    wanted = min(wanted, size)
    sought = min(wanted + GUARDS, size)
    room = min(SUBSPACE, size)
    locked, values = np.empty((size, 0)), np.empty(0)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((size, sought)), locked)
    image = product(basis)
    best = np.inf
    for turn in range(OUTER):
        inner = basis.T @ image
        theta, turned = np.linalg.eigh((inner + inner.T) / 2)
        order = np.argsort(-theta, kind="stable")[: sought - len(values)]
        theta, turned = theta[order], turned[:, order]
        pairs, images = basis @ turned, image @ turned
        residuals = images - pairs * theta
        residuals -= locked @ (locked.T @ residuals)
        sizes = np.linalg.norm(residuals, axis=0)
        scale = max(np.abs(theta).max(initial=0.0), np.abs(values).max(initial=0.0))
        if not scale:  # the matrix is zero here: any vectors will do
            take = wanted - len(values)
            return np.append(values, theta[:take]), np.hstack([locked, pairs[:, :take]])
        limit = 8 * np.finfo(float).eps * np.sqrt(size) * scale
        missing = wanted - len(values)
        worst = sizes[:missing].max()
        # Rounding may leave a little more than the limit; then it gets no better.
        stuck = turn > 2 and worst > best / 2 and worst < 100 * limit
        best = min(best, worst)
        if basis.shape[1] + len(values) == size:
            stuck = True  # the subspace is the whole space: its pairs are exact but for rounding
        good = 0
        while good < missing and (sizes[good] <= limit or stuck):
            good += 1
        if good:
            locked, values = np.hstack([locked, pairs[:, :good]]), np.append(values, theta[:good])
            if len(values) == wanted:
                order = np.argsort(-values, kind="stable")
                return values[order], locked[:, order]
            basis, image = pairs[:, good:], images[:, good:]
            theta, pairs, residuals, sizes = theta[good:], basis, residuals[:, good:], sizes[good:]
        elif basis.shape[1] + sought - len(values) > room:
            basis, image = pairs, images
        missing = wanted - len(values)
        open_pairs = np.flatnonzero((sizes > limit) & (np.arange(len(sizes)) < missing + GUARDS))
        away = np.hstack([locked, pairs])
        corrections = minres(
            product, theta[open_pairs], -residuals[:, open_pairs], away, 2.0 ** -(turn + 2), INNER
        )
        known = np.hstack([locked, basis])
        fresh = _orthonormal(corrections, known)
        if not fresh.shape[1]:  # no correction left: residuals are rounding, or a start that missed a part
            fresh = _orthonormal(np.random.default_rng(seed + turn + 1).standard_normal((size, 1)), known)
        room_left = size - known.shape[1]
        fresh = fresh[:, :room_left]
        if not fresh.shape[1]:
            basis = _orthonormal(basis, locked)
            image = product(basis)
            continue
        # Rounding adds up in what is carried along: the whole basis is multiplied afresh.
        basis = _orthonormal(np.hstack([basis, fresh]), locked)
        image = product(basis)
    raise ArithmeticError(f"no convergence in {OUTER} turns; residuals up to {best:.3g}")


# ------------------------------------------------------------------ passes over the vectors


_PARTIAL = "slot int, part binary"


def _partial(slot: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slot", "part"]
    )


@dataclass
class FitList:
    """The distinct vectors, packed in blocks, and what one pass said of them."""

    blocks: DataFrame
    n: int
    sums: np.ndarray  # exact, as Python integers or int64

    @property
    def mean(self) -> np.ndarray:
        return np.array([int(s) / self.n for s in self.sums])

    def summed(self, cells: Callable[[np.ndarray], np.ndarray], count: int) -> np.ndarray:
        """The sum, over all vectors, of ``count`` cells that are made of centred rows."""
        mean, size = self.mean, len(self.sums)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(count)
            for batch in batches:
                for block in batch.column(0):
                    rows = np.frombuffer(block.as_py(), np.int64).reshape(-1, size)
                    total += cells(rows - mean)
            yield _partial(TaskContext.get().partitionId() % SLOTS, total)

        def add(rows: pa.Table) -> pa.Table:
            parts = [np.frombuffer(part.as_py(), np.float64) for part in rows["part"]]
            return pa.Table.from_batches([_partial(rows["slot"][0].as_py(), sum(parts))])

        # One row of each task, then one of each slot.
        sums = self.blocks.mapInArrow(run, _PARTIAL).groupBy("slot").applyInArrow(add, _PARTIAL)
        return sum((np.frombuffer(part.as_py(), np.float64) for part in sums.toArrow()["part"]), np.zeros(count))

    def product(self, columns: np.ndarray) -> np.ndarray:
        """The covariance times ``columns``: one pass."""
        size, n = columns.shape, self.n
        return self.summed(lambda rows: (rows.T @ (rows @ columns)).ravel(), columns.size).reshape(size) / n


def fit_list(vectors: DataFrame) -> FitList:
    """The distinct ``x`` of ``vectors`` (x array<long>, all of one length), packed and written."""
    distinct = vectors.select("x").distinct()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1))
            count += batch.num_rows
            if count >= BLOCK_ROWS or count * held[0].shape[1] * 8 >= BLOCK_BYTES:
                yield block_of(held)
                held, count = [], 0
        if held:
            yield block_of(held)

    def block_of(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(held)
        columns = [
            pa.array([rows.tobytes()], pa.binary()), pa.array([len(rows)], pa.int64()),
            pa.array([rows.sum(0).tolist()], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "rows", "sums"])

    with small_batches(vectors.sparkSession, BLOCK_ROWS):
        packed = stored(distinct.mapInArrow(pack, "block binary, rows long, sums array<long>"), "fit_list")
    n = packed.agg(F.sum("rows")).first()[0] or 0
    # Sums of a block are longs; all of them together may be more.
    parts = packed.select(F.posexplode("sums").alias("dim", "part"))
    total = parts.groupBy("dim").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).orderBy("dim").collect()
    return FitList(packed.select("block"), int(n), np.array([int(r.total) for r in total], object))


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of ``rows`` (vec_id, embedding).

    One row per vector and component, for up to ``components`` of them: as many
    as the vectors have directions with more than ``LEAST_SHARE`` of the largest
    variance; a table of one distinct vector, and an empty one, have no rows.
    Left out are vectors that are null or empty, that hold null or non-finite
    entries or entries of ``LARGEST`` or more in size (not exact on the grid),
    and those of another length than most have (ties: the longer). Repeated
    rows, also of one id, and rows without id each have rows of their own;
    equal vectors count once in the fit. Equal eigenvalues are numbered in any
    order. A deviation beyond a long is an error. Other columns are not looked at.
    """
    known = rows.select("vec_id", "embedding").filter(fits(F.col("embedding")))
    lengths = known.groupBy(F.size("embedding").alias("size")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    schema = f"vec_id {dict(rows.dtypes)['vec_id']}, {OUT}"
    if usual is None:
        return rows.sparkSession.createDataFrame([], schema)
    vectors = known.filter(F.size("embedding") == usual["size"]).select("vec_id", on_grid(F.col("embedding")).alias("x"))
    fitted = fit_list(vectors)
    mean, n, size = fitted.mean, fitted.n, usual["size"]
    trace = float(fitted.summed(lambda c: (c * c).sum(0), size).sum() / n)
    if not trace:
        return rows.sparkSession.createDataFrame([], schema)
    values, axes = jacobi_davidson(fitted.product, size, components)
    able = values > LEAST_SHARE * values[0]
    values, axes = values[able], axes[:, able]
    scaled, count = axes / np.sqrt(values), len(values)
    covariance = fitted.summed(lambda c: ((c @ scaled).T @ (c @ scaled)).ravel(), count * count) / n
    error = float(np.abs(covariance.reshape(count, count) - np.eye(count)).max())
    sums, explained = fitted.sums, values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, size)
            of_row = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of_row)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(of_row), n, np.int64)),
                    pa.array(deviations(x, n, sums)[of_row]),
                    pa.array(((x - mean) @ scaled).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(of_row), error)),
                ],
                [part.split()[0] for part in schema.split(", ")],
            )

    return vectors.mapInArrow(run, schema)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """The sum over dimensions of (n * x - S) ** 2, exact; an error where a long cannot hold it."""
    about = n * np.abs(x - np.array([int(s) / n for s in sums])).max(initial=0.0)
    if about**2 * x.shape[1] < 2.0**62 and n * np.abs(x).max(initial=0) < 2**62:
        off = n * x - sums.astype(np.int64)
        return (off * off).sum(1)
    off = n * x.astype(object) - sums
    exact = (off * off).sum(1)
    if max(exact) >= 2**63:
        raise OverflowError("a deviation does not fit a long")
    return exact.astype(np.int64)
