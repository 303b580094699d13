"""Embedding whitening by the leading principal components, found with a block Jacobi-Davidson method.

The covariance is never formed. Its product with a few vectors is one pass over the fit list: tasks centre their
vectors, multiply them twice and sum up a small matrix, and Spark adds these matrices up. Around that, on the
driver, everything is as small as (dimensions x a few columns):

1. Rayleigh-Ritz in a subspace gives approximate pairs and their residuals.
2. For each open pair the projected correction equation ``(I - QQ')(V - theta I)(I - QQ') t = -r`` is solved roughly
   by MINRES; Q holds the locked and the current vectors. All equations go in step, so an inner step is one pass.
3. The corrections extend the subspace, which is restarted with its best vectors when it is full.
4. A pair whose residual, computed anew from the data, has reached double precision is locked, the largest first.

A few pairs more than wanted are followed, so that close eigenvalues keep their order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorespan.llm.common import materialize

SCALE = 256
COMPONENTS, GUARDS = 4, 4
#: Columns of the subspace before a restart, inner steps at most, outer steps at most.
SUBSPACE, INNER_STEPS, OUTER_STEPS = 128, 4, 200
EPS = float(np.finfo(float).eps)

_KINDS = ("<i2", "<i8")


def pack(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(rows that take part, their lengths, their whole vectors as bytes): ``floor(SCALE * x) + 0``.

    Rows that are null or empty or hold null or non-finite entries take no part. Equal vectors have equal bytes: a
    mark of the integer size, the smallest that holds the vector, and the integers. Entries beyond the range of a long
    count as its ends.
    """
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
    lengths = np.diff(ends)
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    fine = column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0) & (broken[ends[1:]] == broken[ends[:-1]])
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(SCALE * values)
    high = scaled >= 2.0**63
    whole = np.where(np.isfinite(values) & ~high & (scaled >= -(2.0**63)), scaled, 0).astype(np.int64)
    whole[high & np.isfinite(values)] = np.iinfo(np.int64).max
    whole[(scaled < -(2.0**63)) & np.isfinite(values)] = np.iinfo(np.int64).min
    wide = np.concatenate([[0], np.cumsum((whole < -(2**15)) | (whole >= 2**15))])
    rows = np.flatnonzero(fine)
    out = []
    for row in rows:
        a, b = ends[row], ends[row + 1]
        kind = int(wide[b] > wide[a])
        out.append(bytes([kind]) + whole[a:b].astype(_KINDS[kind]).tobytes())
    return rows, lengths[rows], out


def unpack(column: pa.Array, width: int) -> np.ndarray:
    """The whole vectors of a column of ``pack``'s bytes as a matrix of 64-bit integers."""
    out = np.empty((len(column), width), dtype=np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    for kind, size in enumerate((2, 8)):
        rows = np.flatnonzero(np.diff(offsets) == 1 + width * size)
        if len(rows):
            places = offsets[rows, None] + np.arange(1, 1 + width * size)
            out[rows] = data[places].view(_KINDS[kind])
    return out


@dataclass
class Fit:
    """The fit list (``x binary``, each distinct vector once) and its exact sums."""

    rows: DataFrame
    width: int
    n: int
    sums: list[int]
    largest: int

    def centre(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function for tasks: ``x - S/n`` of a matrix, subtracted in integers where they hold ``n * x``."""
        n, sums = self.n, self.sums
        if n * self.largest < 2**62:
            whole = np.array(sums, dtype=np.int64)
            return lambda x: (x * n - whole) / n
        mean = np.array([s / n for s in sums])
        return lambda x: x.astype(np.float64) - mean

    def total(self, function: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum over the fit list of ``function(centred vectors)``, an array of ``size`` numbers a batch.

        A task returns one sum; positions are added up by Spark, so the driver gets ``size`` numbers at any table size.
        """
        width, centre = self.width, self.centre()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for batch in batches:
                for a in range(0, batch.num_rows, 8192):
                    out += function(centre(unpack(batch.column("x").slice(a, 8192), width)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(out)], ["at", "value"])

        parts = self.rows.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(size)
        out[parts.column("at").to_numpy()] = parts.column("value").to_numpy()
        return out

    def product(self, block: np.ndarray) -> np.ndarray:
        """Covariance times ``block``: one pass."""
        columns = block.shape[1]
        found = self.total(lambda y: (y.T @ (y @ block)).ravel(), self.width * columns)
        return found.reshape(self.width, columns) / self.n


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, width, x`` of the rows of ``vectors`` (``vec_id, embedding``) that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lengths, packed = pack(batch.column("embedding"))
            columns = [batch.column("vec_id").take(pa.array(rows)), pa.array(lengths.astype(np.int32)), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "width", "x"])

    shape = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")]
    return vectors.select(*shape).mapInArrow(run, "vec_id long, width int, x binary")


def fit_list(vectors: DataFrame) -> Fit | None:
    """The distinct vectors of the most common length (of equally common ones, the largest); None without vectors."""
    distinct = whole_vectors(vectors).groupBy("width", "x").agg(F.count("*").alias("copies"))
    distinct = materialize(distinct, "fit")
    widths = distinct.groupBy("width").agg(F.sum("copies").alias("rows"))
    top = widths.orderBy(F.desc("rows"), F.desc("width")).first()
    if top is None:
        return None
    width = top["width"]
    rows = distinct.where(F.col("width") == width).select("x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, n, largest = np.zeros(width, np.int64), np.zeros(width, np.int64), 0, 0.0
        for batch in batches:
            x = unpack(batch.column("x"), width)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            high += (x >> 32).sum(axis=0)
            n += len(x)
            largest = max(largest, float(np.abs(x.astype(np.float64)).max(initial=0)))
        columns = [pa.array(np.arange(width, dtype=np.int32)), pa.array(high), pa.array(low), pa.array(np.full(width, n)), pa.array(np.full(width, largest))]
        yield pa.RecordBatch.from_arrays(columns, ["at", "high", "low", "n", "largest"])

    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    found = (
        rows.mapInArrow(run, "at int, high long, low long, n long, largest double")
        .groupBy("at").agg(*wide, F.sum("n").alias("n"), F.max("largest").alias("largest"))
        .orderBy("at").collect()  # one row a dimension
    )
    sums = [(int(r["high"]) << 32) + int(r["low"]) for r in found]
    return Fit(rows, width, int(found[0]["n"]), sums, int(found[0]["largest"]))


def minres(apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, reduce: float) -> np.ndarray:
    """Rough solutions of ``apply(x) = right``, one a column, all in step; stops when each residual fell to ``reduce``.

    ``apply`` is a symmetric operator, another one for every column.
    """
    size = np.linalg.norm(right, axis=0)
    size[size == 0] = 1.0
    v, before = right / size, np.zeros_like(right)
    beta = np.zeros(right.shape[1])
    left, goal = size.copy(), reduce * size
    cos, cos_old = np.ones_like(size), np.ones_like(size)
    sin, sin_old = np.zeros_like(size), np.zeros_like(size)
    w, w_old, x = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    moving = np.ones(right.shape[1], dtype=bool)
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * before
        following = np.linalg.norm(p, axis=0)
        delta = cos * alpha - cos_old * sin * beta
        third, second = sin_old * beta, sin * alpha + cos_old * cos * beta
        first = np.hypot(delta, following)
        moving &= first > 0
        first[first == 0] = 1.0
        w, w_old = (v - third * w_old - second * w) / first, w
        cos_old, sin_old = cos, sin
        cos, sin = delta / first, following / first
        x = x + np.where(moving, cos * left, 0.0) * w
        left = -sin * left
        moving &= (np.abs(left) > goal) & (following > EPS * size)
        if not moving.any():
            break
        before, v, beta = v, p / np.where(following > 0, following, 1.0), following
    return x


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """The part of ``block`` outside ``against`` (orthonormal), orthonormal itself; columns without such a part go."""
    kept: list[np.ndarray] = []
    for column in block.T:
        size = np.linalg.norm(column)
        column = column / size if size > 0 else column
        for _ in range(3):
            for basis in (*against, np.stack(kept, axis=1) if kept else block[:, :0]):
                column = column - basis @ (basis.T @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            kept.append(column)
    return np.stack(kept, axis=1) if kept else block[:, :0]


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], width: int, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns, residual norms) of the ``wanted`` largest pairs of a symmetric operator.

    ``product`` gives the operator times a block. A pair is locked when its residual, from a fresh product, is at
    most ``8 eps sqrt(width)`` times the largest eigenvalue, or when it is at rounding level and no longer falls.
    """
    wanted = min(wanted, width)
    followed = min(width, wanted + GUARDS)
    start = np.random.default_rng(11).standard_normal((width, followed))
    locked, values, residuals = np.zeros((width, 0)), [], []
    basis = _orthonormal(start)
    image = product(basis)
    largest, best, stalled = 0.0, np.inf, 0
    for outer in range(OUTER_STEPS):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn  # now the Ritz vectors, the largest first
        largest = max(largest, abs(theta[0]), *values)
        goal = 8 * EPS * np.sqrt(width) * largest
        rest = image - basis * theta
        rest -= locked @ (locked.T @ rest)
        norms = np.linalg.norm(rest, axis=0)
        stalled = 0 if norms[0] < best / 2 else stalled + 1
        best = min(best, norms[0])
        allowed = goal if stalled < 6 else 64 * goal
        whole = basis.shape[1] + locked.shape[1] == width
        ready = 0
        while ready < min(wanted - len(values), basis.shape[1]) and norms[ready] <= allowed:
            ready += 1
        if ready:
            # Images were carried through turns and restarts: what counts is a fresh product.
            found = _orthonormal(basis[:, :ready], locked)
            fresh = product(found)
            value = (found * fresh).sum(axis=0)
            true = np.linalg.norm(fresh - found * value - locked @ (locked.T @ fresh), axis=0)
            image[:, :ready], basis[:, :ready] = fresh, found
            good = 0
            while good < ready and true[good] <= (64 * goal if stalled >= 6 or whole else 2 * goal):
                good += 1
            locked = np.column_stack([locked, found[:, :good]])
            values += value[:good].tolist()
            residuals += true[:good].tolist()
            if good:
                basis, image, rest, theta, norms = basis[:, good:], image[:, good:], rest[:, good:], theta[good:], norms[good:]
                best, stalled = np.inf, 0
            if len(values) == wanted:
                break
        if basis.shape[1] + locked.shape[1] >= width:
            image = product(basis)  # the whole space: only rounding is left
            best = best if stalled else np.inf
            continue
        if basis.shape[1] + followed > max(SUBSPACE, 2 * followed):
            basis, image = basis[:, : 2 * followed], image[:, : 2 * followed]
        open_ = np.arange(min(followed - len(values), basis.shape[1]))
        open_ = open_[norms[open_] > goal]
        if not len(open_):
            open_ = np.arange(1)
        q = np.column_stack([locked, basis[:, : max(1, followed - len(values))]])
        shift = theta[open_]

        def apply(block: np.ndarray) -> np.ndarray:
            block = block - q @ (q.T @ block)
            out = product(block) - shift * block
            return out - q @ (q.T @ out)

        right = -(rest[:, open_] - q @ (q.T @ rest[:, open_]))
        step = minres(apply, right, INNER_STEPS if outer else 2, 0.05)
        more = _orthonormal(step, locked, basis)
        if not more.shape[1]:
            more = _orthonormal(np.random.default_rng(outer).standard_normal((width, 1)), locked, basis)
        basis, image = np.column_stack([basis, more]), np.column_stack([image, product(more)])
    else:
        raise RuntimeError(f"{len(values)} of {wanted} components found after {OUTER_STEPS} steps")
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], locked[:, order], np.array(residuals)[order]


@dataclass
class Whitening:
    """Components of a fit list: ``x - S/n`` projected on ``vectors`` over the root of ``values`` is white."""

    width: int
    n: int
    sums: list[int]
    centre: Callable[[np.ndarray], np.ndarray]
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    trace: float
    identity_error: float


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components of the distinct vectors; None where there are no vectors or all are equal.

    Components whose eigenvalue is nought but for rounding (below 1e-12 of the trace) are left out. Of either sign of
    a component, that with a positive largest entry is taken.
    """
    rows = fit_list(vectors)
    if rows is None:
        return None
    trace = float(rows.total(lambda y: np.array([(y * y).sum()]), 1)[0]) / rows.n
    if not trace > 0:
        return None
    values, found, residuals = leading_pairs(rows.product, rows.width, components)
    kept = values > 1e-12 * trace
    values, found, residuals = values[kept], found[:, kept], residuals[kept]
    found = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
    k, turn = len(values), found / np.sqrt(values)

    def moments(y: np.ndarray) -> np.ndarray:
        white = y @ turn
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    sums = rows.total(moments, k + k * k) / rows.n
    mean, square = sums[:k], sums[k:].reshape(k, k)
    error = float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(rows.width, rows.n, rows.sums, rows.centre(), values, found, residuals, trace, error)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact ``sum((n * x - S) ** 2)`` of every row of ``x``; None where it is beyond a long."""
    rough = ((n * x.astype(np.float64) - np.array([float(s) for s in sums])) ** 2).sum(axis=1)
    # Integers of 64 bits wrap around, and come out right where the result fits.
    wrapped = np.array([s % 2**64 for s in sums], dtype=np.uint64)
    gap = (x.view(np.uint64) * np.uint64(n) - wrapped).view(np.int64)
    with np.errstate(over="ignore"):
        out: list[int | None] = (gap * gap).sum(axis=1).tolist()
    for row in np.flatnonzero(rough > 9.0e18):
        exact = sum((n * int(v) - s) ** 2 for v, s in zip(x[row], sums))
        out[row] = exact if exact < 2**63 else None
    return out


def whiten(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue, residual`` of every vector and component.

    Takes ``vec_id long, embedding array<float or double>``; other columns are ignored. Rows whose vector is null or empty
    or holds null or non-finite entries give no rows, nor do vectors of another length than those fitted. A null vec_id
    stays null; repeated rows give rows of their own. Without vectors, or where all are equal, the result is empty.
    ``deviation`` is null where it exceeds a long.
    """
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
        "eigenvalue double, residual double"
    )
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    names = [part.split()[0] for part in schema.split(", ")]
    k = len(model.values)
    turn = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 8192):
                part = batch.slice(a, 8192)
                x = unpack(part.column("x"), model.width)
                m = len(x)
                far = deviations(x, model.n, model.sums)
                columns = [
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(far, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array((model.centre(x) @ turn).ravel()),
                    pa.array(np.tile(model.values / model.trace, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                    pa.array(np.tile(model.values, m)),
                    pa.array(np.tile(model.residuals, m)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = whole_vectors(vectors).where(F.col("width") == model.width)
    return rows.select("vec_id", "x").mapInArrow(run, schema)
