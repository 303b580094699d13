"""Logistic regression: on the driver for bounded samples, and by sums over a distributed table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Partial sums fetched by the driver at once; more are added up by Spark in groups first.
FETCHED = 256


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Coefficients (the last is the intercept) by Newton steps with a ridge penalty on all but the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ beta)
        curve = weight * p * (1 - p) + 1e-9
        slope = x.T @ (weight * (y - p)) - penalty * beta
        step = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(penalty), slope)
        norm = np.abs(step).max()
        beta += step * min(1.0, 4.0 / max(norm, 1e-12))
        if norm < 1e-7:
            break
    return beta


def decision(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return x @ beta[:-1] + beta[-1]


def summed(rows: DataFrame, function: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum over all batches of ``rows`` of ``function(batch)``, an array of ``size`` numbers.

    A task returns one array. The driver fetches at most ``FETCHED`` of them: those of more tasks are dealt to that many groups
    and added up there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                out += function(batch)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([out.tobytes()], pa.binary())], names)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for batch in batches:
            out += sum((np.frombuffer(v, dtype=float) for v in batch.column("value").to_pylist()), np.zeros(size))
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([out.tobytes()], pa.binary())], names)

    names = ["part", "value"]
    parts = rows.mapInArrow(run, "part int, value binary")
    if rows.rdd.getNumPartitions() > FETCHED:
        parts = parts.repartition(FETCHED, "part").mapInArrow(added, "part int, value binary")
    fetched = parts.toArrow()
    order = np.argsort(fetched.column("part").to_numpy(), kind="stable")
    values = fetched.column("value").to_pylist()
    return sum((np.frombuffer(values[k], dtype=float) for k in order), np.zeros(size))


def newton_sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Slope and curvature of the weighted log likelihood at ``beta`` in one array: sums of them are those of all rows."""
    x = np.column_stack([x, np.ones(len(x))])
    p = sigmoid(x @ beta)
    slope = x.T @ (weight * (y - p))
    curve = (x * (weight * p * (1 - p) + 1e-9 * (weight > 0))[:, None]).T @ x
    return np.concatenate([slope, curve.ravel()])


def newton_step(sums: np.ndarray, beta: np.ndarray, ridge: float) -> np.ndarray:
    """The step from ``beta`` by the sums of all rows, with a ridge penalty on all but the intercept, bounded in length."""
    d = len(beta)
    penalty = np.full(d, ridge)
    penalty[-1] = 1e-6
    step = np.linalg.solve(sums[d:].reshape(d, d) + np.diag(penalty), sums[:d] - penalty * beta)
    return step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
