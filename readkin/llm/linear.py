"""Logistic regression by Newton steps whose sums are aggregated by Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: From a batch: features (n, d), target between 0 and 1, weight.
Reader = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def summed(table: DataFrame, per_batch: Callable[[pa.RecordBatch], np.ndarray], length: int) -> np.ndarray:
    """Sum over the table of a vector of fixed length; one vector a task is shuffled, one vector comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for batch in batches:
            total += per_batch(batch)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_pydict({"k": pa.array(at, pa.int32()), "x": pa.array(total[at])})

    out = np.zeros(length)
    for r in table.mapInArrow(run, "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).collect():
        out[r.k] = r.x
    return out


def fit(table: DataFrame, read: Reader, d: int, rounds: int = 12, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression; the last feature should be the constant 1, which is not shrunk.

    A step that raises the loss is cut to a quarter.  Targets may be soft.  Without rows all weights are 0.
    """
    beta = move = np.zeros(d)
    penalty = np.full(d, ridge)
    penalty[-1] = 1e-6
    best = np.inf
    for _ in range(rounds):

        def step(batch: pa.RecordBatch, beta=beta) -> np.ndarray:
            x, y, w = read(batch)
            z = x @ beta
            p = sigmoid(z)
            loss = (w * (np.logaddexp(0, z) - y * z)).sum()
            return np.concatenate(([loss], x.T @ (w * (y - p)), ((x * (w * p * (1 - p))[:, None]).T @ x).ravel()))

        sums = summed(table, step, 1 + d + d * d)
        loss = sums[0] + (penalty * beta**2).sum() / 2
        if loss > best + 1e-9 * abs(best):  # the step went too far
            move = move / 4
            beta = beta - 3 * move
            continue
        best = loss
        move = np.linalg.solve(sums[1 + d :].reshape(d, d) + np.diag(penalty), sums[1 : 1 + d] - penalty * beta)
        beta = beta + move
        if np.abs(move).max() < 1e-4:
            break
    return beta
