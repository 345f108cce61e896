"""Counts of hashed features by class over a bounded sample of labelled texts.

Shared by the classifiers: a feature's weight is its share of rows of class 1, drawn
towards the share of all rows by ``prior_rows`` rows. The sample is the
``max_rows`` labelled rows with the smallest hash of their id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.flat import slices

BITS = 22
_BLOCK = 1 << 16


def labelled_sample(labels: DataFrame, column: str, usable: F.Column, max_rows: int) -> DataFrame:
    """(doc_id, label): at most ``max_rows`` rows, with a half (0 or 1) to fit and test on.

    A doc_id with several labels counts once, with the largest.
    """
    return (
        labels.where(usable & F.col(column).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(column).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
        .withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int"))
    )


class Evidence:
    """Rows of each half and class that have a feature: counts[half, class, bucket]."""

    def __init__(self, counts: np.ndarray, rows: np.ndarray, prior_rows: float):
        self.counts, self.rows, self.prior_rows = counts, rows, prior_rows

    def shares(self, halves: tuple[int, ...]) -> np.ndarray:
        """For each bucket, the share of class 1 in the rows of these halves."""
        zero, one = (sum(self.counts[h, c].astype(np.float32) for h in halves) for c in (0, 1))
        n_zero, n_one = (sum(float(self.rows[h, c]) for h in halves) for c in (0, 1))
        base = (n_one + 1) / (n_zero + n_one + 2)
        return ((one + self.prior_rows * base) / (one + zero + self.prior_rows)).astype(np.float32)


def _distinct(features: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature once per row."""
    both = np.unique(owner.astype(np.uint64) << np.uint64(BITS) | features.astype(np.uint64))
    return (both & np.uint64((1 << BITS) - 1)).astype(np.int64), (both >> np.uint64(BITS)).astype(np.int64)


def gather(
    rows: DataFrame,
    features: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]],
    prior_rows: float,
    column: str = "text",
    limit: int = 2 << 20,
) -> Evidence:
    """Counts over ``rows`` (label, half and what ``features`` reads), by slices of ``column``.

    ``features`` gives buckets below 2^22 and the row of each. The rows may be
    any number; the counts that reach the driver are at most four a bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, limit):
                bucket, owner = _distinct(*features(part))
                label = part.column("label").to_numpy().astype(np.int64)
                half = part.column("half").to_numpy().astype(np.int64)
                kind = (half * 2 + label)[owner]
                code, n = np.unique(bucket << 2 | kind, return_counts=True)
                block = code >> 18
                starts = np.flatnonzero(np.diff(block, prepend=-1))
                ends = np.append(starts, len(code))[1:]
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array(np.append(block[starts], -1), pa.int32()),
                        "codes": pa.array([code[a:b].astype(np.int32).tobytes() for a, b in zip(starts, ends, strict=True)] + [b""], pa.binary()),
                        "n": pa.array([n[a:b].astype(np.int32).tobytes() for a, b in zip(starts, ends, strict=True)] + [np.bincount(half * 2 + label, minlength=4).astype(np.int32).tobytes()], pa.binary()),
                    }
                )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = key[0].as_py()
        if block < 0:
            total = np.zeros(4, np.int64)
            for batch in batches:
                for n in batch.column("n").to_pylist():
                    total += np.frombuffer(n, np.int32)
            codes, sums = np.arange(4), total
        else:
            table = np.zeros(_BLOCK * 4, np.int32)
            for batch in batches:
                for c, n in zip(batch.column("codes").to_pylist(), batch.column("n").to_pylist(), strict=True):
                    table[np.frombuffer(c, np.int32) - block * _BLOCK * 4] += np.frombuffer(n, np.int32)
            codes = np.flatnonzero(table)
            sums = table[codes]
            codes = codes + block * _BLOCK * 4
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([block], pa.int32()),
                "codes": pa.array([codes.astype(np.int32).tobytes()], pa.binary()),
                "n": pa.array([sums.astype(np.int32).tobytes()], pa.binary()),
            }
        )

    schema = "block int, codes binary, n binary"
    table = np.zeros(1 << (BITS + 2), np.int32)
    totals = np.zeros(4, np.int64)
    for row in rows.mapInArrow(count, schema).groupBy("block").applyInArrow(add, schema).toLocalIterator():
        codes, n = np.frombuffer(row.codes, np.int32), np.frombuffer(row.n, np.int32)
        if row.block < 0:
            totals = n
        else:
            table[codes] = n
    counts = np.ascontiguousarray(table.reshape(1 << BITS, 2, 2).transpose(1, 2, 0))
    return Evidence(counts, totals.reshape(2, 2), prior_rows)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights and, last, the intercept of a logistic regression, by Newton steps."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return np.append(np.zeros(x.shape[1]), np.log(share / (1 - share)))
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logit(p: np.ndarray) -> np.ndarray:
    return np.log(p) - np.log1p(-p)
