"""Follow-the-regularised-leader (proximal) for sparse logistic and softmax regression."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Examples of a file, and of those read at a time.
PART, READ = 256, 32


class Ftrl:
    """Weights [features, outputs] that L1 keeps sparse; one output is logistic, more are a softmax.

    z and n are the usual sums of gradients and squared gradients; a weight is worked out from them when read.
    """

    def __init__(self, features: int, outputs: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros((features, outputs)), np.zeros((features, outputs))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, idx=slice(None)) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def step(self, idx: np.ndarray, values: np.ndarray, target: np.ndarray, weight: float = 1.0) -> None:
        """One example: distinct features idx with values, and its target vector."""
        w = self.weights(idx)
        p = link(values @ w)
        g = np.outer(values, (p - target) * weight)
        n = self.n[idx]
        self.z[idx] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[idx] = n + g * g


def link(scores: np.ndarray) -> np.ndarray:
    if scores.shape[-1] == 1:
        return 1 / (1 + np.exp(-np.clip(scores, -35, 35)))
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def counted(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their relative frequencies."""
    idx, n = np.unique(buckets, return_counts=True)
    return idx, n / max(1, len(buckets))


class Examples:
    """Examples (key, idx, val, label) in a written table, in a fixed order that doesn't follow the key's. They are read
    READ at a time, so the driver never holds all of them, however long their texts."""

    def __init__(self, rows: DataFrame, most: int):
        """Keys are distinct; most: a bound on their number."""
        order = (F.xxhash64(F.lit(3), "key"), F.col("key"))
        rows = rows.select("key", "idx", "val", "label").repartitionByRange(max(1, -(-most // PART)), *order).sortWithinPartitions(*order)
        self.fs, self.path = C.open_fs(C.write_table(rows, "examples")._written)

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray, object]]:
        """(features, values, label) of each; those without features too."""
        # Files are numbered in the order of their ranges.
        files = sorted(f.path for f in self.fs.get_file_info(fs.FileSelector(self.path)) if f.base_name.startswith("part-"))
        for file in files:
            with self.fs.open_input_file(file) as f:
                for batch in pq.ParquetFile(f).iter_batches(READ, columns=["idx", "val", "label"]):
                    for idx, val, label in zip(*(batch.column(c).to_pylist() for c in ("idx", "val", "label"))):
                        yield np.frombuffer(idx, "<i4"), np.frombuffer(val, "<f4").astype(float), label
