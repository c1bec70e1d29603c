"""Tables of vectors as blocks: rows that take part, and matrices packed into binary columns."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sums of whole numbers up to here are exact as doubles, in any order.
EXACT = 2.0**53


def finite(vector: Column) -> Column:
    """Whether a vector has components, and only finite ones."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)), F.lit(False))


def usable(rows: DataFrame, *columns: str, vector: str = "embedding") -> DataFrame:
    """``columns`` and ``vec`` (doubles) of the rows that have a vec_id and a finite vector; wholly repeated rows once."""
    vec = F.transform(F.col(vector).cast("array<double>"), lambda x: x + 0.0)
    return rows.select("vec_id", *columns, vec.alias("vec")).where(F.col("vec_id").isNotNull() & finite(F.col("vec"))).distinct()


def matrix(vectors: pa.Array, dim: int, dtype=np.float64) -> np.ndarray:
    """Rows of a list column as a matrix of ``dim`` columns; shorter ones are padded with zeros."""
    lengths = np.diff(vectors.offsets.to_numpy(zero_copy_only=False))
    values = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype)
    if (lengths == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), dtype)
    out[np.arange(dim) < lengths[:, None]] = values
    return out


def unpacked(blob: bytes, dim: int = 0, dtype=np.float64) -> np.ndarray:
    values = np.frombuffer(blob, dtype)
    return values.reshape(-1, dim) if dim else values


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact. Those that leave 64 bits end at the largest or least number."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * a.shape[1]
    if bound < EXACT:
        return np.rint(a.astype(float) @ b.astype(float).T).astype(np.int64)
    if bound < 2.0**62:
        return a @ b.T
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)


class Runs:
    """Rows with equal keys that follow each other, gathered into blocks of at most ``most``, across batches."""

    def __init__(self, most: int):
        self.most, self.key, self.parts, self.held = most, None, [], 0

    def flush(self):
        if self.held:
            yield self.key, [np.concatenate(x) if isinstance(x[0], np.ndarray) else pa.concat_arrays(x) for x in zip(*self.parts, strict=True)]
        self.parts, self.held = [], 0

    def add(self, keys: np.ndarray, columns: list):
        """``keys``: a row each; ``columns``: arrays as long."""
        starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)] if len(keys) else []
        for a, b in zip(starts, starts[1:], strict=False):
            key = tuple(keys[a].tolist())
            if key != self.key:
                yield from self.flush()
                self.key = key
            while a < b:
                n = min(b - a, self.most - self.held)
                self.parts.append([c[a : a + n] if isinstance(c, np.ndarray) else c.slice(a, n) for c in columns])
                self.held += n
                a += n
                if self.held == self.most:
                    yield from self.flush()
