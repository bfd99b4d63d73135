"""Measurement vectors: packed bytes, projection on a basis, reconstruction.

Vectors travel as Arrow batches and are worked on as matrices. Measured on
100,000 vectors of 366 days with 8 cores, decoding took 1.1 s this way against
6 to 10 s for native higher-order functions, which are not generated code and
box every element; projecting took half their time. Nested calls such as
`project(decode(...))` run in one pass over the Python workers, with the
packed bytes going in and the few coefficients coming out.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# What runs in the Python workers is sent to them by value, so that executors
# need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Basis:
    """A mean vector and the leading eigenvectors (rows): `d * (k + 1)` numbers in all."""

    mean: Sequence[float]
    vectors: Sequence[Sequence[float]]
    eigvals: Sequence[float] | None = None

    def __post_init__(self):
        if any(len(v) != len(self.mean) for v in self.vectors):
            raise ValueError("mean and eigenvectors differ in length")

    @property
    def k(self) -> int:
        return len(self.vectors)

    @property
    def days(self) -> int:
        return len(self.mean)


def as_matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The non-null vectors of an Arrow list column as rows (missing: NaN), and which they are."""
    present = pc.is_valid(column).to_numpy(zero_copy_only=False)
    lengths = pc.list_value_length(column.drop_null()).to_numpy(zero_copy_only=False)
    if (lengths != width).any():
        raise ValueError(f"vectors must have {width} values, found {sorted(set(lengths.tolist()))[:5]}")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("f8", copy=False)
    return flat.reshape(-1, width), present


def _lists(rows: np.ndarray, present: np.ndarray) -> pa.Array:
    """Rows back to an Arrow list column, null where no vector was."""
    sizes = np.where(present, rows.shape[1], 0)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("i4")
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(rows.ravel(), pa.float64(), from_pandas=True), mask=pa.array(~present)
    )


def _joined_bytes(column: pa.Array) -> memoryview:
    """The bytes of all non-null values end to end: Arrow keeps them so, nothing is copied per row."""
    packed = column.drop_null().cast(pa.binary())
    if len(packed) == 0:
        return memoryview(b"")
    _, offsets, data = packed.buffers()
    ends = np.frombuffer(offsets, dtype="i4")[packed.offset : packed.offset + len(packed) + 1]
    return memoryview(data or b"")[ends[0] : ends[-1]]


def decode_values(packed: Column, scale: float = 1.0, missing: int | None = None) -> Column:
    """Little-endian int16 values packed in bytes, as `array<double>`; `missing` becomes null."""

    @F.arrow_udf("array<double>")
    def decode(column: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        if (lengths % 2).any():
            raise ValueError("packed values must have an even number of bytes")
        raw = np.frombuffer(_joined_bytes(column), dtype="<i2")
        values = pa.array(raw * scale, pa.float64(), mask=None if missing is None else raw == missing)
        offsets = np.concatenate([[0], np.cumsum(lengths // 2)]).astype("i4")
        return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pc.is_null(column))

    return decode(packed)


def project(vector: Column, basis: Basis) -> Column:
    """`struct<coeff array<double>, res array<double>>` of a vector on a basis.

    A missing day counts as equal to the mean. `coeff[i-1]` is v_i . (x - mean).
    `res[0]` is |x - mean|^2 / |x|^2 and `res[i]` is the squared norm that the
    first i eigenvectors leave of x - mean, over |x - mean|^2; null where the
    divisor is zero.
    """
    mean, vectors = np.asarray(basis.mean, "f8"), np.asarray(basis.vectors, "f8")

    @F.arrow_udf("struct<coeff: array<double>, res: array<double>>")
    def split(column: pa.Array) -> pa.Array:
        x, present = as_matrix(column, len(mean))
        centred = np.nan_to_num(x - mean)
        total, spread = np.nansum(x * x, axis=1), (centred * centred).sum(axis=1)
        coeff = centred @ vectors.T
        res = np.full((len(x), len(vectors) + 1), np.nan)
        np.divide(spread, total, out=res[:, 0], where=total > 0)
        left = centred
        for i, v in enumerate(vectors):
            left = left - np.outer(coeff[:, i], v)
            np.divide((left * left).sum(axis=1), spread, out=res[:, i + 1], where=spread > 0)
        return pa.StructArray.from_arrays(
            [_lists(coeff, present), _lists(res, present)], names=["coeff", "res"], mask=pa.array(~present)
        )

    return split(vector)


def reconstruct(coeff: Column, basis: Basis) -> Column:
    """The approximations by 0, 1, ... k eigenvectors: `array<array<double>>`."""
    mean, vectors = np.asarray(basis.mean, "f8"), np.asarray(basis.vectors, "f8")

    @F.arrow_udf("array<array<double>>")
    def build(column: pa.Array) -> pa.Array:
        c, present = as_matrix(column, len(vectors))
        steps = np.empty((len(c), len(vectors) + 1, len(mean)))
        steps[:, 0] = mean
        for i, v in enumerate(vectors):
            steps[:, i + 1] = steps[:, i] + np.outer(c[:, i], v)
        inner = _lists(steps.reshape(-1, len(mean)), np.ones(len(c) * (len(vectors) + 1), bool))
        offsets = np.concatenate([[0], np.cumsum(np.where(present, len(vectors) + 1, 0))]).astype("i4")
        return pa.ListArray.from_arrays(pa.array(offsets), inner, mask=pa.array(~present))

    return build(coeff)
