"""Vector columns (``array<double>``): Arrow kernels over whole batches.

The built-in array lambdas are evaluated one element at a time; over 64 x 8 values a row an
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from plaint.functions.columns import column


def _flat(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of all lists in one array, with the start and the length of each list (NULL: 0)."""
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values, np.cumsum(lengths) - lengths, lengths


def _rows(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Matrix of the lists that have the given width, and the mask of these lists."""
    values, starts, lengths = _flat(vectors)
    usable = lengths == width
    if usable.all():
        return values.reshape(-1, width), usable
    index = starts[usable][:, None] + np.arange(width)[None, :]
    return values[index] if len(values) else np.empty((0, width)), usable


def concat(first: Column | str, second: Column | str) -> Column:
    """The second vector behind the first; NULL when either is missing."""
    return F.concat(column(first), column(second))


def l2_normalize(vector: Column | str) -> Column:
    """The vector over its length; a zero vector stays zero, NULL stays NULL."""

    @F.arrow_udf("array<double>")
    def kernel(vectors: pa.Array) -> pa.Array:
        values, _, lengths = _flat(vectors)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        norms = np.sqrt(np.bincount(owner, weights=values * values, minlength=len(lengths)))
        norms[norms == 0] = 1.0
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()),
            pa.array(values / norms[owner], pa.float64()),
            mask=vectors.is_null(),
        )

    return kernel(column(vector))


def nearest(vector: Column | str, names: list[str], centers: np.ndarray) -> Column:
    """Name of the closest center (Euclidean); on equal distance, the one listed first.

    ``centers`` are model parameters: one row per cluster, never one per ticket. A missing vector,
    or one of another width, has no nearest center.
    """
    centers = np.asarray(centers, dtype=np.float64)
    labels = np.asarray(names, dtype=object)

    @F.arrow_udf("string")
    def kernel(vectors: pa.Array) -> pa.Array:
        matrix, usable = _rows(vectors, centers.shape[1])
        distances = np.empty((len(matrix), len(centers)))
        for i, center in enumerate(centers):
            gap = matrix - center
            distances[:, i] = np.einsum("ij,ij->i", gap, gap)
        found = np.full(len(usable), None, dtype=object)
        found[usable] = labels[distances.argmin(axis=1)]
        return pa.array(found, pa.string())

    return kernel(column(vector))


def project(vector: Column | str, components: np.ndarray, mean: np.ndarray | None = None) -> Column:
    """Dot product of the (centered) vector with each component, as ``array<double>``."""
    components = np.asarray(components, dtype=np.float64)
    shift = 0.0 if mean is None else np.asarray(mean, dtype=np.float64)

    @F.arrow_udf("array<double>")
    def kernel(vectors: pa.Array) -> pa.Array:
        matrix, usable = _rows(vectors, components.shape[1])
        scores = (matrix - shift) @ components.T
        ends = np.cumsum(usable * len(components))
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.array(scores.ravel()), mask=pa.array(~usable)
        )

    return kernel(column(vector))


def distance(first: Column | str, second: Column | str) -> Column:
    """Euclidean distance of two vectors of equal width; NULL when either is missing."""

    @F.arrow_udf("double")
    def kernel(left: pa.Array, right: pa.Array) -> pa.Array:
        missing = pc.or_(left.is_null(), right.is_null())
        kept = pc.invert(missing)
        a, _, lengths = _flat(left.filter(kept))
        b, _, others = _flat(right.filter(kept))
        if not np.array_equal(lengths, others):
            raise ValueError("vectors of different width")
        owner = np.repeat(np.arange(len(lengths)), lengths)
        squares = np.bincount(owner, weights=(a - b) ** 2, minlength=len(lengths))
        found = np.full(len(left), np.nan)
        missing = missing.to_numpy(zero_copy_only=False)
        found[~missing] = np.sqrt(squares)
        return pa.array(found, pa.float64(), mask=missing)

    return kernel(column(first), column(second))
