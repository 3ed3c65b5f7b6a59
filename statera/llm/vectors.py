"""Arrow columns of vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def dense(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The places of the usable vectors of a list column, and these vectors as rows of doubles. Usable are
    those without null or non-finite components, of length ``dims``; of any length, filled up with zeros, where
    that is None."""
    sizes = np.diff(np.asarray(column.offsets))
    sizes[np.asarray(column.is_null())] = -1
    usable = sizes > 0 if dims is None else sizes == dims
    places = np.flatnonzero(usable)
    if not len(places):
        return places, np.empty((0, dims or 0))
    flat = column.take(pa.array(places)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = sizes[places]
    width = int(sizes.max())
    if (sizes == width).all():
        matrix = flat.reshape(-1, width)
    else:
        matrix = np.zeros((len(places), width))
        matrix[np.arange(width) < sizes[:, None]] = flat
    finite = np.isfinite(matrix).all(axis=1)
    return places[finite], matrix[finite]
