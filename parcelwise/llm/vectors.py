"""Vectors as rows: which count, and how tasks read them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F


def usable(vector: Column) -> Column:
    """Not null, and without null, infinite or NaN components."""
    bad = F.exists(
        vector,
        lambda x: x.isNull()
        | F.isnan(x.cast("double"))
        | (F.abs(x.cast("double")) == F.lit(float("inf"))),
    )
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(column, width: int) -> np.ndarray:
    """The rows of an Arrow list column as doubles, filled with zeros to ``width``."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out
