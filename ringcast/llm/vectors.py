"""What the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# An SQL condition for an array<double> column: no null, NaN or infinite component.
FINITE = "({0} is not null and forall({0}, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')))"


def matrix(column, width: int = 0, fill: float = 0, dtype=np.float64) -> np.ndarray:
    """A list column as rows of numbers, as wide as its longest list and ``width``
    at least; missing entries are ``fill``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(np.asarray(column.offsets))
    d = max(int(lengths.max(initial=0)), width)
    out = np.full((len(lengths), d), fill, dtype=dtype)
    out[np.arange(d)[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out
