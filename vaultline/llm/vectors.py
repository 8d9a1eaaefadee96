"""Embedding columns as integer vectors.

``scaled`` reads an Arrow list column; a usable row has a vector without NULL,
NaN or infinite entries, and its entries c become floor(256*c) in double
arithmetic.  Scaled entries of 2**29 or more in size raise an OverflowError:
longs could not hold sums of their products exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SCALE = 256


def scaled(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(usable, lengths, values): a mask over the rows, the lengths of the
    usable vectors and their scaled entries, one vector after another."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    lengths = pc.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)  # NULL entries become NaN
    row = np.repeat(np.arange(len(vectors)), lengths)
    finite = np.isfinite(flat)
    usable = vectors.is_valid().to_numpy(zero_copy_only=False).copy()
    usable[row[~finite]] = False
    kept = np.floor(SCALE * flat[usable[row]])
    if kept.size and np.abs(kept).max() >= 2**29:
        raise OverflowError("a vector entry times 256 is 2**29 or more")
    return usable, lengths[usable], kept.astype(np.int64)


def list_array(lengths: np.ndarray, values: np.ndarray) -> pa.Array:
    """An Arrow list<int32> column of the given vectors."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an integer list column as int64, missing entries as 0."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return flat.reshape(len(lengths), dim).astype(np.int64)
    out = np.zeros((len(lengths), dim), np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(starts, lengths)] = flat
    return out


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of integer matrices as int64: by floating point where every sum
    stays below 2**53 and so is exact, else by integer arithmetic."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    if top >= 2**63:
        raise OverflowError("an inner product does not fit a long")
    return a.astype(np.int64) @ b.astype(np.int64)
