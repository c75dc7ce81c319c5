"""Vectors as integers in bytes: quantised, in the narrowest integers that hold them, and read back as matrices."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

_KINDS = (np.int8, np.int16, np.int32, np.int64)


def quantise(vector: np.ndarray, scale: int) -> bytes | None:
    """floor(scale * x) of each component behind a byte that holds their width in bytes.

    None without components, with one that is not finite, and where ``length * largest**2`` reaches 2^63: inner products
    of such vectors may not fit a long.
    """
    if not len(vector) or not np.isfinite(vector).all():
        return None
    with np.errstate(over="ignore"):
        x = np.floor(vector.astype(np.float64) * scale)
    top = float(np.abs(x).max())
    if not len(x) * top * top < 2.0**63:
        return None
    kind = next(k for k in _KINDS if top <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + x.astype(kind).tobytes()


def packed(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Batches whose last column, a list of numbers, becomes ``quantise``'s bytes; a row goes that has a null anywhere, or none."""
    for batch in batches:
        vectors = batch.column(batch.num_columns - 1)
        keep, made = [], []
        for i, vector in enumerate(vectors):
            values = vector.values
            if values is None or values.null_count or any(not c[i].is_valid for c in batch.columns[:-1]):
                continue
            data = quantise(values.to_numpy(zero_copy_only=False), scale)
            if data is not None:
                keep.append(i)
                made.append(data)
        rest = [c.take(pa.array(keep, pa.int64())) for c in batch.columns[:-1]]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(made, pa.binary())], [*batch.schema.names[:-1], "v"])


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, _KINDS[data[0].bit_length() - 1], offset=1)


def by_width(data: Sequence[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each number of components: the places of the vectors that have so many, and their matrix of integers."""
    made = [unpack(d) for d in data]
    widths = np.array([len(v) for v in made], np.int64)
    found = {}
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        found[width] = at, np.stack([made[i] for i in at])
    return found


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products (queries x rows); as floats, which are exact below 2^53, where that suffices."""
    bound = float(np.abs(queries.astype(np.float64)).max(initial=0)) * float(np.abs(rows.astype(np.float64)).max(initial=0))
    if bound * max(1, queries.shape[1]) < 2.0**52:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    return queries.astype(np.int64) @ rows.T.astype(np.int64)
