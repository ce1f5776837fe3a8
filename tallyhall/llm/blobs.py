"""Compact bytes for sorted keys and for counts, exchanged between tasks."""

from __future__ import annotations

import numpy as np
import zstandard


def _pack(values: np.ndarray) -> bytes:
    """Byte planes, so that the many zero bytes stand together."""
    width = values.dtype.itemsize
    planes = values.view(np.uint8).reshape(-1, width).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _unpack(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys.astype("<u8"), prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, "<u8"), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    return _pack(counts.astype("<u4"))


def unpack_counts(data: bytes) -> np.ndarray:
    return _unpack(data, "<u4").astype(np.int64)
