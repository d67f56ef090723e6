"""Sorted 64-bit keys of a block, cut into hash buckets and packed for the shuffle.

A block of texts asks each bucket for its distinct keys; the bucket answers in the same
order. Every key is sent once per block, so a very common key weighs no more than a rare one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

_U = np.uint64


def bucket_count(spark: SparkSession) -> int:
    """Two buckets for each shuffle partition, so that the user's setting bounds their size."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


_ZSTD = pa.Codec("zstd", compression_level=3)


def squeeze(raw: bytes) -> bytes:
    return _ZSTD.compress(raw, asbytes=True) if raw else b""


def expand(packed: bytes, size: int) -> bytes:
    return _ZSTD.decompress(packed, size, asbytes=True) if size else b""


def _planes(values: np.ndarray) -> bytes:
    return squeeze(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes())


def _from_planes(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(expand(packed, 8 * n), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(_U).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """The steps between sorted keys byte by byte, so that the high bytes all but vanish."""
    steps = keys.copy()
    steps[1:] -= keys[:-1]
    return _planes(steps)


def unpack_keys(packed: bytes, n: int) -> np.ndarray:
    return np.cumsum(_from_planes(packed, n), dtype=_U)


def pack_counts(counts: np.ndarray) -> bytes:
    return _planes(counts.astype("<u8"))


def unpack_counts(packed: bytes, n: int) -> np.ndarray:
    return _from_planes(packed, n).astype(np.int64)


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin in sorted ``keys``; bucket b takes an equal share of 2**64."""
    bounds = [(b << 64) // buckets for b in range(1, buckets)]
    inner = np.searchsorted(keys, np.array(bounds, _U)) if bounds else np.zeros(0, np.int64)
    return np.concatenate(([0], inner, [len(keys)])).astype(np.int64)
