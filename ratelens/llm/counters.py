"""Sums of fixed-size integer arrays over all tasks.

Each task keeps one array; its parts cross the network as compressed chunks
and are summed chunk by chunk as they stream in, so neither a task nor the
driver ever holds more than one array (whatever the number of tasks).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 14
SCHEMA = "chunk int, counts binary"


def chunks(counts: np.ndarray) -> pa.RecordBatch:
    rows = [(i, zlib.compress(c.astype(np.int64).tobytes(), 1))
            for i, c in enumerate(counts.reshape(-1, CHUNK)) if c.any()]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                       pa.array([r[1] for r in rows], pa.binary())], ["chunk", "counts"])


def _summed(finish: Callable[[np.ndarray], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, c in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[i] = total.get(i, 0) + np.frombuffer(zlib.decompress(c), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([finish(v).tobytes() for v in total.values()], pa.binary())],
            ["chunk", "counts"])
    return run


def whole(v: np.ndarray) -> np.ndarray:
    return v


def total(parts: DataFrame, size: int, finish: Callable[[np.ndarray], np.ndarray] = whole, dtype=np.int64) -> np.ndarray:
    """The sum over all tasks, after ``finish`` per chunk: ``size`` values, at the driver."""
    out = np.zeros(size, dtype)
    for r in parts.repartition("chunk").mapInArrow(_summed(finish), SCHEMA).collect():
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(bytes(r["counts"]), dtype)
    return out
