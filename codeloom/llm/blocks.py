"""Equal-length columns of 64-bit integers as compressed blocks, one row a block, dealt over tasks by key.

Where many rows of a key and a small number are shuffled, most of what is written are the same high bytes. A task sorts its keys, so
that their differences are small, cuts them where the bucket changes, and puts bytes of equal weight side by side before they are
compressed. A block is worth thousands of rows of the same values at about a third of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

COLUMNS = ["bucket", "width", "size", "body"]
SCHEMA = "bucket int, width int, size int, body binary"


def pack(columns: np.ndarray) -> bytes:
    """A block from a (columns, values) matrix whose first row ascends."""
    table = columns.copy()
    table[0, 1:] -= columns[0, :-1]
    planes = table.view(np.uint8).reshape(len(table), -1, 8).transpose(0, 2, 1)
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(width: int, size: int, body: bytes) -> np.ndarray:
    """The matrix that ``pack`` was given."""
    raw = pa.decompress(body, decompressed_size=width * size * 8, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(width, 8, size).transpose(0, 2, 1)
    table = np.array(planes, order="C").view(np.uint64).reshape(width, size)
    table[0] = np.cumsum(table[0])
    return table


def blocks(buckets: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """A row for each run of equal buckets. The first column ascends inside a run, the others go with it."""
    table = np.stack([c.view(np.uint64) for c in columns])
    cuts = np.append(np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])), len(buckets)) if len(buckets) else np.zeros(1, np.int64)
    bodies = [pack(table[:, a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets[cuts[:-1]], pa.int32()), pa.array(np.full(len(bodies), len(columns)), pa.int32()),
         pa.array(np.diff(cuts), pa.int32()), pa.array(bodies, pa.binary())], COLUMNS)


def dealt(table: DataFrame, tasks: int) -> DataFrame:
    """The blocks of a bucket, one after the other in one task."""
    return table.repartition(tasks, "bucket").sortWithinPartitions("bucket")


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each bucket of a dealt table."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, group in groupby(rows, key=lambda row: row["bucket"]):
        yield list(group)
