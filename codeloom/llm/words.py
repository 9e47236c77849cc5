"""Words and word n-grams of whole texts as 64-bit hashes, computed column-wise inside Arrow tasks.

A word is a longest run of bytes other than ASCII white space (0x20, 0x09-0x0D). Hashes are a multilinear sum
over the word's bytes, finished by a bit mixer; two different words share one with a chance below 2**-56.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
PIECE_BYTES = 2 * 1024 * 1024

SOLID = np.ones(256, dtype=bool)
SOLID[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
SAME = np.arange(256, dtype=np.uint64)
FOLDED = SAME.copy()
FOLDED[ord("A"):ord("Z") + 1] += np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def factors(start: int, stop: int) -> np.ndarray:
    """The odd multipliers of byte places start..stop-1, made by rule."""
    return mix(np.arange(start + 1, stop + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


FACTORS = factors(0, 256)


def text_bytes(name: str = "text") -> Column:
    """The text as bytes; null counts as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column without copying, and where each row starts (one place more than rows)."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    buffers = column.buffers()
    places = np.frombuffer(buffers[1], dtype=kind, count=len(column) + 1, offset=column.offset * kind().itemsize).astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[places[0]:places[-1]], places - places[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``, a longer row by itself."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, places = byte_view(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(places, places[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def word_places(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each row the number of its first word (one place more than rows)."""
    solid = SOLID[data]
    head = solid.copy()
    head[1:] &= ~solid[:-1]
    first = rows[:-1][rows[:-1] < len(data)]
    head[first] = solid[first]
    tail = solid.copy()
    tail[:-1] &= ~solid[1:] | head[1:]
    starts, ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
    return starts, ends, np.searchsorted(starts, rows)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """One hash per word; ``fold`` lower-cases A-Z first."""
    table = FOLDED if fold else SAME
    sizes = ends - starts
    out = np.empty(len(starts), dtype=np.uint64)
    before = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(starts):  # about a megabyte of word bytes at a time
        to = max(int(np.searchsorted(before, before[at] + 1_000_000, side="right")) - 1, at + 1)
        size = sizes[at:to]
        local = before[at:to] - before[at]
        place = np.arange(before[to] - before[at]) - np.repeat(local, size)
        longest = int(size.max())
        factor = FACTORS if longest <= len(FACTORS) else factors(0, longest)
        value = table[data[place + np.repeat(starts[at:to], size)]] + np.uint64(1)
        out[at:to] = mix(np.add.reduceat(value * factor[place], local) + size.astype(np.uint64))
        at = to
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that start at each word but the last n-1."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for i, factor in enumerate(factors(1000, 1000 + n)):
        total += words[i:i + count] * factor
    return mix(total)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
