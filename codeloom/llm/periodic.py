"""Periodic runs of words: stretches in which every word equals the word a period before it.

Method (seed and extend along diagonals): a run of smallest period q and length L >= max(6, 4q) has at least
max(3q, 6 - q) places where a window of k words recurs q words later. Periods are taken in levels [q_lo, q_hi] with one
window length k each, between 2 q_hi - 1 (within a primitive run, a window that long recurs first exactly one period
later) and the guaranteed overlap max(3 q_lo, 6 - q_lo). Windows are identified by exact ranks from prefix doubling,
each place is paired with the next place of an equal window, and the pairs whose lag falls in the level are seeds.
Seeds are extended along their diagonal (lag) to the maximal interval of equal words; a table of the furthest place
covered per lag skips seeds inside an interval already extended. So every run is found, each once, without pairing
all occurrences of a frequent window.

Documents are independent: Spark deals them to tasks and each task works through its own, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
RUN = "struct<start:long, length:long, period:long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, collapsed string"


def planted_words(words: Column, doc_id: str = "doc_id") -> Column:
    """The words after the planted repetition of the contract (null id: unchanged).

    h = crc32(decimal doc_id), g = h div 10. If h mod 10 = 0 and n > 0, word i >= a becomes word a + (i - a) mod p,
    with a = g mod n and p = 1 + (n - a) div (3 + g mod 8). ``words`` should be a column of its own: the lambda
    reads it once a word, and an expression in its place would be evaluated that often.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.size(words)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    moved = F.transform(words, lambda w, i: F.when(i >= a, F.element_at(words, (a + F.pmod(i - a, p) + 1).cast("int"))).otherwise(w))
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), moved).otherwise(words)


def levels(n: int) -> list[tuple[int, int, int]]:
    """(k, q_lo, q_hi) for periods up to n // 4: k is the least guaranteed overlap of q_lo, q_hi the largest period it serves."""
    found, low = [], 1
    while low <= n // 4:
        k = max(3 * low, 6 - low)
        high = (k + 1) // 2
        found.append((k, low, high))
        low = high + 1
    return found


def window_ranks(ids: np.ndarray, k: int, doubled: list[np.ndarray]) -> np.ndarray:
    """Exact ranks of the windows of k words (equal windows, equal ranks), from ranks of power-of-two windows."""
    while (1 << (len(doubled) - 1)) * 2 <= k:
        last, width = doubled[-1], 1 << (len(doubled) - 1)
        pairs = last[:-width].astype(np.int64) * (len(ids) + 1) + last[width:]
        doubled.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))
    j = len(doubled) - 1
    while (1 << j) > k:
        j -= 1
    width, ranks = 1 << j, doubled[j]
    count = len(ids) - k + 1
    return ranks[:count] * (len(ids) + 1) + ranks[k - width:k - width + count]


def reach(ids: np.ndarray, a: int, b: int, step: int) -> int:
    """How many places t >= 0 have ids[a + step*t'] == ids[b + step*t'] for all t' <= t, going forward (1) or backward (-1)."""
    done, chunk = 0, 64
    n = len(ids)
    while True:
        if step > 0:
            room = min(chunk, n - b - done)
            if room <= 0:
                return done
            same = ids[a + done:a + done + room] == ids[b + done:b + done + room]
        else:
            room = min(chunk, a - done + 1)
            if room <= 0:
                return done
            same = ids[a - done - room + 1:a - done + 1][::-1] == ids[b - done - room + 1:b - done + 1][::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done += room
        chunk *= 2


def prime_factors(x: int) -> list[int]:
    found, factor = [], 2
    while factor * factor <= x:
        if x % factor == 0:
            found.append(factor)
            while x % factor == 0:
                x //= factor
        factor += 1
    return found + ([x] if x > 1 else [])


def primitive(ids: np.ndarray, start: int, length: int, period: int) -> bool:
    """True if no proper divisor of the period is a period of the interval (a smaller period would divide it)."""
    for factor in prime_factors(period):
        d = period // factor
        if np.array_equal(ids[start:start + length - d], ids[start + d:start + length]):
            return False
    return True


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start then period."""
    n = len(ids)
    doubled = [ids.astype(np.int64)]
    seeds = []
    for k, low, high in levels(n):
        if k > n:
            break
        ranks = window_ranks(ids, k, doubled)
        order = np.lexsort((np.arange(len(ranks)), ranks))
        same = ranks[order[1:]] == ranks[order[:-1]]
        if not same.any():  # no window of k words recurs, so no longer one does: no run of a larger period is left
            break
        here, there = order[:-1][same], order[1:][same]
        lag = there - here
        keep = (lag >= low) & (lag <= high)
        here, lag = here[keep], lag[keep]
        if len(here):
            key = lag * (n + 1) + here  # a seed whose predecessor on the same diagonal is a seed lies in its extension
            first = ~np.isin(key - 1, key)
            seeds.append(np.stack([lag[first], here[first], np.full(int(first.sum()), k)], axis=1))
    if not seeds:
        return []
    table = np.concatenate(seeds)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    covered: dict[int, int] = {}
    found = []
    for lag, place, k in table.tolist():
        if place < covered.get(lag, -1):
            continue
        back = reach(ids, place - 1, place - 1 + lag, -1) if place > 0 else 0
        ahead = reach(ids, place + k, place + k + lag, 1)
        start, last = place - back, place + k - 1 + ahead  # last place that equals the place one lag later
        covered[lag] = last + 1
        length = last - start + 1 + lag
        if length >= max(6, 4 * lag) and primitive(ids, start, length, lag):
            found.append((start, length, lag))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_in_arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, counts, all_runs, collapsed = [], [], [], []
        for row, words in zip(batch.column("doc_id").to_pylist(), batch.column("words").to_pylist()):
            words = words or []
            index: dict[str, int] = {}
            ids = np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=len(words))
            found = runs_of(ids)
            cut = np.zeros(len(words) + 1, dtype=np.int64)
            for start, length, period in found:
                cut[start + period] += 1
                cut[start + length] -= 1
            dropped = np.cumsum(cut[:-1]) > 0
            rows.append(row)
            counts.append(len(words))
            all_runs.append([{"start": s, "length": l, "period": p} for s, l, p in found])
            collapsed.append(" ".join(w for w, gone in zip(words, dropped.tolist()) if not gone))
        yield pa.RecordBatch.from_pydict({"doc_id": rows, "n_words": counts, "runs": all_runs, "collapsed": collapsed},
                                         schema=pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                                                           ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                                                                        ("period", pa.int64())]))),
                                                           ("collapsed", pa.string())]))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (array of start, length, period by start then period), collapsed.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text after :func:`planted_words`, numbered from 0 (null text: none).
    A run is a maximal stretch with smallest period q and length >= max(6, 4q); a word is dropped when a run holds it
    after its first q words, and ``collapsed`` is the kept words joined by one space (empty when none). Every row gives
    one row, in place, so null and repeated ids, empty tables and other columns (whatever their names) need no care.
    """
    words = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD), 0)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words.alias("_words"))
    rows = rows.select("doc_id", planted_words(F.col("_words")).alias("words"))
    return rows.mapInArrow(runs_in_arrow, SCHEMA)
