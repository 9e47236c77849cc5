"""Removal of repeated word spans by a compacted de Bruijn graph.

Edges of the graph are the windows of ``size`` consecutive words; edges that follow each other in a text share a node. Three
steps keep the graph small and free of hot keys:

* Anchors. Of the short word runs inside a window the one with the smallest hash is its anchor. Equal windows have equal
  anchors at equal places, so a window whose anchor occurs only once in the corpus is unique and no edge is made of it.
* Edges. Per batch an edge is one row with its first source coordinate, and the word before and after if all agree. Aggregation over batches gives each edge's first coordinate and whether the nodes at its ends branch.
* Compaction. An edge is joined to the one that starts a word later at its first source; where the node between them does
  not branch both belong to one path. Paths are spans of first occurrences: (source document, start, edges).

A window that may repeat and lies in no path of its own document is a later copy: the source coordinates say so.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeloom.llm.words import byte_view, gram_hashes, pieces, signed, text_bytes, word_hashes, word_places
from codeloom.session import stage

SIZE = 20
ANCHOR = 12
BROADCAST_BYTES = 64 * 1024 * 1024
MIXED = 0x7FFF


def texts_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    data, rows = byte_view(batch.column("body"))
    starts, ends, first = word_places(data, rows)
    words = word_hashes(data, starts, ends, fold=False)
    return (words[first[i]:first[i + 1]] for i in range(batch.num_rows))


def window_anchors(words: np.ndarray, size: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of a text the place of its anchor, and the hashes of all runs."""
    runs = gram_hashes(words, anchor)
    if len(words) < size:
        return np.zeros(0, dtype=np.int64), runs
    views = np.lib.stride_tricks.sliding_window_view(runs, size - anchor + 1)
    return np.arange(len(views)) + views.argmin(axis=1), runs


ANCHORS = ["key", "doc_id", "place", "known"]


def anchor_rows(size: int, anchor: int):
    """Anchors (key, doc_id, place, known). Of equal anchors of a batch only the first is sent by key, all marked as known to
    repeat, so a key takes one row a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "body", 8 * 1024 * 1024):
            key, row, place = [], [], []
            for doc, words in zip(batch.column("doc_id").to_numpy(), texts_of(batch)):
                at, runs = window_anchors(words, size, anchor)
                at = np.unique(at)
                key.append(runs[at])
                place.append(at.astype(np.int32))
                row.append(np.full(len(at), doc, dtype=np.int64))
            key, row, place = np.concatenate(key), np.concatenate(row), np.concatenate(place)
            order = np.argsort(key, kind="stable")
            key, row, place = key[order], row[order], place[order]
            fresh = np.append(True, key[1:] != key[:-1])[:len(key)]
            known = ~fresh | np.append(~fresh[1:], False)[:len(key)]
            yield pa.RecordBatch.from_arrays([pa.array(signed(key), mask=~fresh), pa.array(row), pa.array(place), pa.array(known)], ANCHORS)
    return run


def repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the anchors that occur twice or more, from rows sorted by key."""
    held, sent = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:  # the last row of the batch before, to compare with
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        keyed = np.asarray(pc.is_valid(batch.column("key")))
        key = batch.column("key").fill_null(0).to_numpy()
        same = (key[1:] == key[:-1]) & keyed[1:] & keyed[:-1]
        chosen = np.asarray(batch.column("known")) | np.append(same, False) | np.append(False, same)
        last_sent = bool(chosen[-1]) if held is None or batch.num_rows > 1 else sent
        if held is not None and sent:
            chosen[0] = False
        held, sent = batch.slice(batch.num_rows - 1, 1), last_sent
        yield batch.select(["doc_id", "place"]).filter(pa.array(chosen))


def likely(words: np.ndarray, marks: np.ndarray, size: int, anchor: int) -> np.ndarray:
    """Which windows of a text have a repeated anchor."""
    at, _ = window_anchors(words, size, anchor)
    marked = np.zeros(len(words) + 1, dtype=bool)
    marked[marks[marks < len(words)]] = True  # rows that share an id share their marks
    return marked[at]


EDGES = "edge long, doc_id long, place int, sides int"


def edge_rows(size: int, anchor: int):
    """A batch's distinct edges, each with its first source coordinate and 15 bits of the words before and after.

    The two sides only say where paths end, not what is removed, so short hashes do.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "body", 8 * 1024 * 1024):
            edge, row, place, before, after = [], [], [], [], []
            for doc, marks, words in zip(batch.column("doc_id").to_numpy(), batch.column("marks"), texts_of(batch)):
                chosen = np.flatnonzero(likely(words, marks.values.to_numpy(), size, anchor))
                edge.append(gram_hashes(words, size)[chosen])
                place.append(chosen.astype(np.int32))
                row.append(np.full(len(chosen), doc, dtype=np.int64))
                around = np.concatenate([[np.uint64(doc)], words, [np.uint64(doc)]]) % np.uint64(MIXED)  # a text's end is its own
                before.append(around[chosen].astype(np.int32))
                after.append(around[chosen + size + 1].astype(np.int32))
            edge, row, place = np.concatenate(edge), np.concatenate(row), np.concatenate(place)
            before, after = np.concatenate(before), np.concatenate(after)
            if len(edge):
                order = np.lexsort((place, row, edge))
                yield merged(edge[order], row[order], place[order], before[order], after[order])
    return run


def merged(edge: np.ndarray, row: np.ndarray, place: np.ndarray, before: np.ndarray, after: np.ndarray) -> pa.RecordBatch:
    """One row for each edge of rows sorted by edge and coordinate."""
    head = np.flatnonzero(np.append(True, edge[1:] != edge[:-1]))
    sides = [np.where(np.minimum.reduceat(x, head) == np.maximum.reduceat(x, head), x[head], MIXED) for x in (before, after)]
    return pa.RecordBatch.from_arrays([pa.array(edge[head].view(np.int64)), pa.array(row[head]), pa.array(place[head]),
                                       pa.array((sides[0] << 15 | sides[1]).astype(np.int32))], ["edge", "doc_id", "place", "sides"])


def first_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first source coordinate of each edge and whether the nodes at its ends branch, from rows sorted by edge, at most one
    a batch of texts for each edge."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        edge = batch.column("edge").to_numpy()
        last = int(np.searchsorted(edge, edge[-1]))  # the last edge may go on in the next batch
        held = batch.slice(last)
        if last:
            yield placed(batch.slice(0, last))
    if held is not None:
        yield placed(held)


def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
    sides = batch.column("sides").to_numpy()
    whole = merged(*(batch.column(c).to_numpy() for c in ("edge", "doc_id", "place")), sides >> 15, sides & MIXED)
    sides = whole.column("sides").to_numpy()
    return pa.RecordBatch.from_arrays([whole.column("doc_id"), whole.column("place"), pa.array(sides >> 15 == MIXED), pa.array(sides & MIXED == MIXED)],
                                      ["doc_id", "place", "forks_in", "forks_out"])


def compacted(edges: DataFrame) -> DataFrame:
    """Paths of first occurrences (doc_id, start, n_edges) of the graph whose batch rows are given."""
    n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = edges.repartition(n, "edge").sortWithinPartitions("edge", "doc_id", "place")
    whole = dealt.mapInArrow(first_places, "doc_id long, place int, forks_in boolean, forks_out boolean")
    source = Window.partitionBy("doc_id").orderBy("place")
    joined = (F.lag("place").over(source) == F.col("place") - 1) & ~F.col("forks_in") & ~F.lag("forks_out").over(source)
    starts = whole.withColumn("starts", (~F.coalesce(joined, F.lit(False))).cast("int"))
    path = starts.withColumn("path", F.sum("starts").over(source.rowsBetween(Window.unboundedPreceding, 0)))
    return path.groupBy("doc_id", "path").agg(F.min("place").alias("start"), F.count(F.lit(1)).cast("int").alias("n_edges")).drop("path")


def removals(size: int, anchor: int):
    """Words of the windows that repeat an earlier one: those that may repeat and are in no path of the text itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "body"):
            counts, removed, digest = [], [], []
            for body, marks, starts, edges, words in zip(batch.column("body").to_pylist(), batch.column("marks"), batch.column("starts"),
                                                         batch.column("edges"), texts_of(batch)):
                own, at = body.split(), np.zeros(0, dtype=np.int64)
                if marks.is_valid:
                    later = likely(words, marks.values.to_numpy(), size, anchor)
                    if starts.is_valid:
                        change = np.zeros(len(words) + 2, dtype=np.int64)
                        begin, count = starts.values.to_numpy(), edges.values.to_numpy()
                        np.add.at(change, np.minimum(begin, len(words) + 1), 1)
                        np.add.at(change, np.minimum(begin + count, len(words) + 1), -1)
                        later &= np.cumsum(change)[:len(later)] == 0
                    at = np.flatnonzero(later)
                cover = np.zeros(len(own) + 1, dtype=np.int64)
                cover[at] += 1
                cover[at + size] -= 1
                gone = np.cumsum(cover)[:len(own)] > 0
                counts.append(len(own))
                removed.append(int(gone.sum()))
                digest.append(hashlib.sha256(b" ".join(compress(own, ~gone) if len(at) else own)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest)],
                                             ["doc_id", "n_words", "n_removed", "kept_sha256"])
    return run


def beside(texts: DataFrame, lists: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Join texts to a staged table of number lists: broadcast if its measured size allows, else both sides are shuffled."""
    numbers = sum((F.coalesce(F.size(c), F.lit(0)) for c in columns), F.lit(0))
    total = lists.agg(F.sum(4 * numbers + 40)).first()[0] or 0
    return texts.join(F.broadcast(lists) if total <= BROADCAST_BYTES else lists, "doc_id", how)


def repeated_spans(docs: DataFrame, size: int = SIZE, anchor: int = ANCHOR) -> DataFrame:
    """Columns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space), one row a document.

    A word goes if a window of ``size`` words that covers it also starts earlier: in a smaller doc_id, or before in the same text.
    Null texts have no words, and texts under ``size`` words lose none. The order of documents decides what stays, so rows with a
    null id take no part and come back whole. Ids should be unique; rows that share one count as one document, so they are not
    copies of each other. Other columns are ignored, and an empty table gives an empty result.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    ordered = texts.filter("doc_id is not null")
    anchors = ordered.mapInArrow(anchor_rows(size, anchor), "key long, doc_id long, place int, known boolean")
    dealt = anchors.repartition(n, F.coalesce("key", F.xxhash64("doc_id", "place"))).sortWithinPartitions("key")
    places = dealt.mapInArrow(repeated_anchors, "doc_id long, place int")
    marks = stage(places.groupBy("doc_id").agg(F.sort_array(F.collect_list("place")).alias("marks")), "anchor-marks")
    edges = beside(ordered, marks, ["marks"], "inner").mapInArrow(edge_rows(size, anchor), EDGES)
    paths = compacted(edges).groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("n_edges").alias("edges"))
    found = stage(marks.join(paths, "doc_id", "left"), "paths")
    return beside(texts, found, ["marks", "starts", "edges"], "left").mapInArrow(
        removals(size, anchor), "doc_id long, n_words long, n_removed long, kept_sha256 string")
