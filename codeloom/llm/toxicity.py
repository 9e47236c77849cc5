"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is, combined by noisy-or.

Each sentence s gets p_s = sigmoid(b + sum of the weights of its hashed words and of the words' first 4 and 5
characters, so that an inflected form that no fitting row has is known by its stem); a leak p_0 covers what no sentence
shows. The document's probability is P = 1 - (1 - p_0) * prod_s (1 - p_s). Only document labels are known: the weights
are fitted to them by full-batch Adam on the log loss of P, whose gradient on a sentence's logit is p_s * (1 - y / P)
(and p_0 * (1 - y / P) on the leak). Every epoch is one Spark job: tasks compute the gradient of their documents
against the broadcast weights and returns it as one dense vector, which the driver adds up; the weights have a fixed
number of slots and the fitting rows a documented bound (so a bounded number of tasks), so what the driver and every
task hold is bounded whatever the corpus, and no epoch writes shuffle files. Scoring is a map over all rows with the same broadcast,
no shuffle; it also names the sentences that carry the score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.llm.words import pieces
from codeloom.session import stage

PIECE = 16 * 1024 * 1024  # bytes of text that a task reads at once
SLOTS = 1 << 18
EPOCHS = 40
RATE = 0.3
PENALTY = 1e-4
MAX_TRAIN_DOCS = 200_000  # documented bound on labelled rows used for fitting, stratified by label, seeded by doc_id
THRESHOLD = 0.3
HELD_OUT = 2  # crc32(doc_id as text) mod 4 of the rows kept out of fitting

SENTENCE_END = r"[.!?]+[\s\v\x1c-\x1f\x{85}\pZ]+|[.!?]+$|\n+"  # in the form of Arrow's patterns
NO_WORD = r"[^\pL\pN_]+"
STEMS = (4, 5)  # leading characters of longer words that are features of their own
SCORED = ("doc_id long, n_sentences long, score double, worst_sentence long, worst_probability double, "
          "flagged array<long>")


def hashed(parts: pa.Array, slots: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(part.encode()) % slots for part in parts.to_pylist()), dtype=np.int64, count=len(parts))


@dataclass
class Sentences:
    """The sentences with words of a batch of texts: whose they are, their distinct words, and the slots of each word."""
    count: np.ndarray   # sentences of each text
    starts: np.ndarray  # where each sentence's words start, and their number
    words: np.ndarray   # each sentence's distinct words, as rows of ``table``
    table: np.ndarray   # a row for each different word of the batch: the slots of the word and of its stems, -1 where it has none


def word_table(vocabulary: pa.Array, slots: int) -> np.ndarray:
    columns = [hashed(vocabulary, slots)]
    length = pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False)
    for n in STEMS:  # the mark keeps a stem apart from a word of the same characters
        stems = pc.utf8_slice_codeunits(vocabulary, 0, n).dictionary_encode()
        own = hashed(pc.binary_join_element_wise(stems.dictionary, "*", ""), slots)
        columns.append(np.where(length > n, own[stems.indices.to_numpy()], -1) if len(vocabulary) else columns[0])
    return np.stack(columns, axis=1)


def read_sentences(texts: pa.Array, slots: int) -> Sentences:
    split = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), SENTENCE_END)
    split_words = pc.split_pattern_regex(split.flatten(), NO_WORD)
    words = split_words.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(split_words)), np.diff(split_words.offsets.to_numpy()))
    vocabulary = words.dictionary
    found = words.indices.to_numpy().astype(np.int64)
    some = pc.not_equal(vocabulary, "").to_numpy(zero_copy_only=False)[found] if len(vocabulary) else np.zeros(0, dtype=bool)
    pairs = np.sort((owner[some] << 32) | found[some])
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
    sentence, word = pairs >> 32, pairs & 0xFFFFFFFF
    head = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1])) if len(pairs) else np.zeros(0, dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))[sentence[head]]
    return Sentences(np.bincount(text, minlength=len(texts)), np.append(head, len(pairs)), word, word_table(vocabulary, slots))


def sentence_logits(weights: np.ndarray, found: Sentences) -> np.ndarray:
    """weights[-2] is the bias of a sentence; a word weighs what its slots weigh together."""
    own = np.where(found.table >= 0, weights[found.table], 0.0).sum(axis=1)
    # summed by sentence, so that equal sentences weigh exactly the same
    return (np.add.reduceat(own[found.words], found.starts[:-1]) if len(found.words) else np.zeros(0)) + weights[-2]


def list_column(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values))


def fit_rows(slots: int):
    """Label, the slots of each sentence's distinct words, and where each sentence starts among them (from 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", PIECE):
            found = read_sentences(batch.column("text"), slots)
            rows = found.table[found.words]
            used = rows >= 0
            ends = np.append(0, np.cumsum(used.sum(axis=1)))[found.starts]  # of sentences, among the slots
            last = np.append(0, np.cumsum(found.count))  # of texts, among the sentences
            begins = ends[last[:-1]]
            starts = np.insert(ends[1:] - np.repeat(begins, found.count), last[:-1], 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_y"), list_column(rows[used].astype(np.int32), ends[last[1:]] - begins),
                 list_column(starts.astype(np.int32), found.count + 1)], names=["_y", "_slots", "_starts"])
    return run


def flat_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and row offsets (from 0) of a list column, read from its Arrow buffers without Python objects."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0]


def gradient_rows(shared, slots: int):
    """Gradient of a task's documents, whole batches at a time: sentence sums by cumulative differences, documents by bincount."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        leak = 1.0 / (1.0 + np.exp(-weights[-1]))
        grad = np.zeros(slots + 2)
        loss = 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column("_y").to_numpy(zero_copy_only=False).astype(np.float64)
            found, found_at = flat_lists(batch.column("_slots"))
            starts, starts_at = flat_lists(batch.column("_starts"))
            docs = len(y)
            owner = np.repeat(np.arange(docs), np.diff(starts_at))
            bounds = starts + found_at[owner]  # sentence bounds within the batch's slots
            last = np.zeros(len(starts), dtype=bool)
            last[starts_at[1:] - 1] = True
            begin, end, sentence_doc = bounds[~last], bounds[np.flatnonzero(~last) + 1], owner[~last]
            total = np.concatenate([[0.0], np.cumsum(weights[found])])
            p = 1.0 / (1.0 + np.exp(-np.clip(total[end] - total[begin] + weights[-2], -40, 40)))
            log_q = np.log1p(-leak) + np.bincount(sentence_doc, weights=np.log1p(-np.minimum(p, 1 - 1e-15)), minlength=docs)
            big_p = np.maximum(-np.expm1(log_q), 1e-12)
            factor = 1.0 - y / big_p
            g = p * factor[sentence_doc]
            grad[:slots] += np.bincount(found, weights=np.repeat(g, end - begin), minlength=slots)
            grad[-2] += g.sum()
            grad[-1] += (factor * leak).sum()
            loss -= float(np.sum(np.where(y > 0, np.log(big_p), np.log(np.maximum(1.0 - big_p, 1e-12)))))
        yield pa.RecordBatch.from_pydict({"g": [np.append(grad, loss).astype("<f8").tobytes()]}, schema=pa.schema([("g", pa.binary())]))
    return run


def training_rows(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> DataFrame:
    """Texts and labels of the fitting rows: labelled, crc32(doc_id) mod 4 != 2, at most ``max_docs`` by a seeded stratified draw.

    A doc_id with several label rows is toxic if any says so; null labels and null ids are not used; every document
    row of a labelled id is used (repeated rows weigh more).
    """
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("_y")))
    known = stage(known.filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != HELD_OUT), "toxic-labels")
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if total > max_docs:  # the same share of each label, so the draw keeps the label mix
        known = stage(known.filter(F.pmod(F.xxhash64("doc_id", F.lit("toxic-sample")), F.lit(1_000_000)) < int(max_docs / total * 1_000_000)),
                      "toxic-sample")
    # at most about max_docs ids of two numbers each: a bounded broadcast, so the texts are not shuffled
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, slots: int = SLOTS, epochs: int = EPOCHS, rate: float = RATE,
        penalty: float = PENALTY, max_docs: int = MAX_TRAIN_DOCS) -> np.ndarray:
    """Weights of the word slots, then the sentence bias and the leak logit (``slots + 2`` numbers)."""
    spark = docs.sparkSession
    rows = training_rows(docs, labels, max_docs)
    table = stage(rows.select(F.col("_y").cast("int").alias("_y"), "text").mapInArrow(fit_rows(slots), "_y int, _slots array<int>, _starts array<int>"),
                  "toxic-train")
    weights = np.zeros(slots + 2)
    weights[-2], weights[-1] = -4.0, -2.0
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    n = max(table.count(), 1)
    for epoch in range(1, epochs + 1):
        shared = spark.sparkContext.broadcast(weights)
        # one dense gradient a task, summed on the driver: a bounded number of slots, and nothing written to disk
        parts = table.mapInArrow(gradient_rows(shared, slots), "g binary").toArrow().column("g").to_pylist()
        shared.unpersist()
        grad = np.zeros(slots + 3)
        for part in parts:
            grad += np.frombuffer(part, dtype="<f8")
        grad = grad[:-1]
        grad = grad / n + penalty * np.concatenate([weights[:slots], [0.0, 0.0]])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        weights = weights - rate * (first / (1 - 0.9 ** epoch)) / (np.sqrt(second / (1 - 0.999 ** epoch)) + 1e-8)
    return weights


def score_rows(shared, slots: int, threshold: float):
    """Scores of whole batches: sentences by the sums of their words, documents by bincounts over their sentences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        leak = 1.0 / (1.0 + np.exp(-weights[-1]))
        for batch in pieces(batches, "text", PIECE):
            docs = batch.num_rows
            found = read_sentences(batch.column("text"), slots)
            count, ends = found.count, np.cumsum(found.count)
            p = 1.0 / (1.0 + np.exp(-np.clip(sentence_logits(weights, found), -40, 40)))
            owner = np.repeat(np.arange(docs), count)
            position = np.arange(len(p)) - np.repeat(ends - count, count)
            log_q = np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-15)), minlength=docs)
            score = -np.expm1(np.log1p(-leak) + log_q)
            order = np.lexsort((position, -p, owner))
            worst = order[(ends - count)[count > 0]]  # the first of the largest
            none = count == 0
            worst_position, worst_p = np.zeros(docs, dtype=np.int64), np.zeros(docs)
            worst_position[~none], worst_p[~none] = position[worst], p[worst]
            flagged = p >= threshold
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count), pa.array(score), pa.array(worst_position, mask=none), pa.array(worst_p, mask=none),
                 list_column(position[flagged], np.bincount(owner[flagged], minlength=docs))],
                names=["doc_id", "n_sentences", "score", "worst_sentence", "worst_probability", "flagged"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, slots: int = SLOTS, epochs: int = EPOCHS, rate: float = RATE, penalty: float = PENALTY,
             threshold: float = THRESHOLD, max_docs: int = MAX_TRAIN_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_sentences, score, predicted, worst_sentence, worst_probability, flagged.

    score is P in [0, 1]; a text without words (null, empty, blanks) scores the leak p_0. predicted is 1 when
    score >= ``threshold``. Sentences end at runs of . ! ? before white space or the end, and at line breaks; words
    are runs of letters, digits and ``_``, lower-cased. worst_sentence numbers the sentence of largest p_s (from 0, sentences with words only;
    null when there is none), flagged lists those with p_s >= threshold. Only the text is an input of a score; labels
    of held-out rows (crc32(doc_id) mod 4 = 2) are never read. Repeated and null ids are scored as rows of their own;
    other columns are ignored, whatever their names. An empty table gives no rows (and the fit starts from the prior).
    """
    weights = fit(docs, labels, slots, epochs, rate, penalty, max_docs)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score_rows(shared, slots, threshold), SCORED)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == HELD_OUT
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "n_sentences", "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "worst_sentence", "worst_probability", "flagged")
