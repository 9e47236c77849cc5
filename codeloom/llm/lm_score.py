"""Language-model scores of texts by a weighted backoff automaton.

The model is a word bigram model with absolute discounting, interpolated with the smoothed unigram:
``P(w|h) = (c(hw) - D) / c(h) + left(h) * P(w)`` for kept bigrams, and ``left(h) * P(w)`` for all others, where ``left(h)`` is what
the kept bigrams leave, so each state's probabilities sum to one. As an automaton: a state for the text's start and for each
kept word, an arc for each kept bigram, and a failure arc with weight ``left(h)`` to the root, whose arcs are the unigrams.

Counts cover all training texts. Words and bigrams are counted by Spark; what is sent to the tasks has a bound: the words and
the arcs with at least as many occurrences as keeps them within it. This is only a short cut: other words take their unigram and
failure weight, and other bigrams their arc, from a join with the full tables, so scores do not depend on the bounds. A bit table of
the arcs that are not sent lets the tasks leave out most bigrams that have no arc at all; a false hit costs a few bytes and no more.

Bigrams travel in compressed blocks (``blocks.py``): as rows of their own they were most of the job's disk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from codeloom.llm.blocks import COLUMNS, SCHEMA, blocks, by_bucket, dealt, unpack
from codeloom.llm.words import byte_view, factors, mix, pieces, signed, text_bytes, word_hashes, word_places
from codeloom.session import stage

MAX_WORDS = 1 << 20
MAX_ARCS = 1 << 20
ARC_TOKENS = 11  # an arc is sent for each 2**11 training tokens, up to the bound, so that the share of steps that are joined hardly grows
LEAST_ARCS = 1 << 10
DISCOUNT = 0.75
END = 0  # the hash that stands for the end of a text
START = 0  # the state of a text's start, and its hash where a word comes before; words take states from 1
SIEVE_BITS = 27  # 16 MB
BUCKET_TOKENS = 19  # a bucket of bigrams for each 2**19 training tokens,
LEAST_BUCKETS = 6   # 2**6 at least
STEP_ROWS = 1 << 20  # steps that a task collects before it packs or adds them up
ROW_CHUNK = 12  # 2**12 texts that follow each other are added up in the same bucket
SPREAD = 0xD6E8FEB86659FD93
GATHER = pow(SPREAD, -1, 1 << 64)
FIRST, SECOND = factors(2000, 2002)
STEPS = sorted({2 ** j for j in range(1, 48)} | {3 * 2 ** j for j in range(47)})


def token_batches(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Token hashes of a batch (words, then one end for each text), and where each text starts."""
    for batch in pieces(batches, "body", limit):
        data, rows = byte_view(batch.column("body"))
        starts, ends, first = word_places(data, rows)
        words = word_hashes(data, starts, ends, fold=True)
        yield batch, np.insert(words, first[1:], np.uint64(END)), first + np.arange(batch.num_rows + 1)


def counted(key: np.ndarray) -> pa.RecordBatch:
    keys, n = np.unique(key, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(signed(keys)), pa.array(n)], ["key", "n"])


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, tokens, _ in token_batches(batches, 16 * 1024 * 1024):
        yield counted(tokens)


@dataclass
class Words:
    """Kept words in hash order. A word's state is its place plus one; the end of text has its place like a word."""
    hashes: np.ndarray

    def states(self, tokens: np.ndarray) -> np.ndarray:
        """The state of each token, or -1."""
        if not len(self.hashes):
            return np.full(len(tokens), -1, dtype=np.int64)
        at = np.searchsorted(self.hashes, tokens)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == tokens, at + 1, -1)

    def pairs(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State before each token and state of the token."""
        own = self.states(tokens)
        before = np.append(np.int64(START), own[:-1])
        before[first[:-1]] = START
        return before, own


def hashes_before(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The hash before each token, that of the start before a text's first."""
    before = np.append(np.uint64(START), tokens[:-1])
    before[first[:-1]] = START
    return before


def rare_keys(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Keys of bigrams that hold a word without a state, from the words' hashes: negative, unlike those made of two states."""
    return signed(mix(one * FIRST + two * SECOND) | np.uint64(1 << 63))


@dataclass(frozen=True)
class Space:
    """Bigrams as unsigned keys: those of two states by a bijection that spreads them evenly below 2 ** (2 * bits), those with a
    word that has no state by their hash, from 2 ** 63. A bucket is a range of either kind."""
    bits: int    # of a state
    places: int  # of a bucket's number

    @staticmethod
    def of(words: int, tokens: int) -> "Space":
        bits = max(words.bit_length(), 1)
        return Space(bits, min(2 * bits, max(LEAST_BUCKETS, (tokens >> BUCKET_TOKENS).bit_length())))

    @property
    def mask(self) -> np.uint64:
        return np.uint64((1 << 2 * self.bits) - 1)

    def keys(self, pairs: np.ndarray) -> np.ndarray:
        """From state << 32 | state, or the negative key of a bigram without."""
        plain = ((pairs >> 32) << self.bits | pairs & 0xFFFFFFFF).astype(np.uint64)
        return np.where(pairs < 0, pairs.view(np.uint64), plain * np.uint64(SPREAD) & self.mask)

    def pairs(self, keys: np.ndarray) -> np.ndarray:
        """state << 32 | state, from keys of two states."""
        plain = (keys * np.uint64(GATHER) & self.mask).astype(np.int64)
        return (plain >> self.bits) << 32 | plain & ((1 << self.bits) - 1)

    def buckets(self, keys: np.ndarray) -> np.ndarray:
        hashed = (keys >> np.uint64(63 - self.places)) & np.uint64((1 << self.places) - 1)
        return np.where(keys >> np.uint64(63), hashed, keys >> np.uint64(2 * self.bits - self.places)).astype(np.int32)


def count_pairs(shared, space: Space):
    """Blocks of bigrams of two states (key, count), and those with a word that has no state (key, count, hash, hash). Bigrams with
    a word that occurs once occur once themselves: the bit table of words without a state leaves them out, all of them without one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, again = shared.value
        for _, tokens, first in token_batches(batches, 16 * 1024 * 1024):
            before, own = words.pairs(tokens, first)
            both = (before >= 0) & (own >= 0)
            keys, n = np.unique(space.keys((before[both] << 32) | own[both]), return_counts=True)
            yield blocks(space.buckets(keys), [keys, n])
            if again is not None and not both.all():
                one, two = hashes_before(tokens, first)[~both], tokens[~both]
                chosen = ((before[~both] >= 0) | marked(again, one)) & ((own[~both] >= 0) | marked(again, two))
                one, two = one[chosen], two[chosen]
                keys, at, n = np.unique(space.keys(rare_keys(one, two)), return_index=True, return_counts=True)
                yield blocks(space.buckets(keys), [keys, n, one[at], two[at]])
    return run


def merge_pairs(space: Space):
    """Bigrams that occur twice or more: (key of two states, null), and those with a word that has no state as (hash, hash)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_bucket(batches):
            for width in (2, 4):
                found = [unpack(r["width"], r["size"], r["body"]) for r in rows if r["width"] == width]
                if not found:
                    continue
                table = np.concatenate(found, axis=1)
                table = table[:, np.argsort(table[0], kind="stable")]
                head = np.flatnonzero(np.append(True, table[0, 1:] != table[0, :-1]))
                n = np.add.reduceat(table[1], head).astype(np.int64)
                head, n = head[n > 1], n[n > 1]
                if width == 2:
                    names = pa.array(space.pairs(table[0, head])), pa.nulls(len(head), pa.int64())
                else:
                    names = pa.array(signed(table[2, head])), pa.array(signed(table[3, head]))
                yield pa.RecordBatch.from_arrays([*names, pa.array(n)], ["key", "next", "n"])
    return run


def sieve_places(keys: np.ndarray) -> np.ndarray:
    """The bit of each key in the table of arcs that are not sent."""
    return mix(keys.view(np.uint64)) >> np.uint64(64 - SIEVE_BITS)


def marked(sieve: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = sieve_places(keys)
    return (sieve[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


@dataclass
class Automaton:
    words: Words
    root: np.ndarray       # log10 of the unigram weight by place
    fail: np.ndarray       # log10 of the failure arc's weight by state
    arcs: np.ndarray       # state << 32 | state of the next word, ascending
    weight: np.ndarray     # log10 of the arc's weight
    sieve: np.ndarray | None  # bits of the arcs that are not sent, if there are any

    def traverse(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Log weight of each step, log unigram weight of each token, the kept words, and the key of each step that may have an arc elsewhere.

        Words that are not kept have the weights 0 here, and steps without an arc elsewhere the key 0. Reading a token leads to its word's state, or to the root if the word has none, so a step depends on the state that
        the token before it left: the states of a batch are carried from left to right all at once.
        """
        before, own = self.words.pairs(tokens, first)
        kept = own >= 0
        unigram = np.where(kept, self.root[np.maximum(own, 1) - 1], 0.0) if len(self.root) else np.zeros(len(tokens))
        step = np.where(before >= 0, self.fail[np.maximum(before, 0)], 0.0) + unigram
        both = kept & (before >= 0)
        wanted = np.where(both, (before << 32) | np.maximum(own, 0), -1)
        held_arc = np.zeros(len(tokens), dtype=bool)
        if len(self.arcs):
            at = np.searchsorted(self.arcs, wanted)
            at[at == len(self.arcs)] = 0
            held_arc = self.arcs[at] == wanted
            step = np.where(held_arc, self.weight[at], step)
        elsewhere = np.zeros(len(tokens), dtype=np.int64)
        if self.sieve is not None:
            wanted[~both] = rare_keys(hashes_before(tokens, first)[~both], tokens[~both])
            elsewhere = np.where(marked(self.sieve, wanted) & ~held_arc, wanted, 0)
        return step, unigram, kept, elsewhere


def state_hashes(shared):
    """The words of states in place of the states; the start has the hash 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = signed(np.append(np.uint64(START), shared.value[0].hashes))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(hashes[batch.column("state").to_numpy()]), batch.column("share")], ["key", "share"])
    return run


def arc_blocks(space: Space, value: str):
    """Blocks of (pair, value) rows; the bits of a value that is no integer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = space.keys(batch.column("pair").to_numpy())
            order = np.argsort(keys, kind="stable")
            yield blocks(space.buckets(keys[order]), [keys[order], batch.column(value).to_numpy()[order]])
    return run


def arc_gains(keys: np.ndarray, values: np.ndarray, weights, space: Space, discount: float) -> np.ndarray:
    """An arc's weight over that of the step that fails to the root instead: from the counts of arcs of two states; others bring it along."""
    seen, left, unigram = weights
    gain = values.view(np.float64).copy()
    plain = keys < np.uint64(1 << 63)
    pair = space.pairs(keys[plain])
    state, word = pair >> 32, pair & 0xFFFFFFFF
    gain[plain] = np.log10(1.0 + (values[plain].astype(np.float64) - discount) / seen[state] / (left[state] * unigram[word - 1]))
    return gain


def row_gains(shared, space: Space, discount: float):
    """Blocks of what the arcs add to rows (row, gain), from blocks of arcs (key, count or gain) and of steps (key, row) with ``step`` set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        rows, gains = np.zeros(0, np.int64), np.zeros(0)
        for group in by_bucket(batches):
            arcs = [unpack(r["width"], r["size"], r["body"]) for r in group if not r["step"]]
            if not arcs or len(arcs) == len(group):
                continue
            keys, values = np.concatenate(arcs, axis=1)
            order = np.argsort(keys)
            keys, values = keys[order], values[order]
            gain = arc_gains(keys, values, weights, space, discount)
            for r in group:
                if r["step"]:
                    wanted, row = unpack(r["width"], r["size"], r["body"])
                    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                    hit = keys[at] == wanted
                    rows, gains = np.append(rows, signed(row[hit])), np.append(gains, gain[at[hit]])
                    if len(rows) > STEP_ROWS:
                        rows, gains = added_up(rows, gains)
                        if len(rows) > STEP_ROWS // 2:
                            yield gain_blocks(space, rows, gains)
                            rows, gains = rows[:0], gains[:0]
        yield gain_blocks(space, *added_up(rows, gains))
    return run


def gain_blocks(space: Space, rows: np.ndarray, gains: np.ndarray) -> pa.RecordBatch:
    buckets = (mix((rows >> ROW_CHUNK).view(np.uint64)) >> np.uint64(64 - space.places)).astype(np.int32)
    order = np.lexsort((rows, buckets))
    return blocks(buckets[order], [rows[order], gains[order]])


def row_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each row's gains."""
    for group in by_bucket(batches):
        rows, gains = np.concatenate([unpack(r["width"], r["size"], r["body"]) for r in group], axis=1)
        rows, gains = added_up(rows.view(np.int64), gains.view(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(gains)], ["row", "score"])


def added_up(rows: np.ndarray, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    different, place = np.unique(rows, return_inverse=True)
    return different, np.bincount(place, weights=gains, minlength=len(different))


def rare_arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = rare_keys(batch.column("key").to_numpy().view(np.uint64), batch.column("next").to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("gain")], ["pair", "gain"])


def sieve_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 64-bit words of the bit table that the keys of a task touch."""
    table = np.zeros(1 << SIEVE_BITS - 6, dtype=np.uint64)
    for batch in batches:
        place = sieve_places(batch.column("pair").to_numpy())
        np.bitwise_or.at(table, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    at = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(signed(table[at]))], ["at", "bits"])


def sieve_of(keys: DataFrame) -> np.ndarray:
    """The bit table of a table's keys (pair)."""
    bits = keys.mapInArrow(sieve_words, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most 2^21 rows
    sieve = np.zeros(1 << SIEVE_BITS - 6, dtype=np.uint64)
    sieve[bits.column("at").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return sieve


def per_row(owner: np.ndarray, keys: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Each different key of each text: the text's place, the key and its number of occurrences."""
    order = np.lexsort((keys, owner))
    who, key = owner[order], keys[order]
    head = np.flatnonzero((np.diff(who, prepend=-1) != 0) | np.append(True, key[1:] != key[:-1]))
    return pa.array(who[head]), pa.array(signed(key[head])), pa.array(np.diff(np.append(head, len(key))))


def step_blocks(space: Space, pairs: list[np.ndarray], rows: list[np.ndarray]) -> pa.RecordBatch:
    keys, row = space.keys(np.concatenate(pairs)), np.concatenate(rows)
    order = np.argsort(keys, kind="stable")
    return blocks(space.buckets(keys[order]), [keys[order], row[order]])


def score_rows(shared, space: Space, schema: pa.Schema):
    """A row of sums for each text, rows for its words (key) whose weights the automaton does not hold, and blocks of the steps
    (key of the bigram, row of the text) that may have an arc elsewhere. All other columns are null."""
    def filled(found: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([found.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Automaton = shared.value
        pairs, rows, waiting = [], [], 0
        for batch, tokens, first in token_batches(batches, 2 * 1024 * 1024):
            step, unigram, kept, elsewhere = model.traverse(tokens, first)
            n = batch.num_rows
            owner = np.repeat(np.arange(n), np.diff(first))
            base, score = (np.bincount(owner, weights=x, minlength=n) for x in (unigram, step))
            yield filled({"row": batch.column("row"), "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                          "n_tokens": pa.array(np.diff(first)), "n_known": pa.array(np.bincount(owner[kept], minlength=n)),
                          "base": pa.array(base), "score": pa.array(score)}, n)
            if not kept.all():
                words = per_row(owner[~kept], tokens[~kept])
                yield filled({"row": batch.column("row").take(words[0]), "key": words[1], "times": words[2]}, len(words[0]))
            chosen = elsewhere != 0
            pairs.append(elsewhere[chosen])
            rows.append(batch.column("row").to_numpy()[owner[chosen]])
            waiting += len(rows[-1])
            if waiting >= STEP_ROWS:
                found = step_blocks(space, pairs, rows)
                yield filled({c: found.column(c) for c in COLUMNS}, found.num_rows)
                pairs, rows, waiting = [], [], 0
        if waiting:
            found = step_blocks(space, pairs, rows)
            yield filled({c: found.column(c) for c in COLUMNS}, found.num_rows)
    return run


def sorted_columns(table: DataFrame, key: str, value: str, kind: type = np.int64) -> tuple[np.ndarray, np.ndarray]:
    """Two columns of a bounded table on the driver, by the first."""
    found = table.select(key, value).toArrow()
    keys, values = found.column(key).to_numpy().view(kind), found.column(value).to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order]


def least_count(counts: DataFrame, limit: int) -> int:
    """The smallest of the fixed steps that at most ``limit`` rows reach."""
    reached = counts.agg(*[F.count_if(F.col("n") >= s).alias(str(s)) for s in STEPS]).first()
    return next((s for s in STEPS if reached[str(s)] <= limit), STEPS[-1])


def held(docs: DataFrame, parts: int = 5, part: int = 1) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts == part


def scores(docs: DataFrame, max_words: int = MAX_WORDS, max_arcs: int = MAX_ARCS, discount: float = DISCOUNT) -> DataFrame:
    """Score every whole text with a model of the texts that are not held out (crc32 of the id modulo 5 is not 1).

    Columns doc_id, held_out, n_tokens, n_known (tokens seen in training), train_tokens, base_score (log10 of the smoothed
    unigram) and score (log10 of the model). A null text is its end token only; a null id is hashed as an empty text and kept;
    repeated ids are rows of their own; other columns are ignored. Without training texts all probabilities are uniform.
    ``max_words`` and ``max_arcs`` bound what is sent to the tasks; they do not change the scores.
    """
    context = docs.sparkSession.sparkContext
    texts = docs.select("doc_id", held(docs).alias("held_out"), text_bytes().alias("body"))
    training = texts.filter("not held_out").select("body")
    counts = stage(training.mapInArrow(count_tokens, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "word-counts")
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("distinct"),
                       F.coalesce(F.max(F.when(F.col("key") == END, F.col("n"))), F.lit(0)).alias("texts")).first()
    scale = whole["tokens"] + 0.5 * (whole["distinct"] + 1)

    least = least_count(counts, max_words)
    rare = least > 2  # a bigram that occurs twice has no word that occurs once
    hashes, n = sorted_columns(counts.filter(F.col("n") >= least), "key", "n", np.uint64)  # at most max_words rows
    words = Words(hashes)
    again = sieve_of(counts.filter((F.col("n") > 1) & (F.col("n") < least)).select(F.col("key").alias("pair"))) if rare else None
    shared = context.broadcast((words, again))
    del again
    space = Space.of(len(hashes), whole["tokens"])
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = stage(dealt(training.mapInArrow(count_pairs(shared, space), SCHEMA), tasks)
                  .mapInArrow(merge_pairs(space), "key long, next long, n long"), "pair-counts")
    both, others = pairs.filter("next is null"), pairs.filter("next is not null")

    # what the arcs of a word take, all of them, whether they are sent or not; the start has the hash of the end, which comes before nothing
    share = F.sum(F.col("n") - F.lit(discount)).alias("share")
    taken = both.groupBy(F.shiftright("key", 32).alias("state")).agg(share).mapInArrow(state_hashes(shared), "key long, share double")
    starts = counts.sparkSession.createDataFrame([(START, max(whole["texts"], 1))], counts.schema)
    leaving = counts.filter(F.col("key") != END).unionByName(starts)  # how often a word is left: once for each occurrence
    if rare:
        taken = taken.unionByName(others.groupBy("key").agg(share)).groupBy("key").agg(F.sum("share").alias("share"))
    taken = stage(taken.join(leaving, "key"), "shares")
    shared.destroy()
    key, part = sorted_columns(taken.filter((F.col("n") >= least) | (F.col("key") == START)), "key", "share")  # at most max_words + 1 rows
    seen = np.append(max(whole["texts"], 1), n).astype(float)
    left = np.ones(len(seen))
    state = np.where(key == START, START, words.states(key.view(np.uint64)))
    left[state] -= part / seen[state]
    unigram = (n + 0.5) / scale

    enough = least_count(both, min(max_arcs, max(LEAST_ARCS, whole["tokens"] >> ARC_TOKENS)))
    key, times = sorted_columns(both.filter(F.col("n") >= enough), "key", "n")  # at most max_arcs rows
    state, word = key >> 32, key & 0xFFFFFFFF
    weight = np.log10((times - discount) / seen[state] + left[state] * unigram[word - 1]) if len(key) else np.zeros(0)
    del times, state, word, part, hashes

    spare = both.filter(F.col("n") < enough).select(F.col("key").alias("pair"), "n")
    elsewhere = sieve = None  # blocks of the arcs that are not sent, and their bits
    if rare or not spare.isEmpty():
        weights = context.broadcast((seen, left, unigram))
        elsewhere, unsent = spare.mapInArrow(arc_blocks(space, "n"), SCHEMA), spare.select("pair")
        if rare:
            before = leaving.join(taken.select("key", "share"), "key").select("key", F.col("n").alias("seen"), (1 - F.col("share") / F.col("n")).alias("whole"))
            after = counts.select(F.col("key").alias("next"), ((F.col("n") + 0.5) / F.lit(scale)).alias("unigram"))
            gain = F.log10(1 + (F.col("n") - F.lit(discount)) / F.col("seen") / (F.col("whole") * F.col("unigram")))
            wordy = stage(others.join(before, "key").join(after, "next").select("key", "next", gain.alias("gain"))
                          .mapInArrow(rare_arcs, "pair long, gain double"), "rare-arcs")
            elsewhere = elsewhere.unionByName(wordy.mapInArrow(arc_blocks(space, "gain"), SCHEMA))
            unsent = unsent.unionByName(wordy.select("pair"))
        sieve = sieve_of(unsent)
    model = context.broadcast(Automaton(words, np.log10(unigram), np.log10(left), key, weight, sieve))
    del words, n, seen, left, unigram, key, weight, sieve

    rows = texts.withColumn("row", F.monotonically_increasing_id())
    schema = StructType.fromDDL(("row long, doc_id {}, held_out boolean, n_tokens long, n_known long, base double, score double, key long, times long, "
                                 + SCHEMA).format(docs.schema["doc_id"].dataType.simpleString()))
    scored = stage(rows.mapInArrow(score_rows(model, space, to_arrow_schema(schema)), schema), "scores")
    log = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(scale))
    single = scored.filter("key is not null").select("row", "key", "times").join(counts, "key", "left")
    fail = F.lit(0.0)
    if rare:  # every word but the end comes before a token once for each time that it occurs
        single = single.join(taken.filter(F.col("key") != START).select("key", "share"), "key", "left")
        fail = F.when(F.col("key") == END, 0.0).otherwise(F.coalesce(F.log10(1 - F.col("share") / F.col("n")), F.lit(0.0)))
    added = single.select("row", F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0).alias("known"), (F.col("times") * log).alias("base"),
                          (F.col("times") * (log + fail)).alias("score"))
    if elsewhere is not None:
        steps = scored.filter("bucket is not null").select(*COLUMNS, F.lit(True).alias("step"))
        found = dealt(steps.unionByName(elsewhere.withColumn("step", F.lit(False))), tasks).mapInArrow(
            row_gains(weights, space, discount), SCHEMA)
        found = dealt(found, tasks).mapInArrow(row_sums, "row long, score double")
        added = added.unionByName(found.select("row", F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("base"), "score"))
    added = added.groupBy("row").agg(F.sum("known").alias("more_known"), F.sum("base").alias("more_base"), F.sum("score").alias("more_score"))
    joined = scored.filter("key is null and bucket is null").drop("key", "times", *COLUMNS).join(added, "row", "left")
    return joined.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                         F.lit(whole["tokens"]).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
                         (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))
