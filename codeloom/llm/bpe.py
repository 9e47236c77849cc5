"""Byte-pair encoding and decoding by a table of distinct words.

Texts are split into words in Spark tasks and counted; each word of the table is encoded once, and its ids are joined back by
the word's position. Decoding joins ids to their pieces. Nothing is trained: the tokenizer file's path is a parameter.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm.words import byte_view, pieces, text_bytes
from codeloom.session import stage

MAX_WORDS = 1 << 17
EXTRA_WORDS = 1 << 17
ENCODE_BYTES = 1 << 20
# Unicode white space (fixed values)
SPACES = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# a word of a byte-level vocabulary takes one space before it; of other white space the last character stands alone
BYTE_LEVEL_WORDS = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]")
PLAIN_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def with_field(rows: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*rows.schema, T.StructField(name, kind)])


def open_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


# How the known kinds of tokenizer files cut a text, and the same rules for ASCII and Latin-1 letters only.
CUTS = {
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+": (True, r"'s|'t|'re|'ve|'m|'ll|'d|[L]+|[0-9]|[^SL0-9]+"),
    "byte level": (False, r"'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[0-9]+| ?[^SL0-9]+|[S]+(?![^S])|[S]+"),
}
LATIN = "a-zA-ZÀ-ÖØ-öø-ÿ"
SIMPLE = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")


def simple_cut(tokenizer) -> tuple[bool, re.Pattern] | None:
    """For a tokenizer of a known kind: whether it lower-cases, and the pattern of its pieces in simple words."""
    rules = json.loads(tokenizer.to_str())
    before, norm = rules["pre_tokenizer"] or {}, rules["normalizer"] or {}
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not norm:
        kind = CUTS["byte level"]
    elif before.get("type") == "Sequence" and [x["type"] for x in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
        kind = CUTS.get(before["pretokenizers"][0].get("pattern", {}).get("Regex"))
    else:
        kind = None
    return kind and (kind[0], re.compile(kind[1].replace("L", LATIN).replace("S", r"\t-\r ")))


class WordIds:
    """Ids of words. Words outside the table it starts with are encoded when first met and forgotten beyond ``limit``.

    Simple words (ASCII and Latin-1 letters) of tokenizers of a known kind are given to the tokenizer's model piece by piece; all
    others go through the whole tokenizer. Both give the same ids.
    """

    def __init__(self, path: str, words: list[str], flat: np.ndarray, sizes: np.ndarray, limit: int = EXTRA_WORDS):
        self.tokenizer, self.limit = open_tokenizer(path), limit
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut, self.model = simple_cut(self.tokenizer), self.tokenizer.model
        # a word of ASCII letters alone is one piece of either kind's pattern, unless a special token may lie in it
        self.letters = not any(s.isalpha() for s in self.special)
        char = {b: c for c, b in byte_of_char().items()}
        self.table = {i: "".join(char[b] for b in chr(i).encode()) for i in range(256)}
        self.base = (words, flat, sizes)
        self.reset()

    def reset(self) -> None:
        words, flat, sizes = self.base
        self.slot = {w: i for i, w in enumerate(words)}
        self.flat, self.size = flat, sizes.astype(np.int64)
        self.start = np.cumsum(self.size) - self.size

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found: list[list[int] | None] = [None] * len(words)
        if self.cut:
            lower, pattern = self.cut
            special = re.compile("|".join(map(re.escape, self.special)) or "(?!)").search
            tokenize, letters = self.model.tokenize, self.letters
            for i, word in enumerate(words):
                if letters and word.isascii() and word.isalpha():
                    found[i] = [t.id for t in tokenize(word.lower() if lower else word)]
                elif SIMPLE.fullmatch(word) and not special(word):
                    found[i] = [t.id for piece in pattern.findall(word.lower() if lower else word)
                                for t in tokenize(piece if piece.isascii() and piece.isalnum() else piece.translate(self.table))]
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            found[i] = e.ids
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        return np.fromiter((i for x in found for i in x), dtype=np.int32, count=int(sizes.sum())), sizes

    def look(self, words: list[str]) -> np.ndarray:
        slots = np.fromiter(map(self.slot.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            if len(self.slot) > len(self.base[0]) + self.limit:
                self.reset()
                return self.look(words)
            fresh = list(dict.fromkeys(words[i] for i in missing))
            flat, sizes = self.encode(fresh)
            self.slot.update((w, len(self.size) + i) for i, w in enumerate(fresh))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(sizes) - sizes])
            self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, sizes])
            slots[missing] = [self.slot[words[i]] for i in missing]
        return slots

    def ids(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and where each text starts (one place more than texts)."""
        slots = self.look(list(chain.from_iterable(texts)))
        size = self.size[slots]
        after = np.cumsum(size)
        total = int(after[-1]) if len(after) else 0
        flat = self.flat[np.repeat(self.start[slots] - (after - size), size) + np.arange(total)]
        words_before = np.cumsum([0, *map(len, texts)])
        return flat, np.concatenate([[0], after])[words_before]


KEPT: dict = {}


def kept_ids(key: object, path: str, words: list[str], flat: np.ndarray, sizes: np.ndarray, limit: int = EXTRA_WORDS) -> WordIds:
    """The words that this worker process knows from earlier tasks of the same query."""
    if KEPT.get("key") != (key, path):
        KEPT.update(key=(key, path), ids=WordIds(path, words, flat, sizes, limit))
    return KEPT["ids"]


@dataclass(frozen=True)
class Cut:
    """How a tokenizer's texts are cut into words that encode alone as they do in the text."""
    byte_level: bool           # whether spaces belong to the vocabulary
    special: tuple[str, ...]
    lower: bool = False
    simple: re.Pattern | None = None

    def words(self, text: str) -> list[str]:
        """Texts of ASCII and Latin-1 letters are cut as the tokenizer cuts them; others at white space. Spaces next to a
        special token depend on it, so with a byte-level vocabulary a text that holds one is a single word."""
        plain = not any(s in text for s in self.special)
        if self.simple and plain and (text.isascii() or SIMPLE.fullmatch(text)):
            return self.simple.findall(text.lower() if self.lower else text)
        if self.byte_level:
            return BYTE_LEVEL_WORDS.findall(text) if plain else [text]
        return PLAIN_WORDS.findall(text)


def describe(path: str) -> Cut:
    tokenizer = open_tokenizer(path)
    special = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
    return Cut(bool(tokenizer.encode(" ", add_special_tokens=False).ids), special, *(simple_cut(tokenizer) or ()))


def count_words(cut: Cut):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "body", 4 * ENCODE_BYTES):
            counts: Counter[str] = Counter()
            for body in batch.column("body").to_pylist():
                text = body.decode("utf-8", "replace")
                words = cut.words(text)
                if len(words) != 1 or words[0] is not text or len(text) < 64:
                    counts.update(words)
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
    return run


def encode_words(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordIds(path, [], np.zeros(0, np.int32), np.zeros(0, np.int64))
        for batch in batches:
            flat, sizes = encoder.encode(batch.column("word").to_pylist())
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("word"), ids], ["word", "ids"])
    return run


def word_table(docs: DataFrame, path: str, max_words: int = MAX_WORDS) -> DataFrame:
    """The distinct words (word, ids), each encoded once.

    Counts cover all texts. The table holds the words with at least 2**j occurrences, j being the smallest number from 1
    that keeps it within ``max_words``, so its size has a bound. The other words are rare and are encoded where they stand.
    """
    counts = (docs.select(text_bytes().alias("body")).mapInArrow(count_words(describe(path)), "word string, n long")
              .groupBy("word").agg(F.sum("n").alias("n")).filter("n >= 2"))
    counts = stage(counts, "word-counts")
    above = counts.agg(*[F.count_if(F.col("n") >= 2 ** j).alias(str(j)) for j in range(1, 48)]).first()
    cut = next((2 ** j for j in range(1, 48) if above[str(j)] <= max_words), 2 ** 48)
    return stage(counts.filter(F.col("n") >= cut).select("word").mapInArrow(encode_words(path), "word string, ids array<int>"), "word-ids")


def encode_texts(path: str, shared, cut: Cut):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept_ids(key, path, *shared.value)
        for batch in pieces(batches, "body", ENCODE_BYTES):
            flat, places = known.ids([cut.words(body.decode("utf-8", "replace")) for body in batch.column("body").to_pylist()])
            ids = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])
    return run


def encoded(docs: DataFrame, path: str, max_words: int = MAX_WORDS) -> DataFrame:
    """Columns doc_id and ids (array<int>), one row for each input row, as the tokenizer encodes the whole text.

    Null text counts as empty and has no ids; null and repeated ids are kept as they are; other columns are ignored. The
    word table is sent to the tasks; its bound is ``max_words`` words.
    """
    table = word_table(docs, path, max_words).toArrow().combine_chunks()
    words, ids = table.column("word").to_pylist(), table.column("ids").combine_chunks()
    sizes = np.asarray(ids.value_lengths()) if len(ids) else np.zeros(0, np.int64)
    flat = np.asarray(ids.flatten(), dtype=np.int32) if len(ids) else np.zeros(0, np.int32)
    shared = docs.sparkSession.sparkContext.broadcast((words, flat, sizes))
    rows = docs.select("doc_id", text_bytes().alias("body"))
    return rows.mapInArrow(encode_texts(path, shared, describe(path)), with_field(rows.select("doc_id"), "ids", T.ArrayType(T.IntegerType())))


def byte_of_char() -> dict[str, int]:
    """The byte that each printable character of a byte-level vocabulary stands for: printable Latin-1 characters stand for
    themselves, the other bytes in rising order for the characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def piece_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every id's piece in id order, and where each starts; ids without a piece have none."""
    tokenizer, byte = open_tokenizer(path), byte_of_char()
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    bodies = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        bodies[i] = bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
    return np.frombuffer(b"".join(bodies), dtype=np.uint8), np.cumsum([0, *map(len, bodies)])


def decode_ids(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body, start = shared.value
        size = np.diff(start)
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                column = batch.column("ids")
                flat = np.asarray(column.flatten(), dtype=np.int64)
                flat = np.where((flat >= 0) & (flat < len(size)), flat, -1)
                long = np.where(flat < 0, 0, size[flat])
                after = np.cumsum(long)
                total = int(after[-1]) if len(after) else 0
                out = body[np.repeat(start[flat] - (after - long), long) + np.arange(total)].tobytes()
                counts = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
                places = np.concatenate([[0], after])[np.concatenate([[0], np.cumsum(counts)])]
                texts = [out[a:b].decode("utf-8", "replace") for a, b in zip(places[:-1], places[1:])]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])
    return run


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """Add the text of each row's ``ids`` (byte-level vocabularies): pieces are joined by id and their bytes put together.

    Bytes that are no UTF-8 become replacement characters; ids without a piece are skipped; null ids give an empty text.
    """
    shared = rows.sparkSession.sparkContext.broadcast(piece_table(path))  # the vocabulary's pieces
    return rows.mapInArrow(decode_ids(shared), with_field(rows, "decoded", T.StringType()))
