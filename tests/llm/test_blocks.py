"""Blocks of integers, and the bigrams that travel in them."""

import collections

import numpy as np
import pyarrow as pa

from codeloom.llm.blocks import blocks, by_bucket, unpack
from codeloom.llm.lm_score import Space, Words, count_pairs, merge_pairs, token_batches


class Shared:
    def __init__(self, value):
        self.value = value


def test_blocks_give_back_their_columns():
    draw = np.random.default_rng(1)
    keys = np.sort(draw.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2))
    buckets, values = (keys >> np.uint64(61)).astype(np.int32), draw.normal(size=500)
    found = list(by_bucket(iter([blocks(buckets, [keys, values])])))
    assert [rows[0]["bucket"] for rows in found] == sorted(set(buckets.tolist()))
    table = np.concatenate([unpack(r["width"], r["size"], r["body"]) for rows in found for r in rows], axis=1)
    assert np.array_equal(table[0], keys) and np.array_equal(table[1].view(np.float64), values)
    assert not blocks(buckets[:0], [keys[:0]]).num_rows


def test_keys_of_two_states_are_a_bijection():
    space = Space.of(5, 10)
    pairs = np.array([a << 32 | b for a in range(6) for b in range(1, 6)])
    keys = space.keys(pairs)
    assert len(set(keys.tolist())) == len(pairs) and np.array_equal(space.pairs(keys), pairs)
    assert space.buckets(np.sort(keys)).max() < 1 << space.places


def test_bigrams_leave_a_task_as_blocks_and_are_counted_whole():
    draw = np.random.default_rng(2)
    texts = [" ".join(f"w{i}" for i in draw.integers(0, 40, 300)).encode() for _ in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["body"])
    _, tokens, first = next(token_batches(iter([batch]), 1 << 24))
    hashes = np.unique(tokens)
    kept = hashes[::2]
    everywhere = np.full(1 << 21, np.uint64((1 << 64) - 1))  # a bit for every word
    space = Space.of(len(kept), len(tokens))
    out = list(count_pairs(Shared((Words(kept), everywhere)), space)(iter([batch, batch])))
    assert sum(b.num_rows for b in out) < 0.5 * len(set(zip(tokens[:-1], tokens[1:])))
    rows = sorted((r for b in out for r in b.to_pylist()), key=lambda r: r["bucket"])
    merged = [r for b in merge_pairs(space)(iter([pa.RecordBatch.from_pylist(rows, schema=out[0].schema)])) for r in b.to_pylist()]
    name = {i + 1: h for i, h in enumerate(kept.tolist())} | {0: 0}
    unsigned = lambda x: x & (1 << 64) - 1
    found = {(name[r["key"] >> 32], name[r["key"] & 0xFFFFFFFF]) if r["next"] is None else (unsigned(r["key"]), unsigned(r["next"])): r["n"] for r in merged}
    expected = collections.Counter()
    for a, b in zip(first[:-1], first[1:]):
        words = [0, *tokens[a:b].tolist()]
        expected.update(zip(words[:-1], words[1:]))
    assert found == {k: 2 * n for k, n in expected.items()}
