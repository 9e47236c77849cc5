"""Every operator against a brute-force version on small documents with copies, near copies, odd texts and odd columns."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from codeloom.llm import license_scan
from codeloom.llm.bpe import decoded, encoded
from codeloom.llm.components import components
from codeloom.llm.content_sort import exact_groups
from codeloom.llm.line_runs import repeated_runs
from codeloom.llm.lm_score import scores
from codeloom.llm.mixing import mixed
from codeloom.llm.ngram_join import near_duplicates
from codeloom.llm.quality import judged
from codeloom.llm.substring import repeated_spans
from codeloom.llm.token_files import token_digests

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, key string, body string, part int"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def texts():
    draw = random.Random(3)
    vocabulary = ["".join(draw.choice("abcdeéß'.,X1") for _ in range(draw.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    base, passage = prose(150), prose(60)
    found = [base, base, base.replace(" ", "\n\n", 3), None, "", " \t\n", "one", "One two", "a b c d e", prose(9),
             "a  <|endoftext|>b\n\n c", "<|startoftext|> É ΣΑΣ \x1c z", "　   a\x85b   ", "x" * 3000, "it's\n\n we'll  \t z  ",
             "\n".join(["Licensed under the Apache License, Version 2.0.", prose(12)]), "the end " * 200, prose(3000)]
    for i in range(60):  # near copies on both sides of the threshold
        words = base.split()
        for at in draw.sample(range(len(words)), i % 8):
            words[at] = f"new{draw.random()}"
        found.append(" ".join(words))
    for _ in range(40):
        lines = [prose(draw.randint(1, 30)) for _ in range(draw.randint(1, 6))]
        if draw.random() < 0.6:
            lines.insert(draw.randint(0, len(lines)), passage)
        if draw.random() < 0.3:
            lines += lines[:2]
        found.append("\n".join(lines))
    return found


@pytest.fixture(scope="module")
def rows():
    return [(7 * i % 1009 + 1, t, [None, "en", "de"][i % 3], [None, "a", "b", "c", "a"][i % 5]) for i, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 0, 1, "k", "b", 2) for r in rows], SCHEMA).repartition(5, "doc_id")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    found = df.collect()
    assert len({r.doc_id for r in found}) == len(found)
    return {r.doc_id: r for r in found}


def folded(text):
    return (text or "").encode().lower().split()


def test_components(spark, none):
    edges = [(1, 2), (2, 1), (3, 3), (9, 8), (8, 7), (7, 1), (20, 30), *((100, i) for i in range(101, 140)), *((i, i + 1) for i in range(200, 260))]
    found = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {found[i] for i in (1, 2, 7, 8, 9)} == {1} and found[30] == 20
    assert {found[i] for i in range(100, 140)} == {100} and {found[i] for i in range(200, 261)} == {200}


def test_exact_groups(docs, rows, none):
    groups = collections.defaultdict(list)
    strip = str.maketrans("", "", " \t\n\x0b\x0c\r")
    for i, text, *_ in rows:
        groups[(text or "").translate(strip)].append((-len(text or ""), i))
    found = by_id(exact_groups(docs))
    for body, members in groups.items():
        for _, i in members:
            r, keep = found[i], min(members)[1]
            assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (keep, len(members), i == keep, hashlib.sha256(body.encode()).hexdigest())
    assert exact_groups(none).count() == 0


def test_one_group_over_many_partitions(spark):
    same = spark.range(400).selectExpr("id as doc_id", "concat('one  text', repeat(' ', cast(id % 3 as int))) as text")
    found = exact_groups(same).collect()
    assert {(r.keep_id, r.group_size) for r in found} == {(2, 400)} and len(found) == 400


def brute_components(rows):
    sets = {}
    for i, text, *_ in rows:
        w = folded(text)
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("tile", [512, 16])
def test_near_duplicates(docs, rows, none, tile):
    found = {i: (r.n_shingles, r.component_id) for i, r in by_id(near_duplicates(docs, tile_rows=tile)).items()}
    expected = brute_components(rows)
    assert found == expected and len({c for _, c in expected.values()}) < len(expected) - 20
    assert near_duplicates(none).count() == 0


def test_scores(docs, rows, none):
    found = by_id(scores(docs))
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in rows}
    tokens = {i: [*folded(t), 0] for i, t, *_ in rows}
    count, pairs = collections.Counter(), collections.Counter()
    for i, w in tokens.items():
        if not held[i]:
            count.update(w)
            pairs.update(zip([None, *w], w))
    whole, scale = sum(count.values()), sum(count.values()) + 0.5 * (len(count) + 1)
    seen = lambda h: count[0] if h is None else count[h]
    left = collections.defaultdict(lambda: 1.0)
    for (h, _), n in pairs.items():
        left[h] -= (n - 0.75) / seen(h) if n > 1 else 0
    for i, w in tokens.items():
        uni = [(count[x] + 0.5) / scale for x in w]
        model = [u * left[h] + ((pairs[h, x] - 0.75) / seen(h) if pairs[h, x] > 1 else 0) for h, x, u in zip([None, *w], w, uni)]
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(count[x] > 0 for x in w), whole)
        assert np.isclose(r.base_score, np.log10(uni).sum()) and np.isclose(r.score, np.log10(model).sum())
    few = by_id(scores(docs, max_words=5, max_arcs=3))  # words outside the tables are scored by the join
    assert all(np.isclose(few[i].base_score, found[i].base_score) and few[i].n_known == found[i].n_known for i in found)
    assert scores(none).count() == 0


def test_quality_rules(docs, rows, none):
    found = by_id(judged(docs))
    for i, text, *_ in rows:
        words = (text or "").encode().split()
        windows = collections.Counter(tuple(words[j:j + 5]) for j in range(len(words) - 4))
        covered = {j + k for j in range(len(words) - 4) if windows[tuple(words[j:j + 5])] > 1 for k in range(5)}
        lines = [x for x in (text or "").split("\n") if x.encode().split()]
        r, failed = found[i], len(words) < 10 or 100 * len(covered) > 20 * len(words)
        assert (r.n_words, r.n_repeat_words, r.n_dup_lines, r.base_failed) == (len(words), len(covered), len(lines) - len(set(lines)), failed)
        assert r.word_chars == sum(len(w.decode()) for w in words) and not (failed and r.kept)
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
    assert judged(none).count() == 0


def test_line_runs(docs, rows, none):
    lines = {i: [x for x in (t or "").split("\n") if x.encode().split()] for i, t, *_ in rows}
    for size in (2, 3):
        seen, found = set(), by_id(repeated_runs(docs, size))
        for i in sorted(lines):
            own, gone = lines[i], set()
            for j in range(len(own) - size + 1):
                key = tuple(own[j:j + size])
                gone |= set(range(j, j + size)) if key in seen else set()
                seen.add(key)
            assert (found[i].n_lines, found[i].n_deleted) == (len(own), len(gone))
            assert found[i].kept == [x for j, x in enumerate(own) if j not in gone]
    assert repeated_runs(none).count() == 0


def test_licences(spark, docs, none):
    model = license_scan.fit(docs)
    held, labels = license_scan.variants(99)  # another seed than the one that the model is fitted on
    predicted = {i: f for i, f, _, _ in model.predict(held)}
    assert np.mean([predicted.get(i, 0) == label for i, label in enumerate(labels)]) > 0.9
    found = by_id(license_scan.licences(docs, model))
    flagged = [f for r in found.values() for f in r.found if f.confirmed]
    assert [f.family for f in flagged] == ["Apache-2.0"]
    assert license_scan.licences(none, model).count() == 0


def test_mixing(docs, rows, none):
    found = by_id(mixed(docs, block_words=4, shard_words=500))
    size = {i: len((t or "").encode().split()) for i, t, *_ in rows}
    whole, taken = collections.Counter(), collections.Counter()
    for i, _, _, source in rows:
        r = found[i]
        assert r.size == size[i] and 0 <= r.taken <= 2 * r.size
        whole[source] += size[i]
        taken[source] += r.taken
    order = sorted(whole, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, budget = {}, set(order), 1.5 * sum(whole.values())
    while free:
        share = {s: (budget - sum(target.values())) * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] >= 2 * whole[s]} or None
        target.update({s: 2.0 * whole[s] for s in above} if above else share)
        free -= above or free
    for i, _, _, source in rows:
        assert np.isclose(found[i].target, target[source]) and found[i].source_size == whole[source]
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] + 16 for s in order)
    assert {(r.doc_id, r.taken) for r in mixed(docs.repartition(3), block_words=4, shard_words=500).collect()} == {(i, r.taken) for i, r in found.items()}
    assert mixed(none).count() == 0


def test_repeated_spans(docs, rows, none):
    found, seen = by_id(repeated_spans(docs)), set()
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for j in range(len(words) - 19):
            key = tuple(words[j:j + 20])
            if key in seen:
                gone[j:j + 20] = [True] * 20
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        r = found[i]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    assert repeated_spans(none).count() == 0


def test_token_files(docs, rows, none, tmp_path):
    found, start = by_id(token_digests(docs, WORDS, folder=str(tmp_path))), 0
    tokenizer = Tokenizer.from_file(WORDS)
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        r = found[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_digests(none, WORDS, folder=str(tmp_path)).count() == 0


@pytest.mark.parametrize("words", [0, 20, 1 << 17])
def test_encoding_and_decoding(docs, rows, none, words):
    found, tokenizer = by_id(decoded(encoded(docs, BYTES, words), BYTES)), Tokenizer.from_file(BYTES)
    for i, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert list(found[i].ids) == ids and found[i].decoded == tokenizer.decode(ids, skip_special_tokens=False) == (text or "")
    assert decoded(encoded(none, BYTES), BYTES).count() == 0


def test_null_and_repeated_ids(spark):
    words = [f"w{i}" for i in range(40)]
    whole, half = " ".join(words), " ".join(words[:25])
    rows = [(None, whole), (5, whole), (5, half), (5, whole), (7, "x " + whole), (None, None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' as lang", "'a' as source").repartition(3)
    spans = sorted(((r.doc_id or 0, r.n_words, r.n_removed) for r in repeated_spans(odd).collect()))
    assert spans == [(0, 0, 0), (0, 40, 0), (5, 25, 0), (5, 40, 0), (5, 40, 0), (7, 41, 40)]
    near = sorted((r.doc_id or 0, r.component_id or 0, r.n_shingles) for r in near_duplicates(odd).collect())
    assert len(near) == len(rows) and near[0] == (0, 0, 0)
    for found in (token_digests(odd, WORDS, end_id=2), scores(odd), judged(odd), repeated_runs(odd), mixed(odd), exact_groups(odd),
                  license_scan.licences(odd), decoded(encoded(odd, BYTES), BYTES)):
        ids = [r.doc_id for r in found.collect()]
        assert sorted(i or 0 for i in ids) == [0, 0, 5, 5, 5, 7]


def test_sample_of_lines_is_bounded(spark):
    many = spark.range(20000).selectExpr("id as doc_id", "concat('line ', id, '\\n', 'second') as text")
    lines = license_scan.sampled_lines(many, 50, 1)
    assert len(lines) == 50 and lines == license_scan.sampled_lines(many.repartition(7), 50, 1)
    assert len(license_scan.sampled_lines(many.limit(10), 50, 2)) == 20


@pytest.mark.parametrize("bounds", [(5, 3), (0, 0), (40, 1 << 20), (1 << 20, 3)])
def test_scores_do_not_depend_on_what_is_sent(docs, bounds):
    whole, few = by_id(scores(docs)), by_id(scores(docs, *bounds))
    for i, r in whole.items():
        assert few[i].n_known == r.n_known and np.isclose(few[i].base_score, r.base_score) and np.isclose(few[i].score, r.score)


def test_length_of_sampled_lines_is_a_parameter(spark):
    long = spark.createDataFrame([(1, "x" * 5000)], "doc_id long, text string")
    assert [len(x) for x in license_scan.sampled_lines(long, 5, 1, 6000)] == [5000] and [len(x) for x in license_scan.sampled_lines(long, 5, 1)] == [2000]
