"""The pipeline's stages over the small tables: what each keeps, against the operators' results and plain Python."""

import collections

import corpus_pipeline
from codeloom.llm.mixing import mixed
from codeloom.llm.quality import judged
from codeloom.session import stage
from tokenizers import Tokenizer

import public_tokenizers

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, []
    verdicts = {r.doc_id: r.kept for r in judged(docs).collect()}
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = stage(apply(spark, docs, FOLDER))
        assert docs.columns == columns
        kept.append(docs.collect())
    good, exact, near, mix = kept
    assert {r.doc_id for r in good} == {i for i, k in verdicts.items() if k}
    bodies = lambda rows: collections.Counter("".join((r.text or "").split(" ")).replace("\n", "") for r in rows)
    assert bodies(exact).keys() == bodies(good).keys() and max(bodies(exact).values()) == 1
    sets = {r.doc_id: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} for r in exact if (w := r.text.encode().lower().split())}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * (n := len(sets[a] & sets[b])) >= 80 * (len(sets[a]) + len(sets[b]) - n) and n}
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert {r.doc_id for r in near} == {i for i in root if root[i] == i}
    copies = collections.Counter(r.doc_id for r in mix)
    assert copies and max(copies.values()) <= 2 and copies.keys() <= {r.doc_id for r in near}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r.doc_id: r.text for r in near}
    assert collections.Counter(r.doc_id for r in last) == copies
    assert all(list(r.ids) == tokenizer.encode(text[r.doc_id], add_special_tokens=False).ids and r.decoded == text[r.doc_id] for r in last)


def test_exact_dedup_of_null_and_repeated_ids(spark):
    rows = [(None, "alone", 1), (5, "twice", 2), (5, "twice", 2), (None, "a b", 3), (9, "ab ", 4), (8, "ab ", 5), (5, "other", 6), (None, None, 7), (None, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(4)
    found = corpus_pipeline.exact_dedup(spark, docs, FOLDER)
    assert found.columns == docs.columns
    kept = sorted(((r.doc_id or 0, (r.text or "").strip()) for r in found.collect()))
    assert kept == [(0, ""), (0, "alone"), (5, "other"), (5, "twice"), (8, "ab")]


def mixed_words(spark, docs):
    found = collections.Counter()
    for r in corpus_pipeline.mix_sources(spark, docs, FOLDER).collect():
        found[r.source] += len((r.text or "").split())
    return found


def test_mixed_words_follow_the_targets(spark):
    sizes = {"a": 3000, "b": 9000, "c": 60000}  # the last source is cut to a fraction that rounds to nothing in every document
    docs = spark.createDataFrame([(k * 1000 + i, " ".join(f"{s}{i}x{j}" for j in range(300)), s)
                                  for k, (s, n) in enumerate(sizes.items()) for i in range(n // 300)], "doc_id long, text string, source string")
    target = {r.source: r.target for r in mixed(docs).select("source", "target").distinct().collect()}
    found = mixed_words(spark, docs)
    assert all(abs(found[s] - target[s]) <= 320 for s in sizes), (found, target)


def test_rows_without_ids_are_mixed_one_by_one(spark):
    docs = spark.createDataFrame([(None if i % 2 else 7, " ".join(f"w{i}x{j}" for j in range(5 + i)), "ab"[i % 4 // 2]) for i in range(200)],
                                 "doc_id long, text string, source string")
    found = corpus_pipeline.mix_sources(spark, docs, FOLDER).collect()
    copies = collections.Counter(r.text for r in found)
    target = {r.source: r.target for r in mixed(docs).select("source", "target").distinct().collect()}
    words = mixed_words(spark, docs.repartition(3))
    assert max(copies.values()) <= 2 and len({r.text for r in found if r.doc_id is None}) > 20
    assert copies == collections.Counter(r.text for r in corpus_pipeline.mix_sources(spark, docs.repartition(3), FOLDER).collect())
    assert all(abs(words[s] - target[s]) <= 220 for s in target), (words, target)
