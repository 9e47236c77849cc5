"""Features and naive Bayes against plain Python."""

import dataclasses
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from codeloom.models import classifiers, naive_bayes, selection
from codeloom.operators import features, fusion, ranking
from codeloom.config import CodingConfig

DOCS = ["JOBTITLE: nurse icu | NAICS: 5 0", "JOBTITLE: nurse", "cook a b", "cook cook chef", "__EMPTY__"]


def char_grams(doc):
    out = []
    for w in doc.split():
        w = f" {w} "
        for n in (3, 4, 5):
            out += [w[i:i + n] for i in range(len(w) - n + 1)]
    return out


def test_terms(spark):
    import re
    df = spark.createDataFrame([(str(i), d, 1) for i, d in enumerate(DOCS)], "id string, doc string, copies bigint")
    found = {}
    for r in features.term_counts(df, features.CHAR).collect():
        found.setdefault(r["id"], Counter())[r["term"]] = r["tf"]
    assert all(found[str(i)] == Counter(char_grams(d)) for i, d in enumerate(DOCS))
    words = {}
    for r in features.term_counts(df, features.WORD).collect():
        words.setdefault(r["id"], Counter())[r["term"]] = r["tf"]
    for i, d in enumerate(DOCS):
        tokens = re.findall(r"\b\w\w+\b", d)
        assert words[str(i)] == Counter(tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])])


def test_tfidf_is_unit_length_and_salted_join_agrees(spark):
    df = spark.createDataFrame([(str(i), d, 2) for i, d in enumerate(DOCS)], "id string, doc string, copies bigint")
    counts = features.term_counts(df, features.WORD)
    vocabulary = features.build_vocabulary(counts, 10, 1, 0.8, 100)
    one = {(r["id"], r["term"]): r["weight"] for r in features.tfidf(counts, vocabulary, broadcast=True).collect()}
    two = {(r["id"], r["term"]): r["weight"] for r in features.tfidf(counts, vocabulary, broadcast=False).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-12 for k in one)
    norms = Counter()
    for (i, _), w in one.items():
        norms[i] += w * w
    assert all(abs(v - 1) < 1e-9 for v in norms.values())


def test_vectors_and_latent(spark):
    rows = [("a", "x", 1.0), ("a", "y", 2.0), ("b", "y", 3.0), ("c", "x", 1.0), ("c", "z", 1.0)]
    weights = spark.createDataFrame(rows, "id string, term string, weight double")
    slots = features.slot_table(weights)
    vectors = features.indexed_vectors(weights, slots, 3)
    dense = {r["id"]: r["features"].toArray() for r in vectors.collect()}
    matrix = np.array([dense[i] for i in "abc"])
    assert (matrix == [[1, 2, 0], [0, 3, 0], [1, 0, 1]]).all()
    basis = features.latent_basis(vectors, 2)
    latent = {r["id"]: np.array(r["latent"]) for r in features.latent_features(vectors, basis).collect()}
    singular = np.linalg.svd(matrix, compute_uv=False)[:2]
    assert np.allclose(np.sqrt((np.array([latent[i] for i in "abc"]) ** 2).sum(axis=0)), singular)


def test_complement_naive_bayes_equals_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 4, size=(12, 5)).astype(float)
    x[:, 4] = 1
    y = np.array([0, 1, 2] * 4)
    weights = [(i, f"t{j}", float(x[i, j])) for i in range(12) for j in range(5) if x[i, j]]
    table = spark.createDataFrame(weights, "id bigint, term string, weight double")
    labels = spark.createDataFrame([(i, "g", str(y[i]), 1) for i in range(12)], "id bigint, grp string, label string, copies bigint")
    model = naive_bayes.fit(naive_bayes.label_term_sums(table, labels), 5, 0.5)
    counts = np.array([x[y == c].sum(axis=0) for c in range(3)])
    comp = counts.sum(axis=0) + 0.5 - counts
    scores = x @ -np.log(comp / comp.sum(axis=1, keepdims=True)).T
    expected = np.exp(scores - scores.max(axis=1, keepdims=True))
    expected /= expected.sum(axis=1, keepdims=True)
    for broadcast in (True, False):
        for r in model.proba(table, labels.select("id", "grp"), broadcast).collect():
            assert abs(r["prob"] - expected[r["id"], int(r["code"])]) < 1e-9
    best = model.top(table, labels.select("id", "grp"), 1).collect()
    assert all(int(r["code"]) == expected[r["id"]].argmax() for r in best)
    scored = naive_bayes.keyed_scores(table, labels, 2, 1, 5, 0.5).collect()
    assert [r["grp"] for r in scored] == ["g"] and 0 <= scored[0]["macro_f1"] <= 1 and math.isfinite(scored[0]["log_loss"])


def test_fusion_denominator_and_alignment(spark):
    config = CodingConfig()
    model = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.4), (2, "a", 1.0)], "id bigint, code string, prob double")
    votes = spark.createDataFrame([(1, "c", 0.9, 0.9, 0.8), (2, "c", 0.9, 0.9, 0.1), (3, "d", 1.0, 1.0, 1.0)],
                                  "id bigint, code string, prob double, conf double, max_sim double")
    got = {(r["id"], r["code"]): r["prob"] for r in fusion.fuse(model, votes, config, 4).collect()}
    sem = 0.85 * 0.8
    assert abs(got[(1, "a")] - 0.6 / (1 + sem)) < 1e-12 and abs(got[(1, "c")] - sem * 0.9 / (1 + sem)) < 1e-12
    assert got[(2, "a")] == 1.0 and (2, "c") not in got
    assert abs(got[(3, "d")] - 0.85 / 1.85) < 1e-12
    aligned = {r["code"]: r["prob"] for r in fusion.align_classes(spark.createDataFrame([(1, "z", 0.5)], "id int, code string, prob double"), ["a", "b"]).collect()}
    assert aligned == {"a": 0.5, "b": 0.5}


def test_promotion_keeps_positions(spark):
    ranked = spark.createDataFrame([(1, 1, "a", 0.5), (1, 2, "b", 0.3), (1, 3, "c", 0.2), (2, 1, "a", 0.4)], "id int, rank int, code string, prob double")
    choices = spark.createDataFrame([(1, "c")], "id int, chosen string")
    got = {(r["id"], r["rank"]): (r["code"], round(r["prob"], 9)) for r in ranking.promote(ranked, choices, 0.72, 4).collect()}
    assert got == {(1, 1): ("c", 0.72), (1, 2): ("a", 0.225), (1, 3): ("b", 0.15), (2, 1): ("a", 0.4)}


def test_rows_of_unseen_terms_stay_and_ensembles_agree_with_the_long_form(spark):
    table = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0), ("c", "x", 1.0), ("c", "y", 0.5), ("d", "never", 1.0)], "id string, term string, weight double")
    labels = spark.createDataFrame([("a", "all", "1", 2), ("b", "all", "2", 1), ("c", "all", "10", 1)], "id string, grp string, label string, copies bigint")
    model = classifiers.ComplementClassifier(naive_bayes.fit(naive_bayes.label_term_sums(table, labels), 2, 0.5))
    example = classifiers.Example(spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "id string"), table, table, None)
    classes = ["1", "10", "2", "3"]  # a class that the model lacks
    one = selection.FittedEnsemble("s", ["m"], [model], [2.0], classes, [], 4, 2)
    two = selection.FittedEnsemble("s", ["m", "m"], [model, model], [2.0, 1.0], classes, [], 4, 2)
    long = {(r["id"], r["code"]): r["prob"] for r in fusion.ensemble_average([(fusion.align_classes(model.proba(example), classes), 1.0)]).collect()}
    for ensemble in (one, two):
        found = {(r["id"], r["code"]): r["prob"] for r in ensemble.proba(example).collect()}
        assert found.keys() == long.keys() and all(abs(found[k] - long[k]) < 1e-12 for k in long)
    assert all(abs(long["e", c] - (0.0 if c == "3" else 1 / 3)) < 1e-12 for c in classes)  # no term at all: the model's classes alike
    best = {r["id"]: r["code"] for r in one.top(example, 1).collect()}
    assert best == {r["id"]: r["code"] for r in ranking.top_k(one.proba(example), 1).collect()} and len(best) == 5
    slots = features.slot_table(table)
    empty = {r["id"]: r["features"].numNonzeros() for r in features.indexed_vectors(table.filter("id < 'c'"), slots, 3, ids=example.rows).collect()}
    assert empty == {"a": 1, "b": 1, "c": 0, "d": 0, "e": 0}


def test_registered_jobs_run_the_full_configuration():
    from codeloom.catalog import jobs
    assert dataclasses.replace(jobs.CONFIG, use_fuzzy=False) == CodingConfig()


def test_registered_classifiers_run_the_full_configuration(monkeypatch):
    from codeloom.catalog import learning
    seen = []
    monkeypatch.setattr(learning, "by_language", lambda t: (None, ["de", "en"], None, 9, 5))
    monkeypatch.setattr(learning.selection, "fit_best", lambda *a: seen.append(a[5:]) or 1 / 0)
    monkeypatch.setattr(learning.selection, "search_parameters", lambda *a: seen.append(a[2:]) or 1 / 0)
    monkeypatch.setattr(learning.classifiers, "candidate", lambda name, **overrides: seen.append((name, overrides)) or 1 / 0)
    for query in (learning.fit_best, learning.param_search, learning.clf_logistic, learning.clf_multinomial, learning.clf_svc, learning.clf_forest):
        with pytest.raises(ZeroDivisionError):
            query(None)
    config = CodingConfig()
    assert seen[:2] == [(config.folds_industry, config, 5, config.search_trials_industry)] * 2
    assert seen[2:] == [(n, {}) for n in (learning.classifiers.SGD, learning.classifiers.LOGISTIC, learning.classifiers.SVC, learning.classifiers.FOREST)]


def test_terms_are_not_shuffled_once_documents_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(features, "TASK_CHARS", 16)
    rows = spark.createDataFrame([(str(i), d, "x", float(i), 2) for i, d in enumerate(DOCS)], "id string, doc string, cat string, num double, copies bigint")
    plan = features.fit_features(rows, ("cat",), ("num",), CodingConfig(word_min_count=1, char_min_count=1, doc_prop_max=1.0))
    weights = plan.all_blocks(rows)
    slots = features.slot_table(weights)
    for vectors in (features.indexed_vectors(weights, slots, slots.count()), features.hashed_vectors(plan.text_weights(rows), 16)):
        shuffles = [line for line in vectors._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning(" in line]
        assert shuffles and all("REPARTITION_BY_NUM" in line for line in shuffles)
        assert vectors.count() == len(DOCS)


def test_term_counts_join_rows_of_one_id(spark):
    df = spark.createDataFrame([("a", "nurse icu", 1), ("a", "nurse", 3), (None, "cook", 1), (None, "cook", 1)], "id string, doc string, copies bigint")
    found = {(r["id"], r["term"]): (r["tf"], r["copies"]) for r in features.term_counts(df, features.WORD, tasks=5).collect()}
    assert found == {("a", "nurse"): (2, 3), ("a", "icu"): (1, 1), ("a", "nurse icu"): (1, 1), (None, "cook"): (2, 1)}
