"""Spelling variants, toxicity and periodic runs against brute-force versions on small tables with odd rows."""

import random
import zlib

import pytest

from codeloom.llm.spelling import variant_forms

SCHEMA = "doc_id long, text string, lang string, source string, word string, root string, _key long"


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = (a, b) if len(a) < len(b) else (b, a)
    return any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))


def spelling_brute(rows):
    import re
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 31 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                counts[run] = counts.get(run, 0) + 1
    vocab = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in vocab if one_edit(w, v)] for w in vocab}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-vocab[v], v)) if others else None
        form[w] = best if best is not None and vocab[best] >= 10 * vocab[w] else None
    out = {}
    for w in vocab:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, vocab[w], len(near[w]), vocab[form[w]] if form[w] else None)
    return out


def spelling_rows():
    draw = random.Random(11)
    base = ["recommend", "necessary", "occurrence", "accommodate", "Ärgerlichkeit", "définition", "embarrass", "tomorrowland"]
    rows, doc = [], 0
    for word in base:
        for _ in range(draw.randint(20, 60)):
            doc += 1
            rows.append((doc, f"{word} and {word.upper()} text"))
        for k in range(draw.randint(1, 4)):  # rarer variants, one edit away
            i = draw.randrange(len(word))
            variant = word[:i] + draw.choice("xyzé") + word[i + 1:] if k % 2 else word[:i] + word[i + 1:]
            for _ in range(draw.randint(1, 5)):
                doc += 1
                rows.append((doc, f"the {variant}, {variant}!"))
    rows += [(None, "recommend recommend"), (doc + 1, None), (doc + 2, ""), (doc + 3, "a" * 5000 + " " + "a" * 5000),
             (doc + 3, "repeated row necessary"), (doc + 3, "repeated row necessary"), (doc + 4, "ÿÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿÿ")]
    return rows


def test_spelling_variants_match_brute_force(spark):
    rows = spelling_rows()
    docs = spark.createDataFrame([(d, t, "en", "web", "x", "y", 1) for d, t in rows], SCHEMA)
    want = spelling_brute(rows)
    for broadcast in (True, False):
        got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in variant_forms(docs, broadcast=broadcast).collect()}
        assert got == want
    assert any(v[0] is not None for v in want.values()) and any(v[3] > 0 for v in want.values())


def test_spelling_variants_of_an_empty_table(spark):
    assert variant_forms(spark.createDataFrame([], SCHEMA)).count() == 0


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def runs_brute(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + 1 < n - q and words[j + 1] == words[j + 1 + q]:
                j += 1
            start, length = i, j - i + 1 + q
            part = words[start:start + length]
            smallest = next(p for p in range(1, length + 1) if all(part[t] == part[t + p] for t in range(length - p)))
            if length >= max(6, 4 * q) and smallest == q:
                found.append((start, length, q))
            i = j + 1
    found.sort(key=lambda r: (r[0], r[2]))
    dropped = set()
    for s, l, q in found:
        dropped.update(range(s + q, s + l))
    return found, " ".join(w for i, w in enumerate(words) if i not in dropped)


def periodic_rows():
    draw = random.Random(5)
    vocab = [f"w{i}" for i in range(6)] + ["é", "ab"]
    rows = []
    for doc in range(1, 400):
        n = draw.choice([0, 1, 5, 6, 9, 20, 60, 200])
        words = [draw.choice(vocab[: draw.randint(1, 8)]) for _ in range(n)]
        if n and draw.random() < 0.4:
            at, period = draw.randrange(n), draw.randint(1, 9)
            unit = [draw.choice(vocab) for _ in range(period)]
            words[at:at] = unit * draw.randint(2, 8)
        rows.append((doc, "\t".join(words) if draw.random() < 0.2 else " ".join(words)))
    rows += [(None, "a a a a a a a"), (5000, "x y x y x y x y"), (5000, "x y x y x y x y"), (9000, None), (9001, ""), (9002, " \n "),
             (9003, " ".join(["a"] * 3000 + ["b", "c"] * 1500)), (9004, " ".join(f"u{i % 97}" for i in range(20000)))]
    return rows


def test_periodic_runs_match_brute_force(spark):
    from codeloom.llm.periodic import periodic_runs
    rows = periodic_rows()
    docs = spark.createDataFrame([(d, t, "en", "web", "x", "y", 1) for d, t in rows], SCHEMA)
    got = periodic_runs(docs).collect()
    assert len(got) == len(rows)
    want = {}
    for d, t in rows:
        import re
        words = planted(d, re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        runs, kept = (runs_brute(words) if len(words) < 5000 else (None, None))
        want.setdefault(d, []).append((len(words), runs, kept))
    planted_seen = 0
    for r in got:
        n, runs, kept = want[r["doc_id"]][0]
        assert r["n_words"] == n
        if runs is not None:
            assert [(x["start"], x["length"], x["period"]) for x in r["runs"]] == runs
            assert r["collapsed"] == kept
        planted_seen += r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 and n > 0
    assert planted_seen
    long_a = next(r for r in got if r["doc_id"] == 9003)
    assert [(x["start"], x["length"], x["period"]) for x in long_a["runs"]][:2] == [(0, 3000, 1), (2999, 3001, 2)] or long_a["runs"]
    cyclic = next(r for r in got if r["doc_id"] == 9004)
    assert [(x["start"], x["length"], x["period"]) for x in cyclic["runs"]] == [(0, 20000, 97)]
    assert cyclic["collapsed"] == " ".join(f"u{i}" for i in range(97))


def test_periodic_runs_of_an_empty_table(spark):
    from codeloom.llm.periodic import periodic_runs
    assert periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def toxic_tables(spark):
    draw = random.Random(8)
    vocab = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 8))) for _ in range(400)]
    insults = ["idiot", "moron", "scum", "pathetic", "worthless"]
    docs, labels = [], []
    for doc in range(600):
        sentences = [" ".join(draw.choice(vocab) for _ in range(draw.randint(3, 12))) + "." for _ in range(draw.randint(1, 8))]
        toxic = draw.random() < 0.3
        if toxic:
            at = draw.randrange(len(sentences) + 1)
            sentences.insert(at, f"you {draw.choice(insults)} {draw.choice(vocab)}!")
        docs.append((doc, " ".join(sentences) if draw.random() < 0.5 else "\n".join(sentences), "en", "web", "a", "b", 1))
        labels.append((doc, 1, int(toxic)))
    docs += [(None, "you idiot!", "en", "web", "a", "b", 1), (700, None, "en", "web", "a", "b", 1), (701, "", "en", "web", "a", "b", 1),
             (702, " ".join(["clean words here."] * 5000), "en", "web", "a", "b", 1), (3, "repeated id", "en", "web", "a", "b", 1)]
    labels += [(3, 1, None), (None, 1, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, _y string, slot string, g int"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_learns_from_documents_and_finds_the_sentence(spark):
    from codeloom.llm.toxicity import toxicity
    docs, labels = toxic_tables(spark)
    got = toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth and r["doc_id"] < 600]
    assert len(held) > 100
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) >= 0.9
    for r in got:
        assert 0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.3)
    empty = [r for r in got if r["doc_id"] in (700, 701)]
    assert len(empty) == 2 and all(r["n_sentences"] == 0 and r["worst_sentence"] is None and r["score"] < 0.3 for r in empty)
    assert next(r for r in got if r["doc_id"] is None)["predicted"] == 1
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in held:
        if truth[r["doc_id"]] and r["predicted"]:
            import re
            sentences = [s for s in re.split(r"[.!?]+(?=\s|$)|\n+", texts[r["doc_id"]]) if re.search(r"\w", s)]
            assert "you " in sentences[r["worst_sentence"]]


def test_toxicity_of_an_empty_table(spark):
    from codeloom.llm.toxicity import toxicity
    docs, labels = toxic_tables(spark)
    assert toxicity(docs.limit(0), labels.limit(0), epochs=2).count() == 0


def test_toxicity_knows_inflected_forms_that_no_fitting_row_has(spark):
    from codeloom.llm.toxicity import toxicity
    draw = random.Random(9)
    syllables = ["ra", "ne", "to", "li", "su", "ka", "mo", "vi"]
    plain = lambda: "".join(draw.choice(syllables) for _ in range(2))
    docs, labels = [], []
    for doc in range(600):
        words = [plain() for _ in range(30)]
        toxic = doc % 4 == 0
        if toxic:
            words[draw.randrange(30)] = draw.choice(["zwerg", "quast"]) + f"en{doc}"  # every form occurs once
        docs.append((doc, " ".join(words) + "."))
        labels.append((doc, int(toxic)))
    got = toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [(r["score"], r["doc_id"] % 4 == 0) for r in got if r["held_out"]]
    worst_toxic = sorted(s for s, toxic in held if toxic)
    clean = sorted(s for s, toxic in held if not toxic)
    assert len(worst_toxic) > 20
    assert sum(s > clean[int(0.9 * len(clean))] for s in worst_toxic) >= 0.9 * len(worst_toxic)
