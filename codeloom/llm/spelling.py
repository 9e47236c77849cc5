"""Spelling variants: words one edit apart, found by a reduced alphabet, and the frequent form each rarer one points to.

Method: every letter is hashed to one of a few symbols. Each word of the vocabulary generates the full one-edit
neighbourhood of its reduced spelling (deletions, substitutions and insertions of every symbol, the spelling itself
included), which is joined with the reduced spellings of the vocabulary. Two words one edit apart have reduced
spellings at most one edit apart, so no pair is missed; each candidate is verified on the original strings with an
exact edit distance. All of it runs in Spark SQL expressions: there is no Python in the plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.operators.lookup import fits_broadcast
from codeloom.session import stage

# Fixed values of the contract: the letters of a run, the case folding (A-Z only), the deletion rule's modulus.
LETTER_RUN = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
DELETION_MODULUS = 31

SYMBOLS = 8  # size of the reduced alphabet: more symbols, fewer false candidates, longer neighbourhoods
MIN_LENGTH = 7
MIN_COUNT = 2
DOMINANCE = 10


def reduction(symbols: int = SYMBOLS) -> tuple[str, str]:
    """The letters after folding (a-z, U+00C0-U+00FF) and the symbol of each, by a multiplicative hash of the code point."""
    letters = LOWER + "".join(chr(c) for c in range(0xC0, 0x100))
    return letters, "".join(str((ord(c) * 2654435761 >> 7) % symbols) for c in letters)


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the altered letter runs of all texts with at least ``min_length`` code points and ``min_count`` occurrences.

    A run is lower-cased in A-Z only. With h the unsigned crc32 of ``<doc_id>:<run>`` (UTF-8), a run with h divisible by
    31 loses its code point h mod length. Null texts have no runs; a null doc_id leaves its runs unaltered (h is undefined).
    Occurrences are counted by a partial aggregate before the shuffle, so a word of a third of all rows costs one row per task.
    """
    runs = docs.select(F.col("doc_id").cast("string").alias("_id"),
                       F.explode(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(LETTER_RUN), 0)).alias("_run"))
    runs = runs.select("_id", F.translate("_run", UPPER, LOWER).alias("_run"))
    runs = runs.withColumn("_h", F.crc32(F.concat(F.col("_id"), F.lit(":"), F.col("_run")).cast("binary")))
    altered = F.expr(f"""CASE WHEN _h % {DELETION_MODULUS} = 0
                         THEN concat(substring(_run, 1, CAST(_h % char_length(_run) AS INT)), substring(_run, CAST(_h % char_length(_run) AS INT) + 2))
                         ELSE _run END""")
    words = runs.select(altered.alias("word")).filter(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def neighbourhood(reduced: str, symbols: int) -> F.Column:
    """64-bit hashes of every spelling one edit from ``reduced`` or equal to it, over the symbols '0'..symbols-1."""
    alphabet = "array(" + ", ".join(f"'{s}'" for s in range(symbols)) + ")"
    r = reduced
    return F.expr(f"""array_distinct(transform(concat(
        transform(sequence(0, char_length({r}) - 1), i -> concat(substring({r}, 1, i), substring({r}, i + 2))),
        flatten(transform(sequence(0, char_length({r}) - 1), i -> transform({alphabet}, s -> concat(substring({r}, 1, i), s, substring({r}, i + 2))))),
        flatten(transform(sequence(0, char_length({r})), i -> transform({alphabet}, s -> concat(substring({r}, 1, i), s, substring({r}, i + 1)))))
    ), x -> xxhash64(x)))""")


def near_pairs(vocabulary: DataFrame, symbols: int = SYMBOLS, broadcast: bool | None = None) -> DataFrame:
    """(word, n, other, other_n) for every ordered pair of distinct vocabulary words one edit apart (code points).

    ``vocabulary`` should be staged (word, n). Its reduced keys are broadcast to the neighbourhoods only when their
    measured size is within the broadcast bound; beyond it both sides shuffle on the key. Neighbourhoods grow with
    the word's length times the symbols, and are hashed, so a very long word costs hashes, not strings.
    """
    letters, codes = reduction(symbols)
    reduced = vocabulary.select("word", "n", F.translate("word", letters, codes).alias("_reduced"))
    keys = reduced.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.xxhash64("_reduced").alias("_key"))
    probes = reduced.select("word", "n", F.explode(neighbourhood("_reduced", symbols)).alias("_key"))
    small = fits_broadcast(keys) if broadcast is None else broadcast
    candidates = probes.join(F.broadcast(keys) if small else keys, "_key").drop("_key")
    return candidates.filter((F.col("word") != F.col("other")) & (F.levenshtein("word", "other", 1) == 1))


def variant_forms(docs: DataFrame, symbols: int = SYMBOLS, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                  dominance: int = DOMINANCE, broadcast: bool | None = None) -> DataFrame:
    """One row per word: word, form, root (strings), n, n_near, form_n (long).

    form: the near word of largest n, ties by smallest word in code-point order, if its n is at least ``dominance``
    times the word's; else null. root: forms followed to the last (the word itself when it has no form). Since a form's
    n is at least ten times its word's, chains are short and never cycle. Null and empty texts and null ids contribute
    as :func:`word_counts` says; repeated rows count every time; other columns of ``docs`` are ignored. An empty table
    gives no rows.
    """
    vocabulary = stage(word_counts(docs, min_length, min_count), "spelling-words")
    pairs = near_pairs(vocabulary, symbols, broadcast)
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                     F.min(F.struct((-F.col("other_n")).alias("neg_n"), F.col("other").alias("other"))).alias("_best"))
    words = vocabulary.join(best, "word", "left")
    best_n = -F.col("_best.neg_n")
    form = F.when(best_n >= dominance * F.col("n"), F.col("_best.other"))
    words = words.select("word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(form.isNotNull(), best_n).cast("long").alias("form_n"))
    return roots(stage(words, "spelling-forms"))


def roots(words: DataFrame) -> DataFrame:
    """Adds root by following form links until none is left; each round is one join, staged to cut the lineage."""
    links = stage(words.filter(F.col("form").isNotNull()).select(F.col("word").alias("_at"), F.col("form").alias("_next")), "spelling-links")
    small = fits_broadcast(links)
    current = words.withColumn("root", F.coalesce("form", "word"))
    while True:
        step = current.join(F.broadcast(links) if small else links, F.col("root") == F.col("_at"), "left")
        step = stage(step.select(*words.columns, F.coalesce("_next", "root").alias("root"),
                                 F.col("_next").isNotNull().alias("_moved")), "spelling-roots")
        if not step.filter("_moved").limit(1).count():
            return step.drop("_moved").select("word", "form", "root", "n", "n_near", "form_n")
        current = step.drop("_moved")
