"""Quality rules with thresholds learned per language and source. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.llm.words import WORD
from codeloom.session import stage

WINDOW_WORDS = 5
MIN_GROUP = 50
FENCE = 3
# margins added to a fence: per mille of characters, lines or words, and hundredths of a character for the word length
MARGINS = {"symbols": 30, "capitals": 200, "dup_lines": 400, "repeats": 150, "word_length": 150}
KEPT_BITS = 6


def repeat_words(words: Column, hashes: str, ordered: str, places: str, size: int) -> list[tuple[str, Column]]:
    """Steps that count the words inside windows of ``size`` words that occur twice or more in the same text."""
    windows = F.when(F.size(words) >= size, F.transform(
        F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.xxhash64(F.slice(words, i, size)))).otherwise(F.array().cast("array<bigint>"))
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    pairs = F.when(some, F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))).otherwise(
        F.array().cast("array<struct<h:bigint,p:int>>"))
    twice = F.filter(ordered, lambda s, i: (F.get(F.col(ordered), i - 1)["h"] == s["h"]) | (F.get(F.col(ordered), i + 1)["h"] == s["h"]))
    found = F.sort_array(F.transform(twice, lambda s: s["p"]))
    gaps = F.transform(places, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(F.col(places), i + 1) - p, F.lit(size))))
    return [(hashes, windows), (ordered, pairs), (places, found),
            ("n_repeat_words", F.aggregate(gaps, F.lit(0), lambda a, g: a + g).cast("long"))]


def measures(docs: DataFrame) -> DataFrame:
    """One row per document with the counts that the rules use; null text has none of anything.

    Repeated windows are found by sorting the 64-bit hashes of a text's windows, inside the row and only where two are equal.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "lang", "source", text.alias("_text"))
    rows = rows.withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), 0))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda line: line.rlike(WORD)))
    for name, column in repeat_words(F.col("_words"), "_hashes", "_ordered", "_places", WINDOW_WORDS):
        rows = rows.withColumn(name, column)

    def count(chars: str) -> Column:
        return F.length(F.regexp_replace("_text", f"[^{chars}]+", "")).cast("long")

    return rows.select(
        "doc_id", "lang", "source", F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        count("#*$%&|<>").alias("n_symbols"), (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", count("A-Z").alias("n_capitals"), F.size("_lines").cast("long").alias("n_lines"))


def rates(rows: DataFrame) -> DataFrame:
    """Whole-number rates: per mille, and hundredths for the mean word length."""
    def rate(top: str, bottom: str, unit: int) -> Column:
        return F.floor(F.col(top) * unit / F.greatest(F.lit(1), F.col(bottom))).cast("long")
    return (rows.withColumn("symbols", rate("n_symbols", "word_chars", 1000)).withColumn("capitals", rate("n_capitals", "word_chars", 1000))
            .withColumn("dup_lines", rate("n_dup_lines", "n_lines", 1000)).withColumn("repeats", rate("n_repeat_words", "n_words", 1000))
            .withColumn("word_length", rate("word_chars", "n_words", 100))
            .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))))


def sketch(rows: DataFrame) -> DataFrame:
    """Mergeable quantile sketches of every rate: counts of values cut to their six highest bits (within 1/32).

    One sketch per (language, source), per language and for all; a sketch of more rows is the sum of its parts' counts,
    whatever the order or partitioning. Columns lang, source, level, measure, bin, n.
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MARGINS])
    long = rows.filter("not base_failed").select("lang", "source", F.inline(pairs))
    drop = F.greatest(F.lit(0), F.length(F.bin("value")) - KEPT_BITS)
    long = long.withColumn("bin", F.call_function("shiftleft", F.call_function("shiftright", F.col("value"), drop), drop))
    finest = stage(long.groupBy("lang", "source", "measure", "bin").agg(F.count(F.lit(1)).alias("n")), "sketch")
    by_lang = finest.groupBy("lang", "measure", "bin").agg(F.sum("n").alias("n"))
    whole = finest.groupBy("measure", "bin").agg(F.sum("n").alias("n"))
    none = F.lit(None).cast("string")
    return (finest.withColumn("level", F.lit(0))
            .unionByName(by_lang.withColumn("source", none).withColumn("level", F.lit(1)))
            .unionByName(whole.withColumn("lang", none).withColumn("source", none).withColumn("level", F.lit(2))))


def thresholds(sketches: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Limits per (language, source): the quartile fence of its sketch, plus a margin.

    A group of fewer than ``min_group`` documents takes the sketch of its language, and that of all if this is small too.
    Columns lang, source and, for each measure, high_<measure>, and low_word_length.
    """
    group = Window.partitionBy("level", "lang", "source", "measure")
    sofar = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    seen = sketches.withColumn("_sofar", sofar).withColumn("_all", F.sum("n").over(group))

    def quartile(i: int) -> Column:
        return F.min(F.when(4 * F.col("_sofar") >= i * F.col("_all"), F.col("bin")))

    found = seen.groupBy("level", "lang", "source", "measure").agg(quartile(1).alias("q1"), quartile(3).alias("q3"), F.first("_all").alias("rows"))
    columns = [F.max("rows").alias("rows")]
    for measure, margin in MARGINS.items():
        reach = FENCE * (F.col("q3") - F.col("q1")) + margin
        columns.append(F.max(F.when(F.col("measure") == measure, F.col("q3") + reach)).alias(f"high_{measure}"))
        if measure == "word_length":
            columns.append(F.max(F.when(F.col("measure") == measure, F.col("q1") - reach)).alias("low_word_length"))
    wide = stage(found.groupBy("level", "lang", "source").agg(*columns), "thresholds")
    limits = [c for c in wide.columns if c not in ("level", "lang", "source", "rows")]
    own, language, whole = (wide.filter(F.col("level") == i) for i in range(3))
    language = language.select(F.col("lang").alias("_lang"), F.col("rows").alias("_rows"), *[F.col(c).alias(f"_l_{c}") for c in limits])
    whole = whole.select(*[F.col(c).alias(f"_w_{c}") for c in limits])  # one row
    joined = own.join(language, F.col("lang").eqNullSafe(F.col("_lang"))).join(F.broadcast(whole))
    return joined.select("lang", "source", *[F.when(F.col("rows") >= min_group, F.col(c)).when(F.col("_rows") >= min_group, F.col(f"_l_{c}"))
                                             .otherwise(F.col(f"_w_{c}")).alias(c) for c in limits])


def judged(docs: DataFrame) -> DataFrame:
    """Every document with its counts, ``base_failed`` and ``kept``.

    A document goes if the base rule fails it (under 10 words, or over 20 % of its words in repeated 5-word windows) or if one of
    its rates lies outside the limits of its language and source. Null and empty texts have no words and fail. Null
    languages and sources are groups of their own; other columns are ignored; repeated ids are judged row by row.
    """
    rows = stage(rates(measures(docs)), "measures")
    limits = thresholds(sketch(rows)).select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "high_symbols", "high_capitals",
                                             "high_dup_lines", "high_repeats", "high_word_length", "low_word_length")
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    outside = F.col("word_length") < F.col("low_word_length")
    for measure in MARGINS:
        outside = outside | (F.col(measure) > F.col(f"high_{measure}"))
    return joined.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~F.coalesce(outside, F.lit(False))).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns (ids are expected to be unique)."""
    kept = judged(docs).filter("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi")
