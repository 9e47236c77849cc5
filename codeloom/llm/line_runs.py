"""Removal of repeated runs of lines by prefix doubling over line ids. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.llm.words import WORD
from codeloom.operators.lookup import fits_broadcast
from codeloom.session import stage

MIN_LINES = 2


def filled_lines(text: Column) -> Column:
    """The lines of a text that hold a word, in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: line.rlike(WORD))


def repeated(names: DataFrame) -> DataFrame:
    """Of (doc_id, line, name) the rows whose name occurs again, with ``later``: whether it also starts earlier.

    Counts and first places are combined before the shuffle; the join back is on a name that many rows may carry and is one
    that Spark can split.
    """
    known = (names.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "line")).alias("first"))
             .filter("n > 1").select("name", "first"))
    return names.join(known, "name").select("doc_id", "line", "name", (F.struct("doc_id", "line") != F.col("first")).alias("later"))


def doubled(level: DataFrame, lines: int, reach: int) -> DataFrame:
    """Names of runs of ``lines`` + ``reach`` lines, from the names of runs of ``lines`` at two places ``reach`` apart."""
    ahead = Window.partitionBy("doc_id").orderBy("line").rangeBetween(reach, reach)
    return (level.withColumn("next", F.first("name").over(ahead)).filter("next is not null")
            .select("doc_id", "line", F.xxhash64("name", "next").alias("name")))


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """Columns doc_id, n_lines, n_deleted, longest_run and kept (array of the lines that stay), one row a document.

    Lines without a word are left out; the others are compared as they are. The suffixes of all line sequences are named by
    prefix doubling: a run of 2k lines is named by the names of its halves, and a place whose run of k lines is unique goes, since
    all longer runs there are unique too. So rounds shrink, and end with the longest repeated run. A place that carries a name which
    starts earlier (smaller doc_id, or before in the same text) has that many lines in common with an earlier suffix; a
    line is deleted if a run of ``min_lines`` or more of them covers it. Longer common runs delete the same lines, as each
    is covered by its parts. ``longest_run`` is the longest such run found, as a power of two.

    Names are 64-bit hashes in place of ranks: only their equality is used. Null and empty texts have no lines. Ids should be
    unique; rows with a null id come back whole. Other columns are ignored, an empty table gives an empty result.
    """
    texts = docs.select("doc_id", filled_lines(F.col("text")).alias("lines"))
    names = (texts.filter("doc_id is not null").select("doc_id", F.posexplode("lines").alias("line", "body"))
             .select("doc_id", "line", F.xxhash64("body").alias("name")))
    lines, found = 1, []
    level = stage(repeated(names), "runs")
    while not level.isEmpty():
        found.append((lines, level))
        level = stage(repeated(doubled(level, lines, lines)), "runs")
        lines *= 2
    base = max((n for n, _ in found if n <= min_lines), default=None)
    if base is None or (base < min_lines and 2 * base < min_lines):
        gone = level.select("doc_id", "line")  # nothing repeats over min_lines lines: an empty table
    else:
        at = dict(found)[base]
        least = at if base == min_lines else repeated(doubled(at, base, min_lines - base))
        gone = least.filter("later").select("doc_id", F.explode(F.sequence(F.col("line"), F.col("line") + min_lines - 1)).alias("line"))
    longest = level.select("doc_id", F.lit(0).alias("longest_run"))
    for n, rows in found:
        if n >= min_lines:
            longest = longest.unionByName(rows.filter("later").select("doc_id", F.lit(n).alias("longest_run")).distinct())
    per_doc = gone.groupBy("doc_id").agg(F.collect_set("line").alias("gone")).join(
        longest.groupBy("doc_id").agg(F.max("longest_run").alias("longest_run")), "doc_id", "left")
    per_doc = stage(per_doc, "deleted-lines")
    whole = texts.join(F.broadcast(per_doc) if fits_broadcast(per_doc) else per_doc, "doc_id", "left")
    # a map of the deleted numbers keeps the look-up of a line independent of how many are deleted
    whole = whole.withColumn("gone", F.map_from_entries(F.transform(F.coalesce("gone", F.array().cast("array<int>")), lambda i: F.struct(i, F.lit(True)))))
    kept = F.when(F.size("gone") == 0, F.col("lines")).otherwise(F.filter("lines", lambda _, i: ~F.map_contains_key("gone", i)))
    return whole.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_deleted"),
                        F.coalesce("longest_run", F.lit(0)).cast("long").alias("longest_run"), kept.alias("kept"))
