"""Purity-filtered dictionaries of repeated answers, and their lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions.codes import MISSING, code_missing, code_or_missing, join_key, key_part, text_key
from codeloom.functions.text import normalized
from codeloom.operators.lookup import fits_broadcast, lookup_join

KeySpecs = Sequence[tuple[str, Sequence[str]]]

ALTERNATES = 5
ENTRY = ("top", "top_prob", "n", "alts")


def summarize_labels(counts: DataFrame, keys: Sequence[str], min_count: int) -> DataFrame:
    """Turn (keys, label, label_n) counts into one entry per key.

    An entry holds the most frequent label, its share, the total and the next five labels. Ties go to the
    smaller label. The input is already aggregated, so a key shared by a third of all rows is only as large
    as its number of distinct labels here.
    """
    per_key = Window.partitionBy(*keys)
    ranked = (
        counts.withColumn("rank", F.row_number().over(per_key.orderBy(F.desc("label_n"), F.asc("label"))))
        .withColumn("n", F.sum("label_n").over(per_key))
        .filter((F.col("rank") <= ALTERNATES + 1) & (F.col("n") >= min_count))
        .withColumn("prob", F.col("label_n") / F.col("n"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col("label").alias("code"), "prob")))
    return (
        ranked.groupBy(*keys).agg(ordered.alias("labels"), F.max("n").alias("n"))
        .select(
            *keys,
            F.get("labels", F.lit(0))["code"].alias("top"),
            F.get("labels", F.lit(0))["prob"].alias("top_prob"),
            "n",
            F.transform(
                F.slice("labels", 2, ALTERNATES),
                lambda e: F.struct(e["code"].alias("code"), e["prob"].alias("prob")),
            ).alias("alts"),
        )
    )


def with_keys(df: DataFrame, specs: KeySpecs) -> tuple[DataFrame, list[tuple[int, str, Column]]]:
    """Add each source column's key part once, and return the (number, name, key) of every usable spec.

    Text columns are normalised by one function over an array, which keeps the generated code small.
    """
    present = [(no, name, cols) for no, (name, cols) in enumerate(specs) if all(c in df.columns for c in cols)]
    sources = sorted({c for _, _, cols in present for c in cols})
    texts = [c for c in sources if df.schema[c].dataType.typeName() == "string"]
    part = {c: F.get("_texts", F.lit(i)) for i, c in enumerate(texts)}
    added = {f"_part_{c}": key_part(df, c) for c in sources if c not in part}
    part.update({c: F.col(f"_part_{c}") for c in sources if c not in part})
    if texts:
        added["_texts"] = F.transform(F.array(*[F.col(c) for c in texts]), text_key)
    parts = df.withColumns(added) if added else df
    return parts, [(no, name, join_key([part[c] for c in cols])) for no, name, cols in present]


def keyed_labels(df: DataFrame, label: Column, specs: KeySpecs) -> DataFrame:
    """(spec, key, label) rows for every key spec whose columns exist; all-MISSING keys are dropped.

    ``explode_outer`` on the never-empty array keeps the optimizer from adding a size filter that would
    compute every key a second time.
    """
    usable = ~code_missing(label)
    parts, keyed = with_keys(df.filter(usable), specs)
    keys = F.array(*[F.struct(F.lit(name).alias("spec"), key.alias("key")) for _, name, key in keyed])
    return (
        parts.select(label.alias("label"), F.explode_outer(keys).alias("entry"))
        .select("entry.spec", "entry.key", "label").filter(F.col("key").isNotNull())
    )


def build_dictionary(df: DataFrame, label: Column, specs: KeySpecs, min_count: int) -> DataFrame:
    """All key specs in one pass: fan out, count with map-side combine, summarize."""
    counts = keyed_labels(df, label, specs).groupBy("spec", "key", "label").agg(F.count("*").alias("label_n"))
    return summarize_labels(counts, ("spec", "key"), min_count)


def _decision(entry: Column, topk: int) -> list[Column]:
    return [
        entry["top"].alias("pred"),
        F.coalesce(entry["top_prob"], F.lit(0.0)).alias("conf"),
        entry["top"].isNotNull().alias("used"),
        F.slice(entry["alts"], 1, max(0, topk - 1)).alias("alts"),
    ]


def lookup_cascade(
    df: DataFrame,
    dictionary: DataFrame,
    specs: KeySpecs,
    purity: float,
    min_count: int,
    topk: int,
    id_col: str = "id",
    broadcast: bool | None = None,
) -> DataFrame:
    """Adds pred, conf, used and alts: the first key spec with an acceptable entry decides.

    Entries that are too rare or impure are removed before the join, which both shrinks the table and lets
    a later spec take over. A small dictionary is broadcast, so the rows are not shuffled at all; a large one
    is probed by one salted join on slim (id, spec, key) rows.
    """
    usable = dictionary.filter((F.col("n") >= min_count) & (F.col("top_prob") >= purity))
    parts, keyed = with_keys(df, specs)
    if not keyed:
        missing = F.lit(None).cast(dictionary.select(F.struct(*ENTRY).alias("e")).schema["e"].dataType)
        return df.select("*", *_decision(missing, topk))
    small = fits_broadcast(usable) if broadcast is None else broadcast
    if small:
        probed = parts.withColumns({f"_key{no}": key for no, _, key in keyed})
        for no, name, _ in keyed:
            entries = usable.filter(F.col("spec") == name).select(
                F.col("key").alias(f"_key{no}"), F.struct(*ENTRY).alias(f"_entry{no}"))
            probed = probed.join(F.broadcast(entries), f"_key{no}", "left")
        first = F.coalesce(*[F.col(f"_entry{no}") for no, _, _ in keyed])
        return probed.select(*[F.col(c) for c in df.columns], *_decision(first, topk))
    keys = F.array(*[
        F.struct(F.lit(no).alias("no"), F.lit(name).alias("spec"), key.alias("key")) for no, name, key in keyed])
    probes = parts.select(id_col, F.explode_outer(keys).alias("k")).select(id_col, "k.*").filter(F.col("key").isNotNull())
    hits = lookup_join(probes, usable.select("spec", "key", F.struct(*ENTRY).alias("entry")),
                       ("spec", "key"), spread=id_col, how="inner", broadcast=False)
    first = hits.groupBy(id_col).agg(F.min_by("entry", "no").alias("_entry"))
    return df.join(first, id_col, "left").select(*[F.col(c) for c in df.columns], *_decision(F.col("_entry"), topk))


def title_labels(df: DataFrame, label: Column, title_col: str, industry_col: str) -> DataFrame:
    """(title, naics, label, n) counts with a title-only copy under MISSING.

    Rows that have no industry count under MISSING twice, once as themselves and once as the copy. Counting
    happens before the fan-out, so the copy doubles distinct answers and not rows.
    """
    counts = (
        df.select(normalized(df, title_col).alias("title"), code_or_missing(df, industry_col).alias("naics"),
                  label.alias("label"))
        .filter((F.col("title") != "") & F.col("label").isNotNull())
        .groupBy("title", "naics", "label").agg(F.count("*").alias("label_n"))
    )
    return (
        counts.select("title", "label", "label_n", F.explode(F.array("naics", F.lit(MISSING))).alias("naics"))
        .groupBy("title", "naics", "label").agg(F.sum("label_n").alias("label_n"))
    )


def build_title_dictionary(df: DataFrame, label: Column, title_col: str, industry_col: str, min_count: int) -> DataFrame:
    """Entries per (title, naics), with naics = MISSING as the title-only level."""
    return summarize_labels(title_labels(df, label, title_col, industry_col), ("title", "naics"), min_count)


def lookup_title(
    df: DataFrame,
    dictionary: DataFrame,
    title_col: str,
    industry_col: str,
    purity: float,
    min_count: int,
    topk: int,
    id_col: str = "id",
    broadcast: bool | None = None,
) -> DataFrame:
    """Adds title, naics, pred, conf, used and alts.

    The title-only entry is consulted when the (title, naics) pair is absent. A pair that exists but is
    impure hides it, and such rows are left for the fuzzy match or the model.
    """
    keyed = df.select("*", normalized(df, title_col).alias("title"), code_or_missing(df, industry_col).alias("naics"))
    small = fits_broadcast(dictionary) if broadcast is None else broadcast
    pairs = dictionary.select("title", "naics", F.struct(*ENTRY).alias("_pair"))
    titles = dictionary.filter(F.col("naics") == MISSING).select("title", F.struct(*ENTRY).alias("_title"))
    joined = lookup_join(keyed, pairs, ("title", "naics"), spread=id_col, broadcast=small)
    joined = lookup_join(joined, titles, ("title",), spread=id_col, broadcast=small)
    entry = F.coalesce("_pair", "_title")
    accepted = F.when((entry["n"] >= min_count) & (entry["top_prob"] >= purity), entry)
    return joined.withColumn("_entry", accepted).select(
        *[F.col(c) for c in df.columns], "title", "naics", *_decision(F.col("_entry"), topk))
