"""The registered queries of the subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from codeloom.llm import oracles
from codeloom.llm.bpe import decoded, encoded
from codeloom.llm.content_sort import exact_groups
from codeloom.llm.license_scan import licences
from codeloom.llm.line_runs import repeated_runs
from codeloom.llm.lm_score import scores
from codeloom.llm.mixing import mixed
from codeloom.llm.ngram_join import near_duplicates
from codeloom.llm.periodic import periodic_runs
from codeloom.llm.quality import judged
from codeloom.llm.spelling import variant_forms
from codeloom.llm.substring import repeated_spans
from codeloom.llm.token_files import token_digests
from codeloom.llm.toxicity import toxicity

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(documents(spark, folder), public_tokenizers.path(WORD_VOCABULARY), end_id=2)


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder)).select("doc_id", "n_shingles", "component_id", "class_id")


def op3_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return scores(documents(spark, folder))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return judged(documents(spark, folder)).drop("lang", "source")


def op5_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_runs(documents(spark, folder))
    return found.select("doc_id", "n_lines", "n_deleted", "longest_run", F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"))


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences(documents(spark, folder))
    confirmed = F.filter("found", lambda x: x["confirmed"])
    return found.select("doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_predicted"), F.size(confirmed).cast("long").alias("n_confirmed"),
                        F.array_join(F.sort_array(F.array_distinct(F.transform(confirmed, lambda x: x["family"]))), ",").alias("families"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(documents(spark, folder)).drop("source")


def op8_substring(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans(documents(spark, folder))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(documents(spark, folder))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_VOCABULARY)
    rows = decoded(encoded(documents(spark, folder), path), path)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variant_forms(documents(spark, folder))


def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(documents(spark, folder))
    longest = F.expr("""get(array_sort(runs, (l, r) -> CASE WHEN l.length != r.length THEN IF(l.length > r.length, -1, 1)
                                                          WHEN l.start != r.start THEN IF(l.start < r.start, -1, 1)
                                                          WHEN l.period != r.period THEN IF(l.period < r.period, -1, 1) ELSE 0 END), 0)""")
    listed = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("_best"), listed.alias("_listed"), "collapsed").select(
        "doc_id", "n_runs", F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.floor(F.col("_best.length") * 1000 / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.col("_listed").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_files, op2_ngram_join, op3_lm_score, op4_quality, op5_line_runs, op6_license_scan, op7_mixing,
                            op8_substring, op9_exact_dedup, op10_bpe, op11_spelling_variants,
                            op12_toxicity, op13_periodic_runs)
} | {"pipeline": corpus_pipeline.run}

ORACLES: dict[str, str] = {"op4_quality": oracles.QUALITY, "op5_line_runs": oracles.LINE_RUNS, "op7_mixing": oracles.MIXING,
                           "op8_substring": oracles.SUBSTRING, "op9_exact_dedup": oracles.EXACT_DEDUP}
