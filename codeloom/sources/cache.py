"""Embedding cache: vectors keyed by a hash of encoder name and text, in a Parquet table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.session import stage


def keyed(docs: DataFrame, encoder: str) -> DataFrame:
    """Add ``key`` for the texts in ``doc``."""
    return docs.withColumn("key", F.sha2(F.concat(F.lit(f"{encoder}\x1f"), F.col("doc")), 256))


def missing_documents(docs: DataFrame, cached: DataFrame, encoder: str) -> DataFrame:
    """Documents whose key is not in the cache."""
    return keyed(docs, encoder).join(cached.select("key"), "key", "left_anti")


def cached_vectors(docs: DataFrame, path: str, encoder: str, encode: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(key, vec) of all distinct documents; only texts without a cached vector are encoded and appended.

    ``encode`` maps (key, doc) rows to (key, vec) rows, typically by ``mapInPandas`` around a model.
    """
    spark = docs.sparkSession
    wanted = keyed(docs.select("doc"), encoder).dropDuplicates(["key"])
    try:
        cached = spark.read.parquet(path)
        todo = wanted.join(cached.select("key"), "key", "left_anti")
    except AnalysisException:
        todo = wanted
    fresh = stage(encode(todo), "fresh-vectors")
    fresh.write.mode("append").parquet(path)
    return spark.read.parquet(path).join(wanted.select("key"), "key", "left_semi")
