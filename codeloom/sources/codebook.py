"""Reference codebooks with flexible column names."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.codes import code_missing, code_of
from codeloom.functions.text import FIELD_SEPARATOR, normalized, with_lead

LOG = logging.getLogger(__name__)

# Accepted names of the code column, in order of preference.
CODE_COLUMNS = {
    "occupation": ("soc", "soc_code", "soc6", "code", "occupation_code"),
    "industry": ("naics", "naics_code", "code", "industry_code"),
}
EMPTY = "code string, doc string"


def codebook_documents(book: DataFrame, kind: str) -> DataFrame:
    """(code, doc): every text column as ``name: text``; rows without a usable code or text are dropped."""
    rank = {name: place for place, name in enumerate(CODE_COLUMNS[kind])}
    code_column = min((c for c in book.columns if c.lower() in rank), key=lambda c: rank[c.lower()], default=None)
    if code_column is None:
        LOG.warning("no code column for %s in %s", kind, book.columns)
        return book.sparkSession.createDataFrame([], EMPTY)
    parts = [with_lead(normalized(book, name), f"{name}: ") for name in book.columns if name != code_column]
    shaped = book.select(code_of(book, code_column).alias("code"), F.concat_ws(FIELD_SEPARATOR, *parts).alias("doc"))
    return shaped.filter(~code_missing(F.col("code")) & (F.col("doc") != ""))


def load_codebook(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Read a CSV codebook; an absent or unreadable file gives an empty table and a warning."""
    if not path:
        return spark.createDataFrame([], EMPTY)
    try:
        book = spark.read.option("header", "true").csv(path)
    except AnalysisException as error:
        LOG.warning("codebook %s was not read: %s", path, error)
        return spark.createDataFrame([], EMPTY)
    return codebook_documents(book, kind)
