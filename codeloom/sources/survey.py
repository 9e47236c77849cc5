"""Survey tables: files in, files out, with column metadata kept on the schema."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FORMATS = ("parquet", "orc", "csv", "json")


def read_survey(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    labels: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """Read responses as stored: user-missing codes stay data and value labels are not applied."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return attach_labels(reader.load(path), labels or {})


TASK_ROWS = 250_000


def input_tasks(df: DataFrame) -> int:
    """Number of tasks that share a table's rows: all cores, and as many more as the rows ask for."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))


def spread_input(df: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Spread a file scan over ``tasks`` tasks when its files give fewer.

    All that is joined, ranked or grouped by ``key`` stays in these tasks, so their number follows the rows and a task's
    rows are bounded. The split is by a hash of ``key``, so a re-run task sees the same rows.
    """
    tasks = input_tasks(df) if tasks is None else tasks
    return df.repartition(tasks, key) if df.rdd.getNumPartitions() < tasks else df


def attach_labels(df: DataFrame, labels: Mapping[str, Mapping]) -> DataFrame:
    """Put label, value labels, missing ranges and the like on the columns' metadata."""
    return df.select(*[
        F.col(c).alias(c, metadata={**df.schema[c].metadata, **dict(labels[c])}) if c in labels else F.col(c)
        for c in df.columns])


def column_labels(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, dict]:
    """Metadata of the columns that exist and have some."""
    wanted = set(columns) if columns is not None else set(df.columns)
    return {f.name: dict(f.metadata) for f in df.schema.fields if f.metadata and f.name in wanted}


def restore_labels(df: DataFrame, source: DataFrame) -> DataFrame:
    """Re-attach a source table's metadata to the columns that survived processing."""
    return attach_labels(df, column_labels(source, df.columns))


def write_survey(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write a scored table. Parquet keeps the metadata; other formats get a JSON side table of it."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)
    if fmt != "parquet":
        labels = [(name, json.dumps(meta, sort_keys=True)) for name, meta in sorted(column_labels(df).items())]
        df.sparkSession.createDataFrame(labels, "column string, metadata string").coalesce(1).write.mode(mode).json(f"{path}.labels")


def write_decision_log(lines: DataFrame, path: str, header: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Write log lines as text files; ``lines`` has one string column. The header is its own small file set."""
    lines.write.mode(mode).text(path)
    if header:
        lines.sparkSession.createDataFrame([("\n".join(header),)], "line string").coalesce(1).write.mode(mode).text(f"{path}.header")
