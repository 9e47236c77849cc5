"""Session defaults and durable staging."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark. Cluster jobs bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("codeloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for staged tables: ``spark.checkpoint.dir``, or a temporary one on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="codeloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage durably (a lost executor re-reads files instead of recomputing), gives the
    optimizer exact sizes, and lets later jobs read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_bytes(table: DataFrame) -> int:
    """Upper estimate of a staged table's in-memory size, from one column-wise aggregate over it."""
    width = F.lit(0).cast("long")
    for field in table.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        elif kind in ("array", "map", "struct"):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)) * 2 + 32
        else:
            width = width + 8
    total = table.agg(F.sum(width).alias("bytes")).first()["bytes"]
    return int(total or 0)
