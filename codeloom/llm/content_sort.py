"""Exact deduplication by a distributed content sort."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.session import stage

LEAD_BYTES = 24
SPACES = " \t\n\x0b\x0c\r"

ROWS = "doc_id long, text_sha256 string, keep_id long, group_size long, chars long, part int, run int, open boolean, body binary"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64()),
                    ("chars", pa.int64()), ("part", pa.int32()), ("run", pa.int32()), ("open", pa.bool_()), ("body", pa.binary())])


def without_space(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare neighbours of a sorted partition in full and number the runs of equal texts.

    A run whose sort key (lead, digest) is that of the partition's first or last row may go on in another partition:
    its rows are marked open, and one further row (with a body) carries its body and best member for the final merge.
    Only ids of the current run and one pending batch are held.
    """
    part, number = None, -1
    body = key = first_key = None
    ids: list[int] = []
    best = (0, 0)
    digest = ""
    # the last key of the partition is known only at its end, so runs of the current key wait in `held`
    held: list[tuple] = []
    for batch in batches:
        columns = batch.to_pydict()
        for i, chars, norm, lead, sha, p in zip(columns["doc_id"], columns["chars"], columns["norm"], columns["lead"],
                                                columns["text_sha256"], columns["part"]):
            if body is None or norm != body:
                if body is not None:
                    held.append((key, part, number, ids, best, digest, body))
                if key != (lead, sha):
                    yield from released(held, first_key, False)
                    held = []
                part, number = p, number + 1
                body, key, digest, ids, best = norm, (lead, sha), sha, [], None
                first_key = first_key or key
            ids.append(i)
            if best is None or chars > best[0] or chars == best[0] and best[1] is None:
                best = (chars, i)  # ids rise within a run, nulls first
    if body is not None:
        held.append((key, part, number, ids, best, digest, body))
        yield from released(held, first_key, True)


def released(held: list[tuple], first_key: tuple | None, last: bool) -> Iterator[pa.RecordBatch]:
    for key, part, number, ids, best, digest, body in held:
        is_open = last or key == first_key
        n, extra = len(ids), int(is_open)
        columns = [pa.array([*ids, *[None] * extra], pa.int64()), pa.array([digest] * (n + extra), pa.string()),
                   pa.array([best[1]] * (n + extra), pa.int64()), pa.array(np.full(n + extra, n, np.int64)),
                   pa.array([*[None] * n, *[best[0]] * extra], pa.int64()), pa.array(np.full(n + extra, part, np.int32)),
                   pa.array(np.full(n + extra, number, np.int32)), pa.array([is_open] * (n + extra)),
                   pa.array([*[None] * n, *[body] * extra], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=SCHEMA)


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Groups of texts that are equal once ASCII white space is deleted.

    Rows are range-partitioned by sampled splitters and sorted by (leading bytes, digest, id), so equal texts are neighbours
    and a group of any size is spread over as many partitions as its rows need. Neighbours are compared in full. Groups that
    touch a partition's ends are merged by their full text; that table holds about two rows a partition.

    Of equal texts the longest original (code points) stays, then the smallest id. Null counts as empty; all empty texts are
    one group. Ids should be unique; a null id stays only where its whole group has none. Other columns are ignored. Returns doc_id, keep_id, group_size, kept, text_sha256, one row for each input row.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    keyed = (docs.select(F.col(id_column).cast("long").alias("doc_id"), F.length(text).cast("long").alias("chars"),
                         without_space(text).cast("binary").alias("norm"))
             .withColumn("lead", F.substring("norm", 1, LEAD_BYTES)).withColumn("text_sha256", F.sha2("norm", 256)))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["lead", "text_sha256", "doc_id"]
    dealt = (keyed.repartitionByRange(n, *order).sortWithinPartitions("lead", "text_sha256", "norm", "doc_id")
             .withColumn("part", F.spark_partition_id()))
    found = stage(dealt.mapInArrow(runs, ROWS), "content-runs")
    members = found.filter("body is null")
    closed = members.filter("not open").select("doc_id", "keep_id", "group_size", "text_sha256")
    ends = found.filter("body is not null")
    merged = (ends.groupBy("body").agg(F.sum("group_size").alias("total"),
                                       F.min_by("keep_id", F.struct(-F.col("chars"), F.col("keep_id").isNull(), F.col("keep_id"))).alias("keeper")))
    names = stage(ends.select("part", "run", "body").join(merged, "body").select("part", "run", "total", "keeper"), "content-ends")
    opened = (members.filter("open").join(F.broadcast(names), ["part", "run"])  # two rows a partition, and 40 bytes a row
              .select("doc_id", F.col("keeper").alias("keep_id"), F.col("total").alias("group_size"), "text_sha256"))
    return (closed.unionByName(opened)
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact deduplication keeps, one of each group, with all their columns.

    Rows are told apart by a staged number, so null and repeated ids are rows like others: the longest original stays, then the
    smallest id, null last.
    """
    rows = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "content-rows")
    facts = rows.select("_row", F.struct(-F.length(F.coalesce("text", F.lit(""))).alias("chars"), F.col("doc_id").isNull().alias("no_id"), "doc_id",
                                         F.xxhash64(*docs.columns).alias("print"), "_row").alias("_order"))
    groups = exact_groups(rows, "_row").select(F.col("doc_id").alias("_row"), F.col("keep_id").alias("_group"))
    kept = groups.join(facts, "_row").groupBy("_group").agg(F.min("_order").alias("_order")).select(F.col("_order._row").alias("_row"))
    return rows.join(kept, "_row", "left_semi").drop("_row")
