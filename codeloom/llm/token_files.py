"""Token ids as flat binary files with 64-bit document offsets, for memory mapping."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeloom.llm.bpe import ENCODE_BYTES, describe, kept_ids, open_tokenizer
from codeloom.llm.words import pieces, text_bytes
from codeloom.session import shared_folder, stage

KNOWN_WORDS = 3 << 17
NO_ID = np.iinfo(np.int64).min
MANIFEST = "part int, file string, width int, n_docs long, n_tokens long"


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder that all executors share."""
    return fs.FileSystem.from_uri(uri)


def write_part(path: str, folder: str, end_id: int, width: int):
    """Write a sorted partition's ids; returns one manifest row. Every attempt writes names of its own, and only those of the
    attempt that succeeds are in the manifest, so retries and lost executors leave no wrong file in use."""
    kind, cut = np.dtype(f"<u{width}"), describe(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept_ids(None, path, [], np.zeros(0, np.int32), np.zeros(0, np.int64), KNOWN_WORDS)
        store, base = place(folder)
        name, part, lengths, ids = uuid.uuid4().hex, None, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/{name}.tokens") as out:
            for batch in pieces(batches, "body", ENCODE_BYTES):
                part = batch.column("part")[0].as_py()
                flat, places = known.ids([cut.words(body.decode("utf-8", "replace")) for body in batch.column("body").to_pylist()])
                flat = np.insert(flat, places[1:], end_id)
                out.write(flat.astype(kind).tobytes())
                lengths.append(np.diff(places) + 1)
                ids.append(batch.column("doc_id").fill_null(NO_ID).to_numpy())
        if part is None:
            store.delete_file(f"{base}/{name}.tokens")
            return
        size, rows = np.concatenate(lengths), np.concatenate(ids)
        with store.open_output_stream(f"{base}/{name}.offsets") as out:
            out.write(np.concatenate([[0], np.cumsum(size)]).astype("<u8").tobytes())
        with store.open_output_stream(f"{base}/{name}.ids") as out:
            out.write(rows.astype("<i8").tobytes())
        yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "width": width, "n_docs": len(rows), "n_tokens": int(size.sum())}],
                                         schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("width", pa.int32()),
                                                           ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))
    return run


def write_tokens(docs: DataFrame, path: str, end_id: int, folder: str) -> DataFrame:
    """Encode whole texts and write them in ascending doc_id order; returns the staged manifest with each part's ``base``.

    A part has three files: ids as flat little-endian unsigned integers (2 bytes where the vocabulary allows, else 4), 64-bit
    offsets of its documents (one more than documents), and their doc_ids. ``base`` is the number of ids in all parts before, a
    prefix sum over one row a part. Null text is empty (only the end id); null ids come first; other columns are ignored.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = 2 if max(open_tokenizer(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"))
    dealt = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id").withColumn("part", F.spark_partition_id())
    manifest = stage(dealt.mapInArrow(write_part(path, folder, end_id, width), MANIFEST), "token-manifest")
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return stage(manifest.withColumn("base", F.coalesce(before, F.lit(0))), "token-bases")


def mapped(store: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where it is local to the task, else read."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r") if store.get_file_info(path).size else np.zeros(0, kind)
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype=kind)


def read_parts(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = place(folder)
        for batch in batches:
            for row in batch.to_pylist():
                at = f"{root}/{row['file']}"
                tokens = mapped(store, f"{at}.tokens", f"<u{row['width']}")
                offsets, ids = mapped(store, f"{at}.offsets", "<u8").astype(np.int64), mapped(store, f"{at}.ids", "<i8")
                for low in range(0, len(ids), 512):
                    high = min(low + 512, len(ids))
                    flat = tokens[offsets[low]:offsets[high]].astype("<i4")
                    local = (offsets[low:high + 1] - offsets[low]).astype(np.int32)
                    own = ids[low:high]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64(), mask=own == NO_ID), pa.array(row["base"] + offsets[low:high], pa.int64()),
                         pa.ListArray.from_arrays(pa.array(local), pa.array(flat))], ["doc_id", "start", "ids"])
    return run


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents from their files: doc_id, start (ids of all documents before it) and ids (array<int>)."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "part").mapInArrow(read_parts(folder), "doc_id long, start long, ids array<int>")


def ids_crc32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("ids")
        flat, counts = np.asarray(column.flatten(), dtype="<u4"), np.asarray(column.value_lengths(), dtype=np.int64)
        places = np.concatenate([[0], np.cumsum(counts)])
        sums = [zlib.crc32(flat[a:b]) for a, b in zip(places[:-1], places[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(counts), pa.array(sums, pa.int64())],
                                         ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digests(docs: DataFrame, path: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write the token files and return, from the files, doc_id, start, n_tokens and ids_crc32."""
    folder = folder or f"{shared_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    rows = read_tokens(write_tokens(docs, path, end_id, folder), folder)
    return rows.mapInArrow(ids_crc32, "doc_id long, start long, n_tokens long, ids_crc32 long")
