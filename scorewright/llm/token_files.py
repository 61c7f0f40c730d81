"""Token ids as flat unsigned-integer files with 64-bit document offsets, read by memory map.

One shuffle range-partitions the documents by id; every task then encodes its sorted documents and
streams them to three files of its own: ``.bin`` (ids, unsigned 16-bit if the vocabulary allows, else
32-bit, little endian), ``.off`` (n + 1 int64 offsets in tokens, from 0) and ``.doc`` (n int64
document ids). A prefix sum over the parts' totals gives each part its base: a document's global
start is base + offset. Files are named after the task's attempt and the answer of the attempt that
counts names them, so retried, lost and speculative tasks leave files that nothing refers to.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewright.llm.encoder import encoder
from scorewright.session import stage_root

NO_ID = -(2**63)


@dataclass(frozen=True)
class TokenFiles:
    """A written set: its folder, the ids' type, and (name, documents, tokens, base) of each part."""

    folder: str
    dtype: str
    parts: tuple[tuple[str, int, int, int], ...]

    @property
    def tokens(self) -> int:
        return sum(p[2] for p in self.parts)


def filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}")


def write_parts(docs: DataFrame, tokenizer: str, end_id: int, by_word: bool = False, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> TokenFiles:
    """Encodes whole texts, appends ``end_id`` and writes one part for each partition of ``docs``, as it lies.

    ``folder`` must be reachable by every executor; by default a new one below spark.checkpoint.dir.
    Null text: empty (the end id alone). Null ids are stored as the smallest int64. An empty partition
    writes no part. Only one row for each part comes to the driver.
    """
    spark = docs.sparkSession
    folder = folder or os.path.join(stage_root(spark), f"tokens-{uuid.uuid4().hex}")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        fs, root = filesystem(folder)
        context = TaskContext.get()
        part = context.partitionId()
        name = f"part-{part:06d}-{context.taskAttemptId()}"
        enc = encoder(tokenizer, by_word)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        at = n = 0
        fs.create_dir(root, recursive=True)

        def rows():
            yield first
            yield from batches

        with fs.open_output_stream(f"{root}/{name}.bin") as ids, fs.open_output_stream(f"{root}/{name}.off") as off, fs.open_output_stream(f"{root}/{name}.doc") as doc:
            off.write(np.zeros(1, "<i8").tobytes())
            for batch in rows():
                lengths = []
                for b in enc.encode(batch.column(1).to_pylist()):
                    ids.write(b + end)
                    lengths.append(len(b) // enc.dtype.itemsize + 1)
                ends = at + np.cumsum(np.array(lengths, dtype="<i8"))
                off.write(ends.astype("<i8").tobytes())
                doc.write(batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                at, n = int(ends[-1]), n + batch.num_rows
        yield pa.RecordBatch.from_pylist([{"part": part, "name": name, "dtype": enc.dtype.str, "docs": n, "tokens": at}])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    written = rows.mapInArrow(write, "part long, name string, dtype string, docs long, tokens long").collect()
    written = sorted(written, key=lambda r: r["part"])
    bases = np.concatenate([[0], np.cumsum([r["tokens"] for r in written], dtype=np.int64)])
    parts = tuple((r["name"], r["docs"], r["tokens"], int(b)) for r, b in zip(written, bases))
    return TokenFiles(folder, written[0]["dtype"] if written else "<u2", parts)


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, by_word: bool = False, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> TokenFiles:
    """Encodes whole texts, appends ``end_id`` and writes the files in ascending id order.

    Null text: empty (the end id alone). Null ids come first; rows sharing an id stay beside each
    other in the order of a hash of their text, and equal rows are interchangeable. An id (or null)
    that holds many rows is cut over as many parts as its rows need. An empty table writes no part.
    Other columns are not read.
    """
    keys = ["__token_id", "__token_hash", "__token_row"]
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("__token_id"), F.col(text_col).alias("__token_text"))
        .withColumns({"__token_hash": F.xxhash64("__token_text"), "__token_row": F.monotonically_increasing_id()})
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
    )
    return write_parts(ordered, tokenizer, end_id, by_word, folder, "__token_id", "__token_text")


def mapped(fs, path: str, dtype: str) -> np.ndarray:
    """The file as an array: mapped where it lies on a mounted disk, else read."""
    if fs.type_name == "local":
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, one task for each part.

    ``start`` counts the ids of all documents before; the checksum is over the ids as little-endian
    unsigned 32-bit integers.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    parts, folder, dtype = files.parts, files.folder, files.dtype

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for k in (k for batch in batches for k in batch.column(0).to_pylist()):
            name, n, _, base = parts[k]
            ids = mapped(fs, f"{root}/{name}.bin", dtype)
            off = mapped(fs, f"{root}/{name}.off", "<i8")
            doc = mapped(fs, f"{root}/{name}.doc", "<i8")
            for i in range(0, n, 10_000):
                ends = np.asarray(off[i : min(i + 10_000, n) + 1])
                crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(ends[:-1], ends[1:])]
                who = np.asarray(doc[i : i + len(crc)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who, mask=who == NO_ID), pa.array(base + ends[:-1]), pa.array(np.diff(ends)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInArrow(read, schema)
