"""Packing by concatenating and cutting: documents end to end, cut into windows of one size.

Pass one encodes every document where it lies and writes flat token files (``token_files``), one part
for each task; only the parts' totals come to the driver, and their prefix sum places every part in the
endless row of tokens. Pass two reads each part by memory map and cuts it at the window borders and at
the documents' ends; a window that runs over the end of a part is two or more boundary records, each
knowing its window and its place there. No text and no token is shuffled for it, and a document of any
length, or a window over many small parts, is only a matter of offsets.

What is left after the last full window is cut into windows of falling powers of two, which need no
padding; so nothing is padded and nothing is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewright.llm.token_files import NO_ID, TokenFiles, filesystem, mapped, write_parts

#: Documents of a part that are cut at once.
DOCS_AT_ONCE = 10_000
#: Tokens of whole windows that go out in one Arrow batch.
TOKENS_AT_ONCE = 1 << 20


class Windows:
    """The windows over ``total`` tokens: their starts, and where a position lies in them."""

    def __init__(self, total: int, size: int):
        if size < 1:
            raise ValueError("windows need at least one token")
        self.total, self.size, self.full = total, size, total // size
        rest = total - self.full * size
        powers = [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]
        self.tail = np.concatenate([[0], np.cumsum(powers, dtype=np.int64)]).astype(np.int64) + self.full * size

    def __len__(self) -> int:
        return self.full + len(self.tail) - 1

    def starts(self, a: int, b: int) -> np.ndarray:
        """Starts of windows in [a, b)."""
        whole = np.arange(-(-a // self.size), min(self.full, -(-b // self.size)), dtype=np.int64) * self.size
        tail = self.tail[(self.tail >= a) & (self.tail < b) & (self.tail < self.total)]
        return np.concatenate([whole, tail])

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, offset there) of each position."""
        in_tail = np.searchsorted(self.tail, at, side="right") - 1
        whole = at < self.full * self.size
        window = np.where(whole, at // self.size, self.full + in_tail)
        begin = np.where(whole, window * self.size, self.tail[np.maximum(in_tail, 0)])
        return window, at - begin

    def bounds(self, window: int) -> tuple[int, int]:
        if window < self.full:
            return window * self.size, (window + 1) * self.size
        return int(self.tail[window - self.full]), int(self.tail[window - self.full + 1])


def encode_for_packing(docs: DataFrame, tokenizer: str, end_id: int, by_word: bool = False, **names: str) -> TokenFiles:
    """Pass one: the token files of ``docs`` in the order in which the rows lie, without a shuffle.

    Null and empty texts are the end id alone; null ids stay null; equal rows are packed each. An empty
    table gives no part. Columns besides the id and the text are not read.
    """
    return write_parts(docs, tokenizer, end_id, by_word, **names)


def _part_rows(spark: SparkSession, files: TokenFiles) -> DataFrame:
    return spark.range(0, len(files.parts), 1, max(1, len(files.parts)))


def pieces(spark: SparkSession, files: TokenFiles, size: int) -> DataFrame:
    """Pass two: every piece of a document that lies in one window.

    doc_id, start (the document's ids before the piece), length, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers), doc_tokens, sequence_id and offset (the piece's place in that window).
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    parts, folder, dtype, windows = files.parts, files.folder, files.dtype, Windows(files.tokens, size)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for k in (k for batch in batches for k in batch.column(0).to_pylist()):
            name, n, _, base = parts[k]
            ids = mapped(fs, f"{root}/{name}.bin", dtype)
            off = mapped(fs, f"{root}/{name}.off", "<i8")
            doc = mapped(fs, f"{root}/{name}.doc", "<i8")
            for i in range(0, n, DOCS_AT_ONCE):
                ends = np.asarray(off[i : min(i + DOCS_AT_ONCE, n) + 1])
                borders = windows.starts(base + int(ends[0]), base + int(ends[-1])) - base
                cuts = np.union1d(ends, borders)
                a, b = cuts[:-1], cuts[1:]
                who = np.searchsorted(ends, a, side="right") - 1
                window, at = windows.place(a + base)
                crc = [zlib.crc32(ids[x:y].astype("<u4")) for x, y in zip(a.tolist(), b.tolist())]
                name_of = np.asarray(doc[i : i + len(ends) - 1])[who]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(name_of, mask=name_of == NO_ID), pa.array(a - ends[who]), pa.array(b - a), pa.array(crc, pa.int64()),
                        pa.array(np.diff(ends)[who]), pa.array(window), pa.array(at),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
                )

    return _part_rows(spark, files).mapInArrow(cut, schema)


def sequences(spark: SparkSession, files: TokenFiles, size: int) -> DataFrame:
    """The packed windows themselves: sequence_id and its ids, every window once.

    Windows inside a part come straight from its file. Of a window over several parts each part gives a
    boundary record; only these (two for each part at most) are shuffled and joined by their offset.
    """
    parts, folder, dtype, windows = files.parts, files.folder, files.dtype, Windows(files.tokens, size)

    def reader(whole: bool):
        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fs, root = filesystem(folder)
            for k in (k for batch in batches for k in batch.column(0).to_pylist()):
                name, _, n, base = parts[k]
                if not n:
                    continue
                ids = mapped(fs, f"{root}/{name}.bin", dtype)
                last = base + n
                (first, end), (_, inside) = windows.place(np.array([base, last - 1]))
                cut_left, cut_right = windows.bounds(int(first))[0] < base, windows.bounds(int(end))[1] > last
                if whole:
                    todo = range(int(first) + cut_left, int(end) + 1 - cut_right)
                else:
                    todo = [int(first)] * cut_left + [int(end)] * (cut_right and not (cut_left and first == end))
                step = max(1, TOKENS_AT_ONCE // windows.size)
                for i in range(0, len(todo), step):
                    bounds = [windows.bounds(w) for w in todo[i : i + step]]
                    held = [(max(a, base), min(b, last)) for a, b in bounds]
                    lengths = np.array([0] + [b - a for a, b in held], dtype=np.int64).cumsum()
                    flat = np.concatenate([ids[a - base : b - base] for a, b in held]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(list(todo[i : i + step]), pa.int64()), pa.array([a - w[0] for (a, _), w in zip(held, bounds)], pa.int64()),
                            pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat)),
                        ],
                        names=["sequence_id", "offset", "ids"],
                    )

        return read

    schema = "sequence_id long, offset long, ids array<int>"
    rows = _part_rows(spark, files)
    fragments = rows.mapInArrow(reader(False), schema)
    joined = fragments.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("f"))
    return rows.mapInArrow(reader(True), schema).select("sequence_id", "ids").unionByName(
        joined.select("sequence_id", F.flatten(F.col("f.ids")).alias("ids"))
    )


def pad(packed: DataFrame, size: int, pad_id: int) -> DataFrame:
    """Windows filled up to ``size`` with ``pad_id``, but for those whose length is a power of two."""
    n = F.size("ids")
    short = (n < size) & (n.bitwiseAND(n - 1) != 0)
    return packed.withColumn("ids", F.when(short, F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(size) - n))).otherwise(F.col("ids")))
