"""Spark jobs over the BPE coder: encode whole texts, decode ids, and digests of a round trip."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from scorewright.llm.bpe import byte_bpe


def encode_texts(docs: DataFrame, tokenizer: str, text_col: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` plus the ids of each whole text. Null text: no ids; other columns pass through."""

    @F.pandas_udf("array<int>")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = byte_bpe(tokenizer)
        for batch in texts:
            yield pd.Series([list(chain.from_iterable(coder.encode_chunks(t or ""))) for t in batch], index=batch.index, dtype=object)

    return docs.withColumn(ids, encode(F.col(text_col)))


def decode_ids(encoded: DataFrame, tokenizer: str, ids_col: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``encoded`` plus the text of its ids; null ids give an empty text, other columns pass through."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = byte_bpe(tokenizer)
        for batch in batches:
            yield pd.Series(["" if x is None else coder.decode(x) for x in batch], index=batch.index, dtype=object)

    return encoded.withColumn(text, decode(F.col(ids_col)))


def round_trip(docs: DataFrame, tokenizer: str, text_col: str = "text", name: str = "bpe") -> DataFrame:
    """``docs`` plus a struct of n_tokens, ids_sha256 (decimal ids, joined by commas) and
    decoded_sha256 (the decoded text in UTF-8).

    Ids are hashed, counted and decoded as they are emitted, so a text of any length takes one chunk
    of ids. Null and empty texts: no token, digests of nothing. Equal texts get equal answers; other
    columns pass through (a column called ``name`` is replaced). Empty in, empty out.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = byte_bpe(tokenizer)
        decimal = coder.decimal.__getitem__

        def one(text: str) -> tuple[int, str, str]:
            n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()

            def watched() -> Iterator[list[int]]:
                nonlocal n
                for part in coder.encode_chunks(text):
                    ids.update(((("," if n else "") + ",".join(map(decimal, part)))).encode())
                    n += len(part)
                    yield part

            for piece in coder.decode_chunks(watched()):
                decoded.update(piece.encode())
            return n, ids.hexdigest(), decoded.hexdigest()

        for batch in texts:
            yield pd.DataFrame([one(t or "") for t in batch], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.withColumn(name, digests(F.col(text_col)))
