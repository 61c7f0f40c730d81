"""Fill-in-middle and packing against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scorewright import llm
from scorewright.llm import encoder, fill_middle, packing

WORD = public_tokenizers.path("word_bpe_49k.json")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, fim string, n long, ids string"
LONG = " ".join(f"word{i}\té\n" for i in range(50_000))
ROWS = [
    (1, "one two  three\n\nfour é日本 five", "x", 7, "i"),
    (2, None, None, None, None),
    (3, "", "x", 7, "i"),
    (4, LONG, "x", 7, "i"),
    (4, LONG, "x", 7, "i"),
    (None, " \t\n", "x", 7, "i"),
    (5, "has <M> inside and <P> too", "x", 7, "i"),
    (6, "\x1f odd\x85blanks\xa0here ", "x", 7, "i"),
    (7, "same", "x", 7, "i"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def brute_fim(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n, sha = len(units), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(sha[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle_equals_brute_force(odd):
    got = fill_middle.fill_in_middle(odd).select("doc_id", "text", "n", "ids", "fim.*").collect()
    assert len(got) == len(ROWS) and {r["ids"] for r in got} == {"i", None}
    for r in got:
        want = brute_fim(r["doc_id"], r["text"])
        assert (r[4], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["output_sha256"] == hashlib.sha256(want[4].encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert fill_middle.fill_in_middle(odd.where("false")).count() == 0


@pytest.mark.parametrize("stretch", [1, 2, 1 << 20])
def test_cuts_in_every_stretch(monkeypatch, stretch):
    """Random bytes around the blanks, words over borders of 64-bit words and of stretches."""
    monkeypatch.setattr(fill_middle, "STRETCH", stretch)
    rng = random.Random(11)
    alphabet = "ab\t\n\x0b\x0c\r \x08\x0e\x1f!\x7f\x85\xa0é日😀"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(300)]
    first, second = (np.array([rng.randrange(2**32) for _ in texts]) for _ in range(2))
    array = pa.array(["skipped", *texts])[1:]
    c = fill_middle.cuts(array, first, second)
    data = c["data"].tobytes()
    for i, text in enumerate(texts):
        units = UNIT.findall(text)
        a, b = sorted((int(first[i]) % (len(units) + 1), int(second[i]) % (len(units) + 1)))
        got = [data[x:y].decode() for x, y in ((c["begin"][i], c["left"][i]), (c["left"][i], c["right"][i]), (c["right"][i], c["end"][i]))]
        want = ["".join(units[:a]), "".join(units[a:b]), "".join(units[b:])]
        assert got == want and c["n"][i] == len(units)
        assert (c["prefix_chars"][i], c["middle_chars"][i]) == (len(want[0]), len(want[1]))


def test_restore_is_the_inverse_of_arrange():
    for form in ("plain", "psm", "spm"):
        for parts in ((b"a", b"b", b"c"), (b"", b"", b"x"), (b"<", b"P>", b"")):
            assert b"".join(fill_middle.restore(b"".join(fill_middle.arrange(*parts, form)), form)) == b"".join(parts)


def brute_tokens(texts, end):
    tokenizer = Tokenizer.from_file(WORD)
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, end] for t in texts]


def check_pieces(rows, documents, size):
    """Every id in one piece, windows gapless and of the one size but for powers of two at the end."""
    by_window, by_doc = {}, {}
    for r in rows:
        by_window.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    lengths = []
    for parts in by_window.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        lengths.append(at)
    assert sorted(by_window) == list(range(len(by_window)))
    assert all(n == size or n & (n - 1) == 0 for n in lengths) and max(lengths) <= size
    for doc_id, ids in documents.items():
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            at += r["length"]
        assert at == len(ids)


def test_packing_query(spark, sf):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    documents = dict(zip(texts, brute_tokens(texts.values(), 1)))
    check_pieces(llm.QUERIES["op13_packing"](spark, sf).collect(), documents, 2048)


@pytest.mark.parametrize("size", [1, 7, 64, 5000])
def test_packing_of_many_small_parts(spark, size):
    """Windows over several parts, parts without rows, documents over several windows."""
    texts = {i: ["a b c", "", None, "word " * (13 * i), "é"][i % 5] for i in range(40)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(16, "doc_id")
    files = packing.encode_for_packing(frame, WORD, end_id=1, by_word=True)
    rows = packing.pieces(spark, files, size).collect()
    documents = dict(zip(texts, brute_tokens(texts.values(), 1)))
    check_pieces(rows, documents, size)
    packed = {r["sequence_id"]: r["ids"] for r in packing.sequences(spark, files, size).collect()}
    assert len(packed) == len({r["sequence_id"] for r in rows})
    for r in rows:
        assert packed[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == documents[r["doc_id"]][r["start"] : r["start"] + r["length"]]
    assert sum(map(len, packed.values())) == files.tokens
    padded = packing.pad(packing.sequences(spark, files, size), size, 0).collect()
    assert all(len(r["ids"]) == size or len(r["ids"]) & (len(r["ids"]) - 1) == 0 for r in padded)


def test_packing_of_odd_rows(spark, odd):
    files = packing.encode_for_packing(odd, WORD, end_id=1, by_word=True)
    rows = packing.pieces(spark, files, 2048).collect()
    assert sum(r["length"] for r in rows) == files.tokens == sum(map(len, brute_tokens([r[1] for r in ROWS], 1)))
    assert {r["doc_id"] for r in rows} == {None, 1, 2, 3, 4, 5, 6, 7}
    assert [(r["length"], r["doc_tokens"]) for r in rows if r["doc_id"] in (2, 3)] == [(1, 1), (1, 1)]
    none = packing.encode_for_packing(odd.where("false"), WORD, end_id=1)
    assert packing.pieces(spark, none, 2048).count() == 0 and packing.sequences(spark, none, 2048).count() == 0


def test_windows():
    w = packing.Windows(2 * 2048 + 5, 2048)
    assert len(w) == 4 and [w.bounds(k) for k in range(4)] == [(0, 2048), (2048, 4096), (4096, 4100), (4100, 4101)]
    window, at = w.place(np.array([0, 2047, 2048, 4095, 4096, 4099, 4100]))
    assert window.tolist() == [0, 0, 1, 1, 2, 2, 3] and at.tolist() == [0, 2047, 0, 2047, 0, 3, 0]
    assert w.starts(2048, 4100).tolist() == [2048, 4096] and len(packing.Windows(0, 2048)) == 0
    with pytest.raises(ValueError):
        packing.Windows(5, 0)


def test_small_memory_encodes_alike(monkeypatch):
    """Words that leave the memory and come back, marks in capitals, long words, Latin letters."""
    monkeypatch.setattr(encoder, "WORD_MEMORY", 5_000)
    monkeypatch.setattr(encoder, "CHUNK_CHARS", 300)
    tokenizer, enc, rng = Tokenizer.from_file(WORD), encoder.Encoder(WORD, True), random.Random(7)
    parts = ["the", "The", "Ünï", "d'où", "don't", "it's", "(x)", "...", "x.,", "a'", "'s", "'sa", "1st", "½", "ß", "ÿ×÷", " ", "  ", "\n", "\t"]
    parts += ["<|endoftext|>", "<|ENDOFTEXT|>", "a<|endoftext|>b", "w" * 400, "é" * 300, "ª", "µm", "İ", "日本", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(30)) for _ in range(600)] + [" ".join(rng.choice(parts) for _ in range(60)) for _ in range(300)]
    assert enc.pieces is not None
    got = [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_files_of_one_id(spark):
    """Rows of one id, or without one, are cut over several parts and stay beside each other."""
    from scorewright.llm import token_files

    frame = spark.range(4000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).alias("doc_id"), F.concat(F.lit("w "), F.col("id")).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = token_files.write_token_files(frame, WORD, 2, by_word=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = token_files.read_token_files(spark, files).collect()
    assert len(files.parts) > 2 and len(rows) == 4000
    assert max(p[1] for p in files.parts) < 2000
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_lists_of_ids_equal_the_library_and_the_stream_of_ids(monkeypatch):
    """Short texts' ids come as one list, longer ones' as a stream; both are the library's."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from scorewright.llm import bpe

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, coder = Tokenizer.from_file(path), bpe.ByteBpe(path)
    library.no_truncation()
    library.no_padding()
    assert coder.transducer.first[ord("t")][ord("h")] == coder.transducer.rule[coder.transducer.start[ord("t")] << coder.transducer.shift | coder.transducer.start[ord("h")]]
    texts = ["", " ", "a  b\n\n c", "Reonier oucheaué,\nHehend's 12,5 &&&### x", "l'été — ofansttionor… 東京\x85　 ", "thear " * 300 + "x" * 5000]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        for limit, chunk in ((1 << 18, 1 << 16), (0, 1 << 16), (1 << 18, 3)):
            monkeypatch.setattr(bpe, "LIST_CHARS", limit)
            monkeypatch.setattr(bpe, "TOKENS_PER_CHUNK", chunk)
            parts = list(coder.encode_chunks(text))
            assert sum(parts, []) == want and all(0 < len(p) <= chunk for p in parts)
        assert list(coder.encode(text)) == want
