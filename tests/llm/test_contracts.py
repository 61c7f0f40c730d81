"""Every query of the package: against its SQL where there is one, else against brute force."""

import glob
import hashlib
import itertools
import os
import re
import zlib

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from scorewright import llm
from pyspark.sql import functions as F

from scorewright.llm import langid, pii, secret_scan
from tests.conftest import SF
from scorewright.session import stage as written
from tests.test_queries import rows, same


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return dict(duck.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall())


def result(spark, sf, name):
    return {r["doc_id"]: r for r in llm.QUERIES[name](spark, sf).collect()}


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_matches_sql(spark, sf, duck, name):
    got, want = llm.QUERIES[name](spark, sf).toArrow(), duck.sql(llm.ORACLES[name]).to_arrow_table()
    names = sorted(want.column_names)
    assert sorted(got.column_names) == names
    left, right = rows(got, names), rows(want, names)
    assert len(left) == len(right)
    for a, b in zip(left, right):
        assert all(map(same, a, b)), (a, b)


def test_all_dealt_operators_are_there():
    numbers = {int(re.match(r"op(\d+)_", n)[1]) for n in llm.QUERIES if n != "pipeline"}
    assert numbers == set(range(1, 14)) and "pipeline" in llm.QUERIES


def brute_components(texts, words, threshold=80):
    sets = {}
    for d, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= threshold * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in texts}


def test_near_dup(spark, sf, docs):
    got = result(spark, sf, "op4_near_dup")
    want = brute_components(docs, 4)
    assert {d: (r["n_shingles"], r["component_id"], r["kept"]) for d, r in got.items()} == {
        d: (n, c, c == d) for d, (n, c) in want.items()
    }


def test_token_files(spark, sf, docs):
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    got = result(spark, sf, "op3_token_files")
    assert set(got) == set(docs)
    for d, text in docs.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        assert tuple(got[d]) == (d, start, len(ids), crc)
        start += len(ids)


def digests(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))


def test_bpe(spark, sf, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for d, r in result(spark, sf, "op10_bpe").items():
        assert tuple(r)[1:] == digests(tokenizer, docs[d])


def test_language_of_the_held_out(spark, sf, duck):
    got = result(spark, sf, "op8_language_id")
    lang = dict(duck.sql("SELECT doc_id, lang FROM documents").fetchall())
    held = {d for d in lang if zlib.crc32(str(d).encode()) % 5 == 0}
    assert {d for d, r in got.items() if r["held_out"]} == held
    assert sum(got[d]["lang_pred"] == lang[d] for d in held) >= 0.9 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


PATTERNS = {
    "assign": r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def test_secrets(spark, sf, docs):
    for d, r in result(spark, sf, "op1_secret_scan").items():
        text, base = docs[d] or "", []
        for k, (kind, pattern) in enumerate(PATTERNS.items()):
            for m in re.finditer(pattern, text):
                if len(m[2] if kind == "assign" else m[0]) >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                    base.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
        listed = [s for *_, s in sorted(base)]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(b[1] == k for b in base) for k in range(3)]
        assert set(listed) <= set(filter(None, r["spans"].split(",")))


def test_personal_data(spark, sf, docs):
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    ip, card, phone = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"
    digits = lambda s: re.sub("[^0-9]", "", s)
    holds = [
        lambda s: True,
        lambda s: all(int(p) <= 255 for p in s.split(".")),
        lambda s: 13 <= len(digits(s)) <= 19 and pii.luhn(digits(s)),
        lambda s: 9 <= len(digits(s)) <= 15,
    ]
    for d, r in result(spark, sf, "op9_pii").items():
        base = []
        for kind, pattern, ok in zip(pii.KINDS, (email, ip, card, phone), holds):
            base += [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, docs[d] or "") if ok(m[0])]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(filter(None, r["spans"].split(",")))


def test_models_find_what_they_were_not_shown(duck):
    path = "/root/testdata/sf0.1/documents.parquet"
    texts = [r[0] for r in duck.sql(f"SELECT text FROM '{path}' WHERE regexp_matches(text, '[0-9]') ORDER BY doc_id LIMIT 900").fetchall()]
    field, tagger = secret_scan.train(texts[:450]), pii.train(texts[:450])
    for gold, found in (
        ([set(secret_scan.labelled_spans(t)) for t in texts[450:]], [{s[1:] for s in field.spans(t)} for t in texts[450:]]),
        ([set(pii.labelled_spans(t)) for t in texts[450:]], [set(tagger.spans(t)) for t in texts[450:]]),
    ):
        hits = sum(len(a & b) for a, b in zip(gold, found))
        assert hits >= 0.9 * sum(map(len, gold)) and hits >= 0.9 * sum(map(len, found))


def test_pipeline_equals_brute_force(spark, sf, docs):
    """Each stage on what the one before wrote, and the last against the tokenizer itself."""
    table = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    named = stages["language_id"](spark, table, sf)
    profiles = langid.fit_profiles(table.where(~langid.held_out(F.col("doc_id"))))
    told = {d: profiles.predict(t) for d, t in docs.items()}
    letters = {d for d, (lang, score) in told.items() if lang != "und" and score >= corpus_pipeline.LEAST_SCORE}
    assert letters == {d for d, t in docs.items() if any(c.isalpha() for c in t or "")}  # clean documents stay
    assert {r[0] for r in named.select("doc_id").collect()} == letters and named.columns == table.columns
    lined = {r["doc_id"]: r["text"] for r in stages["line_dedup"](spark, named, sf).collect()}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    seen = {}
    for d in letters:
        for k in {key(x) for x in docs[d].split("\n")} - {""}:
            seen[k] = seen.get(k, 0) + 1
    assert lined == {d: "\n".join(x for x in docs[d].split("\n") if seen.get(key(x), 0) < 10) for d in letters}
    frame = spark.createDataFrame([(d, t, "en", f"src{d % 3}", len(t)) for d, t in lined.items()], table.schema)
    kept = stages["near_dedup"](spark, frame, sf)
    want = {d for d, (_, c) in brute_components(lined, 5).items() if c == d}
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(want)
    mixed = stages["mixing"](spark, kept, sf)
    copies = [r["doc_id"] for r in mixed.collect()]
    assert set(copies) <= want and max(map(copies.count, copies)) <= 3 and mixed.columns == table.columns
    coded = stages["bpe"](spark, mixed, sf).collect()
    assert sorted(r["doc_id"] for r in coded) == sorted(copies)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert all(tuple(r)[1:] == digests(tokenizer, lined[r["doc_id"]]) for r in coded)


ODD = "doc_id long, text string, lang string, source string, n_chars long, row string, gone int"


def odd_documents(spark):
    rows = [(i, f"the house of the man and the dog {i} in the garden of the town\nshared line", "en", "a", 1, "r", 1) for i in range(1, 30)]
    rows += [(40, None, "en", "a", 1, "r", 1), (41, "", None, None, None, None, None), (42, " \n\t", "en", "a", 1, "r", 1), (None, "the man of the house", "en", None, 1, "r", 1)]
    rows += [(43, "\u0434\u043e\u043c \u0438 \u0441\u0430\u0434 \u0432 \u0433\u043e\u0440\u043e\u0434\u0435", None, "b", 1, "r", 1), (44, "1234 5678 !!", "en", "b", 1, "r", 1)]
    rows += [rows[0], rows[0], (5, "the dog of the house and the man in the town", "en", "b", 1, "r", 1)]
    return spark.createDataFrame(rows, ODD)


def test_pipeline_stages_on_odd_documents(spark, sf):
    docs, n = odd_documents(spark), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf))
        n[name] = docs.count()
        if name != "bpe":
            assert docs.columns == [c.split()[0] for c in ODD.split(", ")]
    assert n["language_id"] == 33 == n["line_dedup"]  # no text, no letter, another script: gone
    assert 0 < n["near_dedup"] <= 33 and 0 < n["mixing"] and n["mixing"] == n["bpe"]
    empty = odd_documents(spark).where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = written(stage(spark, empty, sf))
    assert empty.count() == 0


def test_language_stage_without_labels_keeps_what_has_letters(spark, sf):
    docs = odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert dict(corpus_pipeline.STAGES)["language_id"](spark, docs, sf).count() == 34  # two texts without a letter and two empty ones go
