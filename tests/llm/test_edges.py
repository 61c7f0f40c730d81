"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scorewright.llm import bpe, bpe_jobs, encoder, langid, line_dedup, mixing, near_dup, pii, quality, secret_scan, token_files, topk

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, __h string, quality string, n_lines long"
LONG = " ".join(f"word{i} é" for i in range(20_000))
ROWS = [
    (1, "Shared line\nsome words here", "en", "a", None, "k", "h", "q", 7),
    (2, None, None, None, 3, None, None, None, None),
    (3, "", "en", "b", 0, "k", "h", "q", 7),
    (4, LONG, "fr", "a", 1, "k", "h", "q", 7),
    (4, LONG, "fr", "a", 1, "k", "h", "q", 7),
    (None, " \t\n", "de", None, 1, "k", "h", "q", 7),
    (5, "SHARED line  \nother words here", "en", "a", 1, "k", "h", "q", 7),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def test_lines(odd, empty):
    got = line_dedup.dedup_lines(odd, min_docs=2)
    texts = sorted((r["doc_id"] or 0, r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect())
    assert texts == [(0, " \t\n", 2, 0), (1, "some words here", 2, 1), (2, "", 1, 0), (3, "", 1, 0), (4, LONG, 1, 0), (4, LONG, 1, 0), (5, "other words here", 2, 1)]
    assert {r["key"] for r in got.collect()} == {"k", None}
    assert line_dedup.dedup_lines(empty).count() == 0


def test_mix(odd, empty):
    got = mixing.plan_mix(odd).collect()
    assert len(got) == 7 and all(0 <= r["mix_copies"] <= 3 and r["mix_taken"] == r["mix_copies"] * r["mix_size"] for r in got)
    assert all(0 <= p <= 1 for r in got for p in r["mix_positions"])
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).columns == empty.columns
    rising = ((0.0, (0.0, 1.0, 1.0)), (1.0, (1.0, 1.0, 1.0)))
    late = mixing.mix(odd, schedule=rising)
    assert late.columns == odd.columns and late.count() > 0


def test_a_rising_weight_comes_later(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    rows = mixing.plan_mix(docs, schedule=((0.0, (0.1, 1.0)), (1.0, (1.9, 1.0))), keep=True).collect()
    mean = {s: np.mean([p for r in rows if r["row"]["source"] == s for p in r["mix_positions"]]) for s in "ab"}
    assert mean["a"] > mean["b"] + 0.1
    taken = {s: sum(r["mix_taken"] for r in rows if r["row"]["source"] == s) for s in "ab"}
    target = {r["row"]["source"]: r["mix_target"] for r in rows}
    assert all(abs(taken[s] - target[s]) <= 10 for s in "ab")


def test_quality(odd, empty):
    got = quality.score_quality(odd).select("doc_id", "quality.*").collect()
    assert {r["doc_id"] for r in got if r["base_failed"]} == {None, 1, 2, 3, 5}
    assert quality.score_quality(empty).count() == 0
    window = quality.score_quality(odd.sparkSession.createDataFrame([("a b c a b c x",)], "text string")).select("quality.*").first()
    assert window["n_repeat_words"] == 6 and window["n_words"] == 7


def test_near(odd, empty):
    got = near_dup.components(odd, 4, 80).collect()
    assert sorted(((r["doc_id"] or 0), r["n_shingles"], r["component_id"]) for r in got)[:3] == [(0, 0, None), (1, 2, 1), (2, 0, 2)]
    assert near_dup.components(empty, 4, 80).count() == 0
    assert near_dup.keep_one(odd).columns == odd.columns and near_dup.keep_one(odd).count() == 7


def test_near_chain_and_copies(spark):
    rng = random.Random(3)
    base = [f"t{rng.randrange(10**6)}" for _ in range(300)]
    rows, words = [], list(base)
    for i in range(12):  # each is close to the one before, the last far from the first
        rows.append((i, " ".join(words)))
        at = 20 * i
        words[at : at + 5] = [f"n{i}_{j}" for j in range(5)]
    rows += [(100 + i, " ".join(base)) for i in range(50)] + [(900, "quite another text with words of its own")]
    got = {r["doc_id"]: r["component_id"] for r in near_dup.components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()}
    assert set(got.values()) == {0, 900}


def test_contract_finds_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 107), (107, 103)] + [(200, 200)]
    got = {r["node"]: r["root"] for r in near_dup.contract(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 103: 100, 107: 100}


def test_bayes_bounds():
    bounds = near_dup.least_matches(80)
    assert list(bounds) == sorted(bounds) and bounds[-1] < 0.8 * near_dup.HASHES
    a = np.zeros((1, near_dup.HASHES), np.uint8)
    assert near_dup.may_link(a, a, 80).all() and not near_dup.may_link(a, a + 1, 80).any()


def test_all_batches_together_keep_the_miss_probability():
    """Exact chance that a pair of similarity 0.8 is given up at any batch end."""
    share, lost = np.array([1.0]), 0.0
    one = np.array([math.comb(near_dup.BATCH, k) * 0.8**k * 0.2 ** (near_dup.BATCH - k) for k in range(near_dup.BATCH + 1)])
    for least in near_dup.least_matches(80):
        share = np.convolve(share, one)
        lost += share[:least].sum()
        share[:least] = 0.0
    assert 0 < lost < near_dup.MISS


def test_token_files(spark, odd, empty):
    tokenizer = Tokenizer.from_file(WORD)
    files = token_files.write_token_files(odd, WORD, 2, by_word=True)
    got = token_files.read_token_files(spark, files).collect()
    assert len(got) == 7 and got[0]["doc_id"] is None and [r["start"] for r in got] == list(np.cumsum([0] + [r["n_tokens"] for r in got[:-1]]))
    assert sum(r["n_tokens"] for r in got) == sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in ROWS)
    none = token_files.write_token_files(empty, WORD, 2)
    assert none.tokens == 0 and token_files.read_token_files(spark, none).count() == 0


def test_words_encode_as_whole_texts():
    tokenizer, enc, rng = Tokenizer.from_file(WORD), encoder.Encoder(WORD, True), random.Random(5)
    parts = ["the", "Ünï", "don't", " ", "\n", "  ", "\t", "́", "a<|endoftext|>b", "<|x|>", "日本", "12", "...", " ", "​", "İ", "Σ"]
    texts = ["".join(rng.choice(parts) for _ in range(30)) for _ in range(400)]
    assert [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_bpe(odd, empty):
    tokenizer, coder, rng = Tokenizer.from_file(BYTE), bpe.byte_bpe(BYTE), random.Random(9)
    parts = ["the", "tion", "'ll", " ", "  ", "\n", "\x1c", "\x85", "　", "<|endoftext|>", "é", "日本", "😀", "12", "!?", "aaaa"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(40))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert list(coder.encode(text)) == ids and coder.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False)
    piece = "".join(rng.choice("abest") for _ in range(20_000))
    assert list(coder.encode(piece)) == tokenizer.encode(piece, add_special_tokens=False).ids
    ids = bpe_jobs.encode_texts(odd, BYTE)
    back = bpe_jobs.decode_ids(ids, BYTE).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    assert bpe_jobs.round_trip(odd, BYTE).count() == 7 and bpe_jobs.round_trip(empty, BYTE).count() == 0


def test_bpe_with_little_memory(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_BYTES", 3_000)
    tokenizer, coder, rng = Tokenizer.from_file(BYTE), bpe.ByteBpe(BYTE), random.Random(10)
    texts = [" ".join(rng.choice(["the", "tion", "don't", "x" * 50, "日本", "12"]) + str(rng.randrange(60)) for _ in range(80)) for _ in range(40)]
    assert [list(coder.encode(t)) for t in texts] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(coder.known) < 60 and len(coder.before) < 60


def test_lookahead_of_small_lists():
    ab, bc = (b"a", b"b"), (b"b", b"c")
    assert bpe.sufficient_lookahead([bc, ab]) == 2 and bpe.sufficient_lookahead([]) == 0
    assert bpe.sufficient_lookahead([(b"ab", b"c"), ab]) is None


def test_language(odd, empty):
    profiles = langid.fit_profiles(odd)
    got = [(r["lang_pred"], r["lang_score"]) for r in langid.predict_language(odd, profiles).orderBy("doc_id").collect()]
    assert got[0] == got[2] == got[3] == ("und", 0.0) and got[1][0] == "en"
    nothing = langid.fit_profiles(empty)
    assert {r["lang_pred"] for r in langid.predict_language(odd, nothing).collect()} == {"und"}
    assert langid.predict_language(empty, profiles).count() == 0


def test_spans(odd, empty):
    field, tagger = secret_scan.fit_field(odd), pii.train([])
    for got in (secret_scan.scan_secrets(odd, field).select("secrets.*"), pii.find_personal_data(odd, tagger).select("pii.*")):
        assert got.count() == 7
    assert secret_scan.scan_secrets(empty, secret_scan.fit_field(empty)).count() == 0
    assert pii.find_personal_data(empty, pii.fit_tagger(empty)).count() == 0
    assert secret_scan.base_spans('x password = "abc" token:abcdef') == [("assign", 19, 31)]
    assert pii.emails("a@b a.b@c.de, x@y.z@q.r") == [(4, 12), (14, 19)]


def test_topk(spark):
    rows = [(0, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [float("nan"), 1.0], 1), (5, None, 1), (6, [None, 1.0], 1), (None, [1.0, 1.0], 1), (7, [-1.0], 1), (8, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = [tuple(r) for r in topk.exact_topk(frame, F.col("vec_id") % 100 == 0, k=3).orderBy("query_id", "rank").collect()]
    one = 1024 * 1024
    assert got == [(0, 1, 3, one), (0, 2, 3, one), (0, 3, 100, one), (100, 1, 0, one), (100, 2, 3, one), (100, 3, 3, one)]
    assert topk.exact_topk(frame.where("false"), F.lit(True)).count() == 0


def brute_mix(rows, schedule, max_repeat):
    """Targets by filling sources up to their caps, positions by walking the demand in fine steps."""
    import hashlib

    sizes = {}
    for i, text, source in rows:
        sizes.setdefault(source, []).append((hashlib.md5(str(i).encode()).hexdigest(), i, len(text.split())))
    names = sorted(sizes)
    total = {s: sum(x[2] for x in sizes[s]) for s in names}

    def weight(t, k):
        (t0, w0), (t1, w1) = schedule
        return w0[k % len(w0)] + (w1[k % len(w1)] - w0[k % len(w0)]) * (t - t0) / (t1 - t0)

    steps = mixing.STEPS if len({w for _, w in schedule}) > 1 else 1
    share = {s: [] for s in names}
    for j in range(steps):
        ws = [weight((j + 0.5) / steps, k) for k in range(len(names))]
        for s, w in zip(names, ws):
            share[s].append(w / sum(ws) / steps if sum(ws) else 0.0)
    whole = {s: sum(share[s]) for s in names}
    left, target, free = sum(total.values()), {}, {s for s in names if whole[s] > 0}
    while free:
        level = left / sum(whole[s] for s in free)
        full = {s for s in free if max_repeat * total[s] <= level * whole[s]}
        if not full:
            target.update({s: level * whole[s] for s in free})
            break
        for s in full:
            target[s] = float(max_repeat * total[s])
            left -= max_repeat * total[s]
        free -= full
    out = {}
    for s in names:
        goal, at = target.get(s, 0.0), 0
        passes = int(goal // total[s]) if total[s] else 0
        curve = [goal * sum(share[s][: j + 1]) / whole[s] if whole[s] else 0.0 for j in range(steps)]
        for _, i, n in sorted(sizes[s]):
            copies = min(max_repeat, passes + (at + n * 0.5 <= goal - passes * total[s]))
            places = []
            for c in range(copies):
                where, low = at + c * total[s], 0.0
                for j, high in enumerate(curve):
                    if where < high or j == steps - 1:
                        places.append(min(1.0, (j + ((where - low) / (high - low) if high > low else 0.0)) / steps))
                        break
                    low = high
            out[i] = (goal, copies, places)
            at += n
    return out


@pytest.mark.parametrize("schedule", [((0.0, (1.0, 2.0, 3.0)), (1.0, (1.0, 2.0, 3.0))), ((0.0, (0.2, 1.0, 3.0)), (1.0, (2.0, 1.0, 0.0))), ((0.0, (0.0, 1.0)), (1.0, (0.0, 5.0))), ((0.0, (0.0,)), (1.0, (0.0,)))])
def test_mix_equals_brute_force(spark, schedule):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randrange(0, 40), rng.choice("aabbbc")) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["mix_id"]: r for r in mixing.plan_mix(docs, schedule).collect()}
    want = brute_mix(rows, schedule, 3)
    assert set(got) == set(want)
    for i, (target, copies, places) in want.items():
        assert got[i]["mix_target"] == pytest.approx(target) and got[i]["mix_copies"] == copies
        assert got[i]["mix_positions"] == pytest.approx(places, abs=1e-9)
    mixed = [r["doc_id"] for r in mixing.mix(docs, schedule).collect()]
    assert sorted(mixed) == sorted(i for i, (_, copies, _) in want.items() for _ in range(copies))
    places = sorted((p, i) for i, (*_, ps) in want.items() for p in ps)
    assert [round(p, 6) for p, _ in places] == [round({c: p for c, p in enumerate(want[i][2])}[mixed[:k].count(i)], 6) for k, i in enumerate(mixed)]


CLASHES = "row string, m string, gone string, drop array<int>, doc string, rev string, text string, doc_id long, pos int, h1 int, mix_id int, mix_hash string, mix_source string, size string, found string, source string, lang string, quality int, key string"


def test_names_of_the_callers_columns_may_be_anything(spark):
    """Columns called as those inside the operators pass through with their values."""
    rows = [("r", "m", "g", [1], "d", "v", f"line\nown {i} " + "word " * 5, i, 1, 2, 3, "mh", "ms", "s", "f", "src", "en", 9, "k") for i in range(4)]
    docs = spark.createDataFrame(rows, CLASHES)
    others = [c for c in docs.columns if c not in ("text", "quality", "lang")]
    want = sorted(tuple(r[c] for c in others) for r in docs.collect())
    profiles = langid.fit_profiles(docs)
    made = {
        "lines": line_dedup.dedup_lines(docs, min_docs=2), "quality": quality.score_quality(docs), "near": near_dup.keep_one(docs),
        "lang": langid.predict_language(docs, profiles, lang="lang", score="size2"),
        "secrets": secret_scan.scan_secrets(docs, secret_scan.train([]), name="quality"), "pii": pii.find_personal_data(docs, pii.train([]), name="quality"),
        "bpe": bpe_jobs.round_trip(docs, BYTE, name="quality"),
    }
    for name, out in made.items():
        assert sorted(tuple(r[c] for c in others) for r in out.collect()) == want, name
    assert set(r["doc_id"] for r in mixing.mix(docs).collect()) <= {0, 1, 2, 3} and mixing.mix(docs).columns == docs.columns
    assert {r["text"] for r in made["lines"].collect()} == {f"own {i} " + "word " * 5 for i in range(4)}
    assert token_files.read_token_files(spark, token_files.write_token_files(docs, WORD, 2, by_word=True)).count() == 4


def test_a_hot_line_and_a_line_of_many_kinds(spark):
    """A line of all documents, and null ids, which are one document together."""
    rows = [(i if i % 4 else None, f"hot\n{i % 7}\nown {i}") for i in range(200)]
    got = sorted(r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=10).collect())
    assert got == sorted(f"own {i}" for i in range(200))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=10)
        assert sorted(r["text"] for r in again.collect()) == got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
