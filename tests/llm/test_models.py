"""The models against enumeration, finite differences and plain decoding, and their bounded samples."""

import itertools
import random
import re

import numpy as np
import pytest

from scorewright.llm import crf, langid, pii, samples, secret_scan


def path_score(scores, labels, start, trans):
    return start[labels[0]] + sum(scores[i, x] for i, x in enumerate(labels)) + sum(trans[a, b] for a, b in zip(labels, labels[1:]))


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(1)
    lengths = np.array([4, 0, 1, 5, 3, 5])
    scores, start, trans = rng.normal(size=(lengths.sum(), 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    got = crf.viterbi(scores, lengths, start, trans)
    for a, n in zip(np.cumsum(lengths) - lengths, lengths):
        if n:
            best = max(itertools.product(range(3), repeat=int(n)), key=lambda x: path_score(scores[a : a + n], x, start, trans))
            assert got[a : a + n].tolist() == list(best)
    assert crf.viterbi(np.zeros((3, 2)), np.array([3]), np.zeros(2), np.zeros((2, 2))).tolist() == [0, 0, 0]  # ties


def test_likelihood_and_gradients_equal_enumeration_and_differences():
    rng = np.random.default_rng(2)
    scores, start, trans = rng.normal(size=(3, 4, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    labels, mask = rng.integers(0, 3, size=(3, 4)), np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], bool)

    def loss():
        total = 0.0
        for s, y, m in zip(scores, labels, mask):
            n = int(m.sum())
            every = [path_score(s[:n], p, start, trans) for p in itertools.product(range(3), repeat=n)]
            total += np.log(np.exp(every).sum()) - path_score(s[:n], y[:n].tolist(), start, trans)
        return total / 3

    value, *grads = crf.likelihood(scores, labels, mask, start, trans)
    assert value == pytest.approx(loss())
    for array, grad in zip((scores, start, trans), grads):
        for at in np.ndindex(array.shape):
            keep, h = array[at], 1e-6
            array[at] = keep + h
            up = loss()
            array[at] = keep - h
            down = loss()
            array[at] = keep
            assert grad[at] == pytest.approx((up - down) / (2 * h), abs=1e-6)


@pytest.mark.parametrize("side", ["f", "r"])
def test_network_gradients_equal_differences(side):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2, 5, pii.EMBED))
    p = {"x" + side: rng.normal(size=(pii.EMBED, 4 * pii.HIDDEN)) / 4, "h" + side: rng.normal(size=(pii.HIDDEN, 4 * pii.HIDDEN)) / 4, "b" + side: rng.normal(size=4 * pii.HIDDEN)}
    weigh = rng.normal(size=(2, 5, pii.HIDDEN))
    loss = lambda: float((pii._run(x, p, side, False)[0] * weigh).sum())
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    grads["in"] = pii._run_back(weigh, x, p, side, pii._run(x, p, side, True)[1], grads)
    for name, array in {**p, "in": x}.items():
        for at in [tuple(rng.integers(0, n) for n in array.shape) for _ in range(12)]:
            keep, h = array[at], 1e-6
            array[at] = keep + h
            up = loss()
            array[at] = keep - h
            down = loss()
            array[at] = keep
            assert grads[name][at] == pytest.approx((up - down) / (2 * h), abs=1e-5)


def plain_decode(field, text):
    """Viterbi over every token of the text, those outside islands open to outside only."""
    known = {}
    for island in secret_scan.islands(text):
        known.update(zip(island.spans, secret_scan._scores(island, field.weights)))
    tokens = [m.span() for m in secret_scan.TOKEN.finditer(text)]
    if not tokens:
        return []
    scores = np.array([known.get(t, secret_scan.OUTSIDE[0]) for t in tokens])
    out = []
    for place, label in zip(tokens, crf.viterbi(scores, np.array([len(tokens)]), field.start, field.trans)):
        if label == 1:
            out.append(("crf", *place))
        elif label == 2:
            out[-1] = ("crf", out[-1][1], place[1])
    return out


def test_secrets_are_decoded_over_the_whole_text():
    rng = random.Random(4)
    parts = ["word", "aB3dE6gH", "x=aB3dE6gH==", "(q9W8e7R6t5)", "password", "hunterhunter", "12345678", "the", "key:", "AbCdEfGh", "é", ".", "-", "secret\n", "\t"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(300)]
    weights = np.random.default_rng(5).normal(size=(secret_scan.WIDTH, 3))
    start, trans = secret_scan._constrained()
    trans[trans == 0] = np.random.default_rng(6).normal(size=8)
    field = secret_scan.Field(weights, start, trans)
    found = [field.spans(t) for t in texts]
    assert found == [plain_decode(field, t) for t in texts]
    assert any(found) and all(not re.search(r"\s", t[a:b]) for t, spans in zip(texts, found) for _, a, b in spans)


def test_where_a_secret_may_begin():
    begins = lambda text: [text[a:b] for i in secret_scan.islands(text) for (a, b), may in zip(i.spans, i.begins) if may]
    assert begins("the password hunterhunter or 12345678 so far away hunterhunter") == ["password", "hunterhunter", "12345678"]
    assert begins("a hunterhunter and 12345678 alone") == [] and begins("x aB3dE6gH y") == ["aB3dE6gH"]
    assert begins("SECRET") == ["SECRET"] and begins("key aB3dE6gH") == ["aB3dE6gH"] and begins("") == begins(" \n") == []
    text = "keykey " * 2000
    assert len(begins(text)) == 2000  # overlapping surroundings are cut once


def brute_distance(ranked, own, size):
    return sum(min(abs(ranked.index(c) - i), size) if c in ranked else size for i, c in enumerate(own))


def test_out_of_place_distance_equals_brute_force():
    rng = random.Random(7)
    for size in (5, 20):
        ranked = {lang: rng.sample(range(60), rng.randrange(1, size + 1)) for lang in ("aa", "bb", "cc")}
        profiles = langid.Profiles(ranked, size)
        for _ in range(50):
            own = rng.sample(range(80), rng.randrange(1, size + 1))
            got = profiles.distances(np.array(own, np.uint32))
            assert got.tolist() == [brute_distance(ranked[lang], own, size) for lang in sorted(ranked)]


def test_profile_ranks_equal_brute_force():
    text = "Der Hund, der DEN Hund sah"
    codes, counts = langid.ngrams(text)
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    letters = f" {letters} "
    want = {}
    for n in (1, 2, 3):
        for i in range(len(letters) - n + 1):
            gram = letters[i : i + n]
            ok = gram.isalpha() if n == 1 else gram.strip() != "" if n == 2 else gram[1] != " "
            if ok:
                want[gram] = want.get(gram, 0) + 1
    assert sorted(counts) == sorted(want.values())
    top = langid.profile(codes, counts, 3)
    assert [counts[list(codes).index(c)] for c in top] == sorted(want.values(), reverse=True)[:3]


@pytest.mark.parametrize("n,least", [(10, 1.0), (1500, 1.0), (2 * 10**10, 0.0), (10**13, 0.0)])
def test_share_of_a_language_never_vanishes(n, least):
    """The bound on hashes keeps about 1,500 of n documents at any n."""
    bound = langid.hash_bound(n, 1500)
    assert 0 < bound < 2**63 and bound / 2**63 * n == pytest.approx(min(n, 1500), rel=1e-6)
    assert bound / 2**63 >= least - 1e-9


def cut_words(text):
    for w in text.split():
        yield w.startswith("L"), w[:5]


def test_samples_are_bounded_by_document_and_in_all(spark):
    hot = [(7, f"L{i} " * 50 + "u " * 50) for i in range(400)]
    rows = hot + [(i, "L u u") for i in range(100, 160)] + [(None, "L u"), (8, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = samples.sample_examples(docs, cut_words, sample_docs=40, limit=60, share=3)
    assert len(got) == 60 == len(samples.sample_examples(docs, cut_words, 40, 60, 3))
    assert sum(x.startswith("L") and x != "L" for x in got) <= 3
    assert 25 <= sum(x.startswith("L") for x in got) <= 35
    assert samples.sample_examples(docs.where("false"), cut_words, 40, 60, 3) == []
    long = spark.createDataFrame([(1, "L" + "x" * 20_000_000 + " u" * 100)], "doc_id long, text string")
    assert sorted(samples.sample_examples(long, cut_words, 10, 10, 2)) == ["Lxxxx", "u", "u"]
    assert samples.sample_examples(docs, cut_words, 40, 60, 3) == samples.sample_examples(docs.repartition(3), cut_words, 40, 60, 3)


def test_a_trained_tagger_meets_odd_texts():
    texts = [f"write to a{i}@b{i}.com or +1 (017) 555-77{i:02d} now" for i in range(60)]
    tagger = pii.train(texts)
    assert tagger.spans("") == [] and tagger.spans("no sign") == []
    assert tagger.spans_of(["", "x@y", "1" * 5000, "é@" * 300]) is not None
    long = "plain words " * 50_000 + " a1@b1.com " + "1 2 3 " * 30_000
    found = tagger.spans(long)
    assert all(0 <= a < b <= len(long) for _, a, b in found)
