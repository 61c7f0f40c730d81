"""The conversation trie against brute force, in one shard and in many, and on odd rows."""

import hashlib
import random
import zlib

import pytest

from scorewright.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, path string, kind int"


def brute(rows):
    """Nodes by full prefixes, straight from the definition."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for prefix, members in nodes.items():
        below = [p for p in nodes if p[: len(prefix)] == prefix]
        leaves = [p for p in below if not any(q[:-1] == p for q in nodes if q)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in members if built[c] == prefix)))
        out.append(
            (
                min(members), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(members),
                sum(1 for q in nodes if q and q[:-1] == prefix), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def made(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        common = rng.random() < 0.4
        for turn in range(rng.randrange(1, 14)):
            text = f"common {turn}" if common and turn < rng.randrange(12) else rng.choice(["a", "bb", "é", ""]) * rng.randrange(3)
            rows.append((c, turn if rng.random() < 0.9 else None, rng.choice(["user", None]) if not common else "user", text, "p", 1))
    # Ties in a turn's number are left out here: they go by digest.
    seen, out = set(), []
    for r in rows:
        if r[:2] not in seen:
            seen.add(r[:2])
            out.append(r)
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("shards", [1, 3, 17])
def test_equals_brute_force(spark, shards):
    rows = made(shards)
    got = trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), shards=shards).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_one_conversation_that_most_share(spark, monkeypatch):
    """Its ids are cut over several shards and chunks, and hashed in order all the same."""
    monkeypatch.setattr(trie, "IDS_PER_CHUNK", 7)
    rows = [(c, t, "user", f"turn {t}", None, None) for c in range(400) for t in range(4)]
    rows += [(1000 + c, 0, "user", f"other {c}", None, None) for c in range(40)]
    got = trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), shards=9).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (5, None, None, None, "x", 1), (5, 1, "user", "a", "x", 1), (5, 1, "user", "a", "x", 1),  # a repeated row is two turns
        (6, 2, "user", "b", None, 2), (None, 1, "user", "lost", None, 2),
        (13, 0, "user", "long " * 100_000, None, 2), (-7, 0, "user", "minus", None, 2),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, trie.conversation_trie(frame).collect()), key=str)
    rebuilt = {r["conv_id"]: (len(r["path"]) // 16, list(r["sizes"])) for r in trie.rebuild(frame).collect()}
    assert set(rebuilt) == {5, 6, 13, -7} and sum(n for n, _ in rebuilt.values()) == sum(len(s) for _, s in rebuilt.values())
    assert got[0][1] is not None and sum(r[1] == 0 for r in got) == 1
    root = next(r for r in got if r[1] == 0)
    assert root[:4] == (-7, 0, None, 4)
    assert trie.conversation_trie(frame.where("false")).count() == 0
    assert trie.conversation_trie(frame.where("conv_id IS NULL")).count() == 0


def test_ties_do_not_depend_on_row_order(spark):
    rows = [(5, 1, "user", t, None, None) for t in "abc"] + [(10, 1, "user", t, None, None) for t in "cab"]
    frame = spark.createDataFrame(rows, SCHEMA)
    paths = {bytes(r["path"]) for r in trie.rebuild(frame).collect()}
    assert len(paths) == 1


def test_search_tree_is_balanced_and_iterative():
    sequences = [([k], [1]) for k in range(1023)] + [([2000] * 5000, [1] * 5000)]
    tree = trie.SearchTree()
    nodes = tree.insert_sorted(sequences)
    assert len(tree.symbol) == 1 + 1023 + 5000 and len(nodes[-1]) == 5001

    def height(v):
        deepest, todo = 0, [(v, 1)]
        while todo:
            v, d = todo.pop()
            deepest = max(deepest, d)
            todo += [(c, d + 1) for c in (tree.low[v], tree.high[v]) if c >= 0]
        return deepest

    assert height(tree.down[0]) <= 12
    order = tree.order()
    place = {v: i for i, v in enumerate(order)}
    assert len(order) == len(tree.symbol) and all(place[tree.parent[v]] < place[v] for v in order if v)
