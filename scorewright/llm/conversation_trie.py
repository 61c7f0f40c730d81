"""The trie of conversation prefixes: who shares which first turns, and what sharing them saves.

Every turn becomes a 16-byte digest, so a conversation is a row of digests and text lengths, and texts
are never shuffled. The rows are range-sharded by their digests and then by id: conversations that share
a prefix lie beside each other, and a conversation that a third of all share is cut by id over as many
shards as it needs.

Each shard numbers its digests in a dictionary and inserts its distinct sequences into a ternary search
tree over these numbers, the median first and then the medians of both halves, so the tree is balanced.
One iterative traversal and its reverse sum members, leaves and savings. Nodes that lie on the shard's
first or last sequence may go on in other shards: of these the shard gives only what belongs to it
alone, as one boundary row for either sequence. The boundary rows (two for each shard, however many
conversations it holds) meet in a second tree, which gives the boundary nodes their totals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from scorewright.session import stage

#: Turns that a shard holds on average.
TURNS_PER_SHARD = 50_000
#: Ids in one row of a boundary node's ends.
IDS_PER_CHUNK = 4_096
DIGEST = 16
FAR = 2**63 - 1
NOTHING = hashlib.sha256(b"").hexdigest()

NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
OUT = (
    "kind string, shard long, side int, at_depth long, key binary, path binary, sizes array<int>, x_convs array<long>, "
    "x_first array<long>, x_children array<long>, x_leaves array<long>, x_saved array<long>, first_id long, ids string, " + NODES
)
EDGE_VALUES = ("x_convs", "x_first", "x_children", "x_leaves", "x_saved")


def rebuild(conversations: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, path, sizes) of every rebuilt conversation: digests of its turns in a row, and the UTF-8
    bytes of each text.

    Conversation c takes the first h turns of conversation c - c % group (all, if it has fewer; none, if
    it is absent) and then its own turns after its first h; h = crc32(decimal c) % heads. Turns go by
    number, null first; turns of one number by digest. Null roles and texts are empty, rows without an id
    take no part, and a conversation left without turns stays, with an empty path. Only digests are
    shuffled: a conversation meets in one row of 28 bytes a turn.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
            digest.alias("digest"), F.octet_length(text).alias("size"),
        ).alias("t"),
    )
    own = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    first = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, heads - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    none = F.slice("turns", 1, 0)
    joined = own.join(first, F.col("conv_id") - F.col("conv_id") % group == F.col("head_id"), "left")
    rebuilt = F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), F.slice("turns", h + 1, F.size("turns")))
    return joined.withColumn("turns", rebuilt).select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("path"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )


class SearchTree:
    """A ternary search tree of integer sequences. Node 0 is the root, which stands for no symbol."""

    def __init__(self):
        self.symbol, self.low, self.high, self.down = [0], [-1], [-1], [-1]
        self.parent, self.depth, self.size = [-1], [0], [0]

    def _node(self, symbol: int, parent: int, size: int) -> int:
        for column, value in (
            (self.symbol, symbol), (self.low, -1), (self.high, -1), (self.down, -1),
            (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.size, size),
        ):
            column.append(value)
        return len(self.symbol) - 1

    def insert(self, sequence: Sequence[int], sizes: Sequence[int]) -> list[int]:
        """The nodes of the sequence from the root on, made where they are missing."""
        at, nodes = 0, [0]
        symbol, low, high, down = self.symbol, self.low, self.high, self.down
        for s, size in zip(sequence, sizes):
            cur = down[at]
            if cur < 0:
                cur = down[at] = self._node(s, at, size)
            while symbol[cur] != s:
                side = low if s < symbol[cur] else high
                if side[cur] < 0:
                    side[cur] = self._node(s, at, size)
                cur = side[cur]
            at = cur
            nodes.append(at)
        return nodes

    def insert_sorted(self, sequences: Sequence[tuple[Sequence[int], Sequence[int]]]) -> list[list[int]]:
        """Inserts sorted sequences, medians first; the nodes of each."""
        out: list[list[int]] = [[]] * len(sequences)
        todo = [(0, len(sequences))]
        while todo:
            a, b = todo.pop()
            if a < b:
                m = (a + b) // 2
                out[m] = self.insert(*sequences[m])
                todo += [(a, m), (m + 1, b)]
        return out

    def order(self) -> list[int]:
        """All nodes, each behind its parent."""
        out, todo = [], [0]
        while todo:
            v = todo.pop()
            out.append(v)
            todo += [c for c in (self.high[v], self.low[v], self.down[v]) if c >= 0]
        return out


class Totals:
    """Members, first member, children, leaves and savings of every node, from what each has by itself."""

    def __init__(self, tree: SearchTree):
        n = len(tree.symbol)
        self.tree, self.convs, self.first = tree, [0] * n, [FAR] * n
        self.children, self.leaves, self.saved = [0] * n, [0] * n, [0] * n

    def sum_up(self, open_nodes: set[int]) -> None:
        """Sums over subtrees, children first. Nodes in ``open_nodes`` keep what their closed children
        give them and pass nothing on: their totals need other shards."""
        for v in reversed(self.tree.order()):
            if v in open_nodes:
                continue
            self.leaves[v] = self.leaves[v] if self.children[v] else 1
            self.saved[v] += (self.convs[v] - 1) * self.tree.size[v]
            p = self.tree.parent[v]
            if p >= 0:
                self.convs[p] += self.convs[v]
                self.first[p] = min(self.first[p], self.first[v])
                self.children[p] += 1
                self.leaves[p] += self.leaves[v]
                self.saved[p] += self.saved[v]


def _batch(kind: str, columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    columns = {"kind": [kind] * n, **columns}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema
    )


def _node_columns(t: Totals, nodes: list[int], parents: list[int | None], ends: list[str | None]) -> dict[str, list]:
    pick = lambda values: [values[v] for v in nodes]
    return {
        "conv_id": pick(t.first), "depth": pick(t.tree.depth), "parent_conv_id": parents, "n_convs": pick(t.convs),
        "n_children": pick(t.children), "n_leaves": pick(t.leaves), "saved_tokens": pick(t.saved), "ends_sha256": ends,
    }


def _keys(path: bytes) -> list[bytes]:
    """A digest of every prefix of a path, the empty one first."""
    h = hashlib.md5()
    out = [h.digest()]
    for i in range(0, len(path), DIGEST):
        h.update(path[i : i + DIGEST])
        out.append(h.digest())
    return out


def _coded(paths: Sequence[bytes], sizes: Iterable[Sequence[int]]) -> list[tuple[list[int], Sequence[int]]]:
    """Paths as numbers from a dictionary of their digests, in the digests' order."""
    flat = np.frombuffer(b"".join(paths), dtype=f"S{DIGEST}")
    codes = np.unique(flat, return_inverse=True)[1] if len(flat) else np.zeros(0, np.int64)
    ends = np.cumsum([0] + [len(p) // DIGEST for p in paths])
    return [(codes[a:b].tolist(), s) for a, b, s in zip(ends[:-1], ends[1:], sizes)]


def _shard(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, sizes, members = [], [], []
        for batch in batches:
            for conv, path, size in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if not paths or path != paths[-1]:
                    paths.append(path)
                    sizes.append(size)
                    members.append([])
                members[-1].append(conv)
        if not paths:
            return
        shard = TaskContext.get().partitionId()
        tree = SearchTree()
        nodes = tree.insert_sorted(_coded(paths, sizes))
        t = Totals(tree)
        end_of = {}
        for k, path_nodes in enumerate(nodes):
            v = path_nodes[-1]
            t.convs[v], t.first[v], end_of[v] = len(members[k]), members[k][0], k
        left, right = nodes[0], nodes[-1]
        border = {v: (1, d) for d, v in enumerate(right)} | {v: (0, d) for d, v in enumerate(left)}
        t.sum_up(set(border))

        inner = [v for v in range(len(tree.symbol)) if v not in border]
        joined = lambda k: ",".join(map(str, members[k]))
        ends = [hashlib.sha256(joined(end_of[v]).encode()).hexdigest() if v in end_of else NOTHING for v in inner]
        ups = [tree.parent[v] for v in inner]
        columns = _node_columns(t, inner, [None if p in border else t.first[p] for p in ups], ends)
        if inner:
            yield _batch(
                "node",
                columns
                | {
                    "shard": [shard] * len(inner), "side": [border[p][0] if p in border else None for p in ups],
                    "at_depth": [border[p][1] if p in border else None for p in ups],
                },
                schema,
            )
        for side, k in ((0, 0), (1, len(nodes) - 1)):
            own = [border[v][0] == side for v in nodes[k]]
            if side == 1 and k == 0:
                break
            values = {
                name: [[x[v] if mine else none for v, mine in zip(nodes[k], own)]]
                for name, x, none in zip(EDGE_VALUES, (t.convs, t.first, t.children, t.leaves, t.saved), (0, FAR, 0, 0, 0))
            }
            yield _batch("edge", {"shard": [shard], "side": [side], "path": [paths[k]], "sizes": [sizes[k]], **values}, schema)
            keys = _keys(paths[k])
            for v, mine, key in zip(nodes[k], own, keys):
                if mine and v in end_of:
                    ids = members[end_of[v]]
                    for i in range(0, len(ids), IDS_PER_CHUNK):
                        part = ids[i : i + IDS_PER_CHUNK]
                        yield _batch("ends", {"key": [key], "first_id": [part[0]], "ids": [",".join(map(str, part))]}, schema)

    return run


def _merge(schema: pa.Schema):
    """Boundary rows of all shards to the boundary nodes, and to what each shard's children ask for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for batch in batches for r in batch.to_pylist()), key=lambda r: (r["path"], r["shard"], r["side"]))
        if not rows:
            return
        tree = SearchTree()
        nodes = tree.insert_sorted(_coded([r["path"] for r in rows], [r["sizes"] for r in rows]))
        t, keys = Totals(tree), {}
        for row, path_nodes in zip(rows, nodes):
            for d, (v, key) in enumerate(zip(path_nodes, _keys(row["path"]))):
                keys[v] = key
                t.convs[v] += row["x_convs"][d]
                t.first[v] = min(t.first[v], row["x_first"][d])
                t.children[v] += row["x_children"][d]
                t.leaves[v] += row["x_leaves"][d]
                t.saved[v] += row["x_saved"][d]
        t.sum_up(set())
        every = list(range(len(tree.symbol)))
        parents = [t.first[tree.parent[v]] if v else None for v in every]
        yield _batch("node", _node_columns(t, every, parents, [None] * len(every)) | {"key": [keys[v] for v in every]}, schema)
        for row, path_nodes in zip(rows, nodes):
            n = len(path_nodes)
            yield _batch(
                "asked",
                {"shard": [row["shard"]] * n, "side": [row["side"]] * n, "at_depth": list(range(n)), "conv_id": [t.first[v] for v in path_nodes]},
                schema,
            )

    return run


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and id to the sha256 of each key's ids, one chunk at a time."""
    key, running = None, None
    for batch in batches:
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key and running is not None:
                yield pa.RecordBatch.from_pydict({"end_key": [key], "end_sha256": [running.hexdigest()]}, _ENDS)
            if k != key:
                key, running = k, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
    if running is not None:
        yield pa.RecordBatch.from_pydict({"end_key": [key], "end_sha256": [running.hexdigest()]}, _ENDS)


_ENDS = pa.schema([("end_key", pa.binary()), ("end_sha256", pa.string())])


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of the trie over (conv_id, path, sizes) as ``rebuild`` gives them; ids are unique.

    One row for each distinct sequence of first turns, the empty one included: conv_id (smallest
    member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens (over
    the subtree, (n_convs - 1) times the bytes of the node's last text) and ends_sha256 (of the ids of
    the members that end here, ascending). No conversation at all gives no node. Empty paths end at
    the root; equal paths are one leaf with all their ids.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = paths.sparkSession
    staged = stage(paths)
    if shards is None:
        turns = staged.agg(F.coalesce(F.sum(F.size("sizes") + 1), F.lit(0))).first()[0]
        shards = max(spark.sparkContext.defaultParallelism, -(-turns // TURNS_PER_SHARD))
    schema = to_arrow_schema(StructType.fromDDL(OUT))
    ranged = staged.select("conv_id", "path", "sizes").repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    found = stage(ranged.mapInArrow(_shard(schema), OUT))
    edges = found.where("kind = 'edge'").select("shard", "side", "path", "sizes", *EDGE_VALUES)
    merged = stage(edges.coalesce(1).mapInArrow(_merge(schema), OUT))
    asked = merged.where("kind = 'asked'").select(
        F.col("shard").alias("a_shard"), F.col("side").alias("a_side"), F.col("at_depth").alias("a_depth"), F.col("conv_id").alias("a_conv")
    )
    chunks = found.where("kind = 'ends'").select("key", "ids", "first_id").repartition("key").sortWithinPartitions("key", "first_id")
    ends = chunks.mapInArrow(_digest_ends, "end_key binary, end_sha256 string")

    names = [f.name for f in StructType.fromDDL(NODES).fields]
    inner, outer = found.where("kind = 'node'"), merged.where("kind = 'node'")
    closed = inner.where("side IS NULL").select(*names)
    below = inner.where("side IS NOT NULL").join(
        asked, (F.col("shard") == F.col("a_shard")) & (F.col("side") == F.col("a_side")) & (F.col("at_depth") == F.col("a_depth"))
    )
    below = below.withColumn("parent_conv_id", F.col("a_conv")).select(*names)
    outer = outer.join(ends, F.col("key") == F.col("end_key"), "left")
    outer = outer.withColumn("ends_sha256", F.coalesce("end_sha256", F.lit(NOTHING))).select(*names)
    return closed.unionByName(below).unionByName(outer)


def conversation_trie(conversations: DataFrame, group: int = 5, heads: int = 9, shards: int | None = None) -> DataFrame:
    """The trie of the rebuilt conversations (``rebuild``, ``prefix_trie``); other columns are not read."""
    return prefix_trie(rebuild(conversations.select("conv_id", "turn", "role", "text"), group, heads), shards)
