"""A trie of conversations: every distinct beginning is a node, with aggregates over its subtree.

1. Turns become 128-bit keys and byte counts where they are read; texts are not moved. A conversation is one row, the
   path of its turn keys.
2. Spark sorts the paths, so that each partition holds one range of the trie and knows the paths just before and after
   it. A task cuts its range into shards of at most ``SHARD`` turns, however many conversations share a beginning.
3. A shard numbers its distinct turns densely and packs a double-array trie: a child of node s by turn t stands at
   BASE[s] + t, and CHECK there names s. Walking it gives every node's members; the nodes in reverse order give the
   subtree sums.
4. Only the nodes on the paths that a shard shares with its neighbours can occur in other shards too. All their numbers
   are sums or minima: a node, a child or a leaf counts in the one shard that it begins (a leaf: ends) in. They are
   merged globally; all other nodes are final.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportlens.llm.common import travels_by_value
from reportlens.session import cut_lineage

travels_by_value(__name__)
SHARD = 200_000


# Conversations ------------------------------------------------------------------------------------------------------

def conversation_paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path) of ``turns`` (conv_id, turn, role, text): path is an array
    of (key, bytes) in the order of turn, null first; turns with equal numbers
    are ordered by key. Null role or text counts as empty. Rows without a
    conv_id take no part."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    each = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", key.alias("key"),
                                                                F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    path = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["key"].alias("key"), t["bytes"].alias("bytes")))
    return each.groupBy("conv_id").agg(path.alias("path"))


def rebuilt_paths(paths: DataFrame, of: int = 5, modulus: int = 9) -> DataFrame:
    """Each conversation c with its first h turns taken from conversation
    c - c % ``of``, h being crc32(c) % ``modulus``; then its own turns after its first h."""
    heads = paths.where(F.col("conv_id") % of == 0).select(
        F.col("conv_id").alias("base"), F.slice("path", F.lit(1), F.lit(modulus - 1)).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus).cast("int")
    own = paths.select("conv_id", "path", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % of).alias("base"))
    rest = F.slice("path", F.col("h") + 1, F.greatest(F.size("path") - F.col("h"), F.lit(0)))
    head = F.slice(F.coalesce("head", F.array().cast(dict(paths.dtypes)["path"])), F.lit(1), F.col("h"))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("path"))


# Double-array trie --------------------------------------------------------------------------------------------------

class DoubleArray:
    """Trie over rows of dense turn ids, sorted so that equal beginnings are together.

    ``base`` and ``check`` are the arrays, ``node`` lists the used places from
    the root down (a parent before its children), ``depth`` their depths.
    """

    def __init__(self, paths):
        n = sum(map(len, paths)) + 2
        self.base, self.check, self.depth = [0] * n, [-1] * n, [0] * n
        self.check[0] = 0
        self.node = [0]
        free = list(range(1, n + 1))  # where to look after a used place
        todo = [(0, 0, len(paths), 0)]
        while todo:
            s, lo, hi, d = todo.pop()
            while lo < hi and len(paths[lo]) == d:
                lo += 1
            if lo == hi:
                continue
            below, at = [], lo
            while at < hi:  # children: rows that go on with the same turn
                t, begin = paths[at][d], at
                step = 1
                while at < hi and paths[at][d] == t:
                    at = min(hi, at + step)
                    step *= 2
                if paths[at - 1][d] != t:  # went too far
                    low, high = begin, at - 1
                    while high - low > 1:
                        mid = (low + high) // 2
                        low, high = (mid, high) if paths[mid][d] == t else (low, mid)
                    at = high
                below.append((t, begin, at))
            base = self._place([t for t, _, _ in below], free)
            self.base[s] = base
            for t, begin, end in below:
                at = base + t
                self.check[at], self.depth[at] = s, d + 1
                self.node.append(at)
                todo.append((at, begin, end, d + 1))

    def _place(self, turns, free):
        """The first BASE that puts all of a node's turns on free places."""
        def next_free(p):
            q = p
            while q < len(self.check) and self.check[q] != -1:
                q = free[q]
            while p < q:  # shorten the way for the next
                free[p], p = q, free[p]
            return q

        first, most = min(turns), max(turns)
        p = next_free(1)
        while True:
            base = p - first
            short = base + most + 1 - len(self.check)
            if short > 0:
                self.base += [0] * short
                self.depth += [0] * short
                free += range(len(self.check) + 1, len(self.check) + short + 1)
                self.check += [-1] * short
            if len(turns) == 1 or all(self.check[base + t] == -1 for t in turns):
                return base
            p = next_free(p + 1)

    def walk(self, path):
        """The places of a path's nodes, the root's first."""
        out = [0]
        for t in path:
            at = self.base[out[-1]] + t
            if not 0 < at < len(self.check) or self.check[at] != out[-1]:
                raise KeyError(t)
            out.append(at)
        return out


def _same(a, b):
    """Turns that two paths begin with in common (-1: no path)."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def shard_nodes(rows, before, after):
    """Node rows of one shard: ``rows`` are (conv_id, keys, bytes) in order,
    ``before`` and ``after`` the neighbouring paths (None: there is none).

    (conv_id, depth, parent, above, node, begins, n_convs, size, children, leaves, saved, ends): ``parent`` is the parent's
    conv_id where that is final; else ``above`` names it. ``node`` names a node
    that other shards may hold.
    """
    turns: dict = {}
    paths = [[turns.setdefault(k, len(turns)) for k in keys] for _, keys, _ in rows]
    trie = DoubleArray(paths)
    size = len(trie.check)
    n, least, sizes = [0] * size, [None] * size, [0] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    ends: dict = {}
    left, right = _same(before, rows[0][1]), _same(rows[-1][1], after)
    shared = {}
    for row, depth in ((0, left), (-1, right)):
        name = hashlib.blake2b(digest_size=16)
        for d, at in enumerate(trie.walk(paths[row])[:depth + 1]):
            if d:
                name.update(rows[row][1][d - 1])
            shared[at] = name.copy().digest()
    # Nodes that the path before has too have begun in an earlier shard.
    begun = set(trie.walk(paths[0])[:left + 1])
    for r, (conv, keys, bytes_) in enumerate(rows):
        places = trie.walk(paths[r])
        for at, b in zip(places, [0, *bytes_]):
            n[at] += 1
            sizes[at] = b
            if least[at] is None or conv < least[at]:
                least[at] = conv
        ends.setdefault(places[-1], []).append(conv)
        follows = rows[r + 1][1] if r + 1 < len(rows) else after
        if _same(keys, follows) < len(keys) or follows is None:  # what follows doesn't go on from here
            leaves[places[-1]] += 1
    for at in reversed(trie.node):
        saved[at] += (n[at] - (at not in begun)) * sizes[at]
        if at:
            up = trie.check[at]
            leaves[up] += leaves[at]
            saved[up] += saved[at]
            children[up] += at not in begun
    for at in trie.node:
        up = trie.check[at]
        yield (least[at], trie.depth[at], least[up] if at and up not in shared else None, shared.get(up) if at else None,
               shared.get(at), n[at], children[at], leaves[at], saved[at], ",".join(map(str, ends.get(at, ()))))


_NODE = ("conv_id long, depth long, parent_conv_id long, above binary, node binary, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends string")


def _shards(shard):
    """Rows arrive by part: the path before it (role 0), its paths (1), the path after it (2)."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.string()]
    names = [c.split()[0] for c in _NODE.split(", ")]

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names)

    def run(batches):
        part = before = None
        rows, held = [], 0
        for b in batches:
            for now, role, conv, keys, bytes_ in zip(*(c.to_pylist() for c in b.columns)):
                if now != part:
                    if rows:
                        yield batch(list(shard_nodes(rows, before, None)))
                    part, before, rows, held = now, None, [], 0
                if role == 0:
                    before = keys
                    continue
                if rows and (role == 2 or held + len(keys) + 1 > shard):
                    yield batch(list(shard_nodes(rows, before, keys)))
                    before, rows, held = rows[-1][1], [], 0
                if role == 1:
                    rows.append((conv, keys, bytes_))
                    held += len(keys) + 1
        if rows:
            yield batch(list(shard_nodes(rows, before, None)))
    return run


def _digest(batches):
    """Groups arrive as pieces in order; SHA-256 of them joined by commas."""
    now = sha = None
    empty = True
    for b in batches:
        out = []
        for node, piece in zip(*(c.to_pylist() for c in b.columns)):
            if node != now:
                if now is not None:
                    out.append((now, sha.hexdigest()))
                now, sha, empty = node, hashlib.sha256(), True
            if piece:
                sha.update(piece.encode() if empty else b"," + piece.encode())
                empty = False
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.string())],
                                         ["node", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([sha.hexdigest()], pa.string())], ["node", "ends_sha256"])


def trie_nodes(paths: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id, path: array of (key,
    bytes)): conv_id (its smallest member), depth, parent_conv_id (root: null),
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Paths without turns belong to the root. Each conv_id is one path. An empty
    table has no node. A task holds one shard, or one conversation if that has
    more turns.
    """
    order = ["keys", "conv_id"]
    rows = paths.select("conv_id", F.col("path.key").alias("keys"), F.col("path.bytes").alias("bytes"))
    sorted_ = cut_lineage(rows.repartitionByRange(*order).select(F.spark_partition_id().alias("part"), F.lit(1).alias("role"), "conv_id", "keys", "bytes"))
    # One row per part: its first and last path go to its neighbours.
    ends = sorted_.groupBy("part").agg(F.min("keys").alias("first"), F.max("keys").alias("last"))
    by_part = Window.orderBy("part")
    ends = cut_lineage(ends.select("part", F.lag("last").over(by_part).alias("before"), F.lead("first").over(by_part).alias("after")))
    none = F.lit(None).cast("long").alias("conv_id"), F.lit(None).cast("array<long>").alias("bytes")
    marks = [ends.where(F.col(c).isNotNull()).select("part", F.lit(role).alias("role"), none[0], F.col(c).alias("keys"), none[1])
             for role, c in ((0, "before"), (2, "after"))]
    dealt = sorted_.unionByName(marks[0]).unionByName(marks[1]).repartition("part").sortWithinPartitions("part", "role", *order)
    nodes = cut_lineage(dealt.mapInArrow(_shards(shard), _NODE))
    alone, pieces = nodes.where("node is null"), nodes.where("node is not null")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = pieces.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("above").alias("above"),
                                        F.min("parent_conv_id").alias("parent_conv_id"), *sums)
    listed = (pieces.where("ends <> ''").select("node", "conv_id", "ends"))
    listed = listed.select("node", F.substring_index("ends", ",", 1).cast("long").alias("first"), "ends")
    hashed = listed.repartition("node").sortWithinPartitions("node", "first").select("node", "ends").mapInArrow(_digest, "node binary, ends_sha256 string")
    merged = merged.join(hashed, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
    merged = cut_lineage(merged)
    both = alone.withColumn("ends_sha256", F.sha2("ends", 256)).drop("ends", "node").unionByName(merged.drop("node"))
    up = merged.select(F.col("node").alias("above"), F.col("conv_id").alias("above_conv"))
    return both.join(up, "above", "left").select(
        "conv_id", "depth", F.coalesce("above_conv", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256")


def conversation_nodes(turns: DataFrame, shard: int = SHARD) -> DataFrame:
    """``trie_nodes`` of the rebuilt conversations of ``turns`` (conv_id, turn, role, text, any others)."""
    paths = cut_lineage(conversation_paths(turns))
    return trie_nodes(rebuilt_paths(paths), shard)
