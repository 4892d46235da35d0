"""Repeated passages of at least ``length`` bytes, found by suffix order and removed.

1. Every window of ``length`` bytes names one anchor in it: the place of its least hashed ``GRAM`` bytes (the first of
   equals). Equal windows name equal anchors, so only the suffixes that start at anchors need an order: about one byte
   in ``(length - GRAM) / 2``. The windows of an anchor span its context, the bytes that it is compared by.
2. Anchors are counted by gram; a gram seen once names no repeat. Equal contexts of a gram are one class: a class seen
   twice is covered whole. What is left to order are grams with several classes.
3. Deep-shallow sorting orders the classes of a gram, once by the bytes from the anchor on and once by the bytes before
   it, read backwards: multikey quicksort down to ``SHALLOW`` bytes below what all share, then a blind trie for each
   group that is still together. From both orders and their common prefixes, each class learns with whom it shares most.
4. A gram of more than ``GROUP`` classes (a line in a third of all texts) is first divided on Spark: the windows that
   hold the anchor in their first half go apart from the others, so that both share more bytes than the gram, and again
   until the groups are small, alone, or equal.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlens.llm.common import travels_by_value
from reportlens.session import cut_lineage

travels_by_value(__name__)
LENGTH, GRAM, SHALLOW, GROUP, CHUNK = 400, 100, 8, 1024, 1 << 18
_ODD = 0x9E3779B97F4A7C15


# Anchors ------------------------------------------------------------------------------------------------------------

def _powers(n):
    """Powers of an odd number and of its inverse, modulo 2^64."""
    inverse = pow(_ODD, -1, 1 << 64)
    up, down = np.full(n, _ODD, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _least(values, width):
    """Minimum of each ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values, have = np.minimum(values[:-step], values[step:]), have + step
    return values


def text_anchors(data, first, last, length, gram, byte_values, powers):
    """Anchors of the windows that start in [first, last) of ``data``: arrays
    (gram hash, anchor, first window, last window, hash of the context)."""
    up, down = powers
    part = data[first:last + length - 1]
    n = len(part)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(byte_values[part] * up[:n], out=sums[1:])
    grams = (sums[gram:] - sums[:-gram]) * down[:n - gram + 1]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    bits = np.uint64(n.bit_length())
    mask = (np.uint64(1) << bits) - np.uint64(1)
    at = (_least((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & mask).astype(np.int64)
    cut = np.flatnonzero(np.diff(at)) + 1
    lo, hi = np.r_[0, cut], np.r_[cut, len(at)] - 1
    context = (sums[hi + length] - sums[lo]) * down[lo]
    return grams[at[lo]], at[lo] + first, lo + first, hi + first, context


def _anchors(length, gram):
    """One row per anchor. ``stop`` ends its last window; ``times`` counts the
    places of a run of equal contexts, as in a text of one repeated letter."""
    def run(batches):
        byte_values = np.random.default_rng(5).integers(0, 1 << 64, 256, np.uint64)
        powers = _powers(CHUNK + length + 1)
        for batch in batches:
            out = []
            for doc_id, text_id, raw in zip(*(c.to_pylist() for c in batch.columns)):
                data = np.frombuffer(raw, np.uint8)
                for first in range(0, len(data) - length + 1, CHUNK):
                    last = min(first + CHUNK, len(data) - length + 1)
                    grams, at, lo, hi, context = text_anchors(data, first, last, length, gram, byte_values, powers)
                    new = np.r_[True, (grams[1:] != grams[:-1]) | (context[1:] != context[:-1]) | (np.diff(at) > length)
                                | (np.diff(at - lo) != 0) | (np.diff(hi - lo) != 0)]
                    start = np.flatnonzero(new)
                    end = np.r_[start[1:], len(new)] - 1
                    for g, a, x, y, s, k in zip(grams[start].view(np.int64).tolist(), at[start].tolist(), lo[start].tolist(),
                                                (hi[start] + length).tolist(), (hi[end] + length).tolist(), (end - start + 1).tolist()):
                        mark = hashlib.blake2b(raw[x:y], digest_size=14).digest() + (a - x).to_bytes(2, "little")
                        out.append((doc_id, text_id, g, mark, a, x, y, s, k))
                        if len(out) == 20000:
                            yield _anchor_rows(out)
                            out = []
            yield _anchor_rows(out)
    return run


_ANCHOR = "doc_id long, text_id binary, gram long, context binary, at long, lo long, hi long, stop long, times long"


def _anchor_rows(out):
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)],
                                      [c.split()[0] for c in _ANCHOR.split(", ")])


# Deep-shallow sorting -----------------------------------------------------------------------------------------------

def common_prefix(a: bytes, b: bytes, lo: int = 0) -> int:
    """Length of the common prefix; the first ``lo`` bytes are known to agree."""
    hi = min(len(a), len(b))
    if a[lo:hi] == b[lo:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class _Node:
    """A branch of a blind trie: how many bytes all below share, and what follows (-1: the string ends)."""

    __slots__ = ("depth", "below")

    def __init__(self, depth, below):
        self.depth, self.below = depth, below


def blind_trie(strings, ids, known):
    """``ids`` in the order of their strings, which agree in ``known`` bytes, and
    the common prefix of each with the one before. Equal strings keep the order of ids.

    A string goes down by the branching bytes alone, is compared once with a
    string it meets there, and is hung where the two part.
    """
    def byte(s, at):
        return s[at] if at < len(s) else -1

    root = [ids[0]]
    for i in ids[1:]:
        s, node = strings[i], root
        while isinstance(node, _Node):
            node = node.below.get(byte(s, node.depth)) or next(iter(node.below.values()))
        other = strings[node[0]]
        same = common_prefix(s, other, known)
        if same == len(s) == len(other):
            node.append(i)
            continue
        above, node = None, root
        while isinstance(node, _Node) and node.depth < same:
            above, node = (node, byte(s, node.depth)), node.below[byte(s, node.depth)]
        if isinstance(node, _Node) and node.depth == same:
            node.below[byte(s, same)] = [i]
            continue
        branch = _Node(same, {byte(other, same): node, byte(s, same): [i]})
        if above is None:
            root = branch
        else:
            above[0].below[above[1]] = branch
    order, shared, todo = [], [], [(root, known)]
    while todo:
        node, above = todo.pop()
        if isinstance(node, _Node):
            keys = sorted(node.below)
            todo += [(node.below[k], node.depth if n else above) for n, k in reversed(list(enumerate(keys)))]
        else:
            order += node
            shared += [above] + [len(strings[node[0]])] * (len(node) - 1)
    return order, shared


def deep_shallow(strings, shallow=SHALLOW):
    """(order, shared): the strings' numbers in sorted order and the common
    prefix of each with the one before it (0 for the first)."""
    order, shared = [], []
    todo = [(list(range(len(strings))), 0, 0, None)]  # group, bytes in common, shared with what stands before, levels left
    while todo:
        ids, depth, above, left = todo.pop()
        if len(ids) == 1:
            order += ids
            shared.append(above)
            continue
        if left is None:  # multikey quicksort starts below what the whole group shares
            depth, left = common_prefix(min(strings[i] for i in ids), max(strings[i] for i in ids), depth), shallow
        if left == 0:
            o, s = blind_trie(strings, ids, depth)
            order += o
            shared += [above] + s[1:]
            continue
        at = [strings[i][depth] if depth < len(strings[i]) else -1 for i in ids]
        pivot = sorted((at[0], at[len(at) // 2], at[-1]))[1]
        parts = [[i for i, b in zip(ids, at) if b < pivot], [i for i, b in zip(ids, at) if b == pivot],
                 [i for i, b in zip(ids, at) if b > pivot]]
        rows, before = [], above
        for k, part in enumerate(parts):
            if not part:
                continue
            if k == 1 and pivot == -1:  # all end here: equal strings
                rows += [([i], depth, before if n == 0 else depth, left) for n, i in enumerate(part)]
            else:
                rows.append((part, depth + (k == 1), before, left - (k == 1)))
            before = depth
        todo += reversed(rows)
    if shared:
        shared[0] = 0
    return order, shared


# Longest matches on both sides --------------------------------------------------------------------------------------

def _range_least(values):
    """Sparse table of minima."""
    rows, step = [np.array(values, np.int64)], 1
    while 2 * step <= len(values):
        rows.append(np.minimum(rows[-1][:-step], rows[-1][step:]))
        step *= 2
    return rows


def matches(bodies, at, length):
    """{(number, bytes before the anchor, bytes from it on)}: the widest
    stretches of at least ``length`` bytes around the anchor that a body has in
    common with another one.

    Bodies that share the most bytes after the anchor meet first. Inside what
    has met, the neighbours by the order before the anchor share most there, so
    that each meeting asks two neighbours only, for the smaller side.
    """
    right, after = deep_shallow([b[a:] for b, a in zip(bodies, at)])
    left, before = deep_shallow([b[:a][::-1] for b, a in zip(bodies, at)])
    rank = [0] * len(bodies)
    for n, i in enumerate(left):
        rank[i] = n
    table = _range_least(before)

    def backwards(x, y):  # common bytes before the anchors of the ranks x < y
        k = (y - x).bit_length() - 1
        return int(min(table[k][x + 1], table[k][y - (1 << k) + 1]))

    found, best = set(), {}
    group = [[rank[i]] for i in right]  # by place in the order; a merged group is held by all its places' head
    head = list(range(len(right)))

    def top(p):
        while head[p] != p:
            head[p] = head[head[p]]
            p = head[p]
        return p

    for p in sorted(range(1, len(right)), key=lambda p: -after[p]):
        r = after[p]
        if r + max(at) < length:
            break
        a, b = top(p - 1), top(p)
        if len(group[a]) > len(group[b]):
            a, b = b, a
        large = group[b]
        for x in group[a]:
            k = bisect_left(large, x)
            for y in large[max(0, k - 1):k + 1]:
                common = backwards(min(x, y), max(x, y))
                if common + r >= length:
                    for z in (x, y):
                        if common > best.get(z, -1):
                            best[z] = common
                            found.add((left[z], common, r))
        group[b] = sorted(large + group[a])
        head[a], group[a] = b, []
    return found


def _sorted_groups(length):
    """Groups arrive sorted by key: the stretches of each class."""
    def solve(rows):
        out = matches([r[1] for r in rows], [r[2] for r in rows], length) if len(rows) > 1 else ()
        return [(rows[i][3], rows[i][4] - before, rows[i][4] + behind) for i, before, behind in out if rows[i][5] < 2]

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.int64()))],
                                          ["text_id", "start", "stop"])

    def run(batches):
        rows = []
        for b in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if rows and rows[0][0] != row[0]:
                    out += solve(rows)
                    rows = []
                rows.append(row)
            yield batch(out)
        yield batch(solve(rows))
    return run


# The operator -------------------------------------------------------------------------------------------------------

def _divided(rows: DataFrame, length: int, group: int) -> tuple[DataFrame, DataFrame]:
    """Groups of at most ``group`` classes, and the stretches settled on the way.

    ``rows``: key, u, v (the group holds the windows that start u to v bytes
    before the anchor), body, before (bytes of the body before the anchor),
    times, and the class's text_id, at.
    """
    small, settled = [], []
    while True:
        size = cut_lineage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        sized = cut_lineage(rows.join(size, "key"))
        small.append(sized.where(F.col("n") <= group).drop("n"))
        large = sized.where(F.col("n") > group).drop("n")
        if large.isEmpty():
            break
        mid = F.floor((F.col("u") + F.col("v")) / 2).cast("long")
        halves = large.withColumn("half", F.explode(F.array(F.struct(F.col("u").alias("u"), mid.alias("v")),
                                                            F.struct((mid + 1).alias("u"), F.col("v").alias("v"))))).drop("u", "v")
        halves = halves.select("*", F.col("half.u").alias("u"), F.col("half.v").alias("v")).drop("half").where("u <= v")
        near = F.greatest(F.lit(0), F.col("before") + length - F.octet_length("body"))  # the least window start before the anchor
        halves = halves.where((near <= F.col("v")) & (F.col("before") >= F.col("u")))
        # What all windows of the half have in common names it; the bytes of any of them tell classes apart.
        core = F.expr(f"substring(body, int(before - u + 1), int({length} - v + u))")
        begin = F.greatest(F.lit(0), F.col("before") - F.col("v"))
        hull = F.expr(f"substring(body, int(greatest(0, before - v) + 1), int(before - u + {length} - greatest(0, before - v)))")
        halves = halves.select(F.sha2(F.concat_ws(":", "u", "v", F.sha2(core, 256)), 256).alias("key"), "u", "v", hull.alias("body"),
                               (F.col("before") - begin).alias("before"), "times", "text_id", "at")
        halves = cut_lineage(halves)
        mark = F.sha2(F.concat_ws(":", "before", F.sha2("body", 256)), 256)
        classes = halves.select("key", "u", "v", mark.alias("mark"), "body", "before", "times", "text_id", "at")
        one = classes.groupBy("key", "mark").agg(F.min(F.struct("text_id", "at")).alias("one"), F.sum("times").alias("all"))
        one = cut_lineage(one)
        both = classes.join(one, ["key", "mark"])
        settled.append(both.where("all > 1 and times = 1").select(
            "text_id", (F.col("at") - F.col("before")).alias("start"), (F.col("at") - F.col("before") + F.octet_length("body")).alias("stop")))
        rows = cut_lineage(both.where((F.col("one.text_id") == F.col("text_id")) & (F.col("one.at") == F.col("at")))
                           .select("key", "u", "v", "body", "before", F.col("all").alias("times"), "text_id", "at"))
    out = small[0]
    for s in small[1:]:
        out = out.unionByName(s)
    done = out.limit(0).select("text_id", F.col("at").alias("start"), F.col("at").alias("stop"))
    for s in settled:
        done = done.unionByName(s)
    return out, done


def _raw(docs: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(raw)).alias("text_id"), raw.alias("raw"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int | None = None, group: int = GROUP) -> DataFrame:
    """(text_id, spans) of the texts of ``docs`` (doc_id, text, any others) that
    hold a repeat. spans: stretches (start, stop) of bytes, in no order and
    overlapping, that together are what strings of ``length`` bytes cover that
    start anywhere else too. text_id is the MD5 of the text, whose copies have
    equal spans. Null counts as empty; shorter texts and empty tables have none.
    """
    gram = gram or max(1, min(GRAM, length // 4))
    texts = _raw(docs).where(F.octet_length("raw") >= length)
    anchors = cut_lineage(texts.mapInArrow(_anchors(length, gram), _ANCHOR))
    again = cut_lineage(anchors.groupBy("gram").agg(F.sum("times").alias("seen")).where("seen > 1").select("gram"))
    hits = cut_lineage(anchors.join(again, "gram"))
    classes = cut_lineage(hits.groupBy("gram", "context").agg(
        F.sum("times").alias("times"), F.min(F.struct("text_id", "doc_id", "at", "lo", "hi")).alias("one")))
    whole = classes.where("times > 1").select("gram", "context")
    covered = hits.join(whole, ["gram", "context"]).select("text_id", F.col("lo").alias("start"), "stop")
    several = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    apart = classes.join(several, "gram").select("gram", "times", "one.*")
    # A text travels once for all that is wanted of it, and so does only one of its copies.
    want = apart.groupBy("text_id", F.col("doc_id").alias("_doc")).agg(F.collect_list(F.struct("gram", "times", "at", "lo", "hi")).alias("want"))
    cuts = texts.join(want.withColumnRenamed("text_id", "_text"), (F.col("text_id") == F.col("_text")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
    cuts = cuts.select("text_id", "raw", F.explode("want").alias("w"))
    rows = cuts.select(F.hex("w.gram").alias("key"), F.lit(0).cast("long").alias("u"), F.lit(length - gram).cast("long").alias("v"),
                       F.expr("substring(raw, int(w.lo + 1), int(w.hi - w.lo))").alias("body"),
                       (F.col("w.at") - F.col("w.lo")).alias("before"), "w.times", "text_id", "w.at")
    # Rows that repeat a doc_id and its text are one.
    rows = cut_lineage(rows.dropDuplicates(["key", "text_id", "at", "before"]))
    groups, settled = _divided(rows, length, group)
    found = (groups.select("key", "body", "before", "text_id", "at", "times").repartition("key").sortWithinPartitions("key")
             .mapInArrow(_sorted_groups(length), "text_id binary, start long, stop long"))
    spans = covered.unionByName(found).unionByName(settled)
    return spans.groupBy("text_id").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def _remove(batches):
    for batch in batches:
        out = []
        for doc_id, raw, starts, stops in zip(*(c.to_pylist() for c in batch.columns)):
            kept, end, at, n = [], 0, -1, 0
            for start, stop in sorted(zip(starts or (), stops or ())):
                if start > at:  # a new run
                    n += 1
                    kept.append(raw[end:start])
                at = end = max(end, stop)
            out.append((doc_id, b"".join(kept) + raw[end:], len(raw), n))
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.int64(), pa.int64()))],
                                         ["doc_id", "kept", "n_bytes", "n_spans"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int | None = None, group: int = GROUP) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any others): doc_id, kept
    (the UTF-8 bytes that stay), n_bytes of the text, n_spans removed.

    A byte goes if a string of ``length`` bytes covers it that starts anywhere
    else too, in this or another row; strings are judged on the input. A null
    text counts as empty, a null doc_id is kept, repeated rows repeat each other.
    """
    spans = repeated_spans(docs, length, gram, group).withColumnRenamed("text_id", "_text")
    rows = _raw(docs)
    rows = rows.join(spans, rows["text_id"] == spans["_text"], "left").select("doc_id", "raw", "spans.start", "spans.stop")
    return rows.mapInArrow(_remove, "doc_id long, kept binary, n_bytes long, n_spans long")


def removal_decisions(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``remove_repeats`` as numbers: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    out = remove_repeats(docs, length)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))
