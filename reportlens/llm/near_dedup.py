"""Near-duplicates by a MinHash LSH forest, confirmed on full shingle sets.

1. Each text becomes its set of 5-word shingles and ``TREES`` x ``DEPTH`` min-hashes. Equal sets fold into one node.
2. Each tree is a sorted order of the nodes by its min-hashes. Nodes that share the first ``SHALLOW`` hashes of a tree
   form a region. A region of at most ``CROWDED`` nodes offers all its pairs; a larger one is divided by the next hash,
   down to ``DEPTH``, and neighbours across the division are offered too.
3. Leaves still crowded at full depth that share nodes form a crowd, and every link of a crowd is found. Its nodes are
   written as their differences from what most of them hold. Two nodes with few enough differences are linked whatever
   these are, and then also to the node with the fewest; any other linked pair has differences in common, and some among
   the rarest of both (prefix filter), so that only nodes that share rare differences are compared: one of them, or where
   that leaves many nodes together two, three or four. A node that needs many common differences meets only nodes that
   hold as many. These links are counted on full sets, and no other pair inside a crowd is one.
4. Other offered pairs are confirmed on the full sets, at first only each node's most often offered partner, then all
   offered pairs between different components whose 120 hashes agree as often as those of linked pairs do (all but one in
   10^9). Links that lie inside a component need no confirmation.

At a similarity of 0.85 a pair shares 3 hashes in a tree with p = 0.61, so that all 20 trees miss it with p = 5e-9, and
6 hashes with p = 0.38: where regions are divided, 20 trees miss one given pair with p = 8e-5. A pair whose nodes are in
one crowd is not missed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportlens.llm.common import travels_by_value
from reportlens.llm.components import components
from reportlens.llm.shingles import min_hashes, mix, multipliers, set_digest, shingle_set
from reportlens.session import cut_lineage

travels_by_value(__name__)
TREES, SHALLOW, DEPTH, CROWDED, SHINGLE, BLOCK, SQUARE, LEVELS = 20, 3, 6, 64, 5, 64, 1024, 4
_BITS = 21


def _signatures(batches):
    factors = multipliers(TREES * DEPTH, 17)
    shift = np.array([2 * _BITS, _BITS, 0], np.uint64)
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            n, digests, keys = [], [], []
            for raw in part.column(1).cast(pa.binary()).to_pylist():
                s = shingle_set(raw, SHINGLE)
                n.append(len(s))
                if len(s):
                    low = mix(min_hashes(s, factors)) & np.uint64((1 << _BITS) - 1)
                    keys.append((low.reshape(-1, 3) << shift).sum(axis=1).astype(np.int64))
                    digests.append(set_digest(s))
                else:
                    keys.append(None)
                    digests.append(None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "keys"])


def _descend(lo, rid, depth, pairs, wholes, leaves):
    """Divide a region until it offers all its pairs; ``lo`` holds hashes 4 to 6, sorted."""
    if len(rid) <= CROWDED:
        wholes.append(rid)
    elif depth == DEPTH:
        leaves.append((lo, rid))
    else:
        cut = np.flatnonzero(np.diff(lo >> np.int64(_BITS * (DEPTH - depth - 1)))) + 1
        if len(cut):
            pairs.append((rid[cut - 1], rid[cut]))
        for a, b in zip(np.r_[0, cut], np.r_[cut, len(rid)]):
            if b - a > 1:
                _descend(lo[a:b], rid[a:b], depth + 1, pairs, wholes, leaves)


def _regions(tree, hi, lo, rid, edges=None):
    """Offers of sorted rows: kind 0 a pair (a, b), kind 1 a node a of a crowded
    leaf, kind 3 a node a of a region that offers all its pairs, b its first
    node. With ``edges``, kind 2 are the rows beside the two ends, which may
    continue in the neighbouring partitions; b is the place in the order."""
    pairs, out = [], []
    cut = np.flatnonzero((np.diff(hi) != 0) | (np.diff(tree) != 0)) + 1
    lo_at, hi_at = np.r_[0, cut], np.r_[cut, len(rid)]
    two = hi_at - lo_at == 2
    pairs.append((rid[lo_at[two]], rid[lo_at[two] + 1]))
    for a, b in zip(lo_at[hi_at - lo_at > 2], hi_at[hi_at - lo_at > 2]):
        wholes: list = []
        leaves: list = []
        _descend(lo[a:b], rid[a:b], SHALLOW, pairs, wholes, leaves)
        for r in wholes:
            out.append((3, r, *(np.full(len(r), x) for x in (r[0], tree[a], hi[a], 0))))
        for leaf, r in leaves:
            out.append((1, r, r, np.full(len(r), tree[a]), np.full(len(r), hi[a]), leaf))
    x, y = (np.concatenate(v) for v in zip(*pairs))
    zero = np.zeros(len(x), np.int64)
    out.append((0, np.minimum(x, y), np.maximum(x, y), zero, zero, zero))
    for s in edges or []:
        out.append((2, rid[s], np.arange(len(rid))[s], tree[s], hi[s], lo[s]))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([np.full(len(o[1]), o[0], np.int32) for o in out])),
         *(pa.array(np.concatenate([o[k] for o in out]).astype(np.int64)) for k in range(1, 6))],
        ["kind", "a", "b", "tree", "hi", "lo"])


def _forest(batches):
    """Stream a sorted partition: regions that are complete are offered, the last one waits for the next batch."""
    held, first = None, True
    for batch in batches:
        now = [batch.column(k).to_numpy() for k in range(4)]
        held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
        tree, hi = held[0], held[1]
        if not len(tree):
            continue
        last = np.flatnonzero((hi != hi[-1]) | (tree != tree[-1]))
        if len(last):
            end = last[-1] + 1
            done = [x[:end] for x in held]
            held = [x[end:] for x in held]
            yield _regions(*done, edges=[slice(0, _run(done))] if first else None)
            first = False
    if held is not None and len(held[0]):
        n = len(held[0])
        yield _regions(*held, edges=[slice(max(0, n - CROWDED), n)] + ([slice(0, min(n, CROWDED))] if first and n > CROWDED else []))


def _run(rows):
    """Length of the first region, at most CROWDED."""
    tree, hi = rows[0], rows[1]
    other = np.flatnonzero((hi != hi[0]) | (tree != tree[0]))
    return min(CROWDED, other[0] if len(other) else len(hi))


def _confirm(batches):
    """Groups arrive as a hub (role 0) and its partners; count common shingles."""
    hub = hub_set = None
    for batch in batches:
        out = []
        for b, salt, role, rid, digest, text in zip(*(c.to_pylist() for c in batch.columns[:5]),
                                                    batch.column(5).cast(pa.binary()).to_pylist()):
            if hub == (b, salt) and role == 0:
                continue
            s = shingle_set(text, SHINGLE)
            if set_digest(s) != digest:
                continue
            if role == 0:
                hub, hub_set = (b, salt), s
            elif hub == (b, salt):
                both = len(np.intersect1d(s, hub_set, assume_unique=True))
                out.append((rid, b, both, len(s) + len(hub_set) - both))
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(4)],
                                         ["a", "b", "common", "all"])


def _beside(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts of ``pairs`` (a, b) of node ids, sorted into groups: b (role
    0), then its partners. The text of b travels once for ``BLOCK`` partners."""
    many = cut_lineage(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
                       .select(F.col("b").alias("_b"), F.ceil(F.col("n") / BLOCK).alias("_n")))
    dealt = pairs.join(many, F.col("b") == F.col("_b"), "left").select(
        "a", "b", F.pmod(F.xxhash64("a"), F.coalesce("_n", F.lit(1))).alias("salt"))
    dealt = cut_lineage(dealt)
    want = (dealt.select("b", "salt", F.lit(1).alias("role"), F.col("a").alias("rid"))
            .unionByName(dealt.select("b", "salt", F.lit(0).alias("role"), F.col("b").alias("rid")).distinct()))
    want = want.join(sets.select("rid", "first", "digest"), "rid")
    t = texts.select(F.col("doc_id").alias("_doc"), "text")
    # Repeated rows of one document would travel once per copy.
    rows = want.join(t, want["first"].eqNullSafe(t["_doc"])).select("b", "salt", "role", "rid", "digest", "text")
    return rows.repartition("b", "salt").sortWithinPartitions("b", "salt", "role", "rid")


def confirm(pairs: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, common, all) for ``pairs`` (a, b) of node ids: sizes of the
    intersection and the union of their full shingle sets."""
    return _beside(pairs, sets, texts).mapInArrow(_confirm, "a long, b long, common long, all long").distinct()


def _apart(batches):
    """Groups arrive as a hub (role 0) and its partners; the shingles that only one of both has."""
    hub = hub_set = None
    for batch in batches:
        out = []
        for b, salt, role, rid, digest, text in zip(*(c.to_pylist() for c in batch.columns[:5]),
                                                    batch.column(5).cast(pa.binary()).to_pylist()):
            if hub == (b, salt) and role == 0:
                continue
            s = shingle_set(text, SHINGLE)
            if set_digest(s) != digest:
                continue
            if role == 0:
                hub, hub_set = (b, salt), s
            elif hub == (b, salt):
                out.append((b, rid, len(s), np.setxor1d(s, hub_set, assume_unique=True).view(np.int64)))
        yield pa.RecordBatch.from_arrays([*(pa.array([o[k] for o in out], pa.int64()) for k in range(3)),
                                          pa.array([o[3] for o in out], pa.list_(pa.int64()))], ["crowd", "rid", "n", "unlike"])


def _forest_of(rid, over, close, held, unit):
    """Links (a, b) that connect whatever the links among these nodes connect; close nodes are connected already."""
    at = np.unique(np.concatenate(held), return_inverse=True)[1]
    row = np.repeat(np.arange(len(rid)), [len(h) for h in held])
    many = np.bincount(at) > 1
    at, row = (np.cumsum(many) - 1)[at[many[at]]], row[many[at]]
    has = np.zeros((len(rid), many.sum()), np.float32)
    has[row, at] = 1
    over, close = np.array(over), np.array(close)
    linked = (over[:, None] + over <= unit * (has @ has.T).astype(np.int64)) | (close[:, None] & close)
    links, new = [], np.ones(len(rid), bool)
    for i in range(len(rid)):
        todo = [i] if new[i] else []
        new[i] = False
        while todo:
            k = todo.pop()
            found = np.flatnonzero(linked[k] & new)
            new[found] = False
            todo += found.tolist()
            links += [(min(rid[k], rid[m]), max(rid[k], rid[m])) for m in found if not (close[k] and close[m])]
    return links


def _squares(unit):
    def run(batches):
        key, rows = None, []
        for batch in batches:
            out = []
            # The differences stay in Arrow's buffer; as lists of Python numbers they would take ten times as much.
            lists, plain = batch.column(6), [batch.column(k).to_pylist() for k in range(6)]
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for n, (*now, rid, over, close) in enumerate(zip(*plain)):
                if now != key:
                    out += _forest_of(*zip(*rows), unit) if len(rows) > 1 else []
                    key, rows = now, []
                rows.append((rid, over, close, values[ends[n]:ends[n + 1]]))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(2)], ["a", "b"])
        out = _forest_of(*zip(*rows), unit) if len(rows) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(2)], ["a", "b"])
    return run


def _crowd_links(leaf: DataFrame, sets: DataFrame, texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect all nodes of ``leaf`` (tree, hi, lo, rid) that links inside a crowd connect, counted on
    full sets; and the crowd (root) of each of its nodes (rid).

    With ``over`` = (100 + percent) * differences - (100 - percent) * shingles
    of a node, two nodes are linked exactly if the sum of their ``over`` is at
    most 2 * (100 + percent) * their common differences. Nodes that are not
    close are dealt into classes by the differences they need, and meet the
    nodes of their own and lower classes: in a class, a node needs what its
    bottom needs, and stays away if it does not hold as many.
    """
    unit = 2 * (100 + percent)
    score = leaf.groupBy("rid").agg(F.count(F.lit(1)).alias("score"))
    any_of = leaf.groupBy("tree", "hi", "lo").agg(F.min("rid").alias("b"))
    roots = components(leaf.join(any_of, ["tree", "hi", "lo"]).select(F.col("rid").alias("a"), "b"))
    roots = cut_lineage(roots.join(score, F.col("id") == F.col("rid")).select("root", "rid", "score"))
    head = roots.groupBy("root").agg(F.max_by("rid", F.struct("score", -F.col("rid"))).alias("b"))
    told = roots.join(head, "root").select(F.col("rid").alias("a"), "b")
    apart = cut_lineage(_beside(told, sets, texts).mapInArrow(_apart, "crowd long, rid long, n long, unlike array<long>")
                        .dropDuplicates(["rid"]))
    size = apart.groupBy("crowd").agg(F.count(F.lit(1)).alias("size"))
    usual = apart.select("crowd", F.explode("unlike").alias("x")).groupBy("crowd", "x").agg(F.count(F.lit(1)).alias("k"))
    usual = cut_lineage(usual.join(size, "crowd").where("2 * k > size").groupBy("crowd").agg(F.collect_list("x").alias("usual")))
    common = F.coalesce("usual", F.array().cast("array<long>"))
    unlike = F.concat(F.array_except("unlike", common), F.array_except(common, "unlike"))
    nodes = apart.join(usual, "crowd", "left").select("crowd", "rid", "n", unlike.alias("unlike"))
    nodes = nodes.withColumn("over", (100 + percent) * F.size("unlike").cast("long") - (100 - percent) * F.col("n"))
    nodes = cut_lineage(nodes.drop("n"))
    least = nodes.groupBy("crowd").agg(F.min(F.struct("over", "rid")).alias("least"), F.max("over").alias("most"))
    least = cut_lineage(least.select("crowd", F.col("least.over").alias("least"), F.col("least.rid").alias("first"), "most"))
    nodes = nodes.join(least, "crowd").withColumn("close", F.col("over") + F.col("least") <= 0)
    star = nodes.where("close and rid <> first").select(F.least("rid", "first").alias("a"), F.greatest("rid", "first").alias("b"))
    nodes = nodes.where("most + least > 0")  # else all are close
    need = F.greatest(F.lit(1), F.ceil((F.col("over") + F.col("least")) / unit)).cast("int")
    nodes = cut_lineage(nodes.withColumn("need", need).where("size(unlike) >= need").select("crowd", "rid", "over", "close", "need", "unlike"))
    nodes = cut_lineage(nodes.join(_items(nodes.select("crowd", "rid", F.explode("unlike").alias("x"))), "rid").drop("unlike"))
    nodes = nodes.withColumn("class", F.when(F.col("close"), 0).otherwise(1 + F.floor(F.log2("need"))).cast("int"))
    bottoms = cut_lineage(nodes.where("not close").groupBy("crowd", "class").agg(F.min("over").alias("bottom")))
    classes = nodes.withColumnRenamed("class", "own").join(bottoms, "crowd").where("own <= class").withColumn("top", F.expr("own = class"))
    least_common = F.greatest(F.lit(1), F.ceil((F.col("over") + F.col("bottom")) / unit)).cast("int")
    classes = classes.withColumn("need", F.when(F.col("top"), F.col("need")).otherwise(least_common)).where("size(held) >= need")
    # Lower nodes need no meeting among each other here, just as close ones need none.
    met = _meetings(cut_lineage(classes.select(F.xxhash64("crowd", "class").alias("crowd"), "rid", (~F.col("top")).alias("close"), "need", "items")))
    # Nodes of a key are dealt into parts; each two parts meet in a task of their own.
    parts = F.ceil(F.col("m") / SQUARE)
    rows = met.withColumn("part", F.pmod(F.xxhash64("rid"), parts)).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "rid")
    rows = rows.join(nodes.select("rid", "over", "close", "held"), "rid").select("key", "i", "j", "rid", "over", "close", "held")
    square = ["key", "i", "j"]
    links = rows.repartition(*square).sortWithinPartitions(*square).mapInArrow(_squares(unit), "a long, b long")
    return cut_lineage(star.unionByName(links)), roots


def _items(each: DataFrame) -> DataFrame:
    """(rid, held, items) of rows (crowd, rid, x): the differences that other
    nodes of the crowd have too. Differences that the same nodes have are one
    item (name, w differences), the items of fewer nodes first, with ``rest``,
    the differences of this and all later items."""
    seen = each.groupBy("crowd", "x").agg(F.count(F.lit(1)).alias("k"), F.bit_xor(F.xxhash64("rid")).alias("s1"),
                                          F.bit_xor(F.xxhash64("rid", F.lit(1))).alias("s2")).where("k > 1")
    rows = each.join(seen, ["crowd", "x"]).groupBy("rid", "k", "s1", "s2").agg(F.collect_list("x").alias("xs"))
    later = Window.partitionBy("rid").orderBy("k", "s1", "s2").rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("w", F.size("xs")).withColumn("rest", F.sum("w").over(later).cast("int"))
    item = F.struct("k", "s1", "s2", "w", "rest")
    return rows.groupBy("rid").agg(F.flatten(F.collect_list("xs")).alias("held"), F.array_sort(F.collect_list(item)).alias("items"))


def _meetings(nodes: DataFrame) -> DataFrame:
    """(key, rid, m): the groups, of m nodes each, in which every two nodes of
    a crowd of ``nodes`` (crowd, rid, close, need, items) meet, one of them not
    close, that have as many differences in common as both need.

    A key is the first common item in the order of rarity, which must leave a
    node enough differences. A key of more than ``SQUARE`` nodes is lengthened
    by the next common one, up to ``LEVELS`` of them; nodes that need no more
    differences than the key has stay under it, too.
    """
    def keyed(of, got):
        return lambda x, i: F.struct(F.xxhash64(of, x["s1"], x["s2"]).alias("key"), i.alias("pos"), (got + x["w"]).alias("got"), x["rest"].alias("rest"))
    enough = lambda got: lambda x: got + x["rest"] >= F.col("need")
    first = F.filter(F.transform("items", keyed("crowd", F.lit(0))), enough(F.lit(0)))
    rows = nodes.select("crowd", "rid", "close", F.inline(first)).drop("rest")
    found = []
    for level in range(1, LEVELS + 1):
        size = cut_lineage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("close").alias("all_close"))
                           .where("m > 1 and not all_close").select("key", "m"))
        sized = cut_lineage(rows.join(size, "key"))
        whole = (F.col("m") <= SQUARE) | (F.col("pos") < 0) if level < LEVELS else F.lit(True)
        found.append(sized.where(whole).select("key", "rid", "m"))
        large = sized.where(~whole)
        if level == LEVELS or large.isEmpty():
            break
        large = large.drop("m").join(nodes.select("crowd", "rid", "need", "items"), ["crowd", "rid"])
        follows = F.filter(F.transform("items", keyed("key", F.col("got"))), lambda x: (x["pos"] > F.col("pos")) & enough(F.col("got"))(x))
        stays = large.where("got >= need").select("crowd", "rid", "close", F.xxhash64("key", F.lit("closed")).alias("key"), F.lit(-1).alias("pos"), "got")
        rows = cut_lineage(large.select("crowd", "rid", "close", F.inline(follows)).drop("rest").unionByName(stays))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return cut_lineage(out)


def _across(batches):
    """The pairs of each region's nodes (rid, root) that are not of one crowd."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            lists, pairs = batch.column(0).slice(at, 500), [(np.empty(0, np.int64), np.empty(0, np.int64))]
            rid, root = (f.to_numpy() for f in lists.flatten().flatten())
            ends = np.cumsum(np.r_[0, lists.value_lengths().to_numpy()])
            for lo, hi in zip(ends[:-1], ends[1:]):
                i, j = np.triu_indices(hi - lo, 1)
                apart = root[lo + i] != root[lo + j]
                x, y = rid[lo + i[apart]], rid[lo + j[apart]]
                pairs.append((np.minimum(x, y), np.maximum(x, y)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*pairs)], ["a", "b"])


def _offers(sets: DataFrame, texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of the forest, (a, b, votes), but for pairs inside a crowd; the links (a, b) of crowds."""
    trees = sets.select("rid", "keys", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = trees.select(F.col("tree").cast("long").alias("tree"), F.col("keys")[2 * F.col("tree")].alias("hi"),
                        F.col("keys")[2 * F.col("tree") + 1].alias("lo"), "rid")
    order = ["tree", "hi", "lo", "rid"]
    made = "kind int, a long, b long, tree long, hi long, lo long"
    found = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_forest, made))
    # Regions that continue in another partition: only the rows beside the cuts, so few that each region is one group.
    cut = found.where("kind = 2").select("tree", "hi", "lo", F.col("a").alias("rid"))

    def joined(frame):
        f = frame.drop_duplicates().sort_values(["tree", "hi", "lo", "rid"])
        return _regions(*(f[c].to_numpy() for c in ["tree", "hi", "lo", "rid"])).to_pandas()

    seams = cut.groupBy("tree", "hi").applyInPandas(joined, made)
    # A region of a seam may begin with the node that one of a partition begins with.
    seams = seams.withColumn("tree", F.when(F.col("kind") == 3, F.col("tree") + TREES).otherwise(F.col("tree")))
    found = found.where("kind <> 2").unionByName(seams)
    leaf = cut_lineage(found.where("kind = 1").select("tree", "hi", "lo", F.col("a").alias("rid")).distinct())
    links, crowds = _crowd_links(leaf, sets, texts, percent) if not leaf.isEmpty() else (
        leaf.select(F.col("rid").alias("a"), F.col("rid").alias("b")), leaf.select(F.col("rid").alias("root"), "rid"))
    # Pairs inside a crowd are left out before they are made: a crowd of n nodes would offer up to n * CROWDED of them a tree.
    nodes = found.where("kind = 3").select("tree", F.col("b").alias("region"), F.col("a").alias("rid"))
    nodes = nodes.join(crowds.select("rid", "root"), "rid", "left").withColumn("root", F.coalesce("root", -1 - F.col("rid")))
    whole = nodes.groupBy("tree", "region").agg(F.collect_list(F.struct("rid", "root")).alias("nodes"))
    pairs = found.where("kind = 0").groupBy("a", "b").agg(F.count(F.lit(1)).alias("votes"))
    for end in ("a", "b"):
        pairs = pairs.join(crowds.select(F.col("rid").alias(end), F.col("root").alias(f"{end}_crowd")), end, "left")
    pairs = pairs.where("a_crowd is null or b_crowd is null or a_crowd <> b_crowd").select("a", "b", "votes")
    pairs = pairs.unionByName(whole.select("nodes").mapInArrow(_across, "a long, b long").withColumn("votes", F.lit(1).cast("long")))
    return cut_lineage(pairs.groupBy("a", "b").agg(F.sum("votes").alias("votes"))), links


def least_agreement(percent: int, hashes: int = TREES * DEPTH, risk: float = 1e-9) -> int:
    """How many of ``hashes`` min-hashes two sets of a similarity of ``percent``
    have in common but for a chance of at most ``risk``."""
    p, below = percent / 100, 0.0
    for n in range(hashes + 1):
        below += math.comb(hashes, n) * p ** n * (1 - p) ** (hashes - n)
        if below > risk:
            return n
    return hashes


def _agreeing(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose signatures have enough hashes in common."""
    mask = (1 << _BITS) - 1

    def hashes(x, y):
        both = x.bitwiseXOR(y)
        return sum(((F.shiftrightunsigned(both, s).bitwiseAND(F.lit(mask)) == 0).cast("int") for s in (0, _BITS, 2 * _BITS)), F.lit(0))
    agree = F.aggregate(F.zip_with("a_keys", "b_keys", hashes), F.lit(0), lambda s, x: s + x)
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("rid").alias(end), F.col("keys").alias(f"{end}_keys")), end)
    return pairs.where(agree >= least_agreement(percent)).select("a", "b")


def near_decisions(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any others): doc_id,
    n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= ``percent`` * union of their
    sets of 5-word shingles (A-Z lower-cased). component_id is the smallest
    doc_id that links reach. Null texts and texts without a word have no
    shingle and stay alone, also among each other. Repeated rows of a kept
    document are all marked kept. Null ids lose to any other.
    """
    seen = cut_lineage(docs.select("doc_id", "text").mapInArrow(
        _signatures, "doc_id long, n_shingles long, digest binary, keys array<long>"))
    sets = cut_lineage(seen.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.first("keys").alias("keys")))
    sets = cut_lineage(sets.withColumn("rid", F.monotonically_increasing_id()))
    texts = docs.select("doc_id", "text")
    offers, sure = _offers(sets, texts, percent)

    def linked(sizes):
        return sizes.where(100 * F.col("common") >= percent * F.col("all")).select("a", "b")

    ends = offers.select("a", "b", "votes").unionByName(offers.select(F.col("b").alias("a"), F.col("a").alias("b"), "votes"))
    best = ends.groupBy("a").agg(F.max_by("b", F.struct("votes", -F.col("b"))).alias("b"))
    best = cut_lineage(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    links = cut_lineage(linked(confirm(best, sets, texts)).unionByName(sure))
    roots = components(links)
    left = offers.join(best, ["a", "b"], "left_anti").select("a", "b")
    for end in ("a", "b"):
        r = roots.select(F.col("id").alias(end), F.col("root").alias(f"{end}_root"))
        left = left.join(r, end, "left")
    left = left.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")
    left = cut_lineage(_agreeing(left, sets, percent))
    roots = components(links.unionByName(linked(confirm(left, sets, texts))))
    rooted = cut_lineage(roots.join(sets.select(F.col("rid").alias("id"), "first", "digest"), "id").select("root", "first", "digest"))
    smallest = cut_lineage(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    linked_sets = cut_lineage(rooted.join(smallest, "root").select("digest", "component_id"))
    named = cut_lineage(sets.select("digest", "first").join(linked_sets, "digest", "left")
                        .select("digest", F.coalesce("component_id", "first").alias("component_id")))
    out = seen.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_copies(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay, one per component, with all columns.
    Rows without a shingle all stay. A doc_id with several rows stays if any of
    them does; rows that repeat its text are one."""
    made = near_decisions(docs, percent)
    ids = made.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.max("n_shingles").alias("n"), F.count(F.lit(1)).alias("rows"))
    known = cut_lineage(ids.where("not kept or (rows > 1 and n > 0)").select(F.col("doc_id").alias("id"), "kept"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    rows = rows.join(known, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    first = F.row_number().over(Window.partitionBy("doc_id", "text").orderBy("kept"))
    repeated = rows.where("kept").withColumn("nth", first).where("nth = 1")
    return rows.where("kept is null").select("row.*").unionByName(repeated.select("row.*"))
