"""Prefix tries, suffix order and hard negatives against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportlens.llm.hard_negatives import RTree, hard_negatives, prepare, shifted_labels, str_order
from reportlens.llm.prefix_trie import DoubleArray, conversation_nodes
from reportlens.llm.suffix_dedup import blind_trie, common_prefix, deep_shallow, matches, removal_decisions, remove_repeats, repeated_spans

TURNS = "conv_id long, turn long, role string, text string"


def plain_nodes(turns):
    """Nodes by the words of the contract."""
    own = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, key, (role, text)))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + v[h:])
    members, ends = {}, {}
    for c, path in built.items():
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    below = Counter(p[:-1] for p in members if p)
    out = []
    for p, convs in members.items():
        under = [q for q in members if q[:len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q)
        out.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), below[p], sum(not below[q] for q in under), saved,
                    hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()))
    return sorted(out, key=str)


def nodes_of(df, shard):
    out = conversation_nodes(df, shard).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r) for r in out.collect()), key=str)


def some_turns(seed, convs, most=6):
    rnd = random.Random(seed)
    out = []
    for c in rnd.sample(range(4 * convs), convs):
        for turn in range(rnd.randint(0, most)):
            hot = turn == 0 and rnd.random() < 0.5
            out.append((c, turn, "user", "hello é" if hot else rnd.choice(["a", "b", "c é", "", None])))
    return out


@pytest.mark.parametrize("shard", [1, 7, 200_000])
def test_trie_equals_plain_nodes(spark, shard):
    turns = some_turns(shard, 60)
    turns += [(0, 50, None, "x"), (0, None, "user", None), (0, 51, None, "x"), (None, 1, "user", "lost"), (7, 3, "user", "tie"), (7, 3, "user", "tie2")]
    turns += [(1000 + i, t, "user", f"t{t}") for i in range(12) for t in range(9)]  # many equal conversations
    df = spark.createDataFrame(turns, TURNS).repartition(3).withColumn("node", F.lit(1)).withColumn("part", F.lit("x"))
    assert nodes_of(df, shard) == plain_nodes(turns)


def test_trie_of_little_and_of_long(spark):
    empty = spark.createDataFrame([], TURNS)
    assert conversation_nodes(empty).collect() == []
    assert nodes_of(spark.createDataFrame([(None, 1, "a", "b")], TURNS), 10) == []
    one = [(c, 1, "user", "t") for c in (1, 2, 3, 4)]  # h > 0 and no conversation 0: turnless
    assert nodes_of(spark.createDataFrame(one, TURNS), 10) == plain_nodes(one)
    long = [(5, t, "user", f"{t % 3}") for t in range(3000)] + [(6, t, "user", f"{t % 3}") for t in range(3000)] + [(7, 1, "user", "y" * 300_000)]
    got = {r[:2]: r for r in nodes_of(spark.createDataFrame(long, TURNS), 500)}
    deepest = max(d for c, d in got if c == 5)
    assert deepest == 3000 and got[(5, 0)][3] == 3 and got[(5, 10)][3] == 2 and got[(5, 3000)][4:7] == (0, 1, 1)


def test_double_array_walks_every_path():
    rnd = random.Random(3)
    paths = sorted([rnd.randint(0, 40) for _ in range(rnd.randint(0, 6))] for _ in range(500))
    trie = DoubleArray(paths)
    places = {}
    for p in paths:
        for d, at in enumerate(trie.walk(p)):
            assert places.setdefault(at, tuple(p[:d])) == tuple(p[:d]) and trie.depth[at] == d
    assert len(places) == len({tuple(p[:d]) for p in paths for d in range(len(p) + 1)}) == len(trie.node)
    with pytest.raises(KeyError):
        trie.walk([41])


def plain_removal(docs, length):
    raws = [(t or "").encode() for _, t in docs]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (doc, _), r in zip(docs, raws):
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(r, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed, length, n):
    """Texts of chance letters, cut passages that recur, and letters in runs."""
    rnd = random.Random(seed)
    chance = lambda k: "".join(rnd.choice("abcdeé ") for _ in range(k))
    known = [chance(rnd.randint(length // 2, 3 * length)) for _ in range(4)] + ["a" * (3 * length), "ab" * (2 * length)]
    docs = []
    for i in range(n):
        text = ""
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(known)
            text += chance(rnd.randint(0, 2 * length)) if rnd.random() < 0.6 else p[rnd.randint(0, len(p) // 3):len(p) - rnd.randint(0, len(p) // 3)]
        docs.append((i, text))
    return docs + [docs[0], (n, None), (n + 1, ""), (None, docs[1][1]), (n + 2, docs[2][1])]


def removal_of(df, length, group):
    out = remove_repeats(df, length, None, group).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("gone"), "n_spans", F.sha2("kept", 256))
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("seed,length,n,group", [(1, 40, 60, 1024), (2, 40, 60, 3), (3, 24, 40, 2), (4, 400, 30, 2)])
def test_removal_equals_all_windows(spark, seed, length, n, group):
    docs = passages(seed, length, n)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("text_id", F.lit("x")).withColumn("key", F.lit(1)).withColumn("gram", F.lit(2))
    assert removal_of(df.repartition(3), length, group) == plain_removal(docs, length)


def test_removal_of_one_passage_in_all_texts(spark):
    """A hot gram: every text holds the passage between bytes of its own; groups are divided on Spark."""
    rnd = random.Random(9)
    own = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(10, 90)))
    passage = own() * 3
    docs = [(i, own() + passage + own()) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert removal_of(df, 60, 8) == plain_removal(docs, 60)


def test_removal_small_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert removal_decisions(empty).collect() == [] and repeated_spans(empty).collect() == []
    half = "é" * 100 + "x" * 200  # 400 bytes
    docs = [(1, half), (2, "y" + half[:-1]), (3, half[1:]), (4, "z" * 401), (5, "q" * 400)]
    got = {r.doc_id: r for r in removal_decisions(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[k].n_removed for k in range(1, 6)] == [0, 0, 0, 401, 0] and got[4].n_spans == 1
    assert got[1].kept_sha256 == hashlib.sha256(half.encode()).hexdigest() and got[4].kept_sha256 == hashlib.sha256(b"").hexdigest()


def test_long_texts_are_cut_into_chunks(spark):
    """Two long texts share all but their beginnings, so that chunks end elsewhere in them."""
    rnd = random.Random(4)
    long = "".join(rnd.choice("abcdefghij") for _ in range(700_000))
    docs = [(1, long), (2, "nothing else" + long), (3, "b" * 600_000)]
    got = {r.doc_id: r for r in removal_decisions(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 700_000 and got[2].n_removed == 700_000 and got[2].n_spans == 1 and got[3].n_removed == 600_000


def test_deep_shallow_sorts():
    rnd = random.Random(1)
    for _ in range(200):
        base = bytes(rnd.choice(b"ab") for _ in range(30))
        strings = [base[:rnd.randint(0, 30)] + bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 6))) for _ in range(rnd.randint(1, 40))]
        order, shared = deep_shallow(strings, rnd.choice([0, 1, 3, 8]))
        assert [strings[i] for i in order] == sorted(strings)
        assert all(shared[k] == common_prefix(strings[order[k - 1]], strings[order[k]]) for k in range(1, len(order)))
        o, s = blind_trie(strings, list(range(len(strings))), 0)
        assert [strings[i] for i in o] == sorted(strings) and s[1:] == shared[1:]


def test_matches_find_the_widest():
    rnd = random.Random(2)
    for _ in range(60):
        at = [rnd.randint(0, 12) for _ in range(rnd.randint(2, 12))]
        bodies = [bytes(rnd.choice(b"ab") for _ in range(a)) + b"anchor" + bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 9))) for a in at]
        want = set()
        for i, (x, a) in enumerate(zip(bodies, at)):
            for j, (y, b) in enumerate(zip(bodies, at)):
                left, right = common_prefix(x[:a][::-1], y[:b][::-1]), common_prefix(x[a:], y[b:])
                if i != j and left + right >= 12:
                    want |= {(i, p) for p in range(a - left, a + right)}
        assert {(i, p) for i, left, right in matches(bodies, at, 12) for p in range(at[i] - left, at[i] + right)} == want


VECTORS = "vec_id long, embedding array<float>, label int"


def plain_negatives(rows, every=100):
    held = []
    for vec, e, label in rows:
        if vec is not None and label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e):
            held.append((vec, (label + 1) % 10 if vec % 7 == 0 else label, [int(np.floor(256 * float(np.float32(x)))) for x in e]))
    held = list({(v, lab, tuple(e)) for v, lab, e in held})
    out = []
    for anchor, label, a in held:
        if anchor % every:
            continue
        scored = [(sum(x * y for x, y in zip(a, b)), vec, lab) for vec, lab, b in held if vec != anchor]
        best = sorted((s for s in scored if s[2] == label), key=lambda s: (-s[0], s[1]))[:5]
        for ps, pos, _ in best:
            inside = sorted((s for s in scored if s[2] != label and 80 * ps <= 100 * s[0] <= 100 * ps), key=lambda s: (-s[0], s[1]))[:5]
            out += [(anchor, pos, k + 1, neg, ps, s) for k, (s, neg, _) in enumerate(inside)]
    return sorted(out)


def some_vectors(seed, n, width=6):
    rnd = random.Random(seed)
    centre = [[rnd.gauss(0, 1) for _ in range(width)] for _ in range(3)]
    return [(i, [c + rnd.gauss(0, 0.4) for c in rnd.choice(centre)], rnd.randint(0, 3)) for i in range(n)]


@pytest.mark.parametrize("block,group", [(4096, 256), (64, 3)])
def test_negatives_equal_plain_search(spark, block, group):
    rows = some_vectors(block, 600)
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(40)]  # a vector that recurs: ties
    rows += [rows[5], (700, None, 1), (800, [1.0, None] * 3, 1), (900, [float("nan")] * 6, 1), (2000, [float("inf")] + [1.0] * 5, 2),
             (2100, [1.0] * 6, None), (None, [1.0] * 6, 1), (2200, [0.5, 0.5], 1), (2300, [], 2)]
    df = spark.createDataFrame(rows, VECTORS).repartition(4).withColumn("group", F.lit(1)).withColumn("ids", F.lit("x"))
    got = hard_negatives(shifted_labels(prepare(df)), block=block, group=group)
    assert sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) == plain_negatives(rows)


def test_negatives_of_little(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives(shifted_labels(prepare(empty))).collect() == []
    few = [(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 2), (2, [1.0, 0.1], 1), (100, [1e30, -1e30], 3)]
    assert hard_negatives(prepare(spark.createDataFrame(few, VECTORS))).select("negative_id").collect() == [(1,)]


def test_tree_boxes_bound_their_vectors():
    rng = np.random.default_rng(1)
    v = rng.integers(-50, 50, (700, 5))
    v = v[str_order(v, [2, 0, 1, 3, 4])]
    assert sorted(map(tuple, v)) == sorted(map(tuple, v[str_order(v, [])]))
    tree, anchors = RTree(v), rng.integers(-9, 9, (4, 5))
    bounds = tree.bounds(anchors)
    for level, (lo, hi) in enumerate(bounds):
        per = tree.leaf * tree.fanout ** level
        for n in range(lo.shape[1]):
            scores = anchors @ v[n * per:(n + 1) * per].T
            assert (scores.min(axis=1) >= lo[:, n]).all() and (scores.max(axis=1) <= hi[:, n]).all()
    got = tree.search(anchors[0], [(lo[0], hi[0]) for lo, hi in bounds], np.ones(700, bool), np.arange(700), [(-40, 40)], 5)
    score = v @ anchors[0]
    want = sorted(((int(s), -i) for i, s in enumerate(score) if -40 <= s <= 40), reverse=True)[:5]
    assert [(s, -i) for _, s, i in got] == want
