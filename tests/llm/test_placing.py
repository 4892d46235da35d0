"""Sharding, mixing and packing against plain versions, and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reportlens.llm.mixing import BLOCK, apply_mix, mix_decisions, mix_pieces, sizes_of, source_targets, _placed, _slots
from reportlens.llm.packing import fullest, minimum_slack, pack_documents, pack_pieces, sequences, token_pieces
from reportlens.llm.queries import word_vocabulary
from reportlens.llm.sharding import assign_shards, lookup_table, write_shards
from reportlens.session import cut_lineage

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_lookup_table_is_even_and_stable():
    names = [f"n{k}" for k in range(40)]
    table = lookup_table(names, 4099)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1 and len(table) == 4099
    fewer = lookup_table(names[:-1], 4099)
    stayed = (table == fewer)[table != 39].mean()
    assert stayed > 0.75 and (lookup_table(names, 4099) == table).all()
    heavy = np.bincount(lookup_table(["a", "b"], 997, [3, 1]))
    assert abs(heavy[0] / heavy[1] - 3) < 0.05
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            lookup_table(bad)
    with pytest.raises(ValueError):
        lookup_table(["a"], 100)


def test_assignment_follows_the_table(spark, tmp_path):
    import hashlib

    names, slots = ["x", "y", "z"], 101
    docs = spark.createDataFrame([(i % 50, "t", "s") for i in range(90)] + [(None, None, "s")], "doc_id long, text string, slot string")
    got = assign_shards(docs, names, slots=slots)
    table = lookup_table(names, slots)
    for r in got.collect():
        digest = hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()
        assert r.slot == int(digest[:15], 16) % slots and r.shard == table[r.slot] and r.shard_name == names[r.shard]
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    write_shards(got, str(tmp_path / "out"), files=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 91
    assert assign_shards(docs.limit(0), names).count() == 0


def reshared(sizes, weights=(5, 2, 1)):
    """Targets by the words of the contract: share, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > 2 * sizes[s]]
        if not over:
            target.update({s: left * w[s] / total for s in free})
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            free.discard(s)
            left -= target[s]
    return target


def mixed_rows(seed=1, n=400):
    rng = random.Random(seed)
    sources = ["b", "a", "Z", "é", "a1", None, "q", "r"]
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 7, 60, 900])), "en", rng.choice(sources[:rng.choice([1, 8])]), None) for i in range(n)]
    return rows + [(n, None, None, "b", None), (n + 1, "x  y\n z", None, None, 3)]


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_meets_targets(spark, seed):
    rows = mixed_rows(seed)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size[r[0]]
    target = reshared(sizes)
    got = {r.doc_id: r for r in mix_decisions(docs).collect()}
    again = {r.doc_id: r for r in mix_decisions(docs.repartition(2)).collect()}
    assert got == again and len(got) == len(rows)
    taken = {}
    for r in rows:
        g = got[r[0]]
        assert (g.size, g.source_size) == (size[r[0]], sizes[r[3]]) and abs(g.target - target[r[3]]) < 1e-6
        assert 0 <= g.taken <= 2 * g.size
        taken[r[3]] = taken.get(r[3], 0) + g.taken
    assert all(0 <= target[s] - taken[s] < 1 + 1e-9 for s in sizes)


def test_slots_interleave_the_sources(spark):
    rows = [(i, " ".join(["w"] * 100), "en", f"s{i % 3}", None) for i in range(600)]
    sizes = cut_lineage(sizes_of(spark.createDataFrame(rows, DOCS)))
    targets = cut_lineage(source_targets(sizes))
    slots = _slots(targets, 50).collect()
    assert sorted((r.s, r.nth) for r in slots) == sorted(set((r.s, r.nth) for r in slots)) and len({r.slot for r in slots}) == len(slots)
    quota = {r.s: int(-(-r.target // 50)) for r in targets.collect()}
    assert {s: sum(r.s == s for r in slots) for s in quota} == quota
    n = sum(quota.values())
    for end in (n // 10, n // 3, n // 2):  # every beginning of the mix holds the target shares
        for s, q in quota.items():
            assert abs(sum(r.s == s and r.slot < end for r in slots) - q * end / n) < 6
    pieces = mix_pieces(cut_lineage(_placed(sizes, targets, 7)), targets, 50).collect()
    filled = {}
    for p in pieces:
        filled[p.slot] = filled.get(p.slot, 0) + p.n_words
    assert max(filled.values()) <= 50 and sum(v < 50 for v in filled.values()) <= 3


def test_apply_mix_takes_what_was_decided(spark):
    rows = mixed_rows(3, 120)
    docs = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("mine")).withColumn("round", F.lit(9))
    got = apply_mix(docs)
    assert got.columns == docs.columns
    words = {}
    for r in got.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len((r.text or "").split())
        assert r.n_chars is None or r.n_chars == len(r.text) or r.text == dict((x[0], x[1]) for x in rows)[r.doc_id]
    assert words == {r.doc_id: r.taken for r in mix_decisions(docs).collect() if r.taken}
    assert apply_mix(docs.limit(0)).count() == 0 and mix_decisions(docs.limit(0)).count() == 0 and BLOCK > 0


def test_apply_mix_deals_the_sources_by_the_schedule(spark, tmp_path):
    rows = [(i, " ".join(["w"] * 100), "en", f"s{i % 3}", None) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS)
    got = [r.source for r in apply_mix(docs, block=50).collect()]
    share = {r.source: r.target for r in source_targets(sizes_of(docs)).collect()}
    for end in (len(got) // 10, len(got) // 3, len(got) // 2):  # every beginning of the mix holds the target shares
        for s, t in share.items():
            assert abs(got[:end].count(s) - t / sum(share.values()) * end) < 8


def test_apply_mix_moves_its_texts_twice_and_keeps_repeated_rows(spark):
    rows = [(i % 40, " ".join(["w"] * (i % 40)), "en", f"s{i % 2}", None) for i in range(120)]
    rows += [(50, "one two", None, "s0", None), (50, "one two", "en", None, 7), (None, None, None, None, None), (None, "a b c", "en", "s1", 5)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    words, taken = {}, {}
    got = apply_mix(docs)
    for r in got.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len((r.text or "").split())
    for r in mix_decisions(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    assert words == {d: n for d, n in taken.items() if n}
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large tables
    try:
        plan = apply_mix(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Exchange rangepartitioning") == 1


@pytest.mark.parametrize("seed", range(20))
def test_fullest_is_the_best_subset(seed):
    rng = random.Random(seed)
    lengths = [rng.randrange(1, 40) for _ in range(12)]
    left = {n: lengths.count(n) for n in lengths}
    room = rng.randrange(1, 90)
    taken = fullest(left, room)
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= room}
    assert sum(taken) == max(sums) and all(taken.count(n) <= left[n] for n in taken)


def test_minimum_slack_uses_every_piece_once():
    rng = random.Random(0)
    lengths = [rng.randrange(1, 2049) for _ in range(3000)]
    bins = minimum_slack(lengths, 2048)
    assert sorted(i for b in bins for i in b) == list(range(3000)) and all(sum(lengths[i] for i in b) <= 2048 for b in bins)
    assert len(bins) <= 1.02 * -(-sum(lengths) // 2048)


TEXTS = ["İstanbul ΣΑΣ Σ été ŉ ſtart 'S don't x'll a_b __ 12½ ²³ <|endoftext|> x<|startoftext|>y z q\tr\r\nw ́a 👍🏽 你好,世界 ß ẞ ĲĳǄ",
         "ÀÉ!! $%&'()", "", None, "   ", "Ünïcödé'S ..., --", "a" * 70 + " " + "é" * 70, "The end. " * 3000, "word", "word", "Word,", "L'été, L'ÉTÉ!"]


def test_packed_pieces_are_the_tokenizers_ids(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_vocabulary())
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(2, "", 1), (None, "null id", 1)], "doc_id long, text string, length int").repartition(3)
    pieces = token_pieces(docs, word_vocabulary(), with_ids=True)
    packed = cut_lineage(pack_pieces(cut_lineage(pieces)))
    rows = packed.collect()
    for i, t in enumerate(TEXTS):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)[: 2 - (i != 2) + 99 * (i != 2)]
        if i != 2:
            assert np.frombuffer(b"".join(bytes(r.ids) for r in mine), "<u4").tolist() == ids
        for r in mine:
            assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length and r.start == 2048 * r.piece
    made = {r.sequence_id: bytes(r.ids) for r in sequences(packed).collect()}
    for r in rows:
        assert made[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)
    assert sum(len(v) for v in made.values()) == 4 * sum(r.length for r in rows) and max(map(len, made.values())) <= 8192
    assert pack_documents(docs.limit(0), word_vocabulary()).count() == 0


def test_pipeline_stages_take_effect(spark, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.choice([25, 90, 400]))) for _ in range(120)]
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    rows += [(200 + i, texts[i].upper(), "en", "s1", len(texts[i])) for i in range(10)]  # exact copies
    long = [i for i, t in enumerate(texts) if len(t.split()) == 400][:8]
    rows += [(300 + i, texts[i].replace(" w1", " v1", 1), "en", "s2", len(texts[i])) for i in long]  # near copies
    rows += [(400, "too short", "en", "s1", 9), (401, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept, out = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = cut_lineage(stage(spark, out, str(tmp_path)))
        kept.append(out)
        if name != "packing":
            assert out.columns == docs.columns
    after_quality, after_exact, after_near, mixed, packed = kept
    assert {r.doc_id for r in after_quality.collect()} == {r[0] for r in rows if r[0] < 400}
    assert {r.doc_id for r in after_exact.collect()} == set(range(10, 120)) | set(range(200, 210)) | {300 + i for i in long}
    left = {r.doc_id for r in after_near.collect()}
    assert len(left) == 120 and {i for i in range(120) if i not in long and i >= 10} <= left
    words = after_near.agg(F.sum(F.size(F.split("text", " ")))).first()[0]
    assert abs(mixed.agg(F.sum(F.size(F.split("text", " ")))).first()[0] - 1.5 * words) <= 4
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in mixed.collect()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == packed.count()
