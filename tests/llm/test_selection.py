"""Exact and near duplicates, repeated passages and quality rules against plain versions."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reportlens.llm import near_dedup, passage_dedup
from reportlens.llm.components import components
from reportlens.llm.exact_dedup import drop_exact_copies, exact_decisions
from reportlens.llm.near_dedup import drop_near_copies, near_decisions
from reportlens.llm.passage_dedup import compact_windows, repeated_passages
from reportlens.llm.quality_rules import apply_quality_rules, quality_decisions
from tests.llm.brute import near_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, size=2000):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).repartition(3)


def near_rows(n_groups=12, seed=3):
    """Groups of edited copies around a base, stray texts, and odd rows."""
    rng, rows = random.Random(seed), []
    for _ in range(n_groups):
        base = words(rng, rng.choice([30, 80, 300]))
        for _ in range(rng.choice([2, 5, 12])):
            edited = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                edited[rng.randrange(len(edited))] = "changed"
            rows.append(" ".join(edited))
    rows += [" ".join(words(rng, 60)) for _ in range(30)] + ["", None, " \t\n", "one two", "ONE  two", "three", "x " * 5000]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_pairs_between_eighty_and_eighty_five_percent(spark):
    rng = random.Random(21)
    rows = []
    for i in range(30):  # one word of 52 changed: 43 of 53 shingles in common
        base = words(rng, 52)
        edited = list(base)
        edited[20] = "changed"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(edited))]
    at_80, at_85 = ({r.doc_id: r.component_id for r in near_decisions(frame(spark, rows), percent).collect()} for percent in (80, 85))
    assert at_80 == {d: d - d % 2 for d, _ in rows} and at_85 == {d: d for d, _ in rows}


def test_near_components_equal_brute_force(spark):
    rows = near_rows()
    got = {r.doc_id: r for r in near_decisions(frame(spark, rows)).collect()}
    want = near_components(rows)
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == want
    assert all(r.kept == (r.component_id == d) for d, r in got.items())


def test_crowded_regions_lose_no_link(spark, monkeypatch):
    """With tiny regions most of a large group is found by neighbours and heads."""
    rng = random.Random(5)
    base = words(rng, 120)
    rows = []
    for i in range(150):
        edited = list(base)
        edited[rng.randrange(120)] = f"e{i}"
        rows.append((i, " ".join(edited)))
    monkeypatch.setattr(near_dedup, "CROWDED", 8)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_decisions(frame(spark, rows).repartition(7)).collect()}
    assert got == near_components(rows)


def test_regions_of_a_crowd_make_no_pairs(spark, monkeypatch):
    """What the forest offers is in proportion to the texts, however many of them share a region; pairs inside a crowd are not made."""
    rng = random.Random(6)
    base, texts = words(rng, 120), []
    for i in range(300):
        edited = list(base)
        for p in rng.sample(range(120), rng.choice([0, 1, 3])):
            edited[p] = f"e{i}"
        texts.append(" ".join(edited + ["end"] * (i % 2)))
    rows = list(enumerate(texts)) + [(300 + i, " ".join(words(rng, 40))) for i in range(20)]
    made, cut = [], near_dedup.cut_lineage

    def counted(df):
        out = cut(df)
        if "kind" in df.columns or "votes" in df.columns:
            made.append(out.count())
        return out
    monkeypatch.setattr(near_dedup, "cut_lineage", counted)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_decisions(frame(spark, rows).repartition(5)).collect()}
    assert got == near_components(rows)
    assert made and max(made) < 30 * len(rows)


def test_linked_pairs_among_unlinked_texts_of_one_template(spark, monkeypatch):
    """All texts end in words of their own, any two are 0.848 alike; partners have two of these in common and are 0.861 alike."""
    rng = random.Random(8)
    base, texts = words(rng, 250), []
    for i in range(200):
        for k in range(2 if i < 60 else 1):
            texts.append(" ".join(base + [f"e{i}x{n}" for n in range(2)] + [f"e{i}x{n}x{k}" for n in range(20)]))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = near_components(rows)
    assert len({c for _, c in want.values()}) == 200
    monkeypatch.setattr(near_dedup, "CROWDED", 16)
    monkeypatch.setattr(near_dedup, "SQUARE", 16, raising=False)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_decisions(frame(spark, rows).repartition(5)).collect()}
    assert got == want


def test_outliers_of_a_crowd_meet_few_of_its_texts(spark, monkeypatch):
    """A tight group, texts too far from it, and links among these: pairs inside a crowd are not read again, and a text
    that needs many differences in common does not meet those that hold few."""
    rng = random.Random(13)
    base, texts = words(rng, 150, 5000), []
    for i in range(300):
        edited = list(base)
        for p in rng.sample(range(150), rng.choice([1, 2, 2]) if i < 200 else 6):
            edited[p] = f"e{rng.randrange(40)}"
        texts.append(" ".join(edited))
        if i >= 280:
            texts.append(texts[-1] + " more")
    rows = list(enumerate(texts))
    want = near_components(rows)
    assert len({c for _, c in want.values()}) > 40
    met, read, meetings, confirm = [], [], near_dedup._meetings, near_dedup.confirm
    monkeypatch.setattr(near_dedup, "CROWDED", 8)
    monkeypatch.setattr(near_dedup, "_meetings", lambda nodes: (out := meetings(nodes), met.append(out.count()))[0])
    monkeypatch.setattr(near_dedup, "confirm", lambda pairs, *a: (read.append(pairs.count()), confirm(pairs, *a))[1])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_decisions(frame(spark, rows)).collect()}
    assert got == want and sum(met) <= 4000 and sum(read) <= 200


def crowd(spark, nodes):
    df = spark.createDataFrame(nodes, "crowd long, rid long, close boolean, need int, unlike array<long>")
    return df.join(near_dedup._items(df.select("crowd", "rid", F.explode("unlike").alias("x"))), "rid").select("crowd", "rid", "close", "need", "items")


def test_meetings_lose_no_pair_that_may_be_linked(spark, monkeypatch):
    """Nodes with the differences they hold, rarest first: two that share as many as either needs meet under a key."""
    monkeypatch.setattr(near_dedup, "SQUARE", 3)
    rng = random.Random(11)
    held = [sorted(rng.sample(range(14), rng.randint(1, 8))) for _ in range(120)]
    nodes = [(7, i, False, rng.randint(1, len(h)), h) for i, h in enumerate(held)]
    df = crowd(spark, nodes)
    groups = {}
    for r in near_dedup._meetings(df).collect():
        groups.setdefault(r.key, set()).add(r.rid)
    met = {(a, b) for g in groups.values() for a in g for b in g if a < b}
    for i, (_, _, _, need, h) in enumerate(nodes):
        for j in range(i + 1, 120):
            if len(set(h) & set(held[j])) >= max(need, nodes[j][3]):
                assert (i, j) in met


def test_rows_of_a_template_grow_with_its_texts(spark, monkeypatch):
    """Texts of one template with two edits from three words: what meets is linear in the texts."""
    monkeypatch.setattr(near_dedup, "SQUARE", 16)
    rows = {}
    for n in (200, 800):
        rng = random.Random(n)
        edits = [[10 * p + rng.randrange(3) for p in rng.sample(range(60), 2)] for _ in range(n)]
        # Ten differences an edit; a text needs twelve in common with any other.
        df = crowd(spark, [(1, i, False, 12, sorted({x * 10 + k for x in e for k in range(10)})) for i, e in enumerate(edits)])
        met = near_dedup._meetings(df)
        rows[n] = met.select(F.sum(F.ceil(F.col("m") / near_dedup.SQUARE))).first()[0] or 0
    assert rows[800] <= 6 * max(rows[200], 200)


def test_rows_that_meet_do_not_jump_where_a_crowd_outgrows_a_key(spark):
    """Copies of one text of 50 shingles with edits anywhere: a text meets under few keys, also if hundreds share each."""
    rng = random.Random(3)
    held = [sorted({x for p in rng.sample(range(46), rng.randint(1, 6)) for x in range(p, p + 5)}) for _ in range(1500)]
    df = crowd(spark, [(1, i, False, max(1, len(h) // 2), h) for i, h in enumerate(held)])
    assert near_dedup._meetings(df).count() <= 12 * 1500


def test_least_agreement_keeps_linked_pairs():
    import numpy as np
    for percent in (80, 85):
        least = near_dedup.least_agreement(percent)
        assert (np.random.default_rng(1).binomial(120, percent / 100, 200_000) >= least).all() and least > 60


def test_near_ties_repeats_nulls(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (2, "A B c d e f"), (None, "a b c d e f"), (None, None), (7, "")]
    got = sorted(map(tuple, near_decisions(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(5, 2, 2, False), (5, 2, 2, False), (2, 2, 2, True), (None, 2, 2, False), (None, 0, None, True), (7, 0, 7, True)], key=str)
    kept = drop_near_copies(frame(spark, rows + [(2, "A B c d e f")]).withColumn("kept", F.lit("x")))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [2, 7] and kept.columns == ["doc_id", "text", "kept"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    for made in (near_decisions, exact_decisions, repeated_passages, quality_decisions, drop_near_copies, drop_exact_copies, apply_quality_rules):
        assert made(docs).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(200, 200)]
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 160)}}


def test_exact_decisions_with_a_hot_text(spark):
    rows = [(i, "Same Text" if i % 3 == 0 else f"t{i // 2}") for i in range(300)] + [(None, "same text"), (None, None), (1000, ""), (297, "sAME text")]
    got = exact_decisions(frame(spark, rows), counters=4).collect()
    groups = {}
    for d, t in rows:
        groups.setdefault((t or "").lower(), []).append(d)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id < 300 and r.doc_id % 3 == 0:
            assert (r.keep_id, r.group_size) == (297, 102)
    assert sum(r.kept for r in got) == len(groups)
    assert {r.keep_id for r in got if r.kept} == {max(d for d in g if d is not None) for g in groups.values()}
    left = drop_exact_copies(frame(spark, rows).withColumn("digest", F.lit(1)).withColumn("heavy", F.lit(2)), counters=4)
    assert left.count() == len(groups) and left.columns == ["doc_id", "text", "digest", "heavy"]


@pytest.mark.parametrize("n", [1, 46, 300, 1000])
def test_compact_windows_partition_the_passages(n):
    """Every passage lies, with its least hash, in exactly one window."""
    import numpy as np

    rng = np.random.default_rng(n)
    h = rng.integers(0, 50, n).astype(np.uint64)
    found = compact_windows(h, 20)
    for i in range(0, n - 20, 7):
        for j in range(i + 19, min(n, i + 120), 11):
            inside = [w for w in found if w[0] <= i <= w[1] <= j <= w[2]]
            assert len(inside) == 1 and h[inside[0][1]] == h[i:j + 1].min()


def test_passages_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(11)
    passages = [words(rng, n) for n in (55, 70, 200)]
    rows, holds = [], {}
    for i in range(120):
        text = words(rng, rng.choice([0, 40, 400]), 10 ** 6)
        for k, p in enumerate(passages):
            if rng.random() < (0.3, 0.1, 0.05)[k]:
                at = rng.randrange(len(text) + 1)
                edited = list(p)
                if k == 2:
                    edited[rng.randrange(len(p))] = "edited"
                text[at:at] = edited
                holds.setdefault(k, set()).add(i)
        rows.append((i, " ".join(text)))
    rows += [(500, "again " * 3000), (501, None), (502, "short"), (None, " ".join(passages[0]))]
    got = repeated_passages(frame(spark, rows).repartition(9)).collect()
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for r in got:
        up[root(r.doc_id)] = root(r.of_doc_id)
        assert r.stop - r.start >= 50 and r.of_stop - r.of_start >= 50 and r.similarity >= 0.8 and r.doc_id > r.of_doc_id
    seen = {r.doc_id for r in got} | {r.of_doc_id for r in got}
    assert seen == set().union(*holds.values())
    for group in holds.values():
        assert len({root(d) for d in group}) == 1


def test_a_line_in_many_documents_of_a_large_host_goes(spark):
    rng = random.Random(17)
    body = lambda: " ".join(words(rng, 30))
    rows = [(i, body() + ("\nAll rights reserved by us" if i < 40 else "") + ("\nYes. No." if i >= 550 else ""), "hot") for i in range(600)]
    df = frame(spark, rows, "doc_id long, text string, source string")
    lost = {r.doc_id for r in quality_decisions(df, max_docs=20).collect() if r.n_removed}
    assert lost == set(range(1, 40)) and not any(r.n_removed for r in quality_decisions(df.where("doc_id < 500")).collect())
    out = {r.doc_id: r.text for r in apply_quality_rules(df, max_docs=20).collect()}
    assert len(out) == 600 and "rights" in out[0] and "rights" not in out[5]


@pytest.mark.parametrize("edits,least", [((), 1.0), ((40, 80), 1.0), ((30, 60, 90), 0.95)])
def test_edited_passages_are_found(spark, edits, least):
    """Also where the whole stretch is not alike enough, but a part of it around the anchor is."""
    rng = random.Random(len(edits))
    strange = lambda n: [f"u{rng.randrange(10 ** 7)}" for _ in range(n)]
    rows = []
    for i in range(60):
        passage = strange(120)
        edited = ["x" + w if k in edits else w for k, w in enumerate(passage)]
        rows += [(2 * i, " ".join(strange(40) + passage + strange(40))), (2 * i + 1, " ".join(strange(40) + edited + strange(40)))]
    got = [r for r in repeated_passages(frame(spark, rows)).collect()]
    assert len({(r.doc_id, r.of_doc_id) for r in got if r.of_doc_id == r.doc_id - 1}) >= least * 60
    texts = {d: t.split() for d, t in rows}
    for r in got:
        x, y = ({tuple(w[k:k + 5]) for k in range(a, b - 4)} for w, a, b in ((texts[r.doc_id], r.start, r.stop), (texts[r.of_doc_id], r.of_start, r.of_stop)))
        assert abs(len(x & y) / len(x | y) - r.similarity) < 1e-9 and r.similarity >= 0.8 and min(r.stop - r.start, r.of_stop - r.of_start) >= 50


@pytest.mark.parametrize("crowd", [256, 2])
def test_passages_beside_partial_quotes_are_found(spark, monkeypatch, crowd):
    """The smallest doc_ids hold 45 of 60 words, too few; two more share all of them."""
    monkeypatch.setattr(passage_dedup, "CROWD", crowd, raising=False)
    rng = random.Random(crowd)
    strange = lambda n: [f"u{rng.randrange(10 ** 7)}" for _ in range(n)]
    rows = []
    for i in range(60):
        p = strange(60)
        rows += [(10 * i + k, " ".join(strange(40) + q + strange(40))) for k, q in enumerate((p[:45], p[15:], p, p))]
    got = {(r.doc_id, r.of_doc_id) for r in repeated_passages(frame(spark, rows)).collect()}
    wanted = {(10 * i + 3, 10 * i + 2) for i in range(60)}
    assert got <= wanted and len(got) >= 57


def test_every_window_of_the_first_document_meets(spark):
    """Document 1 has the hash in two places; document 2 quotes the second one, but meets the first."""
    rng = random.Random(9)
    strange = lambda n: [f"u{rng.randrange(10 ** 7)}" for _ in range(n)]
    five, quoted = strange(5), strange(55)
    quoted[25:25] = five
    docs = frame(spark, [(1, " ".join(strange(50) + five + strange(100) + quoted + strange(50))), (2, " ".join(strange(50) + quoted + strange(50)))])
    first, second, other = (50, 180, 75)
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*[(7, d, x, c - 45, c, c + 45) for d, x, c in ((1, 1, first), (1, 2, second), (2, 3, other))])],
                                       passage_dedup._WINDOW)
    met = spark.createDataFrame([r for b in passage_dedup._meet([batch]) for r in zip(*(c.to_pylist() for c in b.columns))],
                                "kind long, " + ", ".join(f"{c} long" for c in passage_dedup._PAIR))
    found = spark.createDataFrame([], "doc_id long, of_doc_id long, start long, stop long, of_start long, of_stop long, similarity double")
    rows = met.where("kind = 0").select(*passage_dedup._PAIR)
    assert [(r.c, r.bc) for r in rows.collect()] == [(other, first)]
    again = passage_dedup._left_out(rows, found, docs, met.where("kind = 2")).collect()
    assert [(r.a, r.b, r.c, r.bc) for r in again] == [(2, 1, other, second)]


def test_quality_rules_small(spark):
    common = "the very same line stands here"
    rows = []
    for i in range(40):
        own = " ".join(f"d{i}x{k}" for k in range(30))
        rows.append((i, f"{own}\n{common}", "en", "a", None))
    rows += [(100, f"{common}\n{common}\n" + " ".join(f"z{k}" for k in range(18)), "en", "a", None), (101, None, None, None, None),
             (102, "", "en", None, 0), (103, " ".join("abcdefgh") + " " + " ".join(["abcdefgh x y z u v w q"] * 9), "en", "b", 1)]
    docs = frame(spark, rows, DOCS)
    got = {r.doc_id: r for r in quality_decisions(docs).collect()}
    assert got[0].n_removed == 0 and got[1].n_removed == 6 and got[1].kept  # the first bearer keeps the line
    assert not got[100].base_failed and got[100].n_removed == 12 and not got[100].kept  # depleted
    assert (got[101].n_words, got[101].kept, got[102].base_failed) == (0, False, True)
    assert got[103].n_repeat_words == 72 and got[103].base_failed
    out = {r.doc_id: r for r in apply_quality_rules(docs.withColumn("removed", F.lit("mine"))).collect()}
    assert set(out) == set(range(40)) and common in out[0].text and common not in out[1].text
    assert out[1].n_chars == len(out[1].text) and out[1].removed == "mine" and out[0].n_chars is None
