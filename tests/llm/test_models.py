"""Held-out accuracy of the learned operators and the rules beside them."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportlens.llm import url_filter
from reportlens.llm.language_id import predict_languages
from reportlens.llm.toxicity import label_model, toxicity_scores
from reportlens.llm.url_filter import differences, judge_urls, stretch_counts


def crc(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode())


def test_languages(spark):
    rng = random.Random(1)
    sounds = {"aa": "ka lo mi re".split(), "bb": "sch ung heit ber".split(), "cc": "oux ée tion ç".split()}
    rows = []
    for i in range(300):
        lang = rng.choice(sorted(sounds))
        text = " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.choice([3, 40, 400])))
        rows.append((i, text, lang if i % 10 else None, lang))
    rows += [(1000, None, "aa", None), (1001, "123 !?", "aa", None), (1002, "", None, None), (None, "kalomi", "aa", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in predict_languages(docs).collect()}
    assert len(got) == len(rows) and [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    right = [got[i].lang_pred == lang for i, _, _, lang in rows if lang]
    assert sum(right) >= 0.97 * len(right)
    assert all(got[i].held_out == (crc(i) % 4 == 2) and 0 <= got[i].score <= 1 for i, *_ in rows if i is not None)
    assert got[None].lang_pred == "aa"


def test_languages_without_anything_learned(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert predict_languages(docs).collect()[0].lang_pred == "und"
    assert predict_languages(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def toxic(spark):
    rng, rows, labels = random.Random(2), [], []
    bad = ["idiot", "grobol", "zarnik", "zarniv", "zarnot", "flimsk"]
    for i in range(1500):
        text = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([20, 80, 300]))]
        label = int(rng.random() < 0.15)
        for _ in range(4 * label):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text)))
        if rng.random() < 0.5:
            labels.append((i, label))
        elif label:
            rows[-1] = (i, " ".join(text))
    rows += [(9000, None), (9001, ""), (None, "a b c")]
    labels += [(None, 1), (9000, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), rows, dict(labels), bad


def test_toxicity_on_held_out_rows(toxic):
    docs, labels, rows, _, bad = toxic
    got = {r.doc_id: r for r in toxicity_scores(docs, labels).collect()}
    assert len(got) == len(rows)
    wrong = [d for d, t in rows if d is not None and got[d].predicted != int(any(b in (t or "").split() for b in bad))]
    assert len(wrong) <= 0.02 * len(rows)
    for d, r in got.items():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (crc("" if d is None else d) % 5 == 0)


def test_toxicity_never_reads_held_out_labels(spark, toxic):
    docs, labels, _, _, _ = toxic
    flipped = spark.createDataFrame([(r.doc_id, 1 - r.toxic if r.toxic is not None and crc(r.doc_id) % 5 == 0 else r.toxic)
                                     for r in labels.collect()], "doc_id long, toxic int")
    a = {r.doc_id: r.score for r in toxicity_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity_scores(docs, flipped).collect()}
    assert a == b


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "you idiot idiot idiot"), (2, "a calm text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity_scores(docs, none).count() == 2 and toxicity_scores(docs.limit(0), none).count() == 0


def test_label_model_discounts_copied_voters():
    """Three copies of a poor voter outvote three good ones in a majority, not in the model."""
    rng = np.random.default_rng(4)
    truth = rng.random(20000) < 0.3
    poor = np.where(rng.random(20000) < 0.65, truth, ~truth)
    good = [np.where(rng.random(20000) < 0.9, truth, ~truth) for _ in range(3)]
    votes = np.stack([poor, poor, poor, *good], 1) + 1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    post = dict(zip(map(tuple, patterns), label_model(patterns, counts.astype(float))))
    said = np.array([post[tuple(v)] >= 0.5 for v in votes])
    majority = (votes == 2).mean(1) >= 0.5
    assert (said == truth).mean() > (majority == truth).mean() + 0.1


def test_url_rules_and_parts(spark):
    urls = ["https://A.Example.org/es/1", "http://example.org/en/12", "http://x.com/fr/", "http://com/de/x?y", "http://org", "http://org/",
            "noscheme.org/es/", None, "://", "http://badexample.org/es/", "http://h.net#/es/", "http://u:p@h.ORG/?q"]
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert [got[i].rule for i in range(12)] == ["example.org/es/", "example.org/en/1", "com/fr/", "com/de/", None, "org/", None, None, None, "org/", None, "org/"]
    assert [got[i].verdict for i in (0, 1, 2, 3, 5, 9)] == ["block", "block", "allow", "block", "allow", "allow"]
    assert (got[0].host, got[0].path) == ("a.example.org", "/es/1") and (got[4].host, got[4].path) == ("org", "")
    assert (got[6].host, got[6].path, got[7].host, got[7].path) == ("", "", "", "") and (got[10].host, got[10].path) == ("h.net", "")
    assert (got[11].host, got[11].path, got[8].verdict) == ("u:p@h.org", "/", "allow")


def plain_log_likelihood(texts, text, order=5):
    """Per character, by Witten-Bell counts of ``texts`` kept in dictionaries."""
    counts = {}
    for t in texts:
        t = "\x02" * order + t + "\x03"
        for i in range(order, len(t)):
            for k in range(order + 1):
                after = counts.setdefault(t[i - k:i], {})
                after[t[i]] = after.get(t[i], 0) + 1
    t, total = "\x02" * order + text + "\x03", 0.0
    for i in range(order, len(t)):
        p = 1 / 256
        for k in range(order + 1):
            after = counts.get(t[i - k:i], {})
            if after:
                p = (after.get(t[i], 0) + len(after) * p) / (sum(after.values()) + len(after))
        total += math.log(p)
    return total / (len(t) - order)


def test_url_differences_equal_a_plain_model(spark):
    rng = random.Random(12)
    make = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 14)))
    learn = [(make("abcé/"), 1, i % 3 == 0) for i in range(30)] + [(make("bcd/𝄞"), 0, i % 3 == 0) for i in range(30)]
    texts = [(i, t, back) for i, (t, _, back) in enumerate(learn) if back] + [(100, "abz", False), (101, "d" * 3000, False), (102, "é𝄞", False)]
    counts = stretch_counts(spark.createDataFrame(learn, "text string, label int, back boolean"))
    got = {r.id: r.d for r in differences(spark.createDataFrame(texts, "id long, text string, back boolean"), counts).collect()}
    for i, t, back in texts:
        kept = [(x, label) for x, label, held in learn if not (back and held)]
        accepted, rejected = (plain_log_likelihood([x for x, label in kept if label == want], t) for want in (1, 0))
        assert abs(got[i] - (accepted - rejected)) < 1e-9


def test_url_model_gains_from_more_data(spark):
    rng = random.Random(13)
    words = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(3000)] for _ in range(2)]
    learned = lambda label, n: [f"http://h{k}.{('com', 'org')[label]}/{('de', 'fr')[label]}/{rng.choice(words[label])}" for k in range(n)]
    right = []
    for n in (300, 6000):
        new = [(label, f"http://h{k}.net/xx/{rng.choice(words[label])}") for label in (0, 1) for k in range(200)]
        urls = learned(0, n) + learned(1, n) + [u for _, u in new]
        got = {r.page_id: r.verdict for r in judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
        right.append(np.mean([(got[2 * n + k] == "allow") == bool(label) for k, (label, _) in enumerate(new)]))
    assert right[1] > right[0] + 0.2 and right[1] >= 0.9


def test_url_repeated_rows_and_ties(spark):
    urls = ["http://a.org/x", "http://b.com/de/x"] * 5 + ["http://c.net/x"] * 3 + ["http://c.net/" + "y" * 20000]
    got = [(r.verdict, r.difference) for r in judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn(
        "text", F.lit("z"))).orderBy("page_id").collect()]
    assert len(got) == 14 and len(set(got[10:13])) == 1 and got[13][0] in ("allow", "block")


def test_url_joins_send_no_growing_table_through_the_driver(spark, monkeypatch):
    """A written table of addresses is small beside the stretches made of it."""
    plans, cut = [], url_filter.cut_lineage

    def recorded(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)
    monkeypatch.setattr(url_filter, "cut_lineage", recorded)
    urls = [f"http://{k}.{tld}/{way}/{k}" for k in range(40) for tld, way in (("org", "en"), ("com", "de"), ("net", "fr"))]
    judged = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    plans.append(judged._jdf.queryExecution().executedPlan().toString())
    assert judged.count() == 120 and sum("SortMergeJoin" in p for p in plans) >= 7
    assert not any("BroadcastHashJoin" in p for p in plans)


def test_url_model_learns_the_path(spark):
    rng = random.Random(6)
    host = lambda tld: "".join(rng.choice("abcdefg") for _ in range(6)) + tld
    urls = [f"http://{host('.org')}/en/{k}" for k in range(400)] + [f"http://{host('.com')}/de/{k}" for k in range(400)]
    rest = [f"http://{host('.net')}/en/{k}" for k in range(50)] + [f"http://{host('.net')}/de/{k}" for k in range(50)]
    rows = [(k, u, "x") for k, u in enumerate(urls + rest)]
    got = {r.page_id: r for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, verdict string")).collect()}
    assert sum(got[800 + k].verdict == "allow" for k in range(50)) >= 45
    assert sum(got[850 + k].verdict == "block" for k in range(50)) >= 45
    assert judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
