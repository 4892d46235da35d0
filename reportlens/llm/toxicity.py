"""Toxicity by weak supervision.

1. Mining: on a bounded sample of labelled rows, words and word beginnings that are far more frequent in toxic texts
   become lexicons, beside a short list of insults that everybody knows.
2. Voting: every text is read once; lexicon and pattern voters say toxic, harmless or nothing.
3. Label model: over the counts of all vote patterns (bounded by 3 to the number of voters), EM estimates how each
   voter votes on either class. Voters that still agree given the class are correlated; each counts only for the part
   of its evidence that it does not share. This gives each pattern a posterior.
4. Classifier: a logistic regression on the mined features learns the posteriors of a bounded sample of all texts and
   scores every text.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlens.llm.common import travels_by_value
from reportlens.llm.shingles import mix, runs_of
from reportlens.session import cut_lineage

travels_by_value(__name__)
LABELLED, FITTED, MINED, BUCKETS = 20_000, 20_000, 4096, 1 << 18
# Insults in common use.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting", "imbecile",
           "bastard", "bitch", "shit", "fuck", "asshole", "retard", "dumb", "vermin", "filth")
BEGINNINGS = (0, 4, 5, 6)  # bytes of a word's beginning; 0 is the whole word
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def text_features(raw: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of a text, bucket * 4 + place in BEGINNINGS, and how often each occurs."""
    chars, place, starts, lengths = runs_of(raw or b"", _INSIDE)
    out = []
    if len(starts):
        for kind, n in enumerate(BEGINNINGS):
            h = (np.add.reduceat(np.where(place < n, chars, np.uint64(0)), starts)[lengths > n] if n
                 else np.add.reduceat(chars, starts))
            out.append((mix(h) % np.uint64(BUCKETS)).astype(np.int64) * 4 + kind)
    return np.unique(np.concatenate(out) if out else np.empty(0, np.int64), return_counts=True)


def _tally(batches):
    sums = np.zeros((2, BUCKETS * 4), np.int32)
    for batch in batches:
        for raw, toxic in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
            sums[toxic, text_features(raw)[0]] += 1
    seen = np.flatnonzero(sums.sum(axis=0))
    for i in range(0, len(seen), 50_000):
        part = seen[i:i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(sums[0, part].astype(np.int64)), pa.array(sums[1, part].astype(np.int64))],
                                         ["feature", "n0", "n1"])


def _draw(rows: DataFrame, bound: int, *key: str) -> DataFrame:
    """At most ``bound`` rows, the same in every run, by a hash of ``key``."""
    n = rows.count()
    if n <= bound:
        return rows
    share = 0.97 * bound / n
    return rows.where(F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < int(share * (1 << 30))).limit(bound)


def mine(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Features of toxic texts, strongest first, at most MINED. ``labels``
    (doc_id, toxic) is a bounded table, so it is broadcast."""
    sample = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id").select("text", "toxic")
    counts = sample.mapInArrow(_tally, "feature long, n0 long, n1 long").groupBy("feature").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    by_class = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    n0, n1 = by_class.get(0, 0) + 1, by_class.get(1, 0) + 1
    odds = (F.col("n1") + 0.5) / n1 / ((F.col("n0") + 0.5) / n0)
    both, p = F.col("n0") + F.col("n1"), n1 / (n0 + n1)
    gain = 2 * (F.col("n1") * F.log(F.col("n1") / (both * p))
                + F.when(F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") / (both * (1 - p)))).otherwise(0.0))
    counts = cut_lineage(counts.where("n1 > 0"))
    # So many features are tried that some look toxic by chance; the gain of the best of n such is about 2 log n.
    least = 2 * math.log(max(2, counts.count())) + 2
    found = (counts.withColumn("gain", gain).where((odds >= 8) & (F.col("gain") >= least))
             .orderBy(F.desc("gain"), "feature").limit(MINED).select("feature"))
    return np.array([r[0] for r in found.collect()], np.int64)


LEVELS = (1, 2, 3, 5)


def _votes(raw, column, known) -> tuple[list[int], list[int]]:
    """Votes (0 nothing, 1 harmless, 2 toxic) and the features of a text that
    the classifier sees: mined ones, and how many hits of each sort there are."""
    features, times = text_features(raw)
    mined = column[features]
    hit = mined >= 0
    kinds = np.bincount(features[hit] % 4, times[hit], 4).astype(int)
    listed = int(times[known[features]].sum())
    words = int(times[features % 4 == 0].sum())
    most = max(int(kinds.max()), listed)

    def vote(n, least):
        return 2 if n >= least else 0 if n else 1
    votes = [vote(kinds[0], 2), *(vote(kinds[k], 3) for k in (1, 2, 3)), 2 if listed else 0, 2 if most >= 5 else 0,
             vote(most, max(2, words // 100)), vote(int((features[hit] % 4 == 0).sum()), 2)]
    counts = (kinds[0], kinds[1:].max(), listed)
    levels = [len(LEVELS) * i + k for i, n in enumerate(counts) for k, least in enumerate(LEVELS) if n >= least]
    return votes, levels + (mined[hit] + len(LEVELS) * len(counts)).tolist()


VOTERS, COUNTED = 8, 3 * len(LEVELS)


def word_feature(word: str) -> int:
    return next(int(f) for f in text_features(word.encode())[0] if f % 4 == 0)


def _vote(sent):
    def run(batches):
        mined = sent.value
        column = np.full(BUCKETS * 4, -1, np.int32)
        column[mined] = np.arange(len(mined))
        known = np.zeros(BUCKETS * 4, bool)
        known[[word_feature(w) for w in INSULTS]] = True
        for batch in batches:
            codes, features = [], []
            for raw in batch.column(1).cast(pa.binary()).to_pylist():
                votes, found = _votes(raw, column, known)
                codes.append(sum(v * 3 ** k for k, v in enumerate(votes)))
                features.append(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(codes, pa.int32()), pa.array(features, pa.list_(pa.int32()))],
                                             ["doc_id", "held_out", "code", "features"])
    return run


def _unshared(side: np.ndarray, mass: list[np.ndarray]) -> np.ndarray:
    """Per voter one over the sum of its correlations with all voters, within the classes that ``mass`` weighs."""
    shared = np.zeros((side.shape[1],) * 2)
    for w in mass:
        left = side - w @ side / max(w.sum(), 1e-9)
        cov = (left * w[:, None]).T @ left / max(w.sum(), 1e-9)
        sd = np.sqrt(np.diag(cov)) + 1e-9
        shared += np.clip(cov / sd / sd[:, None], 0, 1) / len(mass)
    np.fill_diagonal(shared, 1)
    return 1 / shared.sum(1)


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior of toxic for each vote pattern (rows of 0, 1, 2) seen ``counts``
    times. EM begins with the votes weighted by what each voter does not share
    with any other, else copies of one voter would pass for the truth."""
    one = np.eye(3)[patterns]
    side = (patterns == 2).astype(float) - (patterns == 1)
    weight = _unshared(side, [counts])
    share = ((side > 0) @ weight) / np.maximum(1e-9, (side != 0) @ weight)
    post = np.clip(share, 0.02, 0.98)
    for turn in range(rounds):
        mass = counts * np.stack([1 - post, post])
        rates = (np.einsum("cn,nmk->cmk", mass, one) + 0.5) / (mass.sum(1)[:, None, None] + 1.5)
        evidence = np.einsum("nmk,cmk->ncm", one, np.log(rates))
        if turn in (5, 15, 30):  # what voters share given the class
            weight = _unshared(side, list(mass))
        score = np.log((mass.sum(1) + 1) / (counts.sum() + 2)) + evidence @ weight
        post = 1 / (1 + np.exp(np.clip(score[:, 0] - score[:, 1], -50, 50)))
    return post


def fit(rows: list[np.ndarray], target: np.ndarray, size: int, steps: int = 300) -> np.ndarray:
    """Weights of a logistic regression on 0/1 features, the last is the bias."""
    at = np.concatenate([np.append(r, size).astype(np.int64) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[at], len(rows)), -30, 30)))
        g = np.bincount(at, (p - target)[row], size + 1) / len(rows) + 1e-6 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return w


def _score(sent):
    def run(batches):
        w = sent.value
        for batch in batches:
            x = np.array([w[-1] + (w[f].sum() if f else 0.0) for f in batch.column(2).to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])
    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, fitted: int = FITTED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any others): doc_id, held_out,
    score, predicted.

    Labels (doc_id, toxic) are read only where crc32 of the doc_id modulo 5 is
    not 0, at most ``labelled`` of them; null labels are passed over, of
    repeated ones the largest counts. ``fitted`` bounds the texts whose
    posteriors the classifier learns. A null or empty text gets the score of
    a text without any feature. Without labels only the listed insults vote.
    """
    spark = docs.sparkSession

    def remainder(c):
        return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(5))
    learn = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id")) != 0))
    learn = learn.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    mined = mine(docs, cut_lineage(_draw(cut_lineage(learn), labelled, "doc_id")))
    voted = cut_lineage(docs.select("doc_id", "text", (remainder(F.col("doc_id")) == 0).alias("held_out")).mapInArrow(
        _vote(spark.sparkContext.broadcast(mined)), "doc_id long, held_out boolean, code int, features array<int>"))
    seen = voted.groupBy("code").count().orderBy("code").collect()
    if not seen:
        return voted.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    codes = np.array([r["code"] for r in seen])
    patterns = codes[:, None] // 3 ** np.arange(VOTERS) % 3
    post = dict(zip(codes.tolist(), label_model(patterns, np.array([r["count"] for r in seen], float))))
    drawn = _draw(voted.select("doc_id", "code", "features"), fitted, "doc_id").select("code", "features").toArrow()
    rows = [np.array(f, np.int64) for f in drawn.column("features").to_pylist()]
    w = fit(rows, np.array([post[c] for c in drawn.column("code").to_pylist()]), len(mined) + COUNTED)
    return voted.select("doc_id", "held_out", "features").mapInArrow(
        _score(spark.sparkContext.broadcast(w)), "doc_id long, held_out boolean, score double, predicted int")
