"""Extractive summaries and ROUGE scores."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from reportlens.functions import text as tx
from reportlens.operators import corpus
from reportlens.operators.rows import sample_n
from reportlens.session import cut_lineage


# ------------------------------------------------------------- summarisers

def sentence_rows(df: DataFrame, key: str, text: str, mode: str = "dot") -> DataFrame:
    """(key, pos, sentence)."""
    return df.select(key, F.posexplode(tx.sentences(text, mode)).alias("pos", "sentence"))


def _tfidf_parts(sents: DataFrame, key: str, max_features: int | None) -> DataFrame:
    """(key, pos, term, w), dealt by key: unit TF-IDF vectors with every sentence
    a document. ``sents`` is dealt by key, so that counting needs no shuffle. The
    most frequent terms, nearly all occurrences, are broadcast; the others are met
    by term and come back as a map per key. ``term`` is a number."""
    tf = sents.select(key, "pos", F.explode(corpus.term_list("sentence")).alias("term")).groupBy(key, "pos", "term").agg(F.count(F.lit(1)).alias("tf"))
    vocab = corpus.vocabulary(tf, sents.agg(F.count(F.lit(1))).scalar(), max_features=max_features)
    vocab = cut_lineage(vocab.select("term", F.struct(F.monotonically_increasing_id().alias("t"), "idf").alias("v")))
    common = vocab if corpus.small(max_features) else vocab.orderBy("v.idf", "term").limit(corpus.BROADCAST_TERMS)
    found = tf.join(F.broadcast(common), "term", "inner" if corpus.small(max_features) else "left")
    if not corpus.small(max_features):
        rare = tf.join(F.broadcast(common), "term", "left_anti").select(key, "term").distinct().join(vocab, "term")
        rare = rare.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("term", "v"))).alias("_rare"))
        found = found.join(rare, key, "left").withColumn("v", F.coalesce("v", F.try_element_at("_rare", "term"))).drop("_rare")
    w = F.col("tf") * F.col("v.idf")
    length = F.sqrt(F.sum("w").over(Window.partitionBy(key, "pos")))
    found = found.select(key, "pos", F.col("v.t").alias("term"), (w * w).alias("w"), w.alias("_w"))
    return found.select(key, "pos", "term", (F.col("_w") / length).alias("w"))


def extractive_summary(df: DataFrame, key: str, text: str, k: int = 2, embed=None, max_features: int | None = None,
                       mode: str = "dot") -> DataFrame:
    """(key, summary): the k sentences closest to the document centroid, in
    their original order, joined by ``. ``.

    Sentences are TF-IDF vectors, or whatever ``embed`` (a DataFrame function
    over key, pos, sentence) puts in an array column ``vec``. All terms count
    unless ``max_features`` asks for the most frequent ones only.
    """
    # All steps group inside a document: texts and vectors are dealt by key once.
    sents = sentence_rows(df.select(key, text).repartition(F.col(key)), key, text, mode)
    if embed is None:
        parts = _tfidf_parts(sents, key, max_features)
    else:
        parts = embed(sents).select(key, "pos", F.posexplode("vec").alias("term", "w")).repartition(F.col(key))
    centroid = Window.partitionBy(key, "term")
    dots = parts.withColumn("_c", F.sum("w").over(centroid)).groupBy(key, "pos").agg(
        F.sum(F.col("w") * F.col("_c")).alias("dot"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    # |centroid|^2 is the sum of the dots: the same for every sentence of a document.
    doc = Window.partitionBy(key)
    scored = dots.withColumn("_cn", F.sqrt(F.sum("dot").over(doc))).select(
        key, "pos", F.when((F.col("norm") > 0) & (F.col("_cn") > 0), F.round(F.col("dot") / (F.col("norm") * F.col("_cn")), 9)).alias("score"))
    scores = scored.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("pos", "score"))).alias("_scores"))
    found = sents.join(scores, key, "left").withColumn("score", F.coalesce(F.try_element_at("_scores", F.col("pos")), F.lit(0.0))).drop("_scores")
    ranked = top_k_in_record(found, key, "score", "pos", k)
    chosen = ranked.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "sentence"))).alias("s"))
    joined = chosen.select(key, F.concat(F.array_join(F.transform("s", lambda x: x["sentence"]), ". "), F.lit(".")).alias("summary"))
    return df.select(key).join(joined, key, "left").fillna("", subset=["summary"])


def top_k_in_record(df: DataFrame, key: str, score: str, position: str, k: int) -> DataFrame:
    """The k best items of every record; equal scores go to the earlier one."""
    w = Window.partitionBy(key).orderBy(F.desc(score), position)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def lead_n(text, n: int = 2, mode: str = "punct") -> Column:
    """First n sentences."""
    return F.array_join(F.slice(tx.sentences(text, mode), 1, n), " ")


# ------------------------------------------------------------------- rouge

def rouge_tokens(text, unicode: bool = False) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[\p{L}\p{N}]+" if unicode else "[a-z0-9]+"), F.lit(0))


def _grams(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens
    return F.flatten(F.transform(F.array(tokens), lambda t: F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.size(t) - n + 1, F.lit(1))), lambda i: i <= F.size(t) - n + 1),
        lambda i: F.array_join(F.slice(t, i, n), " "))))


def _scores(overlap, n_ref, n_pred, name: str):
    p = F.when(n_pred > 0, overlap / n_pred).otherwise(F.lit(0.0))
    r = F.when(n_ref > 0, overlap / n_ref).otherwise(F.lit(0.0))
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return [p.alias(f"{name}_p"), r.alias(f"{name}_r"), f.alias(f"{name}_f")]


def rouge_n(df: DataFrame, key, ref: str, pred: str, n: int = 1, unicode: bool = False) -> DataFrame:
    """(key, rouge<n>_p, rouge<n>_r, rouge<n>_f): clipped n-gram overlap. Texts
    without n-grams score 0."""
    keys = [key] if isinstance(key, str) else list(key)
    a = F.transform(_grams(rouge_tokens(ref, unicode), n), lambda g: F.struct(g.alias("g"), F.lit(1).alias("a"), F.lit(0).alias("b")))
    b = F.transform(_grams(rouge_tokens(pred, unicode), n), lambda g: F.struct(g.alias("g"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    counts = df.select(*keys, F.inline_outer(F.concat(a, b))).groupBy(*keys, "g").agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"))
    one = counts.groupBy(*keys).agg(F.sum(F.least("a", "b")).alias("o"), F.sum("a").alias("na"), F.sum("b").alias("nb"))
    return one.select(*keys, *_scores(F.col("o"), F.col("na"), F.col("nb"), f"rouge{n}"))


def _lcs_length():
    """Arrow function: longest common subsequence of two token arrays, one bit
    per token. Defined inside a function so that it travels to the executors by
    value."""
    @F.pandas_udf(T.IntegerType())
    def lcs(a: pd.Series, b: pd.Series) -> pd.Series:
        def length(x, y):
            x, y = list(x), list(y)
            places: dict = {}
            for i, w in enumerate(x):
                places[w] = places.get(w, 0) | (1 << i)
            full = (1 << len(x)) - 1
            state = full
            for w in y:
                hit = state & places.get(w, 0)
                state = ((state + hit) | (state - hit)) & full
            return len(x) - state.bit_count()
        return pd.Series([length(x, y) for x, y in zip(a, b)])
    return lcs


def rouge_l(df: DataFrame, key, ref: str, pred: str, unicode: bool = False) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    t = df.select(*keys, rouge_tokens(ref, unicode).alias("a"), rouge_tokens(pred, unicode).alias("b"))
    t = t.withColumn("o", _lcs_length()("a", "b"))
    return t.select(*keys, *_scores(F.col("o"), F.size("a"), F.size("b"), "rougeL"))


def rouge_all(df: DataFrame, key, ref: str, pred: str, unicode: bool = False) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return (rouge_n(df, keys, ref, pred, 1, unicode).join(rouge_n(df, keys, ref, pred, 2, unicode), keys)
            .join(rouge_l(df, keys, ref, pred, unicode), keys))


# -------------------------------------------------------------- evaluation

def as_summariser(fn):
    """Turn a Python ``text -> text`` callback into a DataFrame summariser; it
    runs in Arrow batches on the executors."""
    @F.pandas_udf(T.StringType())
    def call(s: pd.Series) -> pd.Series:
        return s.map(fn)
    return lambda df, key, text: df.select(key, call(F.col(text)).alias("summary"))


def predictions(df: DataFrame, key: str, source: str, reference: str, summarisers: dict, n: int | None = None, seed: int = 42) -> DataFrame:
    """(model, key, source, reference, prediction) for every summariser: a
    function (df, key, text) -> (key, summary). ``n`` evaluates a sample of n
    pairs drawn by ``seed``, as an evaluation sample is a parameter of the report."""
    pairs = df.filter((F.coalesce(F.col(source), F.lit("")) != "") & (F.coalesce(F.col(reference), F.lit("")) != ""))
    if n:
        pairs = sample_n(pairs, n, seed, key)
    pairs = pairs.select(key, F.col(source).alias("source"), F.col(reference).alias("reference"))
    parts = [pairs.join(fn(pairs, key, "source").withColumnRenamed("summary", "prediction"), key)
             .select(F.lit(name).alias("model"), key, "source", "reference", "prediction") for name, fn in summarisers.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def evaluate_summaries(df: DataFrame, key: str, source: str, reference: str, summarisers: dict, n: int | None = None,
                       unicode: bool = False, seed: int = 42) -> DataFrame:
    """(model, pairs, mean of each ROUGE score)."""
    # Written once: three scores read the predictions, and a summariser may be costly.
    pred = cut_lineage(predictions(df, key, source, reference, summarisers, n, seed))
    s = rouge_all(pred, ["model", key], "reference", "prediction", unicode)
    names = [f"rouge{x}_{m}" for x in ("1", "2", "L") for m in ("p", "r", "f")]
    return s.groupBy("model").agg(F.count(F.lit(1)).alias("pairs"), *[F.avg(c).alias(c) for c in names])
