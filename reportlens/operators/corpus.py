"""TF-IDF in long form (id, term, weight)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reportlens.session import cut_lineage

WORD = r"[\p{L}\p{N}_]{2,}"
BROADCAST_TERMS = 100_000  # a vocabulary of at most so many terms (some 5 MB) is broadcast


def small(max_features: int | None) -> bool:
    return bool(max_features) and max_features <= BROADCAST_TERMS


def term_list(text, stop_words=(), ngrams=(1,)) -> Column:
    """Lower-cased word tokens of two letters or more, stop words removed, then
    n-grams of neighbouring tokens."""
    c = F.col(text) if isinstance(text, str) else text
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(WORD), F.lit(0))
    if stop_words:
        found = F.filter(found, lambda w: ~w.isin(list(stop_words)))

    def grams(toks, n):
        if n == 1:
            return toks
        many = F.greatest(F.size(toks) - n + 1, F.lit(0))
        return F.zip_with(F.slice(grams(toks, n - 1), F.lit(1), many), F.slice(toks, F.lit(n), many), lambda a, b: F.concat_ws(" ", a, b))
    if tuple(ngrams) == (1,):
        return found
    # The token array is bound once, then every n-gram size is read off it.
    return F.flatten(F.transform(F.array(found), lambda t: F.concat(*[grams(t, n) for n in ngrams])))


def term_frequencies(docs: DataFrame, key: str, terms: str, weight: str | None = None) -> DataFrame:
    """(key, [weight,] term, tf). Repeats inside a document are added up before
    the shuffle because they come from one row."""
    keep = [key] + ([weight] if weight else [])
    return docs.select(*keep, F.explode(terms).alias("term")).groupBy(*keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(tf: DataFrame, n_docs: Column, min_df: int = 1, max_df: float = 1.0, max_features: int | None = 5000,
               weight: str | None = None) -> DataFrame:
    """(term, df, idf): terms inside the document-frequency bounds, the most
    frequent ``max_features`` (equal totals ordered by term)."""
    m = F.col(weight) if weight else F.lit(1)
    v = tf.groupBy("term").agg(F.sum(m).alias("df"), F.sum(F.col("tf") * m).alias("total"))
    v = v.withColumn("_n", n_docs)
    v = v.filter((F.col("df") >= min_df) & (F.col("df") <= max_df * F.col("_n")))
    if max_features:
        v = v.orderBy(F.desc("total"), "term").limit(max_features)
    return v.select("term", "df", (F.log((1 + F.col("_n")) / (1 + F.col("df"))) + 1).alias("idf"))


def weigh(tf: DataFrame, vocab: DataFrame, key: str, max_features: int | None) -> DataFrame:
    """(key, term, df, weight): tf * idf with unit length per key. The
    vocabulary is broadcast only if ``max_features`` keeps it small."""
    side = F.broadcast(vocab) if small(max_features) else vocab
    raw = tf.join(side, "term").withColumn("_w", F.col("tf") * F.col("idf"))
    per_doc = Window.partitionBy(key)
    return raw.select(key, "term", "df", (F.col("_w") / F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(per_doc))).alias("weight"))


def _frequent_words(tf: DataFrame, n_docs: Column, min_df: int, max_df: float, max_features: int) -> DataFrame | None:
    """The words that may be part of a vocabulary of ``max_features`` n-grams:
    ``max_features`` words alone reach some total, so a rarer n-gram is none,
    and an n-gram is as rare as its rarest word. None if all words may be."""
    words = cut_lineage(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")))
    allowed = words.withColumn("_n", n_docs).filter((F.col("df") >= min_df) & (F.col("df") <= max_df * F.col("_n")))
    last = allowed.orderBy(F.desc("total"), "term").limit(max_features).agg(F.count(F.lit(1)).alias("n"), F.min("total").alias("total")).first()
    if last["n"] < max_features:
        return None
    frequent = words.filter(F.col("total") >= last["total"]).select("term")
    return frequent if frequent.count() <= BROADCAST_TERMS else None


def tfidf(df: DataFrame, key: str, text: str, ngrams=(1,), min_df: int = 1, max_df: float = 1.0,
          max_features: int | None = 5000, stop_words=()) -> DataFrame:
    """(key, term, weight) with idf = ln((1+n)/(1+df)) + 1 and unit-length rows.

    The texts are shuffled by key once; counts and lengths per key need no
    further shuffle of the terms. N-grams beside words are counted only if all
    their words are frequent enough for them to be among ``max_features``.
    """
    texts = df.select(key, F.col(text).alias("_text")).repartition(F.col(key))
    n_docs = df.agg(F.count(F.lit(1))).scalar()

    def counted(ngrams, frequent=None):
        terms = texts.select(key, F.explode(term_list("_text", stop_words, ngrams)).alias("term"))
        if frequent is not None:
            word = F.broadcast(frequent.withColumnRenamed("term", "_word"))
            for at in (1, -1):
                terms = terms.join(word, F.element_at(F.split("term", " "), at) == F.col("_word"), "left_semi")
        return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))
    frequent = None
    if 1 in ngrams and len(ngrams) > 1 and small(max_features):
        frequent = _frequent_words(counted((1,)), n_docs, min_df, max_df, max_features)
    tf = counted(ngrams, frequent)
    vocab = vocabulary(tf, n_docs, min_df, max_df, max_features)
    return weigh(tf, vocab, key, max_features).drop("df")
