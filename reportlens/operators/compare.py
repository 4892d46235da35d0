"""Side-by-side comparison of two sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from reportlens.functions import text as tx
from reportlens.operators import ordered, profile
from reportlens.session import cut_lineage


SOURCE_LANGUAGES = {"primary": "en", "secondary": "fr"}


def _long(df: DataFrame, keys, names, section: str) -> DataFrame:
    cast = df.select(*keys, *[F.col(n).cast("double").alias(n) for n in names])
    return cast.unpivot(list(keys), list(names), "metric", "value").select(F.lit(section).alias("section"), *keys, "metric", "value")


def size_comparison(raw: DataFrame, clean: DataFrame, by: str = "dataset_source") -> DataFrame:
    """(source, raw, clean, keep_pct, size_ratio to the smallest cleaned source)."""
    r = raw.groupBy(by).agg(F.count(F.lit(1)).alias("raw"))
    c = clean.groupBy(by).agg(F.count(F.lit(1)).alias("clean"))
    both = r.join(c, by, "left").fillna(0, subset=["clean"])
    smallest = clean.groupBy(by).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).scalar()
    return both.withColumns({"keep_pct": F.col("clean") / F.col("raw") * 100, "size_ratio": F.col("clean") / smallest})


def top_missing(raw: DataFrame, cols, by: str = "dataset_source", k: int = 10) -> DataFrame:
    """The k columns with the highest null share per source. The table ranked has
    one row per (source, column)."""
    one = raw.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot([by, "_n"], list(cols), "column_name", "missing").withColumn("pct", F.round(F.col("missing") / F.col("_n") * 100, 2))
    w = Window.partitionBy(by).orderBy(F.desc("pct"), "column_name")
    return long.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(by, "column_name", "pct")


def source_terms(df: DataFrame, text: str, by: str, langs: dict) -> DataFrame:
    """(source, term, n): words of every source, cut and cleared of stop words in
    the source's own language."""
    words = tx.tokens(text, "en")
    for lang in sorted(set(langs.values()) - {"en"}):
        words = F.when(F.col(by).isin([s for s, of in langs.items() if of == lang]), tx.tokens(text, lang)).otherwise(words)
    return df.select(by, F.explode(words).alias("term")).groupBy(by, "term").agg(F.count(F.lit(1)).alias("n"))


def compare_sources(raw: DataFrame, clean: DataFrame, missing_cols, findings: str = "findings_clean",
                    impression: str = "impression_clean", by: str = "dataset_source", langs: dict | None = None, k: int = 5) -> DataFrame:
    """(section, source, metric, value): counts, retention, size ratio, highest
    null shares, lengths, vocabulary and the ``k`` most frequent words of every
    source. ``langs`` names the language (en or fr) of a source, by default that
    of the two known ones; the words of any other source are taken as English."""
    langs = SOURCE_LANGUAGES if langs is None else langs
    sizes = _long(size_comparison(raw, clean, by), [by], ["raw", "clean", "keep_pct", "size_ratio"], "size")
    miss = top_missing(raw, missing_cols, by).select(F.lit("missing").alias("section"), by, F.col("column_name").alias("metric"), F.col("pct").alias("value"))
    words = clean.select(by, tx.word_count(findings).alias("findings"), tx.word_count(impression).alias("impression"))
    ls = profile.length_summary(words, ("findings", "impression"), [by])
    stats = [ls.select(F.lit("length").alias("section"), by, F.concat("metric", F.lit("_" + s)).alias("metric"), F.col(s).alias("value")) for s in ("mean", "median")]
    terms = source_terms(clean, findings, by, langs)
    vocab = _long(terms.groupBy(by).agg(F.count(F.lit(1)).alias("vocabulary"), F.sum("n").alias("total_tokens")),
                  [by], ["vocabulary", "total_tokens"], "vocabulary")
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "term"))
    top = terms.withColumn("_rank", rank).filter(F.col("_rank") <= k).select(
        F.lit("top_words").alias("section"), by, F.col("term").alias("metric"), F.col("n").cast("double").alias("value"))
    return reduce(lambda a, b: a.unionByName(b), [sizes, miss, *stats, vocab, top])


def feature_overlap(df: DataFrame, cols, by: str = "dataset_source", edges: int = 40) -> DataFrame:
    """(feature, source, bin, lo, hi, n, density) of shared features.

    ``edges`` equally spaced points run from the lowest 1 % to the highest 99 %
    quantile of the sources. Values outside are left out, as in a plot range.
    """
    bins = edges - 1
    # Counted once: the quantiles and the bins both read the distinct values.
    values = cut_lineage(ordered.value_counts_long(df, cols, [by]))
    q = ordered.quantiles_of_counts(values, [0.01, 0.99], [by, "metric"])
    span = q.groupBy("metric").agg(F.min("q_0").alias("a"), F.max("q_1").alias("b"))
    counts = values.join(span, "metric").filter(F.col("value").between(F.col("a"), F.col("b")))
    width = (F.col("b") - F.col("a")) / bins
    raw = F.coalesce(F.floor((F.col("value") - F.col("a")) / F.nullif(width, F.lit(0.0))), F.lit(0))
    fixed = F.when(F.col("value") < F.col("a") + width * raw, raw - 1).when(F.col("value") >= F.col("a") + width * (raw + 1), raw + 1).otherwise(raw)
    bin_no = F.least(F.greatest(fixed, F.lit(0)), F.lit(bins - 1)).cast("int")
    counted = counts.groupBy(by, "metric", bin_no.alias("bin")).agg(F.sum("n").alias("n"))
    empty = q.select(by, "metric", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), F.lit(0).cast("long").alias("n"))
    full = counted.unionByName(empty).groupBy(by, "metric", "bin").agg(F.sum("n").alias("n"))
    totals = full.groupBy(by, "metric").agg(F.sum("n").alias("_t"))
    out = full.join(span, "metric").join(totals, [by, "metric"])
    lo = F.col("a") + width * F.col("bin")
    return out.select(F.col("metric").alias("feature"), by, "bin", lo.alias("lo"), (lo + width).alias("hi"), "n",
                      (F.col("n") / F.nullif(F.col("_t") * width, F.lit(0.0))).alias("density"))


OVERLAP_FEATURES = [
    # The ten features shared by both sources.
    "F01_clinical_sentiment", "F02_clinical_entity_count", "F03_severity_score", "F06_word_count",
    "F07_sentence_count", "F10_negation_count", "F13_flesch_kincaid", "F16_hedge_count",
    "F22_composite_severity", "F23_pathology_confidence",
]
