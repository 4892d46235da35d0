"""Profiling aggregates.

All statistics are grouped or global aggregations with partial (map-side)
sums; exact quantiles come from ``ordered`` and never collect a group.
"""

from __future__ import annotations

import math
from itertools import combinations
from statistics import NormalDist

from pyspark.sql import DataFrame, functions as F

from reportlens.functions import lexicons as lx, text as tx
from reportlens.operators import ordered
from reportlens.operators.rows import label_flags

QUARTILES = (0.25, 0.5, 0.75)


def with_lengths(df: DataFrame, findings: str = "findings", impression: str = "impression",
                 indication: str | None = None) -> DataFrame:
    """Word, character and sentence counts per section."""
    out = df.withColumns({
        "findings_words": tx.word_count(findings),
        "impression_words": tx.word_count(impression),
        "findings_chars": tx.char_count(findings),
        "impression_chars": tx.char_count(impression),
        "findings_sentences": tx.sentence_count(findings),
        "impression_sentences": tx.sentence_count(impression),
    })
    if indication:
        out = out.withColumn("indication_words", tx.word_count(indication))
    return out.withColumns({
        "total_words": F.col("findings_words") + F.col("impression_words"),
        "avg_sentence_len": tx.avg_sentence_len("findings_words", "findings_sentences"),
    })


# ------------------------------------------------------------------- counts

def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    return src.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def _share_profile(df: DataFrame, flags: dict, digits: int | None) -> DataFrame:
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(f).alias(c) for c, f in flags.items()])
    long = one.unpivot(["_n"], list(flags), "column_name", "missing")
    pct = F.when(F.col("_n") > 0, F.col("missing") / F.col("_n") * 100)
    return long.select("column_name", "missing", (F.round(pct, digits) if digits is not None else pct).alias("pct"))


def missing_profile(df: DataFrame, cols=None) -> DataFrame:
    """Null count and share of every column, shares rounded to two places."""
    return _share_profile(df, {c: F.col(f"`{c}`").isNull() for c in cols or df.columns}, 2)


def empty_profile(df: DataFrame, cols) -> DataFrame:
    """Share of rows that are null or the empty string."""
    return _share_profile(df, {c: F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in cols}, None)


def missing_matrix(df: DataFrame, key: str, cols) -> DataFrame:
    return df.select(key, *[(F.coalesce(F.col(c).cast("string"), F.lit("")) == "").cast("int").alias(c) for c in cols])


def section_presence(df: DataFrame, findings: str = "findings", impression: str = "impression", strip: bool = False) -> DataFrame:
    def there(c):
        return ~tx.is_blank(c) if strip else F.coalesce(F.col(c), F.lit("")) != ""
    f, i = there(findings), there(impression)
    return df.agg(F.count_if(f & ~i).alias("findings_only"), F.count_if(~f & i).alias("impression_only"),
                  F.count_if(f & i).alias("both_present"), F.count_if(~f & ~i).alias("none_present"))


# -------------------------------------------------------- numeric summaries

def _described(df: DataFrame, cols, by, positive_only: bool) -> DataFrame:
    counts = ordered.value_counts_long(df, cols, by, positive_only)
    return ordered.summary_of_counts(counts, QUARTILES, [*by, "metric"]).withColumnsRenamed({"q_0": "q25", "q_1": "median", "q_2": "q75"})


def describe_numeric(df: DataFrame, cols, by=(), positive_only: bool = False) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per column (and group)."""
    return _described(df, cols, by, positive_only).select(*by, "metric", "n", "mean", "std", "min", "max", "q25", "median", "q75")


def numeric_summary(df: DataFrame, col: str) -> DataFrame:
    return describe_numeric(df, [col]).select("metric", "n", "mean", "median", "min", "max")


def length_summary(df: DataFrame, cols=("findings_words", "impression_words"), by=()) -> DataFrame:
    """Mean and median of the positive word counts."""
    return describe_numeric(df, cols, by, positive_only=True).select(*by, "metric", "n", "mean", "median")


def distribution_properties(df: DataFrame, cols) -> DataFrame:
    """Describe plus population skewness, excess kurtosis and IQR, over the
    positive values."""
    d = _described(df, cols, (), True)
    return d.select("metric", "n", "mean", "std", "min", "max", "q25", "median", "q75", "skewness", "kurtosis",
                    (F.col("q75") - F.col("q25")).alias("iqr"))


def percentile_table(df: DataFrame, cols, ps=(5, 10, 25, 50, 75, 90, 95, 99)) -> DataFrame:
    """(metric, percentile, value) of the positive values."""
    q = ordered.quantiles(df, cols, [p / 100 for p in ps], positive_only=True)
    named = q.select("metric", *[F.col(f"q_{i}").alias(str(p)) for i, p in enumerate(ps)])
    long = named.unpivot(["metric"], [str(p) for p in ps], "percentile", "value")
    return long.select("metric", F.col("percentile").cast("int").alias("percentile"), "value")


def iqr_bounds(df: DataFrame, cols, by=(), k: float = 1.5) -> DataFrame:
    """Quartiles and fences per column, with the outlier count and percent."""
    counts = ordered.value_counts_long(df, cols, by)
    keys = [*by, "metric"]
    q = ordered.quantiles_of_counts(counts, (0.25, 0.75), keys)
    iqr = F.col("q_1") - F.col("q_0")
    fences = q.select(*keys, "n", F.col("q_0").alias("q25"), F.col("q_1").alias("q75"),
                      (F.col("q_0") - k * iqr).alias("lower"), (F.col("q_1") + k * iqr).alias("upper"))
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    hit = counts.withColumnRenamed("n", "m").join(fences, keys).groupBy(*keys).agg(
        F.sum(F.when(outside, F.col("m")).otherwise(F.lit(0))).alias("outliers"))
    return fences.join(hit, keys).withColumn("pct", F.col("outliers") / F.col("n") * 100)


def flag_outliers(df: DataFrame, cols, k: float = 1.5) -> DataFrame:
    """Adds ``<col>_outlier``; the fences are a scalar subquery of one row."""
    b = iqr_bounds(df, cols, k=k)
    fences = b.agg(*[F.struct(F.max(F.when(F.col("metric") == c, F.col("lower"))).alias("lo"),
                              F.max(F.when(F.col("metric") == c, F.col("upper"))).alias("hi")).alias(c) for c in cols])
    row = fences.select(F.struct(*cols)).scalar()
    return df.withColumn("_fences", row).withColumns({
        f"{c}_outlier": F.coalesce((F.col(c) < F.col(f"_fences.{c}.lo")) | (F.col(c) > F.col(f"_fences.{c}.hi")), F.lit(False))
        for c in cols}).drop("_fences")


def box_stats(df: DataFrame, by: str, col: str, positive_only: bool = False) -> DataFrame:
    """n, min, whiskers (furthest values inside 1.5 IQR), quartiles, mean, max."""
    counts = ordered.value_counts_long(df, [col], [by], positive_only)
    q = ordered.quantiles_of_counts(counts, QUARTILES, [by, "metric"]).select(
        by, F.col("q_0").alias("q25"), F.col("q_1").alias("median"), F.col("q_2").alias("q75"))
    iqr = F.col("q75") - F.col("q25")
    inside = F.col("value").between(F.col("q25") - 1.5 * iqr, F.col("q75") + 1.5 * iqr)
    return counts.join(q, by).groupBy(by).agg(
        F.sum("n").alias("n"), F.min("value").alias("min"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"), F.first("q25").alias("q25"),
        F.first("median").alias("median"), F.first("q75").alias("q75"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"), F.max("value").alias("max"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))


def histogram(df: DataFrame, col: str, bins: int | None = None, edges=None, lo=None, hi=None,
              density: bool = False, positive_only: bool = False, by: str | None = None) -> DataFrame:
    """Counts of equal-width bins, the last one closed; empty bins included.

    Bins are given by ``bins`` over [lo, hi] (the data range if not given) or by
    explicit equally spaced ``edges``. ``lo`` and ``hi`` may be Columns holding
    a scalar subquery. Output: (by,) bin, lo, hi, n or density.
    """
    keys = [by] if by else []
    long = ordered.melt(df, [col], keys, positive_only=positive_only)
    if edges is not None:
        bins, lo, hi = len(edges) - 1, float(edges[0]), float(edges[-1])
    if lo is None or hi is None:
        span = long.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi"))).scalar()
        lo, hi = span["lo"] if lo is None else lo, span["hi"] if hi is None else hi
    lo, hi = (x if not isinstance(x, (int, float)) else F.lit(float(x)) for x in (lo, hi))
    with_range = long.select(*keys, "value", lo.alias("_lo"), hi.alias("_hi"))
    width_col = (F.col("_hi") - F.col("_lo")) / bins
    raw = F.coalesce(F.floor((F.col("value") - F.col("_lo")) / F.nullif(width_col, F.lit(0.0))), F.lit(0))
    # The division may round across an edge, so the bin is checked against both.
    low_edge, high_edge = F.col("_lo") + width_col * raw, F.col("_lo") + width_col * (raw + 1)
    fixed = F.when(F.col("value") < low_edge, raw - 1).when(F.col("value") >= high_edge, raw + 1).otherwise(raw)
    bin_no = F.when(F.col("value") == F.col("_hi"), bins - 1).otherwise(F.least(F.greatest(fixed, F.lit(0)), F.lit(bins - 1))).cast("int")
    inside = F.col("value").between(F.col("_lo"), F.col("_hi"))
    counted = with_range.filter(inside).groupBy(*keys, bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # Every bin of every group gets a zero row from a constant array.
    groups = long.select(*keys).distinct() if by else df.sparkSession.range(1).select()
    empty = groups.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")).withColumn("n", F.lit(0).cast("long"))
    full = counted.unionByName(empty).groupBy(*keys, "bin").agg(F.sum("n").alias("n"))
    width = (hi - lo) / bins
    out = full.select(*keys, "bin", (lo + width * F.col("bin")).alias("lo"), (lo + width * (F.col("bin") + 1)).alias("hi"), "n")
    if not density:
        return out
    totals = full.groupBy(*keys).agg(F.sum("n").alias("_t"))
    if by:
        out = out.join(totals, by)
    else:
        out = out.withColumn("_t", totals.scalar())
    return out.withColumn("density", F.col("n") / (F.col("_t") * (F.col("hi") - F.col("lo")))).drop("_t")


def kde(df: DataFrame, col: str, grid, by: str) -> DataFrame:
    """Gaussian density with Scott bandwidth on a fixed grid, per group.

    Distinct values are counted first; each contributes to every grid point, so
    the work is distinct values x grid size and only partial sums are shuffled.
    """
    counts = ordered.value_counts_long(df, [col], [by]).select(by, "value", "n")
    stats = ordered.melt(df, [col], [by]).groupBy(by).agg(
        F.count("value").alias("total"), (F.stddev_samp("value") * F.pow(F.count("value"), F.lit(-0.2))).alias("h"))
    points = F.array(*[F.lit(float(g)) for g in grid])
    spreadout = counts.join(stats, by).select(by, "value", "n", "total", "h", F.explode(points).alias("grid"))
    z = (F.col("grid") - F.col("value")) / F.col("h")
    weight = F.col("n") * F.exp(-0.5 * z * z) / (F.col("h") * math.sqrt(2 * math.pi))
    return spreadout.groupBy(by, "grid").agg((F.sum(weight / F.col("total"))).alias("density"))


def qq_points(df: DataFrame, col: str, k: int = 50, positive_only: bool = True) -> DataFrame:
    """k points of the sample quantiles against standard-normal quantiles."""
    probs = qq_probs(k)
    q = ordered.quantiles(df, [col], probs, positive_only=positive_only)
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(NormalDist().inv_cdf(p)).alias("theoretical"),
                               F.col(f"q_{i}").alias("sample")) for i, p in enumerate(probs)])
    return q.select(F.inline(pairs))


def qq_probs(k: int):
    return [(i + 0.5) / k for i in range(k)]


# ------------------------------------------------------------- correlation

def correlated_pairs(df: DataFrame, cols, min_abs: float = 0.0) -> DataFrame:
    """(feature_a, feature_b, r) for every column pair, from one aggregation."""
    pairs = list(combinations(cols, 2))
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"p{i}").alias("r"))
                     for i, (a, b) in enumerate(pairs)])
    out = one.select(F.inline(rows))
    return out.filter(F.abs("r") > min_abs) if min_abs else out


def correlation_matrix(df: DataFrame, cols) -> DataFrame:
    """Long symmetric matrix, the diagonal included (null for constants)."""
    upper = correlated_pairs(df, cols)
    flipped = upper.select(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), "r")
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(c).cast("double")).alias(f"d{i}") for i, c in enumerate(cols)])
    diag = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature_a"), F.lit(c).alias("feature_b"),
                                                  F.round(F.col(f"d{i}"), 12).alias("r")) for i, c in enumerate(cols)])))
    return upper.unionByName(flipped).unionByName(diag)


def ranked_pairs(df: DataFrame, cols, head: int = 8, tail: int = 3) -> DataFrame:
    """The strongest ``head`` and weakest ``tail`` pairs, with mean |r|. The
    number of pairs depends on the column list only, not on the rows."""
    p = correlated_pairs(df, cols)
    mean_abs = p.agg(F.avg(F.abs("r"))).scalar()
    top = p.orderBy(F.desc("r"), "feature_a", "feature_b").limit(head).withColumn("side", F.lit("top"))
    low = p.orderBy(F.asc("r"), F.desc("feature_a"), F.desc("feature_b")).limit(tail).withColumn("side", F.lit("bottom"))
    return top.unionByName(low).withColumn("mean_abs_r", mean_abs)


# ------------------------------------------------------------------- texts

def compression_stats(df: DataFrame, findings: str = "findings_words", impression: str = "impression_words") -> DataFrame:
    """Findings words / impression words where both are positive."""
    ratio = df.filter((F.col(findings) > 0) & (F.col(impression) > 0)).select(
        (F.col(findings) / F.col(impression)).alias("compression"))
    base = describe_numeric(ratio, ["compression"]).select("metric", "n", "mean", "median", "min", "max")
    below = ratio.groupBy().agg(F.count_if(F.col("compression") < 20).alias("below_20")).scalar()
    return base.withColumn("below_20", below)


def text_quality(df: DataFrame, findings: str = "findings", impression: str = "impression") -> DataFrame:
    """Counters over a table prepared by ``with_lengths``."""
    marked = tx.has_placeholder(findings) | tx.has_placeholder(impression)
    d = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(marked).alias("placeholder"),
        (F.count_if(marked) / F.count(F.lit(1)) * 100).alias("placeholder_pct"),
        F.count_if(F.col("findings_words") < 5).alias("very_short"),
        F.count_if(F.col("total_words") > 100).alias("very_long"),
        F.count_if(F.col("total_words") * 1.3 > 512).alias("over_512_tokens"),
        F.avg("avg_sentence_len").alias("sentence_len_mean"), F.stddev_samp("avg_sentence_len").alias("sentence_len_std"))
    median = ordered.quantiles(df, ["avg_sentence_len"], [0.5]).select("q_0")
    return d.withColumn("sentence_len_median", median.scalar())


def token_counts(df: DataFrame, col: str, lang: str = "en", by=()) -> DataFrame:
    """(by, term, n); map-side counting keeps the shuffle at vocabulary size."""
    return (df.select(*by, F.explode(tx.tokens(col, lang)).alias("term"))
            .groupBy(*by, "term").agg(F.count(F.lit(1)).alias("n")))


def vocabulary_size(df: DataFrame, col: str, lang: str = "en", by=(), approximate: bool = False) -> DataFrame:
    if approximate:
        words = df.select(*by, F.explode(tx.tokens(col, lang)).alias("term"))
        return words.groupBy(*by).agg(F.approx_count_distinct("term").alias("vocabulary"), F.count(F.lit(1)).alias("total_tokens"))
    counts = token_counts(df, col, lang, by)
    return counts.groupBy(*by).agg(F.count(F.lit(1)).alias("vocabulary"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_tokens"))


def top_terms(df: DataFrame, col: str, lang: str = "en", k: int = 25) -> DataFrame:
    """Most frequent terms; equal counts are ordered by term."""
    return token_counts(df, col, lang).orderBy(F.desc("n"), "term").limit(k)


def term_class_counts(df: DataFrame, by: str, text, terms=lx.FR_KEY_TERMS) -> DataFrame:
    """(class, term, n): occurrences of every term summed per class."""
    low = df.select(by, tx.lowered(text).alias("_low"))
    wide = low.groupBy(by).agg(*[F.sum(tx.occurrences("_low", t)).alias(t) for t in terms])
    return wide.unpivot([by], list(terms), "term", "n")


# ------------------------------------------------------------------ labels

def exploded_labels(df: DataFrame, col: str, sep: str = "|") -> DataFrame:
    return df.filter(F.coalesce(F.col(col), F.lit("")) != "").select(
        F.explode(F.split(col, "\\" + sep)).alias("label"))


def label_term_counts(df: DataFrame, col: str, sep: str = "|", k: int | None = None) -> DataFrame:
    out = exploded_labels(df, col, sep).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.desc("n"), "label").limit(k) if k else out


def label_totals(df: DataFrame, col: str, sep: str = "|") -> DataFrame:
    """Unique labels and total occurrences."""
    return label_term_counts(df, col, sep).agg(F.count(F.lit(1)).alias("unique_labels"),
                                               F.coalesce(F.sum("n"), F.lit(0)).alias("occurrences"))


def label_cooccurrence(df: DataFrame, labels: str, names) -> DataFrame:
    """(label_a, label_b, n, pct of the smaller label) for a fixed label list.

    One pass over the rows with a sum per label pair: no self-join, and the
    number of sums depends on the label list alone.
    """
    flags = label_flags(df.select(labels), labels, names, prefix="")
    pairs = [(a, b) for a in names for b in names]
    one = flags.agg(*[F.coalesce(F.sum(F.col(f"`{a}`") * F.col(f"`{b}`")), F.lit(0)).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    at = {p: str(i) for i, p in enumerate(pairs)}

    def cell(a, b):
        n = F.col(f"`{at[(a, b)]}`")
        small = F.least(F.col(f"`{at[(a, a)]}`"), F.col(f"`{at[(b, b)]}`"))
        pct = F.when(small > 0, n / small * 100).otherwise(F.lit(0.0))
        return F.struct(F.lit(a).alias("label_a"), F.lit(b).alias("label_b"), n.alias("n"), pct.alias("pct"))
    return one.select(F.inline(F.array(*[cell(a, b) for a, b in pairs])))


def crosstab_margins(df: DataFrame, row: str, cols) -> DataFrame:
    """Counts of one flag against a combination of flags, with both margins."""
    cols = list(cols)
    sets = [[row, *cols], [row], cols, []]
    out = df.groupingSets([[F.col(f"`{c}`") for c in s] for s in sets], *[F.col(f"`{c}`") for c in [row, *cols]]).agg(
        F.count(F.lit(1)).alias("n"), F.grouping(F.col(f"`{row}`")).cast("int").alias("row_margin"),
        F.grouping(F.col(f"`{cols[0]}`")).cast("int").alias("col_margin"))
    return out


def class_imbalance(df: DataFrame, labels: str, names) -> DataFrame:
    """(label, n, pct, imbalance_ratio = largest / smallest, 0 if undefined)."""
    flags = label_flags(df.select(labels), labels, names, prefix="")
    one = flags.agg(F.count(F.lit(1)).alias("_rows"), *[F.coalesce(F.sum(f"`{n}`"), F.lit(0)).alias(n) for n in names])
    counts = [F.col(f"`{n}`") for n in names]
    smallest = F.least(*counts)
    ratio = F.when(smallest > 0, F.greatest(*counts) / smallest).otherwise(F.lit(0.0))
    rows = F.array(*[F.struct(F.lit(n).alias("label"), F.col(f"`{n}`").alias("n"),
                              (F.col(f"`{n}`") / F.col("_rows") * 100).alias("pct"), ratio.alias("imbalance_ratio")) for n in names])
    return one.select(F.inline(rows))


def label_cardinality(df: DataFrame, labels: str, names) -> DataFrame:
    flags = label_flags(df.select(labels), labels, names, prefix="")
    per_row = tx.total([F.col(f"`{n}`") for n in names])
    return flags.agg(F.avg(per_row).alias("cardinality")).withColumn("density", F.col("cardinality") / len(names))


def labels_per_record(df: DataFrame, labels: str) -> DataFrame:
    """(num_labels, n) plus the shares of rows with at least 1, 2, 3 labels."""
    size = df.select(F.size(labels).alias("num_labels"))
    share = size.agg(F.struct(*[(F.count_if(F.col("num_labels") >= k) / F.count(F.lit(1)) * 100).alias(f"ge{k}")
                                for k in (1, 2, 3)])).scalar()
    out = size.groupBy("num_labels").agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("_s", share).withColumns({f"pct_ge{k}": F.col(f"_s.ge{k}") for k in (1, 2, 3)}).drop("_s")


# ---------------------------------------------------------------- overviews

def demographics(df: DataFrame, age: str = "patient_age", gender: str = "patient_gender", by: str = "condition") -> DataFrame:
    """Age statistics per condition and gender (null gender is its own group)."""
    d = df.withColumn("_g", F.coalesce(F.col(gender), F.lit("unknown")))
    counts = d.groupBy(by, "_g").agg(F.count(F.lit(1)).alias("records"))
    ages = describe_numeric(d, [age], [by, "_g"]).drop("metric").withColumnRenamed("n", "n_age")
    return counts.join(ages, [by, "_g"], "left").withColumnRenamed("_g", "gender")


def dataset_overview(df: DataFrame, images: str | None = "num_images") -> DataFrame:
    """(metric, value): rows, columns, columns per type, image total and mean."""
    kinds: dict[str, int] = {}
    for f in df.schema.fields:
        kinds[f.dataType.simpleString()] = kinds.get(f.dataType.simpleString(), 0) + 1
    parts = [("rows", F.count(F.lit(1)).cast("double")), ("columns", F.lit(float(len(df.columns))))]
    parts += [(f"columns_{k}", F.lit(float(n))) for k, n in sorted(kinds.items())]
    if images and images in df.columns:
        parts += [("images", F.sum(images).cast("double")), ("images_per_report", F.avg(images))]
    one = df.agg(*[c.alias(n) for n, c in parts])
    return one.unpivot([], [n for n, _ in parts], "metric", "value")


def feature_summary(df: DataFrame, cols, target: str) -> DataFrame:
    """(target, metric, n, mean, std, min, max) per feature and class."""
    return ordered.melt(df, cols, [target]).groupBy(target, "metric").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
