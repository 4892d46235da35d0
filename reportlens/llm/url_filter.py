"""URL filters: listed rules, and a character language-model ratio for the rest.

Two variable-order Markov models, of accepted and of rejected addresses, predict each character from up to ``ORDER``
characters before it. Orders are blended by Witten-Bell weights: a context seen n times with t different followers gives
the estimate of the next shorter context the weight t / (n + t). Counts are exact and come from all addresses that a rule
decides: one row for each different stretch of ``ORDER`` + 1 characters, from which the shorter orders are summed. They
grow with the data and stay distributed: the stretches that are to be scored are joined with them order by order, each
different one once. These joins are sorted merges: a written table is small beside the stretches made of it, so Spark
would take them for small and send them through the driver. An address is rejected if the difference of its log-likelihoods per character is below a threshold,
the one with the least mean error of both classes on held-back addresses.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlens.llm.common import lower_ascii, travels_by_value
from reportlens.session import cut_lineage

travels_by_value(__name__)
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
ORDER, BINS, SPAN = 5, 2000, 8.0
_START, _END, _UNSEEN = "\x02", "\x03", 1 / 256


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else nulls. The rules are a
    list that a person keeps: one expression for each."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, slash, start = text.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + start))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _stretches(text: Column) -> Column:
    """Each character of the text, and its end, with the ``ORDER`` characters before it."""
    padded = F.filter(F.split(F.concat(F.lit(_START * ORDER), text, F.lit(_END)), ""), lambda c: c != "")
    ends = F.sequence(F.lit(1), F.size(padded) - ORDER)
    # The characters are bound once.
    return F.flatten(F.transform(F.array(padded), lambda cs: F.transform(ends, lambda i: F.array_join(F.slice(cs, i, ORDER + 1), ""))))


_KINDS = [f"{part}{label}" for part in ("fit", "all") for label in (0, 1)]


def stretch_counts(learn: DataFrame) -> DataFrame:
    """(gram, fit0, fit1, all0, all1) of rows (text, label 0 or 1, back): how
    often a stretch occurs in the texts of a label, without the held-``back``
    ones and with them."""
    grams = learn.select("label", "back", F.explode(_stretches(F.col("text"))).alias("gram"))
    sums = [F.count_if((F.col("label") == label) & (F.lit(part == "all") | ~F.col("back"))).alias(f"{part}{label}")
            for part in ("fit", "all") for label in (0, 1)]
    return grams.groupBy("gram").agg(*sums)


def stretch_likelihoods(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, p_fit0, p_fit1, p_all0, p_all1) for the stretches ``wanted``
    (gram): the probability of the last character after the others."""
    lower = None
    for k in range(ORDER + 1):
        tail = F.substring("gram", ORDER + 1 - k, k + 1)
        seen = counts.groupBy(tail.alias("tail")).agg(*[F.sum(c).alias(c) for c in _KINDS])
        before = F.substring("tail", 1, k) if k else F.lit("")
        contexts = seen.groupBy(before.alias("before")).agg(*[F.sum(c).alias(f"n_{c}") for c in _KINDS], *[F.count_if(F.col(c) > 0).alias(f"t_{c}") for c in _KINDS])
        rows = wanted.select(tail.alias("tail")).distinct().withColumn("before", before)
        rows = rows.join(seen.hint("merge"), "tail", "left").join(contexts.hint("merge"), "before", "left")
        if lower is not None:
            rows = rows.join(lower.hint("merge"), F.substring("tail", 2, k) == F.col("shorter"), "left")
        out = []
        for c in _KINDS:
            less = F.lit(_UNSEEN) if lower is None else F.col(f"p_{c}")
            n, t = F.coalesce(F.col(f"n_{c}"), F.lit(0)), F.coalesce(F.col(f"t_{c}"), F.lit(0))
            out.append(F.when(n > 0, (F.coalesce(F.col(c), F.lit(0)) + t * less) / (n + t)).otherwise(less).alias(f"p_{c}"))
        lower = cut_lineage(rows.select(F.col("tail").alias("shorter"), *out))
    return lower.withColumnRenamed("shorter", "gram")


def differences(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(id, d) of rows (id, text, back): log-likelihood of accepted less that of
    rejected, per character; a held-``back`` text by the counts without such."""
    grams = texts.select("id", "back", F.explode(_stretches(F.col("text"))).alias("gram"))
    likely = stretch_likelihoods(counts, grams.select("gram").distinct())
    ratio = F.when(F.col("back"), F.log(F.col("p_fit1") / F.col("p_fit0"))).otherwise(F.log(F.col("p_all1") / F.col("p_all0")))
    return grams.join(likely.hint("merge"), "gram").groupBy("id").agg(F.avg(ratio).alias("d"))


def _threshold(scored: DataFrame) -> float:
    """Of the cuts with the least mean error over both labels the one nearest to 0, from a histogram of ``BINS`` bins."""
    at = F.floor((F.least(F.greatest("d", F.lit(-SPAN)), F.lit(SPAN - 1e-9)) + SPAN) * (BINS / (2 * SPAN))).cast("int")
    seen = np.zeros((2, BINS))
    for r in scored.groupBy("label", at.alias("bin")).count().collect():
        seen[r["label"], r["bin"]] = r["count"]
    if not seen.sum(axis=1).all():
        return 0.0
    wrong = np.r_[0, np.cumsum(seen[1])] / seen[1].sum() + 1 - np.r_[0, np.cumsum(seen[0])] / seen[0].sum()
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    cuts = best * 2 * SPAN / BINS - SPAN
    return float(cuts[np.abs(cuts).argmin()])


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, any others): page_id, host,
    path, rule, verdict, difference (null where a rule decides).

    A null url or one without :// has no host and no path, so no rule, and the
    difference 0. If the rules allow or block nothing, nothing is learned and
    the rest is allowed. Repeated rows get the same verdict each; one address
    is counted once however many rows have it.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parts = parts.withColumn("rule", rule).withColumn("said", verdict)
    parts = cut_lineage(parts.withColumn("text", F.concat("host", "path")))
    back = F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(5)) == 0
    learn = cut_lineage(parts.where("rule is not null").select(
        F.when(F.col("said") == "allow", 1).otherwise(0).alias("label"), "text").distinct().withColumn("back", back))
    if learn.agg(F.countDistinct("label")).first()[0] < 2:
        scored, cut = parts.where("text <> ''").select("text").limit(0).withColumn("difference", F.lit(0.0)), 0.0
    else:
        new = parts.where("rule is null and text <> ''").select("text").distinct()
        texts = cut_lineage(learn.where("back").select("text", "label", "back").unionByName(
            new.select("text", F.lit(None).cast("int").alias("label"), F.lit(False).alias("back"))).withColumn("id", F.monotonically_increasing_id()))
        found = cut_lineage(differences(texts, cut_lineage(stretch_counts(learn))).join(texts.hint("merge"), "id"))
        cut = _threshold(found.where("back"))
        scored = found.where("not back").select("text", F.col("d").alias("difference"))
    rest = parts.where("rule is null").join(scored.hint("merge"), "text", "left").withColumn("difference", F.coalesce("difference", F.lit(0.0)))
    method = F.when((F.col("text") != "") & (F.col("difference") < cut), "block").otherwise("allow")
    columns = ["page_id", "host", "path", "rule"]
    return (rest.select(*columns, method.alias("verdict"), "difference").unionByName(
        parts.where("rule is not null").select(*columns, F.col("said").alias("verdict"), F.lit(None).cast("double").alias("difference"))))
