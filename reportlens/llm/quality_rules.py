"""Quality rules: rules on one document, and lines that too many documents of a host share.

Everything is a Column expression or a DataFrame operation. Hashed lines are counted over the distinct texts of a host,
so copies of one text count once. A line of more than ``max_share`` of a host's texts (and of at least ``min_docs``) is
boilerplate, and so is a line of ``LINE_WORDS`` words or more in more than ``max_docs`` texts of a host, however large
the host. It is removed, except from the first text that has it: no content is lost entirely. A document that loses so
much that less than ``min_words`` words or ``min_left`` of its words stay is depleted and rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlens.llm.common import SPACE, WORD, n_words
from reportlens.session import cut_lineage

MIN_WORDS, MAX_REPEATED, GRAM = 20, 30, 8
MAX_SHARE, MIN_DOCS, MIN_LEFT = 0.1, 10, 0.3
MAX_DOCS, LINE_WORDS = 500, 3


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.lower(F.trim(F.regexp_replace(line, SPACE, " "))))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))


def _grams(hashes: Column, n: int) -> Column:
    """Hash of each window of ``n`` words."""
    at = F.sequence(F.lit(0), F.size(hashes) - n)
    return F.when(F.size(hashes) >= n, F.transform(at, lambda i: F.xxhash64(*[hashes.getItem(i + k) for k in range(n)])))


def _repeated(grams: Column) -> Column:
    """Windows sorted by hash and place, if any hash occurs twice; else null.
    The result must be a column of its own before ``_covered`` reads it: an
    expression inside a lambda is evaluated for every element."""
    pairs = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), pairs)


def _covered(pairs: Column, n: int) -> Column:
    """Words in windows whose hash occurs again: equal windows are neighbours in
    ``pairs``; their places, sorted again, add at most ``n`` words each."""
    beside = F.filter(pairs, lambda x, i: F.get(pairs, i - 1)["h"].eqNullSafe(x["h"])
                      | F.get(pairs, i + 1)["h"].eqNullSafe(x["h"]))
    places = F.array_sort(F.transform(beside, lambda x: x["i"]))
    return F.aggregate(places, F.struct(F.lit(0).alias("sum"), F.lit(-n).alias("last")),
                       lambda a, p: F.struct((a["sum"] + F.least(p - a["last"], F.lit(n))).alias("sum"),
                                             p.alias("last")), lambda a: a["sum"])


def document_features(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per row of ``docs``: doc_id, host, the base counts, and ``lines``: hash
    and words of each distinct normalised line. Null text is empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", F.col(host).alias("host"), text.alias("text")).select(
        "doc_id", "host", "text", F.xxhash64("text").alias("digest"),
        F.array_remove(F.split("text", SPACE), "").alias("words"), _lines(F.col("text")).alias("rows"))
    hashed = split.select(
        "doc_id", "host", "digest", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("rows") - F.size(F.array_distinct("rows"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda x: F.xxhash64(x)).alias("hashes"),
        F.transform("rows", lambda x: F.struct(_line_hash(x).alias("h"), n_words(x).alias("n"))).alias("lines"))
    windows = hashed.withColumn("grams", _grams(F.col("hashes"), GRAM)).drop("hashes")
    sorted_twice = windows.withColumn("pairs", _repeated(F.col("grams"))).drop("grams")
    covered = F.coalesce(_covered(F.col("pairs"), GRAM), F.lit(0)).cast("long")
    counted = sorted_twice.withColumn("n_repeat_words", covered).drop("pairs")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def common_lines(features: DataFrame, max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS, max_docs: int = MAX_DOCS) -> DataFrame:
    """Lines over the limit of their host: (host, h, first_digest), the last
    being the text that may keep the line."""
    text = ["host", "digest"]
    one = features.groupBy(*text).agg(F.min("doc_id").alias("doc_id"), F.first("lines").alias("lines"))
    size = one.groupBy("host").agg(F.count(F.lit(1)).alias("texts")).withColumnRenamed("host", "of")
    bearers = one.select("host", "digest", "doc_id", F.explode(F.array_distinct("lines")).alias("line")).select("host", "digest", "doc_id", "line.*")
    counts = bearers.groupBy("host", "h").agg(F.count(F.lit(1)).alias("texts_with"), F.max("n").alias("n_words"),
                                              F.min(F.struct("doc_id", "digest")).alias("first")).where(F.col("texts_with") >= min_docs)
    often = (F.col("texts_with") > max_docs) & (F.col("n_words") >= LINE_WORDS)
    return (counts.join(size, F.col("host").eqNullSafe(F.col("of"))).where((F.col("texts_with") > max_share * F.col("texts")) | often)
            .select("host", "h", F.col("first.digest").alias("first_digest")))


def _removed(features: DataFrame, common: DataFrame) -> DataFrame:
    """Lines that go, per distinct (host, digest): their hashes and words."""
    line = F.explode("lines").alias("line")
    rows = (features.groupBy("host", "digest").agg(F.first("lines").alias("lines"))
            .select("host", "digest", line).select("host", "digest", "line.h", "line.n"))
    c = common.select(F.col("host").alias("of"), F.col("h").alias("g"), "first_digest")
    hit = rows.join(c, (F.col("h") == F.col("g")) & F.col("host").eqNullSafe(F.col("of"))
                    & (F.col("digest") != F.col("first_digest")))
    return hit.groupBy(F.col("host").alias("of"), F.col("digest").alias("whose")).agg(
        F.sum("n").alias("n_removed"), F.collect_set("h").alias("removed"))


def quality_decisions(docs: DataFrame, host: str = "source", max_share: float = MAX_SHARE, min_docs: int = MIN_DOCS,
                      min_left: float = MIN_LEFT, max_docs: int = MAX_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, n_removed (words in removed
    lines), kept, and host, digest, removed (hashes of removed lines).

    Null text or text without a word has zero counts and fails the base rules.
    Null hosts are one host. Repeated rows get the same verdict each.
    """
    features = cut_lineage(document_features(docs, host))
    gone = _removed(features, cut_lineage(common_lines(features, max_share, min_docs, max_docs)))
    out = features.drop("lines").join(gone, F.col("host").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("whose")), "left")
    removed = F.coalesce("n_removed", F.lit(0))
    left = F.col("n_words") - removed
    depleted = (removed > 0) & ((left < MIN_WORDS) | (left < min_left * F.col("n_words")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      removed.alias("n_removed"), (~F.col("base_failed") & ~depleted).alias("kept"), "host", "digest", "removed")


def apply_quality_rules(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents that pass, without their removed lines; ``n_chars``, if
    there is one, follows the text. All other columns are as they were."""
    made = quality_decisions(docs, host, **limits)
    known = cut_lineage(made.where(~F.col("kept") | (F.col("n_removed") > 0)).select(
        F.col("host").alias("of"), F.col("digest").alias("whose"), "kept", "removed").distinct())
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col(host).alias("host"), F.xxhash64(text).alias("digest"))
    rows = rows.join(known, (F.col("digest") == F.col("whose")) & F.col("host").eqNullSafe(F.col("of")), "left")
    rows = rows.where("kept is null or kept")
    lines = F.filter(F.split("row.text", "\n"), lambda x: ~F.array_contains(F.col("removed"), _line_hash(x)))
    changed = F.col("row").withField("text", F.array_join(lines, "\n"))
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.length(F.array_join(lines, "\n")).cast(docs.schema["n_chars"].dataType))
    return rows.select(F.when(F.size("removed") > 0, changed).otherwise(F.col("row")).alias("row")).select("row.*")
