"""Exact de-duplication with a heavy-hitter split.

A text that fills a large part of the table would meet in one task if all rows were shuffled by digest. Misra-Gries
counters (one pass, a fixed number of counters) find the digests that can be that frequent, one exact count verifies
them, and their winners are broadcast: the losers are marked where they are read. What is left has no frequent digest
and is shuffled in the ordinary way.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportlens.llm.common import lower_ascii, travels_by_value
from reportlens.session import cut_lineage

travels_by_value(__name__)
COUNTERS = 1024


def text_digest(c):
    """SHA-256 (lower-case hex) of the text with A-Z lower-cased; null counts as empty."""
    return F.sha2(lower_ascii(F.coalesce(c, F.lit(""))), 256)


def _misra_gries(k: int):
    """Summarise the digests of a partition in at most ``k`` counters. A digest
    seen more than rows / (k + 1) times is always among them."""
    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for x in batch.column(0).value_counts().tolist():
                held[x["values"]] += x["counts"]
            if len(held) > k:  # all give up what the (k + 1)-th largest has
                cut = sorted(held.values(), reverse=True)[k]
                held = Counter({d: n - cut for d, n in held.items() if n > cut})
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                         ["digest", "seen"])
    return run


def heavy_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified frequent digests: (digest, keep_id, group_size), at most
    ``counters`` rows. ``digests`` has the columns (doc_id, digest)."""
    seen = digests.select("digest").mapInArrow(_misra_gries(counters), "digest string, seen long")
    likely = (seen.groupBy("digest").agg(F.sum("seen").alias("seen")).orderBy(F.desc("seen"), "digest")
              .limit(counters).select("digest"))
    exact = (digests.join(F.broadcast(likely), "digest", "left_semi").groupBy("digest")
             .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    return exact.where("group_size > 1")


def exact_decisions(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any others): doc_id, keep_id,
    group_size, kept, text_sha256.

    Equal texts are those that agree once A-Z is lower-cased; null counts as
    the empty text. The largest doc_id of a group stays (a null id loses to any
    other). Of repeated rows with that doc_id exactly one is kept. An empty
    table gives an empty result.
    """
    digests = cut_lineage(docs.select("doc_id", text_digest(F.col("text")).alias("digest")))
    heavy = cut_lineage(heavy_digests(digests, counters))
    marked = digests.join(F.broadcast(heavy), "digest", "left")
    lost = F.col("group_size").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("keep_id"))
    group = Window.partitionBy("digest")
    rest = marked.where(~lost).select(
        "doc_id", F.coalesce("keep_id", F.max("doc_id").over(group)).alias("keep_id"),
        F.coalesce("group_size", F.count(F.lit(1)).over(group)).alias("group_size"),
        (F.row_number().over(group.orderBy(F.col("doc_id").desc_nulls_last())) == 1).alias("kept"), "digest")
    dropped = marked.where(lost).select("doc_id", "keep_id", "group_size", F.lit(False).alias("kept"), "digest")
    return rest.unionByName(dropped).withColumnRenamed("digest", "text_sha256")


def drop_exact_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, by the rule of
    ``exact_decisions``. Losers of frequent texts go before the shuffle."""
    digests = cut_lineage(docs.select("doc_id", text_digest(F.col("text")).alias("digest")))
    heavy = cut_lineage(heavy_digests(digests, counters)).select("digest", "keep_id", F.lit(True).alias("heavy"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", text_digest(F.col("text")).alias("digest"))
    marked = rows.join(F.broadcast(heavy), "digest", "left")
    left = marked.where(F.col("heavy").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")))
    first = Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last())
    return left.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")
