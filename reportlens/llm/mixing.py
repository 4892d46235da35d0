"""Mixing sources to target weights by a low-discrepancy schedule.

A source is an endless tape: its documents in hashed order, again and again, cut into blocks of equally many words.
Slot i of the mix takes the point frac((i + 1/2) * golden ratio), the source whose share of the cumulative weights holds
that point, and the source's next block. So every stretch of the mix holds the sources in nearly their target shares,
and each source gives exactly its target, rounded down to whole words. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportlens.llm.common import n_words
from reportlens.session import cut_lineage

WEIGHTS, SHARE, REPEATS, BLOCK = (5, 2, 1), 1.5, 2, 512
_GOLDEN, _CELLS, _RUN = 0.6180339887498949, 4096, 65536


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, s, source_size, target) of the rows (source, size).

    Sources in code point order, null last, get ``weights`` in turn and number
    ``s``. They share ``share`` times all words by weight; none gets more than
    ``repeats`` times its own words, what is over goes to the others by weight.
    Sorted by cap per weight, the capped ones come first: a source is capped if
    the level that the rest could share evenly reaches its own cap; the first
    that is not gives the level of all that are not.
    """
    one = F.lit(0)
    by_name = Window.partitionBy(one).orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = F.row_number().over(by_name) - 1
    sources = sources.withColumn("s", s).withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.col("s") % len(weights) + 1))
    by_level = Window.partitionBy(one).orderBy(F.col("source_size") / F.col("w"), "s")
    before = F.coalesce(F.sum("source_size").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy(one))
    level = (F.lit(share) * total - repeats * before) / rest
    leveled = sources.withColumn("level", level).withColumn("cap", (repeats * F.col("source_size")).cast("double"))
    open_level = F.max(F.when(F.col("level") * F.col("w") < F.col("cap"), F.col("level"))).over(Window.partitionBy(one))
    target = F.least(F.col("cap"), F.coalesce(open_level * F.col("w"), F.col("cap")))
    return leveled.select("source", "s", "source_size", target.alias("target"))


def _earlier(rows: DataFrame, keys: list[str], bucket: str, order: list, value) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over all rows of the same
    keys in lower buckets or earlier in the same bucket. No key meets in one
    task: sums per bucket are added up first."""
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    start = cut_lineage(sums.select(*keys, bucket, F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_start")))
    placed = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(start, [*keys, bucket])
    return placed.withColumn("before", (F.col("_start") + F.col("_inside")).cast("long")).drop("_start", "_inside")


def _slots(targets: DataFrame, block: int) -> DataFrame:
    """(s, nth, slot): the slot in which a source gives its nth block."""
    quota = F.ceil(F.floor("target") / block).cast("long")
    end = F.sum("quota").over(Window.partitionBy(F.lit(0)).orderBy("s"))
    shares = cut_lineage(targets.withColumn("quota", quota).withColumn("end", end).where("quota > 0")
                         .select("s", "quota", (F.col("end") - F.col("quota")).alias("lo"), "end"))
    n = shares.agg(F.max("end")).first()[0] or 0
    point = F.pmod((F.col("slot") + 0.5) * F.lit(_GOLDEN), F.lit(1.0)) * F.lit(float(n))
    slots = shares.sparkSession.range(n).withColumnRenamed("id", "slot").withColumn("x", F.floor(point))
    width = max(1, -(-n // _CELLS))  # a share meets the cells it overlaps, a slot the cell of its point
    cells = shares.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("end") - 1) / width))))
    drawn = (slots.withColumn("cell", F.floor(F.col("x") / width)).join(cells, "cell").where("x >= lo and x < end")
             .select("s", "quota", "slot", F.floor(F.col("slot") / _RUN).alias("run")))
    ranked = _earlier(cut_lineage(drawn), ["s"], "run", ["slot"], F.lit(1)).withColumnRenamed("before", "nth")
    # What discrepancy left out comes at the end, what it gave too much is passed over.
    got = ranked.groupBy("s").agg(F.count(F.lit(1)).alias("got"))
    late = (shares.join(got, "s", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < quota")
            .select("s", F.explode(F.sequence("got", F.col("quota") - 1)).alias("nth"))
            .select("s", "nth", (F.lit(n) + F.col("nth")).alias("slot")))
    return ranked.where("nth < quota").select("s", "nth", "slot").unionByName(late)


def _placed(docs: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """``docs`` (with size) on the tapes: s, source_size, target, before (words ahead of the document)."""
    t = targets.withColumnRenamed("source", "_source")
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    rows = docs.join(t, docs["source"].eqNullSafe(t["_source"])).drop("_source").withColumn("_at", digest)
    rows = rows.withColumn("_bucket", F.substring("_at", 1, 3))
    return _earlier(rows, ["s"], "_bucket", ["_at", "doc_id", "size"], F.col("size")).drop("_at", "_bucket")


def _takes(placed: DataFrame) -> DataFrame:
    """One row per document and round of the tape that the target reaches: round, n (words taken, from the first on)."""
    shift = F.col("round") * F.col("source_size") + F.col("before")
    n = F.least(F.col("size"), F.floor("target").cast("long") - shift)
    return (placed.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1)))).withColumn("at", shift)
            .withColumn("n", n).where("n > 0"))


def sizes_of(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))


def mix_pieces(placed: DataFrame, targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix in order: slot, nth block of source s, and the part of a document
    in it: doc_id, round, from_word, n_words, with all columns of ``placed``."""
    first, last = F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("n") - 1) / block)
    parts = _takes(placed).withColumn("nth", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("at"), F.col("nth") * block)
    stop = F.least(F.col("at") + F.col("n"), (F.col("nth") + 1) * block)
    parts = parts.withColumn("from_word", start - F.col("at")).withColumn("n_words", stop - start)
    return parts.join(_slots(targets, block), ["s", "nth"]).drop("at", "n")


def mix_decisions(docs: DataFrame, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source, any others): doc_id,
    size, source_size, target, taken, the words of all its pieces in the mix.

    Null text has size 0 and takes 0; a null source is the last source; an
    empty table gives an empty result. The order on a tape is by a digest of
    seed and doc_id, so reruns agree.
    """
    sizes = cut_lineage(sizes_of(docs))
    targets = cut_lineage(source_targets(sizes))
    placed = cut_lineage(_placed(sizes, targets, seed))
    row = ["s", "before", "doc_id", "size", "source_size", "target"]
    taken = mix_pieces(placed, targets, block).groupBy(*row).agg(F.sum("n_words").cast("long").alias("taken"))
    none = placed.where("size = 0 or before >= floor(target)").select(*row, F.lit(0).cast("long").alias("taken"))
    return taken.unionByName(none).select("doc_id", "size", "source_size", "target", "taken")


def apply_mix(docs: DataFrame, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """The mixed corpus with the columns of ``docs``, in the order of the mix: a
    row per document and round of its tape, at the slot of the block in which it
    begins. Where a source's target ends inside a document, its text ends after
    the last word taken; ``n_chars``, if there is one, follows. Targets, places
    and slots come from sizes and hashes of the rows; the texts move twice, to
    their takes and into order.
    """
    # A null leaves a hash as it was, so the places of nulls are hashed, too.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    names = [F.xxhash64(F.lit(k), *columns, *(c.isNull() for c in columns)).alias(f"_h{k}") for k in (1, 2)]
    sizes = cut_lineage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *names))
    targets = cut_lineage(source_targets(sizes))
    taken = _takes(_placed(sizes, targets, seed)).withColumn("nth", F.floor(F.col("at") / block))
    taken = cut_lineage(taken.join(cut_lineage(_slots(targets, block)), ["s", "nth"]).select("_h1", "_h2", "slot", "at", "size", "n"))
    # Each text meets its takes once; rows alike in all columns are one text here, as any of them serves each take.
    same = Window.partitionBy("_h1", "_h2").orderBy("_h1")
    texts = docs.select(F.struct("*").alias("row"), *names)
    texts = texts.withColumn("_again", F.lag(F.lit(True), 1, False).over(same)).where("not _again")
    taken = texts.join(taken, ["_h1", "_h2"]).orderBy("slot", "at")
    spaced = F.split("row.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    text = F.array_join(F.slice(spaced, F.lit(1), F.col("n").cast("int")), "")
    cut = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        cut = cut.withField("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return taken.select(F.when(F.col("n") < F.col("size"), cut).otherwise(F.col("row")).alias("row")).select("row.*")
