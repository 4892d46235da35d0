"""Operators that need a global order: running sums, quantiles, ranks.

A window without partition would move every row to one task. Here the values
are first counted per distinct value, then cut into a fixed number of buckets of
about equally many values. Running sums are taken inside the buckets (in
parallel) and over the bucket totals.
A value shared by a third of all rows is a single counted row after the first
partial aggregation, so no task sees a hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from reportlens.session import cut_lineage

_SPLITS = 1023  # cuts between buckets


def value_splits(df: DataFrame, value: str) -> Column:
    """Cuts that deal the rows of ``df`` evenly by value, as a scalar subquery.

    The quantiles are approximate, which only makes buckets a little uneven. A
    column whose values all lie close together gets as many buckets as any.
    """
    share = [(i + 1) / (_SPLITS + 1) for i in range(_SPLITS)]
    return df.agg(F.percentile_approx(F.col(value).cast("double"), F.array(*map(F.lit, share)), F.lit(10_000))).scalar()


def value_bucket(value: str, splits: str) -> Column:
    """How many cuts of the sorted array column ``splits`` are at most the
    value: a binary search of ten steps, monotone in the value."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range((_SPLITS + 1).bit_length() - 1))])
    v = F.col(value).cast("double")
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(F.col(splits), at + step - 1) <= v, at + step).otherwise(at))


def kept_splits(df: DataFrame, value: str) -> Column:
    """``value_splits`` found once and kept in a table of one row, for any number of uses."""
    return cut_lineage(df.sparkSession.range(1).select(value_splits(df, value).alias("cuts"))).select("cuts").scalar()


def running_sums(df: DataFrame, value: str, sums, by=(), descending: bool = False, totals: bool = True,
                 splits: Column | None = None, written: bool = False) -> DataFrame:
    """Running sums over the distinct values of ``value`` within ``by``.

    ``df`` holds one row per (by, value); ``sums`` are numeric columns. Adds
    ``cum_<s>`` (value included) and, if asked, ``total_<s>`` over the group.
    The counted rows are read for the cuts, the bucket totals and the sums, so
    they are written first unless they are ``written`` already. ``splits``, an
    array of cuts (see ``kept_splits``), saves the look for them in repeated
    calls.
    """
    df = df if written else cut_lineage(df)
    by, sums = list(by), list(sums)
    # A struct compares equal with its nulls, so that one exchange by group and bucket serves windows and join alike.
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    cuts = value_splits(df, value) if splits is None else splits
    bucketed = df.withColumn("_splits", cuts).withColumn("_bucket", value_bucket(value, "_splits")).drop("_splits").withColumn("_group", group)
    order = (lambda c: F.col(c).desc()) if descending else F.col

    inside = Window.partitionBy("_group", "_bucket").orderBy(order(value)).rowsBetween(Window.unboundedPreceding, 0)
    # One row per bucket: at most _SPLITS + 1 for a group.
    before = Window.partitionBy("_group").orderBy(order("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_group")
    per_bucket = bucketed.groupBy("_group", "_bucket").agg(*[F.sum(s).alias("_b_" + s) for s in sums])
    offsets = per_bucket.select(
        "_group", "_bucket", *[F.coalesce(F.sum("_b_" + s).over(before), F.lit(0)).alias("_off_" + s) for s in sums],
        *[F.sum("_b_" + s).over(whole).alias("total_" + s) for s in sums if totals])
    out = bucketed.select("*", *[F.sum(s).over(inside).alias("_in_" + s) for s in sums]).join(offsets, ["_group", "_bucket"])
    out = out.withColumns({"cum_" + s: F.col("_in_" + s) + F.col("_off_" + s) for s in sums})
    return out.drop("_group", "_bucket", *["_in_" + s for s in sums], *["_off_" + s for s in sums])


def melt(df: DataFrame, cols, by=(), name: str = "metric", positive_only: bool = False) -> DataFrame:
    """Long form (by, metric, value double); nulls and NaN are dropped, as are
    values of zero or less when ``positive_only``."""
    wide = df.select(*by, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    long = wide.unpivot(list(by), list(cols), name, "value")
    keep = F.col("value").isNotNull() & ~F.isnan("value")
    return long.filter(keep & (F.col("value") > 0) if positive_only else keep)


def value_counts_long(df: DataFrame, cols, by=(), positive_only: bool = False) -> DataFrame:
    """(by, metric, value, n): one row per distinct value."""
    long = melt(df, cols, by, positive_only=positive_only)
    return long.groupBy(*by, "metric", "value").agg(F.count(F.lit(1)).alias("n"))


def _quantile_parts(probs):
    """(aggregates over ranked counts, result columns) of interpolated quantiles."""
    lo_rank, hi_rank = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1  # zero-based
    aggs, out = [], []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("total_n") - 1)
        for side, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            aggs.append(F.max(F.when((lo_rank <= place) & (hi_rank >= place), F.col("value"))).alias(f"_{side}_{i}"))
        pos, lo, hi = F.lit(float(p)) * (F.col("n") - 1), F.col(f"_lo_{i}"), F.col(f"_hi_{i}")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(f"q_{i}"))
    return aggs, out


def quantiles_of_counts(counts: DataFrame, probs, by=("metric",)) -> DataFrame:
    """Linearly interpolated quantiles from (by, value, n) rows.

    Output: by, n, and one ``q_<i>`` column per probability.
    """
    by = list(by)
    aggs, out = _quantile_parts(probs)
    found = running_sums(counts, "value", ["n"], by).groupBy(*by).agg(F.max("total_n").alias("n"), *aggs)
    return found.select(*by, "n", *out)


def summary_of_counts(counts: DataFrame, probs, by=("metric",)) -> DataFrame:
    """Like ``quantiles_of_counts``, with mean, sample std, min, max, population
    skewness and excess kurtosis from the same rows. The running sums bring the
    total of a group to each of its rows, so that moments are central ones."""
    by = list(by)
    aggs, out = _quantile_parts(probs)
    run = running_sums(counts.withColumn("nv", F.col("n") * F.col("value")), "value", ["n", "nv"], by)
    gap = F.col("value") - F.col("total_nv") / F.col("total_n")
    central = [F.sum(F.col("n") * gap ** k).alias(f"_m{k}") for k in (2, 3, 4)]
    found = run.groupBy(*by).agg(F.max("total_n").alias("n"), (F.sum("nv") / F.sum("n")).alias("mean"), F.min("value").alias("min"),
                                 F.max("value").alias("max"), *central, *aggs)
    n, m2 = F.col("n"), F.col("_m2") / F.col("n")
    return found.select(*by, "n", "mean", F.sqrt(F.col("_m2") / F.nullif(n - 1, F.lit(0))).alias("std"), "min", "max",
                        (F.col("_m3") / n / F.nullif(m2, F.lit(0.0)) ** 1.5).alias("skewness"),
                        (F.col("_m4") / n / F.nullif(m2, F.lit(0.0)) ** 2 - 3).alias("kurtosis"), *out)


def quantiles(df: DataFrame, cols, probs, by=(), positive_only: bool = False) -> DataFrame:
    """Exact quantiles of several columns: (by, metric, n, q_0, q_1, …)."""
    return quantiles_of_counts(value_counts_long(df, cols, by, positive_only), probs, [*by, "metric"])


def ecdf(df: DataFrame, col: str, positive_only: bool = True) -> DataFrame:
    """(value, n, cumulative_pct) per distinct value."""
    counts = value_counts_long(df, [col], positive_only=positive_only).select("value", "n")
    out = running_sums(counts, "value", ["n"])
    return out.select("value", "n", (F.col("cum_n") / F.col("total_n") * 100).alias("cumulative_pct"))


def running_counts(df: DataFrame, value: str, counts: dict, by=(), descending: bool = False) -> DataFrame:
    """Cumulative counts over ordered distinct values.

    ``counts`` maps an output name to a boolean Column; each becomes ``<name>``
    (rows at the value) and ``cum_<name>`` / ``total_<name>``.
    """
    base = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    return running_sums(base, value, list(counts), by, descending)


def distributed_rank(df: DataFrame, order_hash, by=()) -> DataFrame:
    """Exact zero-based ``rank`` inside ``by`` in the order of a 64-bit hash.

    The hash is cut into 65,536 equal slices; rows are numbered inside each slice and
    shifted by the counts of the slices before it. A ``by`` value holding most
    of the rows is spread over all slices.
    """
    by = list(by)
    ranked = df.withColumn("_h", order_hash).withColumn("_slice", F.shiftrightunsigned("_h", 48))
    ranked = ranked.withColumn("_group", F.struct(*by) if by else F.struct(F.lit(0).alias("all")))
    inside = Window.partitionBy("_group", "_slice").orderBy(F.shiftrightunsigned("_h", 1), "_h")
    counts = ranked.groupBy("_group", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_group", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = ranked.withColumn("_rn", F.row_number().over(inside)).join(offsets, ["_group", "_slice"])
    return out.withColumn("rank", F.col("_rn") - 1 + F.col("_off")).drop("_h", "_group", "_slice", "_rn", "_off")
