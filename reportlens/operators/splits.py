"""Seeded splits and folds, functions of a key hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reportlens.functions import draws
from reportlens.operators import ordered, stats


def split(df: DataFrame, weights, seed: int, key: str, out: str = "split") -> DataFrame:
    """Adds the index of the part each row falls in; ``weights`` sum to one.
    The same key always lands in the same part."""
    point = draws.unit(key, seed)
    edges, total = [], 0.0
    for w in weights[:-1]:
        total += w
        edges.append(total)
    part = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        part = F.when(point < edges[i], i).otherwise(part)
    return df.withColumn(out, part)


def assign_folds(df: DataFrame, label: str, k: int, seed: int, key: str, out: str = "fold") -> DataFrame:
    """Stratified folds: sizes differ by at most one row per class. The rank
    inside a class is computed over hash slices, so a class of half of all rows
    is not sorted by one task."""
    ranked = ordered.distributed_rank(df, F.xxhash64(F.lit(seed), F.col(key)), [label])
    return ranked.withColumn(out, (F.col("rank") % k).cast("int")).drop("rank")


def split_drift(df: DataFrame, side: str, cols, flags=(), sections=()) -> DataFrame:
    """(kind, metric, first, second, diff) between the rows where ``side`` holds
    and the others: means and stds with the mean difference in percent of the
    first, label shares and completeness in points."""
    first = F.coalesce(F.col(side), F.lit(False))
    aggs, plan = [], []

    def both(name, fn, value):
        aggs.extend([fn(F.when(first, value)).alias(f"a_{name}"), fn(F.when(~first, value)).alias(f"b_{name}")])
    for i, c in enumerate(cols):
        both(f"m{i}", F.avg, F.col(c))
        both(f"s{i}", F.stddev_samp, F.col(c))
        plan += [("mean", c, f"m{i}"), ("std", c, f"s{i}")]
    for i, c in enumerate(flags):
        both(f"f{i}", F.avg, F.col(f"`{c}`") * 100.0)
        plan.append(("share", c, f"f{i}"))
    for i, c in enumerate(sections):
        present = F.when(F.coalesce(F.col(c), F.lit("")) != "", 100.0).otherwise(0.0)
        both(f"p{i}", F.avg, present)
        plan.append(("completeness", c, f"p{i}"))
    one = df.agg(*aggs)

    def row(kind, metric, n):
        a, b = F.col(f"a_{n}"), F.col(f"b_{n}")
        gap = F.abs(a - b)
        diff = gap / F.nullif(a, F.lit(0.0)) * 100 if kind == "mean" else gap
        return F.struct(F.lit(kind).alias("kind"), F.lit(metric).alias("metric"), a.alias("first"), b.alias("second"), diff.alias("diff"))
    return one.select(F.inline(F.array(*[row(*p) for p in plan])))


def split_match(df: DataFrame, side: str, cols, alpha: float = 0.05) -> DataFrame:
    """Two-sample KS per metric with the distribution verdict."""
    out = stats.ks_two_sample(df, cols, F.coalesce(F.col(side), F.lit(False)))
    return out.withColumn("match", F.col("p_value") > alpha)
