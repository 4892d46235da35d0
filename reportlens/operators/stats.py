"""Quantile bins and two-sample / normality tests."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reportlens.operators import ordered


def quantile_bucket(df: DataFrame, col: str, labels, out: str = "bucket") -> DataFrame:
    """Right-closed bins on the value quantiles. Ties share a bin, unlike
    ``ntile``. The edges are one scalar subquery."""
    k = len(labels)
    probs = [i / k for i in range(1, k)]
    edges = ordered.quantiles(df, [col], probs).select(F.struct(*[f"q_{i}" for i in range(k - 1)])).scalar()
    bucket = F.lit(labels[-1])
    for i in reversed(range(k - 1)):
        bucket = F.when(F.col(col) <= F.col(f"_edges.q_{i}"), F.lit(labels[i])).otherwise(bucket)
    return df.withColumn("_edges", edges).withColumn(out, F.when(F.col(col).isNotNull(), bucket)).drop("_edges")


def kolmogorov_p(statistic: Column, n_effective: Column) -> Column:
    """Asymptotic two-sided p value (first 100 terms of the series)."""
    lam = statistic * F.sqrt(n_effective)
    terms = F.transform(F.sequence(F.lit(1), F.lit(100)),
                        lambda k: F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * k * k * lam * lam))
    p = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


def ks_two_sample(df: DataFrame, cols, side: Column) -> DataFrame:
    """(metric, n1, n2, statistic, p_value); ``side`` marks the first sample."""
    long = ordered.melt(df.withColumn("_first", side), cols, ["_first"])
    counts = long.groupBy("metric", "value").agg(
        F.count_if(F.col("_first")).alias("a"), F.count_if(~F.col("_first")).alias("b"))
    run = ordered.running_sums(counts, "value", ["a", "b"], ["metric"])
    gap = F.abs(F.col("cum_a") / F.col("total_a") - F.col("cum_b") / F.col("total_b"))
    out = run.groupBy("metric").agg(F.max("total_a").alias("n1"), F.max("total_b").alias("n2"), F.max(gap).alias("statistic"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")  # the product of two counts exceeds 64 bits at scale
    n_eff = n1 * n2 / (n1 + n2)
    return out.withColumn("p_value", kolmogorov_p(F.col("statistic"), n_eff))


def ks_normal(df: DataFrame, col: str, positive_only: bool = True) -> DataFrame:
    """One-sample test against the normal law with the sample's mean and std."""
    from pyspark.ml.stat import KolmogorovSmirnovTest
    v = ordered.melt(df, [col], positive_only=positive_only).select("value")
    m = v.agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s")).first()
    return KolmogorovSmirnovTest.test(v, "value", "norm", m["m"], m["s"])


def normality(df: DataFrame, cols, alpha: float = 0.05) -> DataFrame:
    """Jarque-Bera verdict per column from skewness and kurtosis of the
    positive values: (metric, n, jarque_bera, p_value, is_normal)."""
    m = ordered.melt(df, cols, positive_only=True).groupBy("metric").agg(
        F.count("value").alias("n"), F.skewness("value").alias("_s"), F.kurtosis("value").alias("_k"))
    jb = F.col("n") / 6.0 * (F.col("_s") * F.col("_s") + F.col("_k") * F.col("_k") / 4.0)
    out = m.withColumn("jarque_bera", jb).withColumn("p_value", F.exp(-F.col("jarque_bera") / 2.0))
    return out.withColumn("is_normal", F.col("p_value") > alpha).drop("_s", "_k")


def _two_sided_p():
    """Arrow function over the few result rows; built inside a function so that
    it travels to the executors by value."""
    @F.pandas_udf(T.DoubleType())
    def p(z: pd.Series) -> pd.Series:
        return z.map(lambda x: math.erfc(abs(x) / math.sqrt(2)) if x == x else float("nan"))
    return p


def mann_whitney(df: DataFrame, cols, side: Column) -> DataFrame:
    """(metric, n1, n2, u, z, p_value): U of the sample where ``side`` holds,
    tie-corrected normal approximation."""
    long = ordered.melt(df.withColumn("_first", side), cols, ["_first"])
    counts = long.groupBy("metric", "value").agg(
        F.count_if(F.col("_first")).alias("a"), F.count(F.lit(1)).alias("n"))
    run = ordered.running_sums(counts, "value", ["a", "n"], ["metric"])
    mid_rank = F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2
    n = F.col("n").cast("double")
    out = run.groupBy("metric").agg(
        F.max("total_a").alias("n1"), (F.max("total_n") - F.max("total_a")).alias("n2"),
        F.sum(F.col("a") * mid_rank).alias("_rank_sum"), F.sum(n * n * n - n).alias("_ties"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    total = n1 + n2
    out = out.withColumn("u", F.col("_rank_sum") - n1 * (n1 + 1) / 2)
    sigma = F.sqrt(n1 * n2 / 12.0 * ((total + 1) - F.col("_ties") / (total * (total - 1))))
    out = out.withColumn("z", (F.col("u") - n1 * n2 / 2.0) / sigma)
    return out.select("metric", "n1", "n2", "u", "z", _two_sided_p()("z").alias("p_value"))
