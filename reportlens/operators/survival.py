"""Survival analysis over distinct event times."""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from reportlens.functions import draws
from reportlens.operators import ordered, stats
from reportlens.session import cut_lineage, drop_table

RISK_GROUPS = ("Low", "Med-Low", "Med-High", "High")


def surrogate_survival(df: DataFrame, severity: str = "F22_composite_severity", event: str = "F25_is_abnormal",
                       key: str = "uid", seed: int = 42) -> DataFrame:
    """time = clip(10 - 8 * severity + Exp(mean 2), 0.1, 20), event = abnormal.
    The exponential draw is a function of the key and the seed."""
    time = 10.0 - 8.0 * F.col(severity) - 2.0 * F.log(draws.unit(key, seed))
    return df.withColumns({"time": F.least(F.greatest(time, F.lit(0.1)), F.lit(20.0)), "event": F.col(event).cast("int")})


def _linear(cols, beta) -> Column:
    return sum((F.col(f"_z{i}") * float(b) for i, b in enumerate(beta)), F.lit(0.0))


def cox_fit(df: DataFrame, time: str, event: str, cols, l2: float = 0.1, max_iter: int = 100, tol: float = 1e-7) -> dict:
    """Proportional hazards by Newton steps with a ridge penalty (Breslow ties).

    Covariates are standardised for the fit and the coefficients scaled back.
    A step is one aggregation: sums per distinct time, running sums over the
    times from the latest, and p x p totals that reach the driver.
    The likelihood is averaged over the rows, as the penalty is per row. Rows
    without time or event take no part. ``converged`` says whether the gradient
    fell below ``tol``; a fit that did not is also warned about.
    """
    p = len(cols)
    df = df.filter(F.col(time).isNotNull() & F.col(event).isNotNull())
    numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    m = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(numbers[c]).alias(f"m{i}") for i, c in enumerate(cols)],
               *[F.stddev_samp(numbers[c]).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    mean = np.array([m[f"m{i}"] for i in range(p)])
    scale = np.array([m[f"s{i}"] or 1.0 for i in range(p)])
    base = df.select(F.col(time).cast("double").alias("_t"), F.col(event).cast("int").alias("_e"),
                     *[((numbers[c] - float(mean[i])) / float(scale[i])).alias(f"_z{i}") for i, c in enumerate(cols)]).persist()
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    n = m["n"]
    splits = ordered.kept_splits(base, "_t")  # all steps cut the same times

    def step(beta):
        risk = base.withColumn("_r", F.exp(_linear(cols, beta)))
        sums = risk.groupBy("_t").agg(
            F.sum("_e").alias("d"), F.sum("_r").alias("s0"), F.sum(F.when(F.col("_e") == 1, _linear(cols, beta))).alias("eta"),
            *[F.sum(F.col(f"_z{i}") * F.col("_r")).alias(f"a{i}") for i in range(p)],
            *[F.sum(F.col(f"_z{i}") * F.col(f"_z{j}") * F.col("_r")).alias(f"b{i}_{j}") for i, j in pairs],
            *[F.sum(F.when(F.col("_e") == 1, F.col(f"_z{i}")).otherwise(0.0)).alias(f"x{i}") for i in range(p)])
        names = ["s0", *[f"a{i}" for i in range(p)], *[f"b{i}_{j}" for i, j in pairs]]
        sums = cut_lineage(sums)
        run = ordered.running_sums(sums, "_t", names, descending=True, totals=False, splits=splits, written=True).filter("d > 0")
        s0 = F.col("cum_s0")
        one = run.agg(
            F.sum(F.col("eta") - F.col("d") * F.log(s0)).alias("ll"),
            *[F.sum(F.col(f"x{i}") - F.col("d") * F.col(f"cum_a{i}") / s0).alias(f"g{i}") for i in range(p)],
            *[F.sum(F.col("d") * (F.col(f"cum_b{i}_{j}") / s0 - F.col(f"cum_a{i}") * F.col(f"cum_a{j}") / (s0 * s0))).alias(f"h{i}_{j}")
              for i, j in pairs]).first()
        drop_table(sums)
        g = np.array([one[f"g{i}"] for i in range(p)]) / n - l2 * beta
        h = np.zeros((p, p))
        for i, j in pairs:
            h[i, j] = h[j, i] = one[f"h{i}_{j}"] / n
        return one["ll"], g, h + l2 * np.eye(p)

    beta, rounds = np.zeros(p), 0
    try:
        ll, g, h = step(beta)
        while np.max(np.abs(g)) > tol and rounds < max_iter:
            beta = beta + np.linalg.solve(h, g)
            ll, g, h = step(beta)
            rounds += 1
    finally:
        base.unpersist()
    converged = bool(np.max(np.abs(g), initial=0.0) <= tol)
    if not converged:
        warnings.warn(f"the Cox fit did not converge in {rounds} rounds", stacklevel=2)
    return {"cols": list(cols), "coef": (beta / scale).tolist(), "gradient": g.tolist(), "log_likelihood": float(ll),
            "iterations": rounds, "converged": converged, "mean": mean.tolist()}


def cox_table(spark, fit: dict) -> DataFrame:
    """(feature, coef, hazard_ratio, gradient, converged), one row per covariate."""
    data = [(c, float(b), float(np.exp(b)), float(g), fit["converged"]) for c, b, g in zip(fit["cols"], fit["coef"], fit["gradient"])]
    return spark.createDataFrame(data, "feature string, coef double, hazard_ratio double, gradient double, converged boolean")


def cox_risk(df: DataFrame, coef: dict, mean: dict | None = None, out: str = "risk") -> DataFrame:
    """Partial hazard exp(sum beta * (x - mean))."""
    mean = mean or {}
    score = sum((float(b) * (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - float(mean.get(c, 0.0))) for c, b in coef.items()), F.lit(0.0))
    return df.withColumn(out, F.exp(score))


def kaplan_meier(df: DataFrame, time: str, event: str, by) -> DataFrame:
    """(by, time, at_risk, deaths, survival) at every distinct time."""
    by = [by] if isinstance(by, str) else list(by)
    counts = cut_lineage(df.filter(F.col(time).isNotNull()).groupBy(*by, F.col(time).cast("double").alias("time")).agg(
        F.sum(F.col(event).cast("long")).alias("deaths"), F.count(F.lit(1)).alias("exits")))
    splits = ordered.kept_splits(counts, "time")  # both sums run over the same times
    left = ordered.running_sums(counts, "time", ["exits"], by, descending=True, totals=False, splits=splits, written=True)
    at_risk = left.select(*by, "time", F.col("cum_exits").alias("at_risk"), "deaths")
    dead = (F.col("deaths") == F.col("at_risk")).cast("int")
    # The factor 0 has no logarithm; it is carried as a flag.
    logs = at_risk.withColumns({"_log": F.when(dead == 0, F.log(1 - F.col("deaths") / F.col("at_risk"))).otherwise(0.0), "_zero": dead})
    run = ordered.running_sums(logs, "time", ["_log", "_zero"], by, totals=False, splits=splits)
    return run.select(*by, "time", "at_risk", "deaths", F.when(F.col("cum__zero") > 0, 0.0).otherwise(F.exp("cum__log")).alias("survival"))


def risk_group_curves(df: DataFrame, time: str, event: str, risk: str, labels=RISK_GROUPS, by: str = "risk_group") -> DataFrame:
    """Kaplan-Meier curves (risk_group, time, at_risk, deaths, survival) of the
    rows dealt into groups by the quantiles of their risk, lowest first. Equal
    risks share a group; rows without a risk take no part."""
    grouped = stats.quantile_bucket(df.filter(F.col(risk).isNotNull()), risk, list(labels), by)
    return kaplan_meier(grouped, time, event, by)


def _dense_rank(df: DataFrame, col: str, out: str, levels: DataFrame | None = None) -> DataFrame:
    """(col, out): zero-based rank of every distinct value."""
    values = (levels if levels is not None else df).select(F.col(col).cast("double").alias(col)).distinct().withColumn("_one", F.lit(1).cast("long"))
    return ordered.running_sums(values, col, ["_one"], totals=False).select(col, (F.col("cum__one") - 1).alias(out))


def concordance(df: DataFrame, time: str, event: str, risk: str) -> DataFrame:
    """(concordant, discordant, tied, c_index), exact.

    A pair counts if one row has an event and the other leaves later (a censored
    row of the same time counts as later). Higher risk should leave first. Pairs
    are not formed: risks are ranked, and for every bit of the rank the rows
    that agree on all higher bits are compared by running sums over time. That
    is about log2(distinct risks) counted rows per distinct (time, event, risk).
    """
    base = cut_lineage(df.filter(F.col(time).isNotNull() & F.col(risk).isNotNull()).groupBy(
        F.col(time).cast("double").alias("t"), F.col(event).cast("int").alias("e"), F.col(risk).cast("double").alias("r")).agg(
            F.count(F.lit(1)).alias("n")))
    t_rank, r_rank = _dense_rank(base, "t", "ti"), _dense_rank(base, "r", "ri")
    coded = base.join(t_rank, "t").join(r_rank, "r").select((2 * F.col("ti") + 1 - F.col("e")).alias("pos"), "ri", "e", "n")
    coded = cut_lineage(coded)
    top = coded.agg(F.max("ri")).scalar()
    levels = F.expr("filter(sequence(-1, 61), b -> b < 0 OR shiftright(top, b) > 0)")  # as many bits as the ranks have
    # Level -1 groups equal risks (ties); level b compares rows that differ first at bit b.
    cells = coded.withColumn("top", top).withColumn("level", F.explode(levels)).select(
        "level", F.expr("CASE WHEN level < 0 THEN ri ELSE shiftright(ri, level + 1) END").alias("grp"),
        F.expr("CASE WHEN level < 0 THEN 0L ELSE shiftright(ri, level) & 1L END").alias("bit"), "pos", "e", "n")
    per_pos = cells.groupBy("level", "grp", "pos").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("n0"),
        F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when((F.col("bit") == 0) & (F.col("e") == 1), F.col("n")).otherwise(0)).alias("e0"),
        F.sum(F.when((F.col("bit") == 1) & (F.col("e") == 1), F.col("n")).otherwise(0)).alias("e1"))
    run = ordered.running_sums(per_pos, "pos", ["n0", "n1"], ["level", "grp"], descending=True, totals=False)
    later0, later1 = F.col("cum_n0") - F.col("n0"), F.col("cum_n1") - F.col("n1")
    pair = F.col("level") >= 0
    d = lambda c: c.cast("double")  # noqa: E731  (pair counts exceed 64 bits at scale)
    out = run.agg(F.coalesce(F.sum(F.when(pair, d(F.col("e1")) * later0)), F.lit(0.0)).alias("concordant"),
                  F.coalesce(F.sum(F.when(pair, d(F.col("e0")) * later1)), F.lit(0.0)).alias("discordant"),
                  F.coalesce(F.sum(F.when(~pair, d(F.col("e0")) * later0)), F.lit(0.0)).alias("tied"))
    total = F.col("concordant") + F.col("discordant") + F.col("tied")
    return out.withColumn("c_index", (F.col("concordant") + F.col("tied") / 2) / F.nullif(total, F.lit(0.0)))
