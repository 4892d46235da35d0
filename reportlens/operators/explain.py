"""Model explanations as DataFrames."""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from reportlens.operators import ordered
from reportlens.operators.rows import top_n
from reportlens.session import cut_lineage


def _stage(model, attribute: str):
    """The fitted stage of a pipeline that has an attribute."""
    for s in reversed(getattr(model, "stages", [model])):
        if hasattr(s, attribute):
            return s
    raise ValueError(f"no stage with {attribute}")


def odds_ratios(spark, model, cols) -> DataFrame:
    """(feature, coefficient, odds_ratio); one row per feature column."""
    coef = _stage(model, "coefficients").coefficients.toArray().tolist()
    return spark.createDataFrame([(c, float(b), math.exp(b)) for c, b in zip(cols, coef)],
                                 "feature string, coefficient double, odds_ratio double")


def tree_importance(spark, model, cols) -> DataFrame:
    imp = _stage(model, "featureImportances").featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(cols, map(float, imp))), "feature string, importance double")


def top_features(importance: DataFrame, m: int, by: str = "importance") -> list[str]:
    """Names of the m best features (the table has one row per feature)."""
    return [r["feature"] for r in top_n(importance, by, m, tie="feature").collect()]


def _shuffled(long: DataFrame, key: str, draw: str, seed: int, keep):
    """(takers, givers) of the rows of every draw, ranked by two different
    hashes; a giver's vector is called y."""
    def ranked(frame, side):
        return ordered.distributed_rank(frame, F.xxhash64(F.lit(seed + side), F.col(draw), F.col(key)), [draw])
    givers = ranked(long.select(key, draw, F.col("x").alias("y")), 1)
    return ranked(long.select(key, draw, *keep), 0), givers.select(draw, "rank", "y")


def permutation_importance(model, df: DataFrame, cols, repeats: int = 5, seed: int = 42, key: str = "uid") -> DataFrame:
    """(feature, importance, std): mean and std of the accuracy drop when one
    feature's values are shuffled among the rows.

    The shuffle is a re-join, for all repeats at once: in every repeat a row is
    ranked by one hash and takes the value of the row with the same rank under
    another, so nothing is collected. All variants of a row are scored in one
    transform. The plan is the same for any number of repeats.
    """
    base = cut_lineage(df.select(key, "label", vector_to_array("features").alias("x")))
    n = len(cols)
    long = base.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    takers, givers = _shuffled(long, key, "r", seed, ["label", "x"])
    pairs = takers.join(givers, ["r", "rank"])

    def variant(f):
        return F.struct(f.alias("f"), F.transform("x", lambda v, i: F.when(i == f, F.get("y", i)).otherwise(v)).alias("v"))
    variants = pairs.select("label", "r", F.inline(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), variant)))
    rows = base.select("label", F.lit(0).alias("r"), F.lit(-1).alias("f"), F.col("x").alias("v")).unionByName(variants)
    rows = rows.withColumn("features", array_to_vector("v"))
    acc = model.transform(rows).groupBy("f", "r").agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("acc"))
    acc = cut_lineage(acc)  # one row per variant
    whole = acc.filter("f = -1").select("acc").scalar()
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("f") + 1)
    return acc.filter("f >= 0").withColumn("drop", whole - F.col("acc")).groupBy("f").agg(
        F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("std")).select(names.alias("feature"), "importance", "std")


def shapley_sample(model, df: DataFrame, cols, orders: int = 4, seed: int = 42, key: str = "uid", positive: int = 1):
    """(key, feature, attribution): sampled Shapley values of the probability.

    For every sampled feature order a row is paired with another row of the
    table (its background). Features switch from background to own values one by
    one in that order; the change of the prediction at each switch belongs to
    the feature switched. The changes of one order add up to f(row) - f(background).
    All orders are rows of one table: each prediction on a walk counts for the
    feature just switched and against the next one, so that walks need not be
    put together again and the plan is the same for any number of orders.
    """
    base = cut_lineage(df.select(key, vector_to_array("features").alias("x")))
    n = len(cols)
    long = base.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(orders - 1))))
    takers, givers = _shuffled(long, key, "o", seed, ["x"])
    features = F.sequence(F.lit(0), F.lit(n - 1))
    # The order of an o is that of the hashes of its features.
    drawn = F.array_sort(F.transform(features, lambda f: F.struct(F.xxhash64(F.lit(seed), F.col("o"), f).alias("h"), f.alias("f"))))
    walks = takers.join(givers, ["o", "rank"]).withColumn("order", drawn).withColumn("order", F.col("order.f"))
    steps = walks.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(n))))
    own = F.transform("x", lambda v, i: F.when(F.array_position("order", i) <= F.col("step"), v).otherwise(F.get("y", i)))
    scored = model.transform(steps.withColumn("features", array_to_vector(own))).select(
        key, F.get("order", F.col("step") - 1).alias("switched"), F.get("order", F.col("step")).alias("next"),
        vector_to_array("probability")[positive].alias("p"))
    changes = scored.select(key, F.inline(F.array(F.struct(F.col("switched").alias("f"), F.col("p").alias("d")),
                                                  F.struct(F.col("next").alias("f"), (-F.col("p")).alias("d"))))).filter("f IS NOT NULL")
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("f") + 1)
    return changes.groupBy(key, "f").agg((F.sum("d") / orders).alias("attribution")).select(key, names.alias("feature"), "attribution")


def mean_abs_attribution(attributions: DataFrame) -> DataFrame:
    return attributions.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs"))
