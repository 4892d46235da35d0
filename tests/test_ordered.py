"""Global-order operators against numpy / Python."""

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reportlens.operators import dedup, ordered, profile, splits, stats


def test_value_bucket_is_monotone(spark):
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(0, 10.0 ** e, 300) for e in range(-6, 9)] + [2.0 ** np.arange(-20, 40), -(2.0 ** np.arange(-20, 40)), [0.0, 1e300, -1e300]])
    v = np.concatenate([v, np.nextafter(v, np.inf), np.nextafter(v, -np.inf)])
    d = spark.createDataFrame([(float(x),) for x in v], "v double")
    d = d.withColumn("s", ordered.value_splits(d, "v")).select("v", ordered.value_bucket("v", "s").alias("b")).orderBy("v").collect()
    b = [r["b"] for r in d]
    assert all(x <= y for x, y in zip(b, b[1:]))
    assert len(set(b)) > 100


def test_value_bucket_cuts_a_narrow_column(spark):
    """A million values that differ by a millionth of their size are dealt over
    many buckets of about equal size."""
    d = spark.range(1_000_000).select((F.lit(1.7e9) + F.col("id") / 1000).alias("v"))
    d = d.withColumn("s", ordered.value_splits(d, "v")).select(ordered.value_bucket("v", "s").alias("b"))
    n = [r["count"] for r in d.groupBy("b").count().collect()]
    assert len(n) > 900 and max(n) < 5000


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    data = [("hot", float(round(x, 2))) for x in rng.lognormal(3, 2, 2000)] + [("small", -1.5), ("small", 2.5), ("hot", None)] + [("hot", 7.0)] * 1500
    d = spark.createDataFrame(data, "g string, v double").repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r["g"]: [r[f"q_{i}"] for i in range(len(probs))] for r in ordered.quantiles(d, ["v"], probs, ["g"]).collect()}
    for g in ("hot", "small"):
        np.testing.assert_allclose(got[g], np.quantile([x for k, x in data if k == g and x is not None], probs), rtol=1e-12)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_ecdf(spark, values):
    d = spark.createDataFrame([(float(x),) for x in values], "v double")
    got = {r["value"]: r["cumulative_pct"] for r in ordered.ecdf(d, "v", positive_only=False).collect()}
    for x in set(values):
        assert abs(got[float(x)] - 100 * sum(y <= x for y in values) / len(values)) < 1e-9


def test_distributed_rank_is_a_permutation(spark):
    d = spark.range(3000).withColumn("g", F.when(F.col("id") < 2500, "hot").otherwise("cold"))
    got = ordered.distributed_rank(d, F.xxhash64("id"), ["g"]).collect()
    assert sorted(r["rank"] for r in got if r["g"] == "hot") == list(range(2500))
    assert sorted(r["rank"] for r in got if r["g"] == "cold") == list(range(500))


def test_folds_are_balanced_and_stable(spark):
    d = spark.range(1003).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    a = splits.assign_folds(d, "y", 5, 42, "id")
    n = {}
    for r in a.groupBy("y", "fold").count().collect():
        n.setdefault(r["y"], []).append(r["count"])
    assert all(len(c) == 5 and max(c) - min(c) <= 1 for c in n.values())
    again = splits.assign_folds(d.repartition(13), "y", 5, 42, "id")
    assert a.join(again.select("id", F.col("fold").alias("f2")), "id").filter("fold <> f2").count() == 0


def test_split_shares(spark):
    got = {r["split"]: r["count"] for r in splits.split(spark.range(20000), [0.7, 0.15, 0.15], 7, "id").groupBy("split").count().collect()}
    assert abs(got[0] / 20000 - 0.7) < 0.02 and abs(got[1] / 20000 - 0.15) < 0.02


def test_dedup_first_with_hot_key_and_blank(spark):
    d = spark.createDataFrame([(i, "same" if i % 3 else "") for i in range(99)] + [(99, None), (100, "x")], "id int, t string").repartition(5)
    assert sorted(r["id"] for r in dedup.dedup_first(d, "t", "id").collect()) == [0, 1, 99, 100]
    kept = dedup.dedup_first(d, "t", "id", keep_blank=F.coalesce(F.col("t"), F.lit("")) == "")
    assert sorted(r["id"] for r in kept.collect()) == sorted([i for i in range(99) if i % 3 == 0] + [1, 99, 100])


def test_histogram_closes_the_last_bin_and_lists_empty_bins(spark):
    d = spark.createDataFrame([(float(x),) for x in [0, 1, 1, 10]], "v double")
    got = profile.histogram(d, "v", bins=5).orderBy("bin").collect()
    assert [r["n"] for r in got] == [3, 0, 0, 0, 1]
    assert profile.histogram(d.filter("v = 1"), "v", bins=3).agg(F.sum("n")).first()[0] == 2


def test_quantile_bucket_keeps_ties_together(spark):
    d = spark.createDataFrame([(1.0,)] * 6 + [(2.0,), (3.0,)], "v double")
    got = {(r["v"], r["b"]) for r in stats.quantile_bucket(d, "v", ["a", "b", "c", "d"], out="b").collect()}
    assert got == {(1.0, "a"), (2.0, "d"), (3.0, "d")}


def test_rank_tests_match_brute_force(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 20, 150).astype(float), rng.integers(4, 25, 90).astype(float)
    d = spark.createDataFrame([(float(x), True) for x in a] + [(float(x), False) for x in b], "v double, s boolean")
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    mw = stats.mann_whitney(d, ["v"], F.col("s")).first()
    assert mw["u"] == u and mw["p_value"] < 0.001 and mw["z"] < 0
    grid = np.unique(np.concatenate([a, b]))
    ks = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    assert abs(stats.ks_two_sample(d, ["v"], F.col("s")).first()["statistic"] - ks) < 1e-12


def test_ks_p_value_of_equal_samples(spark):
    d = spark.createDataFrame([(float(x), s) for x in range(50) for s in (True, False)], "v double, s boolean")
    assert stats.ks_two_sample(d, ["v"], F.col("s")).first()["p_value"] == 1.0
