"""Classifiers, cross-validation, explanations, Cox model.

What a fit computes is beyond SQL. The queries return what SQL knows of it: the
rows of each class and fold, and properties that hold for a right fit (residuals
that sum to zero at the optimum, attributions that add up, a loss that falls).
Tables that do not depend on a fit are compared in full.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.feature_queries import EN_CLEAN_SQL, EN_FEATURES_SQL, en_cleaned, en_features
from catalog.inputs import REPORTS_SQL, reports, table
from catalog.profile_queries import rounded
from catalog.registry import query
from catalog.stat_queries import _F1, _PRED, predictions, survival_rows, unit_sql
from reportlens.functions import lexicons as lx, text as tx
from reportlens.operators import explain, features, models, survival
from reportlens.session import cut_lineage

COLS = ["F05_impression_length", "F06_word_count", "F07_sentence_count", "F08_findings_impression_ratio",
        "F13_flesch_kincaid", "F14_abbrev_density", "F15_numerical_count", "F17_passive_ratio"]
SURV_COLS = ["l_discount", "l_tax", "l_extendedprice"]


def _features(spark, sf):
    return features.row_features(en_cleaned(spark, sf), lx.EN).select("uid", "condition", *COLS)


def quality_rows(spark, sf, mode="balanced"):
    """Two classes: the quality label on the row features."""
    d = _features(spark, sf).join(table(spark, sf, "labels").select(F.col("doc_id").alias("uid"), "quality"), "uid")
    return models.prepare(d, COLS, "quality", mode).select("uid", "label", "features", "class_weight")


def language_rows(spark, sf):
    """Four classes: the language on the row features."""
    return models.prepare(_features(spark, sf), COLS, "condition").select("uid", "label", "features", "class_weight")


_QUALITY = "(SELECT quality::DOUBLE AS label FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL)"
_LANGUAGE = "(SELECT dense_rank() OVER (ORDER BY lang) - 1.0::DOUBLE AS label FROM documents WHERE lang IS NOT NULL)"


def _classes_sql(source: str, *flags: str) -> str:
    return f"SELECT label::DOUBLE AS label, count(*) AS n{''.join(f', TRUE AS {f}' for f in flags)} FROM {source} GROUP BY 1"


def _classes(pred):
    """(label, n, known, better_than_chance) per class: all predictions are
    classes, and the mean recall is above that of guessing."""
    per = pred.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("recall"))
    one = per.agg(F.avg("recall").alias("recall"), F.count(F.lit(1)).alias("k"))
    known = pred.agg(F.array_except(F.collect_set("prediction"), F.collect_set("label"))).scalar()
    return per.withColumn("_one", one.select(F.struct("recall", "k")).scalar()).select(
        "label", "n", (F.size(known) == 0).alias("known"), (F.col("_one.recall") > 1.0 / F.col("_one.k")).alias("better_than_chance"))


def _balance(pred):
    """(label, n, balanced) per class: at the optimum of a logistic model with
    a free intercept, weighted probabilities and labels of a class have equal sums."""
    from pyspark.ml.functions import vector_to_array
    p = vector_to_array("probability")
    each = pred.select("label", "class_weight", p.alias("p"))
    sums = each.select("label", "class_weight", F.posexplode("p").alias("k", "p")).groupBy("k").agg(
        (F.sum(F.col("class_weight") * (F.col("p") - (F.col("label") == F.col("k")).cast("double"))) / F.sum("class_weight")).alias("gap"))
    counts = each.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(sums, F.col("label") == F.col("k")).select("label", "n", (F.abs("gap") < 1e-3).alias("balanced"))


_Z = [f"(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ())::DOUBLE AS {c}" for c in COLS]


@query("ml1_standardise",
       f"WITH {EN_FEATURES_SQL}, z AS (SELECT {', '.join(_Z)} FROM feats) SELECT "
       + ", ".join(f"round(avg({c}), 6) + 0.0::DOUBLE AS mean_{c[:3]}, round(stddev_samp({c}), 6) AS std_{c[:3]}" for c in COLS) + " FROM z")
def _(spark, sf):
    d = models.assemble(_features(spark, sf), COLS)
    scaled = models.feature_pipeline().fit(d).transform(d)
    from pyspark.ml.functions import vector_to_array
    v = vector_to_array("scaled")
    return scaled.agg(*[(F.round(F.avg(v[i]), 6) + 0.0).alias(f"mean_{c[:3]}") for i, c in enumerate(COLS)],
                      *[F.round(F.stddev_samp(v[i]), 6).alias(f"std_{c[:3]}") for i, c in enumerate(COLS)])


@query("ml3_logistic", _classes_sql(_QUALITY, "balanced"))
def _(spark, sf):
    d = cut_lineage(quality_rows(spark, sf))
    return _balance(models.logistic(d.count()).fit(d).transform(d))


@query("ml3_logistic_multinomial", _classes_sql(_LANGUAGE, "balanced"))
def _(spark, sf):
    d = cut_lineage(language_rows(spark, sf))
    return _balance(models.logistic(d.count()).fit(d).transform(d))


@query("ml4_forest", _classes_sql(_QUALITY, "known", "better_than_chance"))
def _(spark, sf):
    d = cut_lineage(quality_rows(spark, sf))
    return _classes(models.forest(trees=20, depth=8).fit(d).transform(d))


@query("ml5_boosted", _classes_sql(_QUALITY, "known", "better_than_chance"))
def _(spark, sf):
    d = cut_lineage(quality_rows(spark, sf, "positive"))
    return _classes(models.boosted(rounds=10, depth=4).fit(d).transform(d))


@query("ml5_boosted_multiclass", _classes_sql(_LANGUAGE, "known", "better_than_chance"))
def _(spark, sf):
    d = cut_lineage(language_rows(spark, sf))
    return _classes(models.boosted(rounds=4, depth=3, classes=4).fit(d).transform(d))


@query("ml5_softmax_loss",
       "SELECT range::INTEGER AS round, CASE WHEN range = 0 THEN round(ln((SELECT count(DISTINCT lang) FROM documents)), 6) END AS loss, TRUE AS falls FROM range(6)")
def _(spark, sf):
    d = cut_lineage(language_rows(spark, sf))
    losses = models.boosted(rounds=6, depth=3, classes=d.select("label").distinct().count()).fit(d).losses
    return spark.createDataFrame([(i, round(losses[i], 6) if i == 0 else None, losses[i + 1] < losses[i]) for i in range(6)],
                                 "round int, loss double, falls boolean")


@query("ml6_text_classifier", _classes_sql(_LANGUAGE, "balanced"))
def _(spark, sf):
    whole = reports(spark, sf).withColumn("text", tx.combine_text("findings", "impression")).select("uid", "condition", "text")
    coded, _ = models.index_labels(models.term_column(whole, "text"), "condition")
    d = cut_lineage(models.with_class_weight(coded, "label").select("uid", "label", "terms", "class_weight"))
    return _balance(models.text_classifier(d.count()).fit(d).transform(d))


# Fixed predictions, so that the scores over the folds can be compared in full.
_FOLDS = f"{_PRED}, k AS (SELECT *, doc_id % 5 AS fold FROM pred)"
_FOLD_REP = ("rep AS (SELECT fold, c AS class, count(*) FILTER (WHERE label = c AND prediction = c) AS tp, count(*) FILTER (WHERE label = c) AS support, "
             "count(*) FILTER (WHERE prediction = c) AS predicted FROM k, (VALUES (0), (1)) t(c) GROUP BY 1, 2)")


@query("ev1_cross_validate",
       f"WITH {_FOLDS}, {_FOLD_REP}, s AS (SELECT fold, max(CASE WHEN class = 1 THEN {_F1} END) AS f1, avg({_F1}) AS macro_f1, sum(tp) / sum(support) AS accuracy FROM rep GROUP BY 1), "
       "v AS (SELECT fold, score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS q FROM k GROUP BY 1, 2), "
       "a AS (SELECT fold, sum(p * (below + q / 2)) / (sum(p)::DOUBLE * sum(q)) AS auc FROM (SELECT fold, p, q, sum(q) OVER (PARTITION BY fold ORDER BY score) - q AS below FROM v) GROUP BY 1) "
       "SELECT 'primary' AS dataset, 'fixed' AS model, metric, round(avg(v), 6) AS value, round(stddev_pop(v), 6) AS std FROM ("
       + " UNION ALL ".join(f"SELECT '{m}' AS metric, {m}::DOUBLE AS v FROM {t}" for m, t in (("f1", "s"), ("macro_f1", "s"), ("accuracy", "s"), ("auc", "a"))) + ") GROUP BY 3")
def _(spark, sf):
    d = predictions(spark, sf).select("doc_id", F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"),
                                      F.array(F.lit(0.0), F.col("score")).alias("probability"), (F.col("doc_id") % 5).alias("fold"))
    return rounded(models.cross_validate(d, "fixed"))


def _folds_sql(source: str, k: int) -> str:
    return (f"SELECT label::DOUBLE AS label, fold::INTEGER AS fold, ((n - fold + {k - 1}) // {k})::BIGINT AS n, TRUE AS known "
            f"FROM (SELECT label, count(*) AS n FROM {source} GROUP BY 1), range({k}) t(fold)")


def _folds(pred):
    known = pred.agg(F.array_except(F.collect_set("prediction"), F.collect_set("label"))).scalar()
    return pred.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n")).withColumn("known", F.size(known) == 0)


@query("ev2_out_of_fold", _folds_sql(_QUALITY, 3))
def _(spark, sf):
    return _folds(models.cross_val_predict(quality_rows(spark, sf), models.forest(trees=10, depth=5), 3))


_MAIN = ", ".join(f"'{c}'" for c in lx.MAIN_CLASSES)


@query("ev9_multiclass_buckets",
       f"WITH {EN_FEATURES_SQL}, b AS (SELECT dense_rank() OVER (ORDER BY bucket) - 1.0::DOUBLE AS label FROM "
       f"(SELECT CASE WHEN F11_primary_pathology IN ({_MAIN}) THEN F11_primary_pathology ELSE 'Other' END AS bucket FROM feats)) " + _folds_sql("b", 3))
def _(spark, sf):
    d = features.row_features(en_cleaned(spark, sf), lx.EN)
    d = d.withColumn("bucket", tx.bucket_classes("F11_primary_pathology", lx.MAIN_CLASSES))
    d = models.prepare(d, COLS, "bucket").select("uid", "label", "features", "class_weight")
    return _folds(models.cross_val_predict(d, models.forest(trees=10, depth=6), 3))


def _names_sql(flags: str, names=COLS) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {flags}" for c in names)


@query("ex1_odds_ratios", _names_sql("TRUE AS is_exponential"))
def _(spark, sf):
    d = cut_lineage(quality_rows(spark, sf))
    odds = explain.odds_ratios(spark, models.logistic(d.count()).fit(d), COLS)
    return odds.select("feature", (F.abs(F.log("odds_ratio") - F.col("coefficient")) < 1e-9).alias("is_exponential"))


@query("ex2_tree_importance", _names_sql("TRUE AS is_share, TRUE AS adds_up"))
def _(spark, sf):
    imp = explain.tree_importance(spark, models.forest(trees=20, depth=8).fit(cut_lineage(quality_rows(spark, sf))), COLS)
    total = imp.agg(F.sum("importance")).scalar()
    return imp.select("feature", F.col("importance").between(0, 1).alias("is_share"), (F.abs(total - 1) < 1e-9).alias("adds_up"))


_AVG = " UNION ALL ".join(f"SELECT '{c}' AS feature, avg({c})::DOUBLE AS importance FROM feats" for c in COLS)


@query("top4_top_features", f"WITH {EN_FEATURES_SQL} SELECT feature, round(importance, 6) AS importance FROM ({_AVG}) ORDER BY importance DESC, feature LIMIT 3")
def _(spark, sf):
    d = _features(spark, sf)
    imp = d.agg(*[F.avg(c).cast("double").alias(c) for c in COLS]).unpivot([], COLS, "feature", "importance")
    return rounded(imp.filter(F.col("feature").isin(explain.top_features(imp, 3))))


@query("ex3_permutation_importance", _names_sql("TRUE AS valid", [*COLS, "constant"]))
def _(spark, sf):
    """A feature that is the same in all rows can't matter; no accuracy falls by more than all of it."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    d = cut_lineage(quality_rows(spark, sf).withColumn("features", array_to_vector(F.concat(vector_to_array("features"), F.array(F.lit(1.0))))))
    out = explain.permutation_importance(models.forest(trees=10, depth=6).fit(d), d, [*COLS, "constant"], repeats=10)
    nothing = (F.col("importance") == 0) & (F.col("std") == 0)
    return out.select("feature", F.when(F.col("feature") == "constant", nothing).otherwise(F.col("importance").between(-1, 1)).alias("valid"))


@query("ex4_shapley_sample", f"SELECT feature, (SELECT count(*) FROM {_QUALITY}) AS n, TRUE AS adds_up FROM ({_names_sql('1 AS one')})")
def _(spark, sf):
    d = cut_lineage(quality_rows(spark, sf))
    att = cut_lineage(explain.shapley_sample(models.forest(trees=10, depth=6).fit(d), d, COLS, orders=10))
    total = att.agg(F.sum("attribution")).scalar()  # each row is the background of another once per order
    return att.groupBy("feature").agg(F.count("attribution").alias("n")).withColumn("adds_up", F.abs(total) < 1e-6)


@query("ex4_mean_abs_attribution", _names_sql("TRUE AS is_share"))
def _(spark, sf):
    d = cut_lineage(quality_rows(spark, sf))
    mean = explain.mean_abs_attribution(explain.shapley_sample(models.boosted(rounds=5, depth=3).fit(d), d, COLS, orders=2))
    return mean.select("feature", F.col("mean_abs").between(0, 1).alias("is_share"))


@query("sv1_surrogate_survival",
       f"WITH {EN_FEATURES_SQL} SELECT uid, round(least(greatest(10 - 8 * F22_composite_severity - 2 * ln({unit_sql('uid')}), 0.1::DOUBLE), 20), 6) AS time, "
       "F25_is_abnormal::INTEGER AS event FROM feats")
def _(spark, sf):
    return survival.surrogate_survival(en_features(spark, sf, ["uid", "F22_composite_severity", "F25_is_abnormal"])).select("uid", F.round("time", 6).alias("time"), "event")


@query("sv2_cox_fit", _names_sql("TRUE AS stationary, TRUE AS is_exponential, TRUE AS converged", SURV_COLS))
def _(spark, sf):
    fit = survival.cox_table(spark, survival.cox_fit(survival_rows(spark, sf), "t", "e", SURV_COLS))
    return fit.select("feature", (F.abs("gradient") < 1e-6).alias("stationary"),
                      (F.abs(F.log("hazard_ratio") - F.col("coef")) < 1e-9).alias("is_exponential"), "converged")
