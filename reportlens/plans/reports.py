"""Composite entry points: profile, train, compare, run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from reportlens.functions import lexicons as lx, text as tx
from reportlens.operators import compare, evaluate, explain, features, models, ordered, profile, survival
from reportlens.plans.cleaning import clean_reports, cleaning_log, profile_steps
from reportlens.session import cut_lineage

_LENGTHS = ["findings_words", "impression_words", "total_words"]
_NUMERIC = ["findings_words", "impression_words", "findings_chars", "impression_chars",
            "findings_sentences", "impression_sentences", "num_images", "num_labels"]
_OUTLIERS = ["findings_words", "impression_words", "num_labels", "num_images"]


def _rows(df: DataFrame, section: str, prefix=None) -> DataFrame:
    """A wide statistics table as (section, metric, value); ``prefix`` names the
    column that qualifies the metric names."""
    names = [c for c in df.columns if c != prefix]
    keys = [prefix] if prefix else []
    long = df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in names]).unpivot(keys, names, "_m", "value")
    metric = F.concat(F.col(prefix).cast("string"), F.lit("."), F.col("_m")) if prefix else F.col("_m")
    return long.select(F.lit(section).alias("section"), metric.alias("metric"), "value")


def eda_report(df: DataFrame) -> DataFrame:
    """(section, metric, value) of a parsed first-source table.

    The texts are measured once into a narrow numeric table that is written to
    the checkpoint folder; every section is an aggregate of it. Only the
    vocabulary section reads the texts again.
    """
    sections = ["findings", "impression", "indication", "mesh_major"]
    d = profile.with_lengths(df.withColumn("_low_labels", tx.lowered("mesh_major")))
    d = d.withColumn("labels", tx.all_categories("_low_labels", lx.EN_LABEL_CATEGORIES)).withColumn("num_labels", F.size("labels"))
    present = {f"_has_{c}": F.coalesce(F.col(c), F.lit("")) != "" for c in sections}
    d = d.withColumns({**present, "_marked": tx.has_placeholder("findings") | tx.has_placeholder("impression")})
    keep = sorted({*_NUMERIC, "total_words", "avg_sentence_len", "labels", "_marked", *present})
    base = cut_lineage(d.select(*keep))

    parts = [_rows(base.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"), F.sum("num_images").alias("images"),
                            F.avg("num_images").alias("images_per_report")), "overview")]
    complete = F.col("_has_findings") & F.col("_has_impression") & F.col("_has_mesh_major")
    pct = lambda c: F.avg(F.when(c, 100.0).otherwise(0.0))
    parts.append(_rows(base.agg(*[pct(F.col(f"_has_{c}")).alias(c) for c in sections], F.count_if(complete).alias("complete"),
                                pct(complete).alias("complete_pct")), "completeness"))
    parts.append(_rows(profile.describe_numeric(base, _LENGTHS), "lengths", "metric"))
    shape = profile.distribution_properties(base, _LENGTHS).select("metric", "skewness", "kurtosis", "iqr")
    parts.append(_rows(shape, "distribution", "metric"))
    parts.append(_rows(profile.label_cardinality(base, "labels", lx.MAIN_LABELS), "labels"))
    parts.append(_rows(profile.class_imbalance(base, "labels", lx.MAIN_LABELS), "classes", "label"))
    parts.append(_rows(base.agg(*[F.count_if(F.col("num_labels") >= k).alias(f"ge{k}") for k in (1, 2, 3)], F.max("num_labels").alias("max")), "labels_per_record"))
    parts += [_rows(profile.vocabulary_size(df, c, "raw"), f"vocabulary_{c}") for c in ("findings", "impression")]
    parts += [_rows(profile.label_totals(df, c), c) for c in ("mesh_major", "mesh_minor")]
    parts.append(_rows(base.agg(F.count_if("_marked").alias("placeholder"), F.count_if(F.col("findings_words") < 5).alias("very_short"),
                                F.count_if(F.col("total_words") > 100).alias("very_long"),
                                F.count_if(F.col("total_words") * 1.3 > 512).alias("over_512_tokens"),
                                F.avg("avg_sentence_len").alias("sentence_len_mean"), F.stddev_samp("avg_sentence_len").alias("sentence_len_std")), "quality"))
    parts.append(_rows(profile.iqr_bounds(base, _OUTLIERS).select("metric", "outliers", "pct"), "outliers", "metric"))
    pairs = profile.correlated_pairs(base, _NUMERIC)
    parts.append(_rows(pairs.agg(F.max("r").alias("strongest_positive"), F.min("r").alias("strongest_negative"), F.avg(F.abs("r")).alias("mean_abs")), "correlations"))
    parts.append(_rows(profile.compression_stats(base).drop("metric"), "compression"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def profile_second(df: DataFrame, lang: str = "fr_profile") -> DataFrame:
    """(section, metric, value) of a raw second-source table: overview, null
    shares, class counts, ages, genders, lengths, top words, term counts."""
    d = df.withColumns({"age": tx.parse_age("PatientAge", "any"), "gender": tx.normalize_gender("PatientGender"),
                        "findings": tx.word_count("Findings"), "impression": tx.word_count("Impression")})

    def named(frame, section, metric, value):
        return frame.select(F.lit(section).alias("section"), F.col(metric).cast("string").alias("metric"), F.col(value).cast("double").alias("value"))
    ages = profile.numeric_summary(d, "age")
    terms = profile.term_class_counts(df, "condition", tx.combine_text("Findings", "Impression"))
    parts = [
        _rows(df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns")), "overview"),
        named(profile.missing_profile(df), "missing_pct", "column_name", "pct"),
        named(profile.value_counts(df, "condition"), "condition", "condition", "n"),
        _rows(ages.drop("metric"), "age"),
        named(profile.value_counts(d, "gender"), "gender", "gender", "n"),
        _rows(profile.length_summary(d, ("findings", "impression")), "length", "metric"),
        named(profile.top_terms(df, "Findings", lang, 25), "top_words", "term", "n"),
        named(terms.withColumn("cell", F.concat_ws(".", "condition", "term")), "term_by_condition", "cell", "n"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def model_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric feature columns; the label-text columns F12 leak the binary target
    and are left out by default through ``LEAKING``."""
    skip = {"F11_primary_pathology", "F25_is_abnormal", "F25_condition_label", *exclude}
    return [c for c in df.columns if c[0] == "F" and c[1:3].isdigit() and c not in skip]


LEAKING = ("F12_is_multilabel", "F12_multi_label_count")


def cox_outcome(data: DataFrame, df: DataFrame, fitted, cols, target: str, key: str = "uid", covariates: int = 8, repeats: int = 5):
    """(scored rows, fit) of a Cox model of surrogate times on the ``covariates``
    whose permutation costs the model ``fitted`` on ``data`` most accuracy."""
    top = explain.top_features(explain.permutation_importance(fitted, data, cols, repeats, key=key), covariates)
    surv = cut_lineage(survival.surrogate_survival(df, event=target, key=key).select(key, "time", "event", *top))
    fit = survival.cox_fit(surv, "time", "event", top)
    return cut_lineage(survival.cox_risk(surv, dict(zip(fit["cols"], fit["coef"])), dict(zip(fit["cols"], fit["mean"])))), fit


def run_models(df: DataFrame, target: str, key: str = "uid", folds: int = 10, binary: bool = True, trees: int = 300, depth: int = 15,
               rounds: int = 200, exclude=LEAKING, text: str | None = None, dataset: str = "primary", with_cox: bool = True,
               covariates: int = 8, repeats: int = 5) -> DataFrame:
    """(dataset, model, metric, value, std): logistic regression, forest and
    boosted trees by stratified cross-validation; for several classes also a text
    classifier on ``text``. For the binary task the Cox model's C-index on the
    covariates of highest permutation importance, and the survival curves of its
    risk quartiles (metric ``survival.<group>``, one row per time, which stands
    in ``at``; elsewhere ``at`` is null)."""
    cols = model_columns(df, exclude)
    data = cut_lineage(models.prepare(df, cols, target).select(key, "label", "features", "class_weight", *cols))
    one = data.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("k")).first()
    estimators = {
        "logistic_regression": models.logistic(one["n"]),
        "random_forest": models.forest(trees, depth),
        "boosted_trees": models.boosted(rounds, classes=one["k"]),
    }
    parts = [models.cross_validate(models.cross_val_predict(data, est, folds, key), name, dataset, binary) for name, est in estimators.items()]
    if text:
        coded, _ = models.index_labels(models.term_column(df.select(key, target, text), text), target)
        rows = models.with_class_weight(coded, "label").select(key, "label", "terms", "class_weight")
        pred = models.cross_val_predict(rows, models.text_classifier(one["n"]), folds, key)
        parts.append(models.cross_validate(pred, "text_logistic", dataset, binary))
    parts = [p.withColumn("at", F.lit(None).cast("double")) for p in parts]
    if binary and with_cox and "F22_composite_severity" in cols:
        scored, _ = cox_outcome(data, df, estimators["random_forest"].fit(data), cols, target, key, covariates, repeats)

        def cox(frame, metric, value, at):
            return frame.select(F.lit(dataset).alias("dataset"), F.lit("cox").alias("model"), metric.alias("metric"),
                                F.col(value).alias("value"), F.lit(0.0).alias("std"), at.cast("double").alias("at"))
        parts.append(cox(survival.concordance(scored, "time", "event", "risk"), F.lit("c_index"), "c_index", F.lit(None)))
        curves = survival.risk_group_curves(scored, "time", "event", "risk")
        parts.append(cox(curves, F.concat(F.lit("survival."), F.col("risk_group")), "survival", F.col("time")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def comparison_summary(raw: DataFrame, clean: DataFrame, feats: DataFrame, missing_cols, metrics: DataFrame | None = None) -> DataFrame:
    """(section, dataset_source, metric, value): the two-source comparison, the
    densities of the shared features and, if given, the best model scores."""
    out = compare.compare_sources(raw, clean, missing_cols)
    cols = [c for c in compare.OVERLAP_FEATURES if c in feats.columns]
    over = compare.feature_overlap(feats, cols)
    out = out.unionByName(over.select(F.lit("overlap").alias("section"), "dataset_source",
                                      F.concat_ws(".", "feature", F.col("bin").cast("string")).alias("metric"), F.col("density").alias("value")))
    if metrics is not None:
        best = evaluate.leaderboard(metrics.filter("at IS NULL") if "at" in metrics.columns else metrics)  # without the curves
        out = out.unionByName(best.select(F.lit("models").alias("section"), F.col("dataset").alias("dataset_source"),
                                          F.concat_ws(".", "model", "metric").alias("metric"), "value"))
    return out


def run_sources(sources: dict, which: str = "both", order: dict | None = None, columns=None) -> dict:
    """Clean and featurise the chosen source(s): ``primary``, ``secondary`` or
    ``both``. Returns {source: {"log", "cleaned", "features"}} of lazy tables;
    the feature tables have all columns or those asked for."""
    if which not in ("primary", "secondary", "both"):
        raise ValueError("which must be primary, secondary or both")
    order = order or {}
    out = {}
    for name, profile_name, lexicon in (("primary", "en_v1", lx.EN), ("secondary", "fr_v1", lx.FR)):
        if which in (name, "both"):
            key = order.get(name, "uid")
            cleaned = clean_reports(sources[name], profile_name, order=key)
            out[name] = {"log": cleaning_log(sources[name], profile_steps(profile_name), key), "cleaned": cleaned,
                         "features": features.engineer_features(cleaned, lexicon, columns=columns)}
    return out
