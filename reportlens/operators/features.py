"""The twenty-five report features F01-F25.

Row features are plain Column expressions over the lower-cased text; only the
composites F22-F24 (and the age median of the second source) need a global
statistic, which is a scalar subquery of one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reportlens.session import cut_lineage
from reportlens.functions import lexicons as lx, text as tx
from reportlens.operators import ordered

_MEASURE = r"(?i)\d\s*(mm|cm|ml|cc)|\d\.\d|\d\s*x\s*\d"
_NUMBER = r"(?U)\b\d+\.?\d*\b"

# Composite weights.
SEVERITY_WEIGHTS = {"severity": 0.3, "sentiment": 0.25, "entities": 0.2, "burden": 0.15, "hedges": 0.1}
CONFIDENCE_WEIGHTS = {"diagnostic": 0.4, "no_hedges": 0.3, "entities": 0.3}
COMPLEXITY_WEIGHT = 0.25

# Composite -> what it reads; ``burden`` depends on the lexicon.
_READS = {
    "F22_composite_severity": ("F01_clinical_sentiment", "F02_clinical_entity_count", "F03_severity_score", "burden", "F16_hedge_count"),
    "F23_pathology_confidence": ("F02_clinical_entity_count", "F04_diagnostic_term_freq", "F16_hedge_count"),
    "F24_report_complexity": ("F06_word_count", "F07_sentence_count", "F13_flesch_kincaid", "F15_numerical_count"),
}


def sentiment(positive, negative) -> Column:
    """Share of negative terms among all matched polar terms, 0.5 if none."""
    pos, neg = (F.col(c) if isinstance(c, str) else c for c in (positive, negative))
    return F.when(pos + neg > 0, neg / (pos + neg)).otherwise(F.lit(0.5))


def syllables(low, vowels: str) -> Column:
    """Vowel groups of every word, at least one per word: all vowel groups of
    the text plus the words that have no vowel."""
    c = F.col(low) if isinstance(low, str) else low
    groups = F.regexp_count(c, F.lit(f"[{vowels}]+"))
    bare = F.regexp_count(c, F.lit(rf"(?U)(?<!\S)[^{vowels}\s]+(?!\S)"))
    return groups + bare


def readability(n_words, n_sentences, n_syllables) -> Column:
    w, s, y = (F.col(c) if isinstance(c, str) else c for c in (n_words, n_sentences, n_syllables))
    score = 0.39 * w / s + 11.8 * y / w - 15.59
    return F.when((w > 0) & (s > 0), score).otherwise(F.lit(0.0))


def abbreviation_count(text, abbreviations) -> Column:
    """Tokens equal to an abbreviation, in any case."""
    choices = "|".join(abbreviations)
    return F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(rf"(?U)(?<!\S)(?i:{choices})(?!\S)"))


def row_features(df: DataFrame, lexicon: dict = lx.EN) -> DataFrame:
    """Adds ``text`` and every feature that needs only its own row."""
    fr = lexicon["lang"] == "fr"
    text = tx.combine_text("findings_clean", "impression_clean", strip_edges=lexicon.get("strip_text", False))
    d = df.withColumn("text", text).withColumn("_low", F.lower("text"))
    d = d.withColumns({
        "F07_sentence_count": tx.sentence_count("text", lexicon["lang"]),
        "F05_impression_length": tx.word_count("impression_clean"),
        "_fw": tx.word_count("findings_clean"),
        "_syl": syllables("_low", lexicon["vowels"]),
        "_pos": tx.term_hits("_low", lexicon["positive"]),
        "_neg": tx.term_hits("_low", lexicon["negative"]),
    })
    # The sections are joined by a blank, so their words add up.
    d = d.withColumn("F06_word_count", F.col("_fw") + F.col("F05_impression_length"))
    if not fr:
        d = d.withColumn("_labels", tx.lowered("mesh_major"))
    words = F.greatest(F.col("F06_word_count"), F.lit(1))
    labels = "_low" if fr else "_labels"
    passive = tx.term_occurrences("_low", lexicon["passive"]) / words
    few = F.col("F06_word_count") < lexicon["passive_min_words"]
    cols = {
        "F01_clinical_sentiment": sentiment("_pos", "_neg"),
        "F02_clinical_entity_count": tx.term_hits("_low", lexicon["entities"]),
        "F03_severity_score": tx.term_weight_max("_low", lexicon["severity"]),
        "F04_diagnostic_term_freq": tx.term_hits("_low", lexicon["diagnostic"]),
        "F08_findings_impression_ratio": F.col("_fw") / F.greatest(F.col("F05_impression_length"), F.lit(1)),
        "F09_has_measurements": F.col("text").rlike(_MEASURE).cast("int"),
        "F10_negation_count": tx.term_occurrences("_low", lexicon["negations"]),
        "F11_primary_pathology": tx.first_category(labels, lexicon["categories"]),
        "F12_multi_label_count": tx.category_count(labels, lexicon["categories"]),
        "F13_flesch_kincaid": readability("F06_word_count", "F07_sentence_count", "_syl"),
        "F14_abbrev_density": abbreviation_count("text", lexicon["abbreviations"]) / words,
        "F15_numerical_count": F.regexp_count("text", F.lit(_NUMBER)),
        "F16_hedge_count": tx.term_hits("_low", lexicon["hedges"]),
        "F17_passive_ratio": F.when(few, F.lit(0.0)).otherwise(passive),
        "F18_temporal_count": tx.term_hits("_low", lexicon["temporal"]),
        "F19_has_recommendation": tx.has_any("_low", lexicon["recommendations"]).cast("int"),
    }
    if fr:
        cols["F21_is_male"] = F.coalesce(F.col("patient_gender") == "M", F.lit(False)).cast("int")
        cols["F25_condition_label"] = F.col("condition")
    else:
        cols["F20_elixhauser_score"] = tx.term_weight_sum("_low", lexicon["comorbidity"])
        cols["F21_charlson_score"] = tx.term_weight_sum("_low", lexicon["charlson"])
    d = d.withColumns(cols)
    last = {"F12_is_multilabel": (F.col("F12_multi_label_count") > 1).cast("int")}
    if not fr:
        last["F25_is_abnormal"] = (F.col("F11_primary_pathology") != "Normal").cast("int")
    return d.withColumns(last).drop("_low", "_labels", "_fw", "_syl", "_pos", "_neg")


def age_feature(df: DataFrame, default: float = 50.0) -> DataFrame:
    """F20 of the second source: null age becomes the median of the known ages."""
    age = F.col("patient_age").cast("double")
    median = ordered.quantiles(df, ["patient_age"], [0.5]).agg(F.max("q_0")).scalar()
    return df.withColumn("F20_patient_age", F.coalesce(age, median, F.lit(float(default))))


def _burden(lexicon: dict) -> str:
    return "F12_multi_label_count" if lexicon["lang"] == "fr" else "F20_elixhauser_score"


def _inputs(composite: str, lexicon: dict) -> list[str]:
    return [_burden(lexicon) if c == "burden" else c for c in _READS[composite]]


def composite_features(df: DataFrame, lexicon: dict = lx.EN, wanted=tuple(_READS)) -> DataFrame:
    """F22-F24, or those of them ``wanted``, from the row features they read and
    the column maxima."""
    burden = _burden(lexicon)
    read = sorted({c for name in wanted for c in _inputs(name, lexicon)} - {"F01_clinical_sentiment", "F04_diagnostic_term_freq"})
    best = df.agg(F.struct(*[(F.max(F.abs(c)) if c == "F13_flesch_kincaid" else F.max(c)).alias(c) for c in read]).alias("m")).scalar()

    def share(c):
        top = F.col(f"_best.{c}")
        return F.col(c) / F.when(top > 0, top).otherwise(1)
    s, c = SEVERITY_WEIGHTS, CONFIDENCE_WEIGHTS
    made = {
        "F22_composite_severity": lambda: s["severity"] * share("F03_severity_score")
        + s["sentiment"] * F.col("F01_clinical_sentiment")
        + s["entities"] * share("F02_clinical_entity_count")
        + s["burden"] * share(burden) + s["hedges"] * share("F16_hedge_count"),
        "F23_pathology_confidence": lambda: c["diagnostic"] * F.col("F04_diagnostic_term_freq")
        + c["no_hedges"] * (1 - share("F16_hedge_count")) + c["entities"] * share("F02_clinical_entity_count"),
        "F24_report_complexity": lambda: COMPLEXITY_WEIGHT * (
            share("F06_word_count") + F.col("F13_flesch_kincaid") / F.greatest(F.col("_best.F13_flesch_kincaid"), F.lit(1.0))
            + share("F15_numerical_count") + share("F07_sentence_count")),
    }
    return df.withColumn("_best", best).withColumns({name: made[name]() for name in wanted}).drop("_best")


def engineer_features(df: DataFrame, lexicon: dict = lx.EN, stage: str | None = None, columns=None) -> DataFrame:
    """All features of a cleaned table, or the ``columns`` asked for.

    The maxima behind F22-F24 and the median behind the age need a second look
    at the rows. What is asked for and what those read is written once and read
    back, to ``stage`` or else to the checkpoint folder, so that the texts are
    matched against the lexicons only once. Without such a column, and without
    ``stage``, nothing is written.
    """
    fr = lexicon["lang"] == "fr"
    d = row_features(df, lexicon)
    composites = [c for c in _READS if columns is None or c in columns]
    aged = fr and (columns is None or "F20_patient_age" in columns)
    if columns is not None:
        read = {*columns, *(c for name in composites for c in _inputs(name, lexicon)), *(["patient_age"] if aged else [])}
        d = d.select(*[c for c in d.columns if c in read])
    if stage:
        d.write.mode("overwrite").parquet(stage)
        d = df.sparkSession.read.schema(d.schema).parquet(stage)
    elif composites or aged:
        d = cut_lineage(d)
    if aged:
        d = age_feature(d, lexicon.get("default_age", 50.0))
    if composites:
        d = composite_features(d, lexicon, composites)
    if columns is not None:
        return d.select(*columns)
    names = sorted(c for c in d.columns if c[0] == "F" and c[1:3].isdigit())
    return d.select(*[c for c in d.columns if c not in names], *names)
