"""Features F01-F25 for the English, extended English and French lexicons."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import CLINICAL_SQL, REPORTS_SQL, SECONDARY_SQL, clinical_reports, reports, sc, secondary_reports, wc
from catalog.profile_queries import rounded
from catalog.registry import query
from catalog.text_queries import (age_sql, any_sql, cat_count_sql, first_cat_sql, gender_sql, hits_sql, norm_en_sql,
                                  norm_fr_sql, norm_strict_sql, occ_sql, quote, strip_sql, wmax_sql, wsum_sql)
from reportlens.functions import lexicons as lx, text as tx
from reportlens.operators import features, profile
from reportlens.plans.cleaning import clean_reports
from reportlens.session import cut_lineage

EN_CLEAN_SQL = (f"{CLINICAL_SQL}, cleaned AS (SELECT uid, condition, mesh_major, {norm_en_sql('findings')} AS findings_clean, "
                f"{norm_en_sql('impression')} AS impression_clean FROM clinical)")
FR_CLEAN_SQL = (f"{SECONDARY_SQL}, cleaned AS (SELECT seq AS uid, condition, {age_sql('PatientAge', 'leading')} AS patient_age, "
                f"{gender_sql('PatientGender', 'initial')} AS patient_gender, {norm_fr_sql('Findings')} AS findings_clean, "
                f"{norm_fr_sql('Impression')} AS impression_clean FROM secondary WHERE NOT (coalesce(Findings,'') = '' AND coalesce(Impression,'') = ''))")


def en_cleaned(spark, sf):
    d = clinical_reports(spark, sf)
    return d.select("uid", "condition", "mesh_major", tx.normalize_en("findings").alias("findings_clean"),
                    tx.normalize_en("impression").alias("impression_clean"))


def fr_cleaned(spark, sf):
    from reportlens.operators.rows import drop_both_empty
    d = drop_both_empty(secondary_reports(spark, sf), "Findings", "Impression")
    return d.select(F.col("seq").alias("uid"), "condition", tx.parse_age("PatientAge").alias("patient_age"),
                    tx.normalize_gender("PatientGender").alias("patient_gender"),
                    tx.normalize_fr("Findings").alias("findings_clean"), tx.normalize_fr("Impression").alias("impression_clean"))


def row_sql(lex) -> dict:
    """Feature name -> SQL over (text, low, findings_clean, impression_clean)."""
    fr = lex["lang"] == "fr"
    low, labels = "low", "low" if fr else "lower(mesh_major)"
    words = wc("text")
    sents = sc("text", "[.!?]" if fr else r"\.")
    syl = f"list_sum(list_transform(regexp_extract_all(text, '\\S+'), lambda w: greatest(1, len(regexp_extract_all(lower(w), '[{lex['vowels']}]+')))))"
    abbr = ", ".join(quote(a) for a in lex["abbreviations"])
    pos, neg = hits_sql(low, lex["positive"]), hits_sql(low, lex["negative"])
    passive = f"{occ_sql(low, lex['passive'])} / greatest({words}, 1)"
    if lex["passive_min_words"] > 1:
        passive = f"CASE WHEN {words} < {lex['passive_min_words']} THEN 0 ELSE {passive} END"
    # Letters are mapped to 'a' first: the oracle's word bound knows ASCII only.
    ascii_text = "regexp_replace(text, '\\p{L}', 'a', 'g')"
    out = {
        "F01_clinical_sentiment": f"CASE WHEN {pos} + {neg} > 0 THEN {neg} / ({pos} + {neg}) ELSE 0.5 END::DOUBLE",
        "F02_clinical_entity_count": hits_sql(low, lex["entities"]),
        "F03_severity_score": wmax_sql(low, lex["severity"]),
        "F04_diagnostic_term_freq": hits_sql(low, lex["diagnostic"]),
        "F05_impression_length": wc("impression_clean"),
        "F06_word_count": words,
        "F07_sentence_count": sents,
        "F08_findings_impression_ratio": f"{wc('findings_clean')} / greatest({wc('impression_clean')}, 1)",
        "F09_has_measurements": r"CAST(regexp_matches(text, '\d+\s*(mm|cm|ml|cc)|\d+\.\d+|\d+\s*x\s*\d+', 'i') AS INTEGER)",
        "F10_negation_count": occ_sql(low, lex["negations"]),
        "F11_primary_pathology": first_cat_sql(labels, lex["categories"]),
        "F12_multi_label_count": cat_count_sql(labels, lex["categories"]),
        "F12_is_multilabel": f"CAST({cat_count_sql(labels, lex['categories'])} > 1 AS INTEGER)",
        "F13_flesch_kincaid": f"CASE WHEN {words} > 0 AND {sents} > 0 THEN 0.39::DOUBLE * {words} / {sents} + 11.8::DOUBLE * {syl} / {words} - 15.59::DOUBLE ELSE 0 END",
        "F14_abbrev_density": f"len(list_filter(regexp_extract_all(text, '\\S+'), lambda w: upper(w) IN ({abbr}))) / greatest({words}, 1)",
        "F15_numerical_count": f"CAST(len(regexp_extract_all({ascii_text}, '\\b\\d+\\.?\\d*\\b')) AS INTEGER)",
        "F16_hedge_count": hits_sql(low, lex["hedges"]),
        "F17_passive_ratio": passive,
        "F18_temporal_count": hits_sql(low, lex["temporal"]),
        "F19_has_recommendation": f"CAST({any_sql(low, lex['recommendations'])} AS INTEGER)",
    }
    if fr:
        out["F20_patient_age"] = "coalesce(patient_age, (SELECT median(patient_age) FROM cleaned), 50)"
        out["F21_is_male"] = "CAST(coalesce(patient_gender = 'M', false) AS INTEGER)"
        out["F25_condition_label"] = "condition"
    else:
        out["F20_elixhauser_score"] = wsum_sql(low, lex["comorbidity"])
        out["F21_charlson_score"] = wsum_sql(low, lex["charlson"])
        out["F25_is_abnormal"] = f"CAST({first_cat_sql(labels, lex['categories'])} <> 'Normal' AS INTEGER)"
    return out


def feature_cte(lex, clean_sql) -> str:
    text = "findings_clean || ' ' || impression_clean"
    if lex.get("strip_text"):
        text = strip_sql(f"({text})")
    rows = ", ".join(f"{e} AS {n}" for n, e in row_sql(lex).items())
    burden = "F12_multi_label_count" if lex["lang"] == "fr" else "F20_elixhauser_score"

    def share(c):
        return f"({c}::DOUBLE / (SELECT CASE WHEN max({c}) > 0 THEN max({c}) ELSE 1 END FROM rowf))"
    f22 = (f"0.3::DOUBLE * {share('F03_severity_score')} + 0.25::DOUBLE * F01_clinical_sentiment + 0.2::DOUBLE * {share('F02_clinical_entity_count')} "
           f"+ 0.15::DOUBLE * {share(burden)} + 0.1::DOUBLE * {share('F16_hedge_count')}")
    f23 = f"F04_diagnostic_term_freq * 0.4::DOUBLE + (1 - {share('F16_hedge_count')}) * 0.3::DOUBLE + {share('F02_clinical_entity_count')} * 0.3::DOUBLE"
    f24 = (f"0.25::DOUBLE * ({share('F06_word_count')} + F13_flesch_kincaid / (SELECT greatest(max(abs(F13_flesch_kincaid)), 1) FROM rowf) "
           f"+ {share('F15_numerical_count')} + {share('F07_sentence_count')})")
    return (f"{clean_sql}, texts AS (SELECT *, lower(text) AS low FROM (SELECT *, {text} AS text FROM cleaned)), "
            f"rowf AS (SELECT uid, condition, {rows} FROM texts), "
            f"feats AS (SELECT *, {f22} AS F22_composite_severity, {f23} AS F23_pathology_confidence, {f24} AS F24_report_complexity FROM rowf)")


DOUBLES = {"F01_clinical_sentiment", "F08_findings_impression_ratio", "F13_flesch_kincaid", "F14_abbrev_density", "F17_passive_ratio",
           "F20_patient_age", "F22_composite_severity", "F23_pathology_confidence", "F24_report_complexity"}
COMPOSITES = ["F22_composite_severity", "F23_pathology_confidence", "F24_report_complexity"]


def _out(names) -> str:
    return ", ".join(f"round({n}::DOUBLE, 6) AS {n}" if n in DOUBLES else n for n in names)


def en_features(spark, sf, columns=None):
    return features.engineer_features(en_cleaned(spark, sf), lx.EN, columns=columns)


def fr_features(spark, sf, columns=None):
    return features.engineer_features(fr_cleaned(spark, sf), lx.FR, columns=columns)


EN_FEATURES_SQL = feature_cte(lx.EN, EN_CLEAN_SQL)
FR_FEATURES_SQL = feature_cte(lx.FR, FR_CLEAN_SQL)
EN_NAMES = sorted(list(row_sql(lx.EN)) + COMPOSITES)
FR_NAMES = sorted(list(row_sql(lx.FR)) + COMPOSITES)


def _register(key: str, names, lexicon_name: str):
    sql = {"en": EN_FEATURES_SQL, "fr": FR_FEATURES_SQL}[lexicon_name]
    build = {"en": en_features, "fr": fr_features}[lexicon_name]

    @query(key, f"WITH {sql} SELECT uid, {_out(names)} FROM feats")
    def _(spark, sf):
        return rounded(build(spark, sf, ["uid", *names]))


for _name in EN_NAMES:
    _no = _name[:3].lower()
    if _name == "F12_is_multilabel":
        continue
    _cols = [_name, "F12_is_multilabel"] if _no == "f12" else [_name]
    _register(f"{_no}_{_name[4:].lower()}", _cols, "en")
for _name in ("F01_clinical_sentiment", "F07_sentence_count", "F11_primary_pathology", "F13_flesch_kincaid", "F20_patient_age",
              "F21_is_male", "F22_composite_severity", "F25_condition_label"):
    _register(f"{_name[:3].lower()}_{_name[4:].lower()}_fr", [_name], "fr")


@query("pip6_features_en", f"WITH {EN_FEATURES_SQL} SELECT uid, {_out(EN_NAMES)} FROM feats")
def _(spark, sf):
    return rounded(en_features(spark, sf, ["uid", *EN_NAMES]))


@query("pip6_features_fr", f"WITH {FR_FEATURES_SQL} SELECT uid, {_out(FR_NAMES)} FROM feats")
def _(spark, sf):
    return rounded(fr_features(spark, sf, ["uid", *FR_NAMES]))


_EXT_CLEAN = EN_CLEAN_SQL.replace(norm_en_sql("findings"), norm_strict_sql("findings")).replace(norm_en_sql("impression"), norm_strict_sql("impression"))


@query("pip6_features_en_extended", f"WITH {feature_cte(lx.EN_EXTENDED, _EXT_CLEAN)} SELECT uid, {_out(EN_NAMES)} FROM feats")
def _(spark, sf):
    d = clinical_reports(spark, sf).select("uid", "condition", "mesh_major", tx.normalize_en_strict("findings").alias("findings_clean"),
                                           tx.normalize_en_strict("impression").alias("impression_clean"))
    return rounded(features.engineer_features(d, lx.EN_EXTENDED, columns=["uid", *EN_NAMES]))


_NUM = ["F02_clinical_entity_count", "F06_word_count", "F10_negation_count", "F13_flesch_kincaid"]


@query("agg32_feature_summary",
       f"WITH {EN_FEATURES_SQL} " + " UNION ALL ".join(
           f"SELECT F25_is_abnormal, '{c}' AS metric, count(*) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
           f"round(min({c})::DOUBLE, 6) AS min, round(max({c})::DOUBLE, 6) AS max FROM feats GROUP BY 1" for c in _NUM))
def _(spark, sf):
    return rounded(profile.feature_summary(features.row_features(en_cleaned(spark, sf), lx.EN), _NUM, "F25_is_abnormal"))


_SLICE = ["F01_clinical_sentiment", "F06_word_count", "F07_sentence_count", "F16_hedge_count"]


@query("entry_clean_features_by_condition",
       f"WITH {REPORTS_SQL}, first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY findings || ' ' || impression ORDER BY uid) AS rn "
       f"FROM reports WHERE NOT (findings = '' AND impression = '')) WHERE rn = 1 AND {wc(chr(40) + 'findings || ' + quote(' ') + ' || impression)')} >= 5), "
       f"cleaned AS (SELECT uid, condition, '' AS mesh_major, {norm_en_sql('findings')} AS findings_clean, {norm_en_sql('impression')} AS impression_clean FROM first), "
       + feature_cte(lx.EN, "").lstrip(", ") +
       " SELECT condition, count(*) AS n, " + ", ".join(
           f"round(avg({c}), 6) AS mean_{c[:3].lower()}, round(median({c}), 6) AS median_{c[:3].lower()}" for c in _SLICE) + " FROM feats GROUP BY 1")
def _(spark, sf):
    d = clean_reports(reports(spark, sf).withColumns({"indication": F.lit(""), "mesh_major": F.lit("")}), "en_v1")
    # The profile keeps the report columns only; the condition comes back by id.
    d = d.join(reports(spark, sf).select("uid", "condition"), "uid")
    # The texts are matched once; both statistics read the narrow table.
    narrow = cut_lineage(features.row_features(d, lx.EN).select("condition", *_SLICE))
    s = profile.describe_numeric(narrow, _SLICE, ["condition"])
    wide = s.groupBy("condition").agg(
        F.max("n").alias("n"),
        *[F.round(F.max(F.when(F.col("metric") == c, F.col(v))), 6).alias(f"{v}_{c[:3].lower()}") for c in _SLICE for v in ("mean", "median")])
    return wide
