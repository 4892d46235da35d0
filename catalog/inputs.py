"""Stand-in report tables made from the driver tables.

``documents`` plays the report collection. Section texts, label strings,
demographics and placeholders are derived from each row; every row of the
table takes part. ``*_SQL`` hold the same derivations for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reportlens.session import spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Phrases appended to a document so that clinical lexicons have something to
# find; the choice depends on the document id.
EN_PHRASES = [
    "Heart size is normal. The lungs are clear. No evidence of effusion.",
    "Mild cardiomegaly, may represent chronic congestive heart failure. XXXX.",
    "There is a 12 mm nodule in the RUL, CT scan is recommended.",
    "No acute pulmonary disease. Stable x-XXXX since prior exam.",
    "Large left pleural effusion with partial collapse, 3.5 x 4 cm.",
    "Findings suggest pneumonia.. COPD with emphysema cannot be excluded.",
    "Severe edema was increased; follow-up is suggested in 2 weeks",
    "",
]
FR_PHRASES = [
    "Aspect normal du poumon et de l'aorte. Pas de lésion./ Absence d'épanchement",
    "Cardiomégalie modérée, en faveur de l’œdème. Scanner recommandé.",
    "Épanchement pleural important, à recontrôler. 12 mm",
    "Opacité du poumon droit probable, évoque une pneumonie../ Stable",
    "",
]
EN_LABELS = [
    "normal", "Cardiomegaly/mild|Pulmonary Edema", "Opacity/lung|Nodule|Granuloma",
    "", "Pleural Effusion/left", "Pneumonia|Emphysema|Airspace Disease/severe",
    "Pulmonary Congestion|Edema|Cardiomegaly", "No Indexing",
]


def _case(values, key: str) -> str:
    def quote(v):
        return "'" + v.replace("'", "''") + "'"
    arms = " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values[:-1]))
    return f"CASE {key} % {len(values)} {arms} ELSE {quote(values[-1])} END"


_FINDINGS = "CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END"
_IMPRESSION = "CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END"

REPORT_EXPRS = {
    "uid": "doc_id",
    "findings": _FINDINGS,
    "impression": _IMPRESSION,
    "condition": "lang",
    "dataset_source": "CASE WHEN lang = 'fr' THEN 'secondary' ELSE 'primary' END",
}

CLINICAL_EXPRS = {
    "uid": "doc_id",
    "pmc_id": "concat('pmc', CAST(doc_id AS STRING))",
    "filename": "concat(CAST(doc_id AS STRING), '.xml')",
    "findings": f"concat({_FINDINGS}, ' ', {_case(EN_PHRASES, 'doc_id')})",
    "impression": f"concat({_case(EN_PHRASES, '(doc_id + n_chars)')}, ' ', {_IMPRESSION})",
    "indication": "source",
    "comparison": "CASE WHEN doc_id % 3 = 0 THEN 'None' ELSE lang END",
    "mesh_major": _case(EN_LABELS, "(doc_id + n_chars)"),
    "mesh_minor": _case(EN_LABELS, "n_chars"),
    "num_images": "CAST(doc_id % 4 AS INT)",
    "image_ids": "concat('img', CAST(doc_id AS STRING))",
    "condition": "lang",
}

SECONDARY_EXPRS = {
    "ExamID": "CASE WHEN doc_id % 9 = 8 THEN NULL WHEN doc_id % 5 = 4 THEN doc_id - 1 ELSE doc_id END",
    "ImageID": "doc_id",
    "PatientID": "doc_id % 700",
    "PatientAge": "concat(lpad(CAST(n_chars % 130 AS STRING), 3, '0'), 'Y')",
    "PatientGender": "CASE n_chars % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'female' WHEN 2 THEN ' F ' WHEN 3 THEN '74' END",
    "StudyDate": "source",
    "ReportID": "doc_id + 1",
    "Findings": f"CASE WHEN doc_id % 11 = 0 THEN NULL ELSE concat({_FINDINGS}, ' ', {_case(FR_PHRASES, 'doc_id')}) END",
    "Indication": "source",
    "Comparison": "CASE WHEN n_chars % 3 = 0 THEN ' None ' WHEN n_chars % 3 = 1 THEN NULL ELSE lang END",
    "Impression": f"CASE WHEN doc_id % 11 = 0 AND doc_id % 2 = 0 THEN NULL ELSE {_IMPRESSION} END",
    "condition": "lang",
    "seq": "doc_id",
}


def _select(exprs: dict, source: str, sql: bool) -> str:
    items = ", ".join(f"{e} AS {n}" for n, e in exprs.items())
    if sql:
        items = items.replace("AS STRING", "AS VARCHAR")
    return f"SELECT {items} FROM {source}"


def _frame(spark, sf, exprs) -> DataFrame:
    docs = table(spark, sf, "documents")
    fixed = {n: e.replace("strpos(text, chr(10))", "instr(text, '\\n')") for n, e in exprs.items()}
    return spread(docs.selectExpr(*[f"{e} AS {n}" for n, e in fixed.items()]))


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """uid, findings, impression, condition, dataset_source."""
    return _frame(spark, sf, REPORT_EXPRS)


def clinical_reports(spark: SparkSession, sf: str) -> DataFrame:
    """First-source shape: parsed report rows with label strings."""
    return _frame(spark, sf, CLINICAL_EXPRS)


def secondary_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Second-source shape: CSV column names, null keys, repeated keys."""
    return _frame(spark, sf, SECONDARY_EXPRS)


REPORTS_SQL = "reports AS (" + _select(REPORT_EXPRS, "documents", True) + ")"
CLINICAL_SQL = "clinical AS (" + _select(CLINICAL_EXPRS, "documents", True) + ")"
SECONDARY_SQL = "secondary AS (" + _select(SECONDARY_EXPRS, "documents", True) + ")"

# Word and sentence counts in the oracle's regex dialect.
def wc(c: str) -> str:
    return f"CAST(len(regexp_extract_all(coalesce({c}, ''), '\\S+')) AS INTEGER)"


def sc(c: str, sep: str = r"\.") -> str:
    return (f"CAST(len(list_filter(regexp_split_to_array(coalesce({c}, ''), '{sep}'), "
            f"lambda s: regexp_matches(s, '\\S'))) AS INTEGER)")
