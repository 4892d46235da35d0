"""Sources, sinks, comparison and the composite entry points."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Window, functions as F

from catalog.cleaning_queries import _PIP1, _PIP3
from catalog.feature_queries import EN_FEATURES_SQL, EN_NAMES, FR_NAMES, en_features, feature_cte, fr_features
from catalog.inputs import (CLINICAL_SQL, REPORTS_SQL, SECONDARY_SQL, clinical_reports, reports, secondary_reports, table,
                            wc)
from catalog.profile_queries import rounded
from catalog.registry import query
from catalog.text_queries import age_sql, norm_en_sql, norm_fr_sql, strip_sql, tokens_sql
from reportlens.functions import lexicons as lx, text as tx
from reportlens.operators import compare, models, rows, survival
from reportlens.plans import reports as plans
from reportlens.session import cut_lineage, shared_folder, spread
from reportlens.sources import readers, writers


def scratch(spark, name: str) -> str:
    """A fresh path under the shared folder the session names."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --------------------------------------------------------------------- XML

_XML = ("concat('<eCitation><meta><uId id=\"', doc_id, '\"/><pmcId id=\"p', doc_id, '\"/></meta><MedlineCitation><Abstract>', "
        "'<AbstractText Label=\"FINDINGS\">', esc(text), '</AbstractText><AbstractText Label=\"IMPRESSION\"> first version </AbstractText>', "
        "'<AbstractText Label=\"IMPRESSION\"> ', esc(source), ' </AbstractText></Abstract><MeSH><major>', lang, '</major><major> ', source, ' </major></MeSH></MedlineCitation>', "
        "repeat(concat('<parentImage id=\"i', doc_id, '\"/>'), int(doc_id % 3)), '</eCitation>')")


def xml_documents(spark, sf):
    """Well-formed XML from every document; every 50th one is cut short."""
    import re
    x = re.sub(r"esc\(((?:[^()]|\([^()]*\))*)\)", r"replace(replace(\1, '&', '&amp;'), '<', '&lt;')", _XML)
    d = spread(table(spark, sf, "documents"))
    full = d.select(F.expr(x).alias("x"), "doc_id")
    cut = F.expr("CASE WHEN doc_id % 50 = 0 THEN left(x, int(length(x) / 2)) ELSE x END")
    return full.select(cut.alias("value"), F.concat(F.col("doc_id").cast("string"), F.lit(".xml")).alias("filename"))


_TEXT = strip_sql("text")
_XML_SQL = (f"SELECT CAST(doc_id AS VARCHAR) AS uid, 'p' || doc_id AS pmc_id, doc_id || '.xml' AS filename, md5({_TEXT}) AS findings, source AS impression, '' AS indication, "
            "'' AS comparison, lang || '|' || source AS mesh_major, '' AS mesh_minor, CAST(doc_id % 3 AS INTEGER) AS num_images, "
            "array_to_string(list_transform(range(doc_id % 3), lambda i: 'i' || doc_id), '|') AS image_ids FROM documents WHERE doc_id % 50 > 0")


@query("src1_xml_reports", _XML_SQL)
def _(spark, sf):
    return readers.good_rows(readers.parse_xml_reports(xml_documents(spark, sf))).withColumn("findings", F.md5("findings"))


def _file_writer(folder: str, most: int = 1000):
    """A function of Arrow batches (value): each as a file of its own, below a hidden folder that the task names in the
    end, ``most`` to a folder. It is made here so that tasks receive its code along with it."""
    def run(batches):
        import os
        from pyspark import TaskContext
        import pyarrow as pa
        task, n = TaskContext.get(), 0
        hidden = f"{folder}/.{task.partitionId()}-{task.taskAttemptId()}"
        for batch in batches:
            for value in batch.column(0).cast(pa.binary()):
                if n % most == 0:
                    os.makedirs(f"{hidden}/{n // most}")
                with open(f"{hidden}/{n // most}/{n}.txt", "wb") as f:
                    f.write((value.as_py() or b"") + b"\n")
                n += 1
        if n:
            try:
                os.rename(hidden, f"{folder}/{task.partitionId()}")
            except OSError:  # another attempt was first
                if not os.path.isdir(f"{folder}/{task.partitionId()}"):
                    raise
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])
    return run


def xml_files(spark, sf):
    """The XML documents as one file each, in a few folders: one folder a document
    would have to be made, moved by the driver and listed for each. In a shared folder
    of the file system tasks write them themselves, as Spark starts a process there for
    every file; elsewhere Spark's writer does, and its tasks move their own files into place."""
    path = scratch(spark, "xml")
    d = xml_documents(spark, sf).select("value", F.pmod(F.xxhash64("filename"), F.lit(64)).alias("folder"))
    if path.startswith("file:"):
        local = spark._jvm.java.net.URI(path).getPath()
        os.makedirs(local)
        d.select("value").mapInArrow(_file_writer(local), "n long").agg(F.sum("n")).collect()
        return path
    writer = d.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.partitionBy("folder").text(path)
    return path


@query("src1_scan_xml_files", _XML_SQL.replace("doc_id || '.xml' AS filename, ", ""))
def _(spark, sf):
    d = readers.scan_xml_reports(spark, xml_files(spark, sf), pattern="*.txt")
    return d.drop("filename").withColumn("findings", F.md5("findings"))


# The message is the parser's own; what SQL knows is that it names a place inside the cut document.
@query("src2_quarantine", "SELECT doc_id || '.xml' AS filename, TRUE AS has_place, TRUE AS place_is_inside FROM documents WHERE doc_id % 50 = 0")
def _(spark, sf):
    d = xml_documents(spark, sf)
    bad = readers.quarantine(readers.parse_xml_reports(d))
    place = F.regexp_extract("error", r"line (\d+), column \d+$", 1)
    lines = d.select("filename", (F.regexp_count("value", F.lit("\n")) + 1).alias("lines"))
    return bad.join(lines, "filename").select("filename", (place != "").alias("has_place"), (place.cast("int") <= F.col("lines")).alias("place_is_inside"))


# --------------------------------------------------------------------- CSV

@query("src3_labelled_csv",
       "SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, md5(text) AS text, lang AS condition, 'secondary' AS dataset_source FROM documents")
def _(spark, sf):
    base, d = scratch(spark, "labelled"), table(spark, sf, "documents")
    langs = ["en", "fr", "de", "es"]
    for lang in langs:
        writers.write_stage(d.filter(F.col("lang") == lang).select("doc_id", "source", "text", F.lit("x").alias("EndHere")), f"{base}/{lang}", "csv")
    s = readers.scan_labelled_csv(spark, {**{c: f"{base}/{c}" for c in langs}, "absent": f"{base}/absent"}, "secondary")
    return s.withColumn("text", F.md5("text"))


@query("src5_read_table", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, md5(nullif(CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END, '')) AS rest FROM documents")
def _(spark, sf):
    path = scratch(spark, "stage")
    writers.write_stage(reports(spark, sf).select(F.col("uid").alias("doc_id"), F.col("condition").alias("lang"), F.col("impression").alias("rest")), path, "csv")
    return readers.read_table(spark, path, "csv").withColumn("rest", F.md5("rest"))


@query("snk1_stage_table", f"WITH {REPORTS_SQL} SELECT uid, condition, dataset_source, md5(impression) AS impression FROM reports")
def _(spark, sf):
    path = scratch(spark, "stage")
    writers.write_stage(reports(spark, sf), path, partition_by=["dataset_source", "condition"])
    return readers.read_table(spark, path).select("uid", "condition", "dataset_source", F.md5("impression").alias("impression"))


@query("snk2_metrics_json",
       "SELECT lang AS dataset, source AS model, unnest(['mean', 'max']) AS metric, unnest([round(avg(n_chars), 6), max(n_chars)::DOUBLE]) AS value FROM documents GROUP BY 1, 2")
def _(spark, sf):
    m = table(spark, sf, "documents").groupBy(F.col("lang").alias("dataset"), F.col("source").alias("model")).agg(
        F.round(F.avg("n_chars"), 6).alias("mean"), F.max("n_chars").cast("double").alias("max"))
    path = scratch(spark, "metrics")
    writers.write_stage(m.unpivot(["dataset", "model"], ["mean", "max"], "metric", "value"), path, "json")
    return readers.read_table(spark, path, "json", m.sparkSession.createDataFrame([], "dataset string, model string, metric string, value double").schema)


@query("snk4_model_round_trip", "SELECT doc_id AS uid, quality::DOUBLE AS label, TRUE AS same FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def _(spark, sf):
    from catalog.model_queries import quality_rows
    d = cut_lineage(quality_rows(spark, sf))
    path = scratch(spark, "model")
    fitted = models.forest(trees=5, depth=4).fit(d)
    writers.save_model(fitted, path)
    before = fitted.transform(d).select("uid", F.col("prediction").alias("before"))
    after = writers.load_model(path).transform(d)
    return after.join(before, "uid").select("uid", "label", (F.col("prediction") == F.col("before")).alias("same"))


# ------------------------------------------------- report and comparison

_EDA = (f"WITH {CLINICAL_SQL}, w AS (SELECT *, {wc('findings')} AS fw, {wc('impression')} AS iw FROM clinical) "
        "SELECT 'overview' AS section, 'rows' AS metric, count(*)::DOUBLE AS value FROM w UNION ALL SELECT 'overview', 'columns', 12 UNION ALL "
        "SELECT 'overview', 'images', sum(num_images) FROM w UNION ALL SELECT 'overview', 'images_per_report', round(avg(num_images), 6) FROM w UNION ALL "
        + " UNION ALL ".join(f"SELECT 'completeness', '{c}', round(avg(CASE WHEN {c} <> '' THEN 100.0::DOUBLE ELSE 0 END), 6) FROM w" for c in ("findings", "impression", "indication", "mesh_major"))
        + " UNION ALL SELECT 'completeness', 'complete', count(*) FILTER (WHERE findings <> '' AND impression <> '' AND mesh_major <> '') FROM w UNION ALL "
        "SELECT 'completeness', 'complete_pct', round(avg(CASE WHEN findings <> '' AND impression <> '' AND mesh_major <> '' THEN 100.0::DOUBLE ELSE 0 END), 6) FROM w UNION ALL "
        + " UNION ALL ".join(f"SELECT 'lengths', '{n}.{m}', round(({e.format(c=c)})::DOUBLE, 6) FROM w" for n, c in (("findings_words", "fw"), ("impression_words", "iw"), ("total_words", "(fw + iw)"))
                             for m, e in (("n", "count(*)"), ("mean", "avg({c})"), ("std", "stddev_samp({c})"), ("min", "min({c})"), ("q25", "quantile_cont({c}::DOUBLE, .25)"),
                                          ("median", "quantile_cont({c}::DOUBLE, .5)"), ("q75", "quantile_cont({c}::DOUBLE, .75)"), ("max", "max({c})")))
        + " UNION ALL SELECT 'compression', m, round(v::DOUBLE, 6) FROM (SELECT unnest(['n', 'mean', 'median', 'min', 'max', 'below_20']) AS m, "
          "unnest([count(*)::DOUBLE, avg(fw / iw), median(fw / iw), min(fw / iw), max(fw / iw), count(*) FILTER (WHERE fw / iw < 20)]) AS v FROM w WHERE fw > 0 AND iw > 0)"
        + " UNION ALL SELECT 'quality', m, v FROM (SELECT unnest(['very_short', 'very_long', 'over_512_tokens', 'placeholder']) AS m, unnest([count(*) FILTER (WHERE fw < 5), count(*) FILTER (WHERE fw + iw > 100), "
          "count(*) FILTER (WHERE (fw + iw) * 1.3 > 512), count(*) FILTER (WHERE contains(upper(findings), 'XXXX') OR contains(upper(impression), 'XXXX'))])::DOUBLE AS v FROM w)"
        + " UNION ALL " + " UNION ALL ".join(f"SELECT 'vocabulary_{c}', m, v FROM (SELECT unnest(['vocabulary', 'total_tokens']) AS m, unnest([count(DISTINCT t), count(*)])::DOUBLE AS v FROM (SELECT unnest({tokens_sql(c, 'raw')}) AS t FROM w))" for c in ("findings", "impression")))


@query("snk3_eda_report", _EDA)
def _(spark, sf):
    r = plans.eda_report(clinical_reports(spark, sf))
    same = F.col("section").isin("overview", "completeness", "lengths", "compression", "vocabulary_findings", "vocabulary_impression")
    quality = (F.col("section") == "quality") & ~F.col("metric").startswith("sentence")
    return rounded(r.filter(same | quality))


@query("pip5_profile_reports")
def _(spark, sf):
    return rounded(plans.eda_report(clinical_reports(spark, sf)))


_S = f"WITH {SECONDARY_SQL} "
_P2 = (_S + "SELECT 'condition' AS section, condition AS metric, count(*)::DOUBLE AS value FROM secondary GROUP BY 2 UNION ALL "
       "SELECT * FROM (SELECT 'gender', g, count(*) FROM (SELECT CASE WHEN upper(substr(PatientGender, 1, 1)) IN ('M', 'F') THEN upper(substr(PatientGender, 1, 1)) END AS g FROM secondary) WHERE g IS NOT NULL GROUP BY 2) UNION ALL "
       f"SELECT * FROM (SELECT 'top_words', t, count(*) FROM (SELECT unnest({tokens_sql('Findings', 'fr_profile')}) AS t FROM secondary) GROUP BY 2 ORDER BY count(*) DESC, t LIMIT 25)")


@query("pip5_profile_second", _P2)
def _(spark, sf):
    return plans.profile_second(secondary_reports(spark, sf)).filter(F.col("section").isin("condition", "gender", "top_words"))


_MISS = ["findings", "impression", "quality", "toxic"]


def two_sources(spark, sf):
    lab = table(spark, sf, "labels").withColumnRenamed("doc_id", "uid")
    raw = reports(spark, sf).join(lab, "uid", "left").withColumn("impression", F.nullif("impression", F.lit("")))
    clean = rows.drop_truncated(raw, tx.combine_text("findings", "impression")).withColumns(
        {"findings_clean": F.col("findings"), "impression_clean": F.coalesce("impression", F.lit(""))})
    return raw, clean


_RAW = (f"{REPORTS_SQL}, raw AS (SELECT uid, dataset_source, findings, nullif(impression, '') AS impression, quality, toxic FROM reports LEFT JOIN labels ON doc_id = uid), "
        f"clean AS (SELECT *, {wc('findings')} AS fw, {wc('impression')} AS iw FROM raw WHERE {wc('findings')} + {wc('impression')} >= 5)")
_CMP = (f"WITH {_RAW}, sz AS (SELECT dataset_source, (SELECT count(*) FROM raw r WHERE r.dataset_source = c.dataset_source) AS raw, count(*) AS clean FROM clean c GROUP BY 1), "
        "m AS (SELECT dataset_source, unnest(['raw', 'clean', 'keep_pct', 'size_ratio']) AS metric, unnest([raw::DOUBLE, clean, clean / raw * 100, clean / (SELECT min(clean) FROM sz)]) AS value FROM sz), "
        f"terms AS (SELECT dataset_source, t, count(*) AS n FROM (SELECT dataset_source, unnest(CASE WHEN dataset_source = 'secondary' THEN {tokens_sql('findings', 'fr')} ELSE {tokens_sql('findings', 'en')} END) AS t FROM clean) GROUP BY 1, 2) "
        "SELECT 'size' AS section, dataset_source, metric, round(value, 6) AS value FROM m UNION ALL "
        + " UNION ALL ".join(f"SELECT 'missing', dataset_source, '{c}', round((count(*) - count({c})) / count(*) * 100, 2) FROM raw GROUP BY 2" for c in _MISS) + " UNION ALL "
        + " UNION ALL ".join(f"SELECT 'length', dataset_source, '{n}_{m}', round(({e}({c}) FILTER (WHERE {c} > 0))::DOUBLE, 6) FROM clean GROUP BY 2" for n, c in (("findings", "fw"), ("impression", "iw"))
                             for m, e in (("mean", "avg"), ("median", "median")))
        + " UNION ALL SELECT 'vocabulary', dataset_source, m, v FROM (SELECT dataset_source, unnest(['vocabulary', 'total_tokens']) AS m, unnest([count(*), sum(n)])::DOUBLE AS v FROM terms GROUP BY 1)"
          " UNION ALL SELECT 'top_words', dataset_source, t, n::DOUBLE FROM (SELECT *, row_number() OVER (PARTITION BY dataset_source ORDER BY n DESC, t) AS rn FROM terms) WHERE rn <= 5")


@query("agg30_compare_sources", _CMP)
def _(spark, sf):
    raw, clean = two_sources(spark, sf)
    return rounded(compare.compare_sources(raw, clean, _MISS))


_OV = ["F06_word_count", "F13_flesch_kincaid", "F07_sentence_count"]


def _overlap_sql(cols) -> str:
    parts = []
    for c in cols:
        parts.append(f"SELECT '{c}' AS feature, dataset_source, {c}::DOUBLE AS v FROM tagged")
    return (f"lv AS ({' UNION ALL '.join(parts)}), qs AS (SELECT feature, dataset_source, quantile_cont(v, .01) AS a, quantile_cont(v, .99) AS b FROM lv GROUP BY 1, 2), "
            "sp AS (SELECT feature, min(a) AS a, max(b) AS b FROM qs GROUP BY 1), "
            "bn AS (SELECT lv.feature, dataset_source, a, b, CAST(least(greatest(floor((v - a) / ((b - a) / 39)), 0), 38) AS INTEGER) AS raw, v FROM lv JOIN sp ON lv.feature = sp.feature WHERE v BETWEEN a AND b), "
            "fx AS (SELECT feature, dataset_source, CAST(least(CASE WHEN v < a + (b - a) / 39 * raw THEN raw - 1 WHEN v >= a + (b - a) / 39 * (raw + 1) THEN raw + 1 ELSE raw END, 38) AS INTEGER) AS bin FROM bn), "
            "ov AS (SELECT qs.feature, qs.dataset_source, CAST(g.bin AS INTEGER) AS bin, any_value(sp.a) + (any_value(sp.b) - any_value(sp.a)) / 39 * g.bin AS lo, any_value(sp.a) + (any_value(sp.b) - any_value(sp.a)) / 39 * (g.bin + 1) AS hi, "
            "count(fx.bin) AS n, count(fx.bin) / (sum(count(fx.bin)) OVER (PARTITION BY qs.feature, qs.dataset_source) * (any_value(sp.b) - any_value(sp.a)) / 39) AS density "
            "FROM qs JOIN sp ON qs.feature = sp.feature CROSS JOIN range(39) g(bin) LEFT JOIN fx ON fx.feature = qs.feature AND fx.dataset_source = qs.dataset_source AND fx.bin = g.bin GROUP BY qs.feature, qs.dataset_source, g.bin)")


_TAG = "tagged AS (SELECT *, CASE WHEN condition = 'fr' THEN 'secondary' ELSE 'primary' END AS dataset_source FROM feats)"


def tagged_features(spark, sf):
    return en_features(spark, sf, ["uid", "condition", *compare.OVERLAP_FEATURES]).withColumn("dataset_source", F.when(F.col("condition") == "fr", "secondary").otherwise("primary"))


@query("agg31_feature_overlap",
       f"WITH {EN_FEATURES_SQL}, {_TAG}, {_overlap_sql(_OV)} SELECT feature, dataset_source, bin, round(lo, 6) AS lo, round(hi, 6) AS hi, n, round(density, 6) AS density FROM ov")
def _(spark, sf):
    return rounded(compare.feature_overlap(tagged_features(spark, sf), _OV))


@query("pip8_comparison_summary",
       _CMP.replace("SELECT 'size' AS section", f"SELECT * FROM (WITH {EN_FEATURES_SQL}, {_TAG}, {_overlap_sql(compare.OVERLAP_FEATURES)} "
                    "SELECT 'overlap' AS section, dataset_source, feature || '.' || bin AS metric, round(density, 6) AS value FROM ov) UNION ALL SELECT 'size' AS section", 1))
def _(spark, sf):
    raw, clean = two_sources(spark, sf)
    return rounded(plans.comparison_summary(raw, clean, tagged_features(spark, sf), _MISS))


def _models_sql(dataset: str, names: dict, curves: bool) -> str:
    rows = [f"SELECT '{dataset}' AS dataset, '{m}' AS model, '{x}' AS metric, TRUE AS valid" for m, xs in names.items() for x in xs]
    rows += [f"SELECT '{dataset}', 'cox', 'survival.{g}', TRUE" for g in survival.RISK_GROUPS if curves]
    return " UNION ALL ".join(rows)


def _model_rows(out):
    """Which scores there are, and that they are shares; a survival curve does not rise."""
    falls = F.col("value") <= F.coalesce(F.lag("value").over(Window.partitionBy("dataset", "model", "metric").orderBy("at")), F.lit(1.0))
    each = out.withColumn("ok", F.col("value").between(0, 1) & (F.col("at").isNull() | falls))
    return each.groupBy("dataset", "model", "metric").agg(F.min("ok").alias("valid"))


_TWO = ["macro_f1", "accuracy", "f1", "auc"]


@query("pip7_run_models", _models_sql("primary", {"logistic_regression": _TWO, "random_forest": _TWO, "boosted_trees": _TWO, "cox": ["c_index"]}, True))
def _(spark, sf):
    return _model_rows(plans.run_models(en_features(spark, sf, ["uid", *EN_NAMES]), "F25_is_abnormal", folds=3, trees=10, depth=6, rounds=5))


@query("pip7_run_models_multiclass",
       _models_sql("secondary", {m: ["macro_f1", "accuracy"] for m in ("logistic_regression", "random_forest", "boosted_trees", "text_logistic")}, False))
def _(spark, sf):
    return _model_rows(plans.run_models(fr_features(spark, sf, ["uid", "findings_clean", *FR_NAMES]), "F25_condition_label", folds=2, trees=10, depth=6, rounds=2, binary=False,
                                        exclude=(), text="findings_clean", dataset="secondary"))


_P9_EN = feature_cte(lx.EN, f"{_PIP1}, cleaned AS (SELECT uid, '' AS condition, mesh_major, {norm_en_sql('findings')} AS findings_clean, {norm_en_sql('impression')} AS impression_clean FROM s3)")
_P9_FR = feature_cte(lx.FR, f"{_PIP3}, cleaned AS (SELECT ExamID AS uid, condition, {age_sql('PatientAge', 'leading')} AS patient_age, NULL AS patient_gender, "
                            f"{norm_fr_sql('Findings')} AS findings_clean, {norm_fr_sql('Impression')} AS impression_clean FROM s3)")
_P9 = " UNION ALL ".join(
    f"SELECT * FROM (WITH {cte} SELECT '{name}' AS source, CAST(uid AS VARCHAR) AS uid, F06_word_count, round(F13_flesch_kincaid::DOUBLE, 6) AS F13_flesch_kincaid FROM feats)"
    for name, cte in (("primary", _P9_EN), ("secondary", _P9_FR)))


@query("pip9_run_sources", _P9)
def _(spark, sf):
    out = plans.run_sources({"primary": clinical_reports(spark, sf), "secondary": secondary_reports(spark, sf)}, "both",
                            {"primary": "uid", "secondary": "seq"}, ["uid", "F06_word_count", "F13_flesch_kincaid"])
    a, b = (out[name]["features"].select(F.lit(name).alias("source"), F.col("uid").cast("string").alias("uid"), "F06_word_count", "F13_flesch_kincaid")
            for name in ("primary", "secondary"))
    return rounded(a.unionByName(b))
