"""Projections, filters, membership, ordered operators, unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (CLINICAL_SQL, REPORTS_SQL, SECONDARY_SQL, clinical_reports, reports, secondary_reports,
                            table, wc)
from catalog.registry import query
from catalog.text_queries import norm_en_sql, squeeze_sql
from reportlens.functions import text as tx
from reportlens.operators import dedup, ordered, profile, rows

_R = f"WITH {REPORTS_SQL} "
_C = f"WITH {CLINICAL_SQL} "
_S = f"WITH {SECONDARY_SQL} "


@query("src4_drop_placeholder_columns", "SELECT doc_id, lang FROM documents")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang").withColumns(
        {"Unnamed: 0": F.lit(1), "EndHere": F.lit("x")})
    return rows.drop_columns_matching(d)


@query("prj1_select_existing", "SELECT doc_id, lang, source FROM documents")
def _(spark, sf):
    return rows.select_existing(table(spark, sf, "documents"), ["doc_id", "absent", "lang", "source"])


@query("prj2_unified_schema",
       _S + "SELECT ExamID AS uid, ImageID AS image_id, PatientID AS patient_id, StudyDate AS study_date, "
            "ReportID AS report_id, Comparison AS comparison, condition FROM secondary")
def _(spark, sf):
    s = secondary_reports(spark, sf).select("ExamID", "ImageID", "PatientID", "StudyDate", "ReportID", "Comparison", "condition")
    return rows.to_unified_schema(s)


@query("prj3_tag_source", "SELECT doc_id, 'primary' AS dataset_source FROM documents")
def _(spark, sf):
    return rows.tag_source(table(spark, sf, "documents").select("doc_id"), "primary")


@query("prj4_fill_text", _S + "SELECT seq, coalesce(Comparison, '') AS Comparison, md5(coalesce(Findings, '')) AS f FROM secondary")
def _(spark, sf):
    s = rows.fill_text(secondary_reports(spark, sf), ["Comparison", "Findings", "NotThere"])
    return s.select("seq", "Comparison", F.md5("Findings").alias("f"))


@query("prj5_feature_columns", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS F01_a, l_tax AS F02_b FROM lineitem")
def _(spark, sf):
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("F01_a"),
                                            F.col("l_tax").alias("F02_b"), F.col("l_tax").alias("F12_leak"))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", *rows.feature_columns(d, exclude=["F12_leak"]))


@query("prj6_coerce_numeric", "SELECT p_partkey, coalesce(TRY_CAST(replace(p_brand, 'Brand#1', '') AS DOUBLE), 0) AS v FROM part")
def _(spark, sf):
    d = table(spark, sf, "part").select("p_partkey", F.replace("p_brand", F.lit("Brand#1"), F.lit("")).alias("v"))
    return rows.coerce_numeric(d, ["v"])


@query("prj7_squeeze_strings", _R + f"SELECT uid, condition, md5({squeeze_sql('impression')}) AS squeezed FROM reports")
def _(spark, sf):
    d = rows.squeeze_all_strings(reports(spark, sf).select("uid", "condition", "impression"))
    return d.select("uid", "condition", F.md5("impression").alias("squeezed"))


@query("flt1_drop_null_key", "SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left").select("doc_id", "quality")
    return rows.drop_null_key(d, "quality")


@query("flt2_drop_both_empty", _S + "SELECT seq FROM secondary WHERE NOT (coalesce(Findings,'') = '' AND coalesce(Impression,'') = '')")
def _(spark, sf):
    return rows.drop_both_empty(secondary_reports(spark, sf), "Findings", "Impression").select("seq")


@query("flt2_drop_both_empty_stripped",
       _S + "SELECT seq FROM secondary WHERE regexp_matches(coalesce(Findings,''), '\\S') OR regexp_matches(coalesce(Impression,''), '\\S')")
def _(spark, sf):
    return rows.drop_both_empty(secondary_reports(spark, sf), "Findings", "Impression", strip=True).select("seq")


_BOTH = "(findings || ' ' || impression)"


@query("flt3_drop_truncated", _R + f"SELECT uid FROM reports WHERE {wc(_BOTH)} >= 5")
def _(spark, sf):
    return rows.drop_truncated(reports(spark, sf), tx.combine_text("findings", "impression")).select("uid")


@query("flt4_drop_malformed", _R + f"SELECT uid FROM reports WHERE NOT ({wc('findings')} < 3 AND {wc('impression')} = 0)")
def _(spark, sf):
    return rows.drop_malformed(reports(spark, sf)).select("uid")


@query("flt5_summary_pairs", _R + "SELECT uid FROM reports WHERE length(findings) > 10 AND length(impression) > 3")
def _(spark, sf):
    return rows.summary_pairs(reports(spark, sf), "findings", "impression").select("uid")


@query("flt6_positive_only",
       "SELECT event_type, round(avg(CASE WHEN value - 5 > 0 THEN value - 5 END), 6) AS mean_pos, "
       "count(CASE WHEN value - 5 > 0 THEN 1 END) AS n_pos FROM events GROUP BY 1")
def _(spark, sf):
    v = rows.positive_only(F.col("value") - 5)
    return table(spark, sf, "events").groupBy("event_type").agg(F.round(F.avg(v), 6).alias("mean_pos"), F.count(v).alias("n_pos"))


_PRESENCE = """count(*) FILTER (WHERE f AND NOT i) AS findings_only, count(*) FILTER (WHERE NOT f AND i) AS impression_only,
 count(*) FILTER (WHERE f AND i) AS both_present, count(*) FILTER (WHERE NOT f AND NOT i) AS none_present"""


@query("flt7_section_presence",
       _S + f"SELECT {_PRESENCE} FROM (SELECT coalesce(Findings,'') <> '' AS f, coalesce(Impression,'') <> '' AS i FROM secondary)")
def _(spark, sf):
    return profile.section_presence(secondary_reports(spark, sf), "Findings", "Impression")


@query("smp1_sample_n", "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 200")
def _(spark, sf):
    return rows.sample_n(table(spark, sf, "documents").select("doc_id", "lang"), 200, 42, "doc_id")


@query("smp1_head_n", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def _(spark, sf):
    return rows.head_n(table(spark, sf, "documents").select("doc_id", "lang"), 100, "doc_id")


# ----------------------------------------------------------------- joins

_COPIES = """copies AS (SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn
 FROM documents) WHERE rn > 1)"""


@query("jn1_drop_ids", f"WITH {_COPIES} SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM copies)")
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("k"))
    first = d.groupBy("k").agg(F.min("doc_id").alias("doc_id"))
    later = d.join(first, ["k", "doc_id"], "left_anti")
    return rows.drop_ids(d.drop("k"), later, "doc_id")


@query("jn2_keep_in", "SELECT doc_id, lang FROM documents WHERE lang IN ('fr', 'de') AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def _(spark, sf):
    d = rows.keep_in(table(spark, sf, "documents").select("doc_id", "lang"), "lang", ["fr", "de"])
    return rows.keep_in(d, "doc_id", table(spark, sf, "labels").filter("quality = 1").select("doc_id"))


@query("jn4_global_max",
       "SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity / (SELECT max(l_quantity) FROM lineitem), 6) AS q, "
       "round(l_extendedprice / (SELECT max(l_extendedprice) FROM lineitem), 6) AS p FROM lineitem")
def _(spark, sf):
    d = rows.with_global_max(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    return d.select("l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("l_quantity") / F.col("max_l_quantity"), 6).alias("q"),
                    F.round(F.col("l_extendedprice") / F.col("max_l_extendedprice"), 6).alias("p"))


@query("jn6_join_on_key", _R + "SELECT r.uid, r.condition, l.quality, l.toxic FROM reports r JOIN labels l ON l.doc_id = r.uid")
def _(spark, sf):
    right = table(spark, sf, "labels").withColumnRenamed("doc_id", "uid")
    return rows.join_on_key(reports(spark, sf).select("uid", "condition"), right)


# ------------------------------------------------------- window / ordered

@query("win1_dedup_first",
       _R + f"SELECT uid, condition FROM (SELECT uid, condition, row_number() OVER (PARTITION BY {_BOTH} ORDER BY uid) AS rn FROM reports) WHERE rn = 1")
def _(spark, sf):
    d = reports(spark, sf).withColumn("combined", tx.combine_text("findings", "impression"))
    return dedup.dedup_first(d.select("uid", "condition", "combined"), "combined", "uid").select("uid", "condition")


@query("win2_step_difference",
       "SELECT event_type, n, coalesce(lag(n) OVER (ORDER BY n DESC, event_type) - n, 0) AS removed FROM "
       "(SELECT event_type, count(*) AS n FROM events GROUP BY 1)")
def _(spark, sf):
    from reportlens.plans.cleaning import step_differences
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return step_differences(counts, F.desc("n"), "event_type")


_QB = "(SELECT quantile_cont(l_extendedprice, 0.25) a, quantile_cont(l_extendedprice, 0.5) b, quantile_cont(l_extendedprice, 0.75) c FROM lineitem)"


@query("win3_quantile_bucket",
       f"SELECT bucket, count(*) AS n, min(x) AS lo, max(x) AS hi FROM (SELECT l_extendedprice AS x, CASE WHEN l_extendedprice <= a THEN 'Low' "
       f"WHEN l_extendedprice <= b THEN 'Med-Low' WHEN l_extendedprice <= c THEN 'Med-High' ELSE 'High' END AS bucket FROM lineitem, {_QB}) GROUP BY 1")
def _(spark, sf):
    from reportlens.operators.stats import quantile_bucket
    d = quantile_bucket(table(spark, sf, "lineitem"), "l_extendedprice", ["Low", "Med-Low", "Med-High", "High"], out="bucket")
    return d.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"))


@query("win5_running_counts",
       "SELECT value, a, b, sum(a) OVER w AS cum_a, sum(b) OVER w AS cum_b FROM (SELECT value, count(*) FILTER (WHERE event_type = 'click') AS a, "
       "count(*) FILTER (WHERE event_type <> 'click') AS b FROM events GROUP BY 1) WINDOW w AS (ORDER BY value)".replace(
           "sum(a) OVER w AS", "CAST(sum(a) OVER w AS BIGINT) AS").replace("sum(b) OVER w AS", "CAST(sum(b) OVER w AS BIGINT) AS"))
def _(spark, sf):
    out = ordered.running_counts(table(spark, sf, "events"), "value",
                                 {"a": F.col("event_type") == "click", "b": F.col("event_type") != "click"})
    return out.select("value", "a", "b", "cum_a", "cum_b")


# ------------------------------------------------------------ sorts / top-k

@query("top1_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(spark, sf):
    return rows.top_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 20, tie="o_orderkey")


@query("top3_largest_categories", "SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 5")
def _(spark, sf):
    d = table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return rows.top_n(d, "n", 5, tie="source")


# --------------------------------------------------------------------- sets

@query("set1_union_sources",
       _R + "SELECT uid, condition, CAST(NULL AS BIGINT) AS patient_id, 'primary' AS dataset_source FROM reports WHERE condition <> 'fr' UNION ALL "
            "SELECT uid, NULL, uid % 7, 'secondary' FROM reports WHERE condition = 'fr'")
def _(spark, sf):
    r = reports(spark, sf)
    a = rows.tag_source(r.filter("condition <> 'fr'").select("uid", "condition"), "primary")
    b = rows.tag_source(r.filter("condition = 'fr'").select("uid", (F.col("uid") % 7).alias("patient_id")), "secondary")
    return rows.union_sources([a, b])


@query("set2_dedup_keep_blank",
       _S + "SELECT seq FROM (SELECT seq, Findings, row_number() OVER (PARTITION BY Findings ORDER BY seq) AS rn FROM secondary) "
            "WHERE rn = 1 OR NOT regexp_matches(coalesce(Findings,''), '\\S')")
def _(spark, sf):
    s = secondary_reports(spark, sf).select("seq", "Findings")
    return dedup.dedup_first(s, "Findings", "seq", keep_blank=tx.is_blank("Findings")).select("seq")
