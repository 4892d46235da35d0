"""Profiling aggregates, distributions, correlation, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (CLINICAL_SQL, REPORTS_SQL, SECONDARY_SQL, clinical_reports, reports, sc, secondary_reports,
                            table, wc)
from catalog.registry import query
from catalog.text_queries import age_sql, all_cats_sql, gender_sql, hits_sql, occ_sql, quote, tokens_sql
from reportlens.functions import lexicons as lx, text as tx
from reportlens.operators import ordered, profile

LENGTH_COLS = ["findings_words", "impression_words", "total_words", "findings_sentences", "avg_sentence_len"]
LENGTHS_SQL = (
    f"{REPORTS_SQL}, counted AS (SELECT *, {wc('findings')} AS findings_words, {wc('impression')} AS impression_words, "
    f"CAST(length(findings) AS INTEGER) AS findings_chars, CAST(length(impression) AS INTEGER) AS impression_chars, "
    f"{sc('findings')} AS findings_sentences, {sc('impression')} AS impression_sentences FROM reports), "
    "lens AS (SELECT *, findings_words + impression_words AS total_words, "
    "findings_words / greatest(findings_sentences, 1) AS avg_sentence_len FROM counted)")


def melted(cols, source="lens", by=(), positive=True) -> str:
    keys = "".join(f"{b}, " for b in by)
    where = " WHERE value > 0" if positive else " WHERE value IS NOT NULL"
    parts = " UNION ALL ".join(f"SELECT {keys}'{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM {source}" for c in cols)
    return f"melted AS (SELECT * FROM ({parts}){where})"


def lengths(spark, sf):
    return profile.with_lengths(reports(spark, sf))


def rounded(df, digits=6):
    """Round every double column of a result."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


def quant(p, c="value"):
    return f"quantile_cont({c}, {p})"


_L = f"WITH {LENGTHS_SQL}"


@query("agg1_value_counts", "SELECT source, count(*) AS n FROM documents GROUP BY 1")
def _(spark, sf):
    return profile.value_counts(table(spark, sf, "documents"), "source")


@query("agg1_value_counts_with_null",
       "SELECT l.quality, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def _(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return profile.value_counts(d, "quality", dropna=False)


_S_COLS = ["ExamID", "PatientGender", "Findings", "Comparison", "Impression", "condition"]


@query("agg2_missing_profile",
       f"WITH {SECONDARY_SQL} " + " UNION ALL ".join(
           f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, round((count(*) - count({c})) / count(*) * 100, 2) AS pct FROM secondary"
           for c in _S_COLS))
def _(spark, sf):
    return profile.missing_profile(secondary_reports(spark, sf).select(*_S_COLS))


_E_COLS = ["findings", "impression", "indication", "comparison", "mesh_major"]


@query("agg3_empty_profile",
       f"WITH {CLINICAL_SQL} " + " UNION ALL ".join(
           f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE coalesce({c}, '') = '') AS missing, "
           f"round(count(*) FILTER (WHERE coalesce({c}, '') = '') / count(*) * 100, 6) AS pct FROM clinical" for c in _E_COLS))
def _(spark, sf):
    return rounded(profile.empty_profile(clinical_reports(spark, sf), _E_COLS))


@query("agg4_missing_matrix",
       f"WITH {SECONDARY_SQL} SELECT seq, " + ", ".join(
           f"CAST(coalesce({c}, '') = '' AS INTEGER) AS {c}" for c in ("Findings", "Impression", "Comparison")) + " FROM secondary")
def _(spark, sf):
    return profile.missing_matrix(secondary_reports(spark, sf), "seq", ["Findings", "Impression", "Comparison"])


_DESCRIBE = ("count(*) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, "
             f"round({quant(0.25)}, 6) AS q25, round({quant(0.5)}, 6) AS median, round({quant(0.75)}, 6) AS q75, max(value) AS max")
_LI_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("agg5_describe", f"{_L}, {melted(LENGTH_COLS, positive=False)} SELECT metric, {_DESCRIBE.replace('min(value)', 'round(min(value), 6)').replace('max(value)', 'round(max(value), 6)')} FROM melted GROUP BY 1")
def _(spark, sf):
    return rounded(profile.describe_numeric(lengths(spark, sf), LENGTH_COLS))


@query("agg5_describe_prices", f"WITH {melted(_LI_COLS, 'lineitem', positive=False)} SELECT metric, {_DESCRIBE} FROM melted GROUP BY 1")
def _(spark, sf):
    return rounded(profile.describe_numeric(table(spark, sf, "lineitem"), _LI_COLS))


@query("agg6_numeric_summary",
       f"WITH {SECONDARY_SQL}, ages AS (SELECT {age_sql('PatientAge', 'any')} AS value FROM secondary) "
       f"SELECT 'age' AS metric, count(value) AS n, round(avg(value), 6) AS mean, {quant(0.5)} AS median, min(value) AS min, max(value) AS max FROM ages")
def _(spark, sf):
    d = secondary_reports(spark, sf).select(tx.parse_age("PatientAge", "any").alias("age"))
    return rounded(profile.numeric_summary(d, "age"))


@query("agg7_length_summary",
       f"{_L}, {melted(['findings_words', 'impression_words'], by=['condition'])} SELECT condition, metric, count(*) AS n, "
       f"round(avg(value), 6) AS mean, round({quant(0.5)}, 6) AS median FROM melted GROUP BY 1, 2")
def _(spark, sf):
    return rounded(profile.length_summary(lengths(spark, sf), by=["condition"]))


_SKEW = ("round((avg(value*value*value) - 3*avg(value)*avg(value*value) + 2*pow(avg(value),3)) / pow(var_pop(value), 1.5), 4) AS skewness, "
         "round((avg(pow(value,4)) - 4*avg(value)*avg(pow(value,3)) + 6*pow(avg(value),2)*avg(value*value) - 3*pow(avg(value),4)) / pow(var_pop(value), 2) - 3, 4) AS kurtosis")


@query("agg8_distribution_properties",
       f"{_L}, {melted(LENGTH_COLS)} SELECT metric, count(*) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, "
       f"round(min(value), 4) AS min, round({quant(.25)}, 4) AS q25, round({quant(.5)}, 4) AS median, round({quant(.75)}, 4) AS q75, "
       f"round(max(value), 4) AS max, {_SKEW}, round({quant(.75)} - {quant(.25)}, 4) AS iqr FROM melted GROUP BY 1")
def _(spark, sf):
    return rounded(profile.distribution_properties(lengths(spark, sf), LENGTH_COLS), 4)


_PS = (5, 10, 25, 50, 75, 90, 95, 99)


@query("agg9_percentile_table",
       f"{_L}, {melted(LENGTH_COLS)} " + " UNION ALL ".join(
           f"SELECT metric, {p} AS percentile, round({quant(p / 100)}, 6) AS value FROM melted GROUP BY 1" for p in _PS))
def _(spark, sf):
    return rounded(profile.percentile_table(lengths(spark, sf), LENGTH_COLS, _PS))


_IQR_COLS = ["findings_words", "impression_words"]
_FENCES = (f"fences AS (SELECT metric, count(*) AS n, {quant(.25)} AS q25, {quant(.75)} AS q75, "
           f"{quant(.25)} - 1.5*({quant(.75)} - {quant(.25)}) AS lower, {quant(.75)} + 1.5*({quant(.75)} - {quant(.25)}) AS upper FROM melted GROUP BY 1)")


@query("agg10_iqr_bounds",
       f"{_L}, {melted(_IQR_COLS, positive=False)}, {_FENCES} SELECT metric, n, round(q25,6) AS q25, round(q75,6) AS q75, round(lower,6) AS lower, "
       "round(upper,6) AS upper, (SELECT count(*) FROM melted m WHERE m.metric = f.metric AND (m.value < f.lower OR m.value > f.upper)) AS outliers, "
       "round((SELECT count(*) FROM melted m WHERE m.metric = f.metric AND (m.value < f.lower OR m.value > f.upper)) / n * 100, 6) AS pct FROM fences f")
def _(spark, sf):
    return rounded(profile.iqr_bounds(lengths(spark, sf), _IQR_COLS))


@query("agg10_flag_outliers",
       f"{_L}, {melted(_IQR_COLS, positive=False)}, {_FENCES} SELECT uid, " + ", ".join(
           f"({c} < (SELECT lower FROM fences WHERE metric = '{c}') OR {c} > (SELECT upper FROM fences WHERE metric = '{c}')) AS {c}_outlier"
           for c in _IQR_COLS) + " FROM lens")
def _(spark, sf):
    d = profile.flag_outliers(lengths(spark, sf).select("uid", *_IQR_COLS), _IQR_COLS)
    return d.select("uid", *[f"{c}_outlier" for c in _IQR_COLS])


@query("agg11_box_stats",
       "WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, .25) AS q25, quantile_cont(l_extendedprice, .5) AS median, "
       "quantile_cont(l_extendedprice, .75) AS q75 FROM lineitem GROUP BY 1) SELECT l_returnflag, count(*) AS n, min(l_extendedprice) AS min, "
       "min(l_extendedprice) FILTER (WHERE l_extendedprice >= q25 - 1.5*(q75-q25)) AS whisker_low, round(any_value(q25),6) AS q25, round(any_value(median),6) AS median, "
       "round(any_value(q75),6) AS q75, max(l_extendedprice) FILTER (WHERE l_extendedprice <= q75 + 1.5*(q75-q25)) AS whisker_high, "
       "max(l_extendedprice) AS max, round(avg(l_extendedprice), 4) AS mean FROM lineitem JOIN q USING (l_returnflag) GROUP BY 1")
def _(spark, sf):
    d = profile.box_stats(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
    return d.select("l_returnflag", "n", "min", "whisker_low", *[F.round(c, 6).alias(c) for c in ("q25", "median", "q75")],
                    "whisker_high", "max", F.round("mean", 4).alias("mean"))


@query("agg12_histogram",
       "WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem), b AS (SELECT CASE WHEN l_extendedprice = hi THEN 49 "
       "ELSE CAST(floor((l_extendedprice - lo) / (hi - lo) * 50) AS INTEGER) END AS bin FROM lineitem, r) "
       "SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + (hi - lo)/50 * g.bin, 6) AS lo, round(lo + (hi - lo)/50 * (g.bin + 1), 6) AS hi, count(b.bin) AS n "
       "FROM range(50) g(bin) CROSS JOIN r LEFT JOIN b ON b.bin = g.bin GROUP BY g.bin, lo, hi")
def _(spark, sf):
    return rounded(profile.histogram(table(spark, sf, "lineitem"), "l_extendedprice", bins=50))


@query("agg12_histogram_edges",
       f"{_L}, g AS (SELECT DISTINCT condition, CAST(b AS INTEGER) AS bin FROM lens, range(39) t(b)), "
       "h AS (SELECT condition, CASE WHEN findings_words = 195 THEN 38 ELSE CAST(findings_words // 5 AS INTEGER) END AS bin FROM lens "
       "WHERE findings_words > 0 AND findings_words <= 195) SELECT g.condition, g.bin, g.bin * 5.0::DOUBLE AS lo, (g.bin + 1) * 5.0::DOUBLE AS hi, count(h.bin) AS n, "
       "round(count(h.bin) / (sum(count(h.bin)) OVER (PARTITION BY g.condition) * 5), 6) AS density "
       "FROM g LEFT JOIN h ON g.condition = h.condition AND g.bin = h.bin GROUP BY g.condition, g.bin")
def _(spark, sf):
    return rounded(profile.histogram(lengths(spark, sf), "findings_words", edges=list(range(0, 200, 5)), density=True,
                                     positive_only=True, by="condition"))


_GRID = [float(g) for g in range(0, 100, 5)]


@query("agg13_kde",
       "WITH s AS (SELECT event_type, count(value) AS total, stddev_samp(value) * pow(count(value), -0.2) AS h FROM events GROUP BY 1), "
       f"grid AS (SELECT unnest({_GRID}::DOUBLE[]) AS grid) SELECT event_type, grid, "
       "round(sum(exp(-0.5 * pow((grid - value) / h, 2)) / (h * sqrt(2 * pi())) / total), 6) AS density FROM events JOIN s USING (event_type), grid GROUP BY 1, 2")
def _(spark, sf):
    return rounded(profile.kde(table(spark, sf, "events"), "value", _GRID, "event_type"))


@query("agg14_ecdf",
       f"{_L}, {melted(['findings_words'])} SELECT value, count(*) AS n, round(sum(count(*)) OVER (ORDER BY value) / (SELECT count(*) FROM melted) * 100, 6) AS cumulative_pct "
       "FROM melted GROUP BY 1")
def _(spark, sf):
    return rounded(ordered.ecdf(lengths(spark, sf), "findings_words"))


@query("agg15_qq_points",
       "WITH p AS (SELECT unnest(range(50)) AS i, unnest([" + ", ".join(
           repr(round(__import__("statistics").NormalDist().inv_cdf(p), 6)) for p in profile.qq_probs(50)) + "]::DOUBLE[]) AS theoretical, "
       f"(SELECT quantile_cont(value, {profile.qq_probs(50)}) FROM events WHERE value > 0) AS qs) SELECT CAST(i AS INTEGER) AS i, theoretical, round(qs[i + 1], 6) AS sample FROM p")
def _(spark, sf):
    return rounded(profile.qq_points(table(spark, sf, "events"), "value", 50))


NUMERIC = ["findings_words", "impression_words", "findings_chars", "impression_chars", "findings_sentences", "impression_sentences"]


def _corr_sql(cols):
    return " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}::DOUBLE, {b}::DOUBLE) AS r FROM lens"
                              for i, a in enumerate(cols) for b in cols[i + 1:])


@query("agg16_correlation_matrix",
       f"{_L} " + " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}::DOUBLE, {b}::DOUBLE), 6) AS r FROM lens" for a in NUMERIC for b in NUMERIC))
def _(spark, sf):
    return rounded(profile.correlation_matrix(lengths(spark, sf), NUMERIC))


@query("agg17_ranked_pairs",
       f"{_L}, p AS ({_corr_sql(NUMERIC)}), t AS (SELECT *, 'top' AS side FROM p ORDER BY r DESC, feature_a, feature_b LIMIT 8), "
       "b AS (SELECT *, 'bottom' AS side FROM p ORDER BY r, feature_a DESC, feature_b DESC LIMIT 3) "
       "SELECT feature_a, feature_b, round(r, 6) AS r, side, round((SELECT avg(abs(r)) FROM p), 6) AS mean_abs_r FROM (SELECT * FROM t UNION ALL SELECT * FROM b)")
def _(spark, sf):
    return rounded(profile.ranked_pairs(lengths(spark, sf), NUMERIC))


@query("agg17_high_pairs", f"{_L} SELECT feature_a, feature_b, round(r, 6) AS r FROM ({_corr_sql(NUMERIC)}) WHERE abs(r) > 0.7")
def _(spark, sf):
    return rounded(profile.correlated_pairs(lengths(spark, sf), NUMERIC, 0.7))


@query("agg18_compression_stats",
       f"{_L} SELECT 'compression' AS metric, count(*) AS n, round(avg(c), 6) AS mean, round(median(c), 6) AS median, round(min(c), 6) AS min, "
       "round(max(c), 6) AS max, count(*) FILTER (WHERE c < 20) AS below_20 FROM (SELECT findings_words / impression_words AS c FROM lens "
       "WHERE findings_words > 0 AND impression_words > 0)")
def _(spark, sf):
    return rounded(profile.compression_stats(lengths(spark, sf)))


@query("agg19_text_quality",
       f"{_L.replace(REPORTS_SQL, CLINICAL_SQL.replace('clinical AS', 'reports AS'))} SELECT count(*) AS n, count(*) FILTER (WHERE x) AS placeholder, "
       "round(count(*) FILTER (WHERE x) / count(*) * 100, 6) AS placeholder_pct, count(*) FILTER (WHERE findings_words < 5) AS very_short, "
       "count(*) FILTER (WHERE total_words > 100) AS very_long, count(*) FILTER (WHERE total_words * 1.3 > 512) AS over_512_tokens, "
       "round(avg(avg_sentence_len), 6) AS sentence_len_mean, round(stddev_samp(avg_sentence_len), 6) AS sentence_len_std, "
       "round(median(avg_sentence_len), 6) AS sentence_len_median FROM (SELECT *, contains(upper(findings), 'XXXX') OR contains(upper(impression), 'XXXX') AS x FROM lens)")
def _(spark, sf):
    return rounded(profile.text_quality(profile.with_lengths(clinical_reports(spark, sf))))


@query("agg20_vocabulary_size",
       f"WITH {REPORTS_SQL} SELECT dataset_source, count(DISTINCT w) AS vocabulary, count(*) AS total_tokens FROM "
       f"(SELECT dataset_source, unnest({tokens_sql('impression', 'fr')}) AS w FROM reports) GROUP BY 1")
def _(spark, sf):
    return profile.vocabulary_size(reports(spark, sf), "impression", "fr", ["dataset_source"])


@query("agg20_vocabulary_size_raw",
       f"WITH {REPORTS_SQL} SELECT count(DISTINCT w) AS vocabulary, count(*) AS total_tokens FROM (SELECT unnest({tokens_sql('findings', 'raw')}) AS w FROM reports)")
def _(spark, sf):
    return profile.vocabulary_size(reports(spark, sf), "findings", "raw")


@query("agg21_label_term_counts",
       "SELECT label, count(*) AS n FROM (SELECT unnest(string_split(p_type || '|' || p_brand, '|')) AS label FROM part) GROUP BY 1 ORDER BY n DESC, label LIMIT 20")
def _(spark, sf):
    d = table(spark, sf, "part").select(F.concat_ws("|", "p_type", "p_brand").alias("terms"))
    return profile.label_term_counts(d, "terms", k=20)


@query("agg21_label_totals",
       "SELECT count(DISTINCT label) AS unique_labels, count(*) AS occurrences FROM (SELECT unnest(string_split(p_type || '|' || p_brand, '|')) AS label FROM part)")
def _(spark, sf):
    return profile.label_totals(table(spark, sf, "part").select(F.concat_ws("|", "p_type", "p_brand").alias("terms")), "terms")


_TERMS = ["la", "de", "pneumothorax", "ment", "aux", "eau"]


@query("agg22_term_class_counts",
       f"WITH {REPORTS_SQL} " + " UNION ALL ".join(
           f"SELECT condition, '{t}' AS term, CAST(sum({occ_sql(chr(39).join(['lower(findings || ', ' ', ' || impression)']), [t])}) AS BIGINT) AS n FROM reports GROUP BY 1"
           for t in _TERMS))
def _(spark, sf):
    r = reports(spark, sf)
    return profile.term_class_counts(r, "condition", tx.combine_text("findings", "impression"), _TERMS)


_LAB = f"WITH {CLINICAL_SQL}, lab AS (SELECT uid, string_split({all_cats_sql('lower(mesh_major)', lx.EN_LABEL_CATEGORIES)}, '|') AS labels FROM clinical)"


def labelled(spark, sf):
    return clinical_reports(spark, sf).withColumn("low_m", tx.lowered("mesh_major")).select(
        "uid", tx.all_categories("low_m", lx.EN_LABEL_CATEGORIES).alias("labels"))


def _in(l):
    return f"list_contains(labels, {quote(l)})"


@query("agg23_label_cooccurrence",
       _LAB + " SELECT label_a, label_b, n, round(CASE WHEN s > 0 THEN n / s * 100 ELSE 0 END, 6) AS pct FROM (" + " UNION ALL ".join(
           f"SELECT {quote(a)} AS label_a, {quote(b)} AS label_b, count(*) FILTER (WHERE {_in(a)} AND {_in(b)}) AS n, "
           f"least(count(*) FILTER (WHERE {_in(a)}), count(*) FILTER (WHERE {_in(b)})) AS s FROM lab"
           for a in lx.MAIN_LABELS for b in lx.MAIN_LABELS) + ")")
def _(spark, sf):
    return rounded(profile.label_cooccurrence(labelled(spark, sf), "labels", lx.MAIN_LABELS))


_FL = [f"has_{c}" for c in ("Normal", "Cardiomegaly", "Opacity/Mass", "Pneumonia")]


@query("agg24_crosstab_margins",
       _LAB + ", fl AS (SELECT " + ", ".join(f'CAST({_in(c[4:])} AS INTEGER) AS f{i}' for i, c in enumerate(_FL)) + " FROM lab) "
       "SELECT f0, f1, f2, f3, count(*) AS n, CAST(grouping(f0) AS INTEGER) AS row_margin, CAST(grouping(f1) AS INTEGER) AS col_margin FROM fl "
       "GROUP BY GROUPING SETS ((f0, f1, f2, f3), (f0), (f1, f2, f3), ())")
def _(spark, sf):
    from reportlens.operators.rows import label_flags
    flags = label_flags(labelled(spark, sf), "labels", [c[4:] for c in _FL])
    flags = flags.select(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(_FL)])
    return profile.crosstab_margins(flags, "f0", ["f1", "f2", "f3"])


_COUNTS = ", ".join(f"count(*) FILTER (WHERE {_in(l)}) AS n{i}" for i, l in enumerate(lx.MAIN_LABELS))
_NS = ", ".join(f"n{i}" for i in range(len(lx.MAIN_LABELS)))


@query("agg25_class_imbalance",
       _LAB + f", t AS (SELECT count(*) AS tot, {_COUNTS} FROM lab) " + " UNION ALL ".join(
           f"SELECT {quote(l)} AS label, n{i} AS n, round(n{i} / tot * 100, 6) AS pct, "
           f"round(CASE WHEN least({_NS}) > 0 THEN greatest({_NS}) / least({_NS}) ELSE 0 END, 6) AS imbalance_ratio FROM t" for i, l in enumerate(lx.MAIN_LABELS)))
def _(spark, sf):
    return rounded(profile.class_imbalance(labelled(spark, sf), "labels", lx.MAIN_LABELS))


@query("agg26_label_cardinality",
       _LAB + " SELECT round(avg(k), 6) AS cardinality, round(avg(k) / 8, 6) AS density FROM (SELECT "
       + " + ".join(f"CAST({_in(l)} AS INTEGER)" for l in lx.MAIN_LABELS) + " AS k FROM lab)")
def _(spark, sf):
    return rounded(profile.label_cardinality(labelled(spark, sf), "labels", lx.MAIN_LABELS))


@query("agg27_labels_per_record",
       _LAB + ", k AS (SELECT CASE WHEN labels = ['Other'] THEN 0 ELSE CAST(len(labels) AS INTEGER) END AS num_labels FROM lab), "
       "s AS (SELECT " + ", ".join(f"round(count(*) FILTER (WHERE num_labels >= {k}) / count(*) * 100, 6) AS pct_ge{k}" for k in (1, 2, 3)) + " FROM k) "
       "SELECT num_labels, count(*) AS n, any_value(pct_ge1) AS pct_ge1, any_value(pct_ge2) AS pct_ge2, any_value(pct_ge3) AS pct_ge3 FROM k, s GROUP BY 1")
def _(spark, sf):
    return rounded(profile.labels_per_record(labelled(spark, sf), "labels"))


@query("agg29_demographics",
       f"WITH {SECONDARY_SQL}, d AS (SELECT condition, coalesce({gender_sql('PatientGender', 'initial')}, 'unknown') AS gender, {age_sql('PatientAge', 'leading')} AS value FROM secondary) "
       f"SELECT condition, gender, count(*) AS records, count(value) AS n_age, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min, "
       f"round({quant(.25)}, 6) AS q25, round({quant(.5)}, 6) AS median, round({quant(.75)}, 6) AS q75, max(value) AS max FROM d GROUP BY 1, 2")
def _(spark, sf):
    d = secondary_reports(spark, sf).select("condition", tx.parse_age("PatientAge").alias("patient_age"),
                                            tx.normalize_gender("PatientGender").alias("patient_gender"))
    return rounded(profile.demographics(d))


@query("agg33_dataset_overview",
       f"WITH {CLINICAL_SQL} SELECT 'rows' AS metric, count(*)::DOUBLE AS value FROM clinical UNION ALL SELECT 'columns', 12 UNION ALL SELECT 'columns_bigint', 1 "
       "UNION ALL SELECT 'columns_int', 1 UNION ALL SELECT 'columns_string', 10 UNION ALL SELECT 'images', sum(num_images) FROM clinical "
       "UNION ALL SELECT 'images_per_report', round(avg(num_images), 6) FROM clinical")
def _(spark, sf):
    return rounded(profile.dataset_overview(clinical_reports(spark, sf)))


@query("top2_top_terms",
       f"WITH {REPORTS_SQL} SELECT term, count(*) AS n FROM (SELECT unnest({tokens_sql('impression', 'fr')}) AS term FROM reports) GROUP BY 1 ORDER BY n DESC, term LIMIT 25")
def _(spark, sf):
    return profile.top_terms(reports(spark, sf), "impression", "fr", 25)
