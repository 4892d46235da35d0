"""Scalar text expressions (cleaning, parsing, counting, lexicon matching)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (CLINICAL_SQL, REPORTS_SQL, SECONDARY_SQL, clinical_reports, reports, sc,
                            secondary_reports, table, wc)
from catalog.registry import query
from reportlens.functions import lexicons as lx, text as tx
from reportlens.session import spread

# Short lists of strings that really occur in the driver texts.
TERMS = ["the", "of", "tion", "le", "que", "und"]
WEIGHTS = {"tion": 3, "que": 2, "the": 1, "sch": 4}
CATEGORIES = {"T": ["tion", "ation"], "Q": ["que", "sch"], "N": ["the"], "Z": ["zzz"]}


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def has(col: str, term: str) -> str:
    return f"contains({col}, {quote(term)})"


def any_sql(col: str, terms) -> str:
    return "(" + " OR ".join(has(col, t) for t in terms) + ")"


def hits_sql(col: str, terms) -> str:
    return "(" + " + ".join(f"CAST({has(col, t)} AS INTEGER)" for t in terms) + ")"


def occ_sql(col: str, terms) -> str:
    return "(" + " + ".join(
        f"CAST((length({col}) - length(replace({col}, {quote(t)}, ''))) // {len(t)} AS INTEGER)" for t in terms) + ")"


def wmax_sql(col: str, weights) -> str:
    return "greatest(0, " + ", ".join(f"CASE WHEN {has(col, t)} THEN {w} ELSE 0 END" for t, w in weights.items()) + ")"


def wsum_sql(col: str, weights) -> str:
    return "(" + " + ".join(f"CASE WHEN {has(col, t)} THEN {w} ELSE 0 END" for t, w in weights.items()) + ")"


def first_cat_sql(col: str, cats, default="Other") -> str:
    arms = " ".join(f"WHEN {any_sql(col, k)} THEN {quote(n)}" for n, k in cats.items())
    return f"CASE {arms} ELSE '{default}' END"


def cat_count_sql(col: str, cats) -> str:
    return "(" + " + ".join(f"CAST({any_sql(col, k)} AS INTEGER)" for k in cats.values()) + ")"


def all_cats_sql(col: str, cats, default="Other") -> str:
    parts = ", ".join(f"CASE WHEN {any_sql(col, k)} THEN {quote(n)} END" for n, k in cats.items())
    return f"coalesce(nullif(concat_ws('|', {parts}), ''), '{default}')"


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def squeeze_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def norm_en_sql(c: str) -> str:
    t = squeeze_sql(f"regexp_replace(coalesce({c}, ''), '<[^>]+>', '', 'g')")
    return f"replace(regexp_replace({t}, 'x-xxxx', 'x-ray', 'gi'), 'XXXX', '[REDACTED]')"


def norm_strict_sql(c: str) -> str:
    t = f"regexp_replace(lower(coalesce({c}, '')), '<[^>]+>', '', 'g')"
    # The placeholders of the inputs stand between ASCII characters.
    t = f"regexp_replace({t}, '\\bx-xxxx\\b', 'x-ray', 'g')"
    t = f"regexp_replace({t}, '\\bxxxx\\b', '[REDACTED]', 'g')"
    t = squeeze_sql(f"regexp_replace({t}, '\\.{{2,}}', '.', 'g')")
    return f"regexp_replace({t}, '^[\\s,;:.]+|[\\s,;:.]+$', '', 'g')"


def norm_fr_sql(c: str) -> str:
    t = f"regexp_replace(coalesce({c}, ''), '\\s+', ' ', 'g')"
    t = f"regexp_replace({t}, '\\.+', '.', 'g')"
    return f"lower(trim(replace(translate({t}, '’`', ''''''), '/', '. ')))"


def norm_fr_lines_sql(c: str) -> str:
    lines = f"string_split(replace(coalesce({c}, ''), './', '.' || chr(10)), chr(10))"
    lines = f"list_transform({lines}, lambda s: {strip_sql('regexp_replace(s, ' + quote('[ ' + chr(9) + ']+') + ', ' + quote(' ') + ', ' + quote('g') + ')')})"
    t = f"array_to_string(list_filter({lines}, lambda s: s <> ''), chr(10))"
    t = f"regexp_replace({t}, '\\.{{2,}}', '.', 'g')"
    return f"regexp_replace({t}, '^[\\s,;:.]+|[\\s,;:.]+$', '', 'g')"


def tokens_sql(c: str, lang: str, stop=None) -> str:
    if lang == "raw":
        return f"regexp_extract_all(lower(coalesce({c}, '')), '\\S+')"
    letters = "a-z" if lang == "en" else "a-zA-ZÀ-ÿ"
    stop = lx.stop_words(lang) if stop is None else stop
    inside = ", ".join(quote(s) for s in stop)
    return f"list_filter(regexp_extract_all(lower(coalesce({c}, '')), '[{letters}]{{3,}}'), lambda w: w NOT IN ({inside}))"


def age_sql(c: str, mode: str) -> str:
    pattern = "(\\d+)" if mode == "any" else "^\\s*(\\d+)"
    age = f"TRY_CAST(regexp_extract(coalesce({c}, ''), '{pattern}', 1) AS DOUBLE)"
    return f"CASE WHEN {age} <= 120 THEN {age} END" if mode == "bounded" else age


def gender_sql(c: str, mode: str) -> str:
    g, ok = (f"upper(substr({c}, 1, 1))", "('M','F')") if mode == "initial" else (strip_sql(c), "('M','F','O')")
    return f"CASE WHEN {g} IN {ok} THEN {g} END"


def none_sql(c: str) -> str:
    s = strip_sql(f"coalesce({c}, '')")
    return f"CASE WHEN lower({s}) = 'none' THEN '' ELSE {s} END"


def _reports(name: str, spark_cols, sql_cols: dict):
    """Register a query over the plain report rows: uid plus some columns."""
    items = ", ".join(f"{e} AS {n}" for n, e in sql_cols.items())

    @query(name, f"WITH {REPORTS_SQL} SELECT uid, {items} FROM reports")
    def _(spark, sf):
        cols = spark_cols()
        d = reports(spark, sf).withColumns({"low_f": tx.lowered("findings"), "low_i": tx.lowered("impression")})
        return d.select("uid", *[cols[n].alias(n) for n in sql_cols])


def _clinical(name: str, spark_cols, sql_cols: dict):
    items = ", ".join(f"{e} AS {n}" for n, e in sql_cols.items())

    @query(name, f"WITH {CLINICAL_SQL} SELECT uid, {items} FROM clinical")
    def _(spark, sf):
        cols = spark_cols()
        return clinical_reports(spark, sf).withColumn("low_m", tx.lowered("mesh_major")).select("uid", *[cols[n].alias(n) for n in sql_cols])


def _secondary(name: str, spark_cols, sql_cols: dict):
    items = ", ".join(f"{e} AS {n}" for n, e in sql_cols.items())

    @query(name, f"WITH {SECONDARY_SQL} SELECT seq, {items} FROM secondary")
    def _(spark, sf):
        cols = spark_cols()
        return secondary_reports(spark, sf).select("seq", *[cols[n].alias(n) for n in sql_cols])


_reports("txt_a_word_count", lambda: {"findings_words": tx.word_count("findings"), "impression_words": tx.word_count("impression")},
         {"findings_words": wc("findings"), "impression_words": wc("impression")})
_reports("txt_b_char_count", lambda: {"findings_chars": tx.char_count("findings"), "impression_chars": tx.char_count("impression"),
                                      "total_words": tx.word_count("findings") + tx.word_count("impression")},
         {"findings_chars": "CAST(length(findings) AS INTEGER)", "impression_chars": "CAST(length(impression) AS INTEGER)",
          "total_words": f"{wc('findings')} + {wc('impression')}"})
_reports("txt_c_sentence_count", lambda: {"en": tx.sentence_count("impression"), "fr": tx.sentence_count("impression", "fr")},
         {"en": sc("impression"), "fr": sc("impression", "[.!?]")})
_reports("txt_d_avg_sentence_len",
         lambda: {"avg_len": F.round(tx.avg_sentence_len(tx.word_count("findings"), tx.sentence_count("findings")), 6)},
         {"avg_len": f"round({wc('findings')} / greatest({sc('findings')}, 1), 6)"})
_reports("txt_e_combine_text", lambda: {"plain": F.md5(tx.combine_text("findings", "impression")),
                                        "stripped": F.md5(tx.combine_text("findings", "impression", True))},
         {"plain": "md5(findings || ' ' || impression)", "stripped": f"md5({strip_sql(chr(40) + 'findings || ' + quote(' ') + ' || impression)')})"})
_clinical("txt_f_normalize_en", lambda: {"clean": tx.normalize_en("findings"), "impression_md5": F.md5(tx.normalize_en("impression"))},
          {"clean": norm_en_sql("findings"), "impression_md5": f"md5({norm_en_sql('impression')})"})


@query("txt_f_normalize_en_html", f"SELECT page_id, md5({norm_en_sql('html')}) AS clean FROM pages")
def _(spark, sf):
    return spread(table(spark, sf, "pages")).select("page_id", F.md5(tx.normalize_en("html")).alias("clean"))


_clinical("txt_g_normalize_en_strict", lambda: {"clean": tx.normalize_en_strict("findings")}, {"clean": norm_strict_sql("findings")})
_secondary("txt_h_normalize_fr", lambda: {"clean": tx.normalize_fr("Findings")}, {"clean": norm_fr_sql("Findings")})
_secondary("txt_i_normalize_fr_lines", lambda: {"clean": tx.normalize_fr_lines("Findings"), "impression_md5": F.md5(tx.normalize_fr_lines("Impression"))},
           {"clean": norm_fr_lines_sql("Findings"), "impression_md5": f"md5({norm_fr_lines_sql('Impression')})"})
_secondary("txt_j_parse_age", lambda: {m + "_age": tx.parse_age("PatientAge", m) for m in ("any", "leading", "bounded")},
           {m + "_age": age_sql("PatientAge", m) for m in ("any", "leading", "bounded")})
_secondary("txt_k_normalize_gender", lambda: {"initial_g": tx.normalize_gender("PatientGender"), "exact_g": tx.normalize_gender("PatientGender", "exact")},
           {"initial_g": gender_sql("PatientGender", "initial"), "exact_g": gender_sql("PatientGender", "exact")})
_secondary("txt_l_none_to_empty", lambda: {"comparison": tx.none_to_empty("Comparison")}, {"comparison": none_sql("Comparison")})
_reports("txt_m_tokens", lambda: {"en": F.md5(F.array_join(tx.tokens("impression", "en"), " ")),
                                  "fr": F.md5(F.array_join(tx.tokens("impression", "fr"), " ")),
                                  "fr_profile": F.size(tx.tokens("impression", "fr_profile"))},
         {"en": f"md5(array_to_string({tokens_sql('impression', 'en')}, ' '))",
          "fr": f"md5(array_to_string({tokens_sql('impression', 'fr')}, ' '))",
          "fr_profile": f"CAST(len({tokens_sql('impression', 'fr_profile')}) AS INTEGER)"})
_reports("txt_n_raw_tokens", lambda: {"raw": F.md5(F.array_join(tx.tokens("impression", "raw"), " "))},
         {"raw": f"md5(array_to_string({tokens_sql('impression', 'raw')}, ' '))"})
_clinical("txt_o_has_placeholder", lambda: {"flag": tx.has_placeholder("findings") | tx.has_placeholder("impression")},
          {"flag": "contains(upper(findings), 'XXXX') OR contains(upper(impression), 'XXXX')"})
_LOW = "lower(impression)"
_reports("txt_p_term_hits", lambda: {"hits": tx.term_hits("low_i", TERMS)}, {"hits": hits_sql(_LOW, TERMS)})
_reports("txt_q_term_occurrences", lambda: {"n": tx.term_occurrences("low_i", TERMS)}, {"n": occ_sql(_LOW, TERMS)})
_reports("txt_r_has_any", lambda: {"flag": tx.has_any("low_i", ["sch", "ations"])}, {"flag": any_sql(_LOW, ["sch", "ations"])})
_reports("txt_s_term_weights", lambda: {"w_max": tx.term_weight_max("low_i", WEIGHTS),
                                        "w_sum": tx.term_weight_sum("low_i", WEIGHTS)},
         {"w_max": wmax_sql(_LOW, WEIGHTS), "w_sum": wsum_sql(_LOW, WEIGHTS)})
_reports("txt_t_first_category", lambda: {"category": tx.first_category("low_f", CATEGORIES)},
         {"category": first_cat_sql("lower(findings)", CATEGORIES)})
_reports("txt_u_category_count", lambda: {"n": tx.category_count("low_f", CATEGORIES)},
         {"n": cat_count_sql("lower(findings)", CATEGORIES)})
_clinical("txt_v_all_categories", lambda: {"labels": tx.join_labels(tx.all_categories("low_m", lx.EN_LABEL_CATEGORIES))},
          {"labels": all_cats_sql("lower(mesh_major)", lx.EN_LABEL_CATEGORIES)})
_clinical("txt_x_is_normal", lambda: {"flag": tx.is_normal("mesh_major")},
          {"flag": "contains(lower(mesh_major), 'normal') AND NOT contains(mesh_major, '|')"})
_clinical("txt_y_bucket_classes",
          lambda: {"bucket": tx.bucket_classes(tx.first_category("low_m", lx.EN_CATEGORIES), lx.MAIN_CLASSES)},
          {"bucket": f"CASE WHEN {first_cat_sql('lower(mesh_major)', lx.EN_CATEGORIES)} IN ({', '.join(quote(c) for c in lx.MAIN_CLASSES)}) "
                     f"THEN {first_cat_sql('lower(mesh_major)', lx.EN_CATEGORIES)} ELSE 'Other' END"})
_DOT = f"list_filter(list_transform(string_split(impression, '.'), lambda s: {strip_sql('s')}), lambda s: s <> '')"
_reports("txt_z_sentences", lambda: {"n": F.size(tx.sentences("impression")), "joined": F.md5(F.array_join(tx.sentences("impression"), "|"))},
         {"n": f"CAST(len({_DOT}) AS INTEGER)", "joined": f"md5(array_to_string({_DOT}, '|'))"})
# A mark followed by white space is turned into mark + separator, which is the
# look-behind split written without look-behind.
_PUNCT = (f"list_filter(list_transform(string_split(regexp_replace(impression, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), "
          f"lambda s: {strip_sql('s')}), lambda s: s <> '')")
_reports("txt_z_sentences_punct", lambda: {"n": F.size(tx.sentences("impression", "punct")),
                                           "joined": F.md5(F.array_join(tx.sentences("impression", "punct"), "|"))},
         {"n": f"CAST(len({_PUNCT}) AS INTEGER)", "joined": f"md5(array_to_string({_PUNCT}, '|'))"})


@query("txt_aa_clip", "SELECT l_orderkey, l_linenumber, l_partkey, least(greatest(l_quantity, 5.0::DOUBLE), 40.0::DOUBLE) AS q FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", tx.clip("l_quantity", 5.0, 40.0).alias("q"))


@query("txt_w_label_flags",
       f"WITH {CLINICAL_SQL} SELECT uid, " + ", ".join(
           f"CAST(list_contains(string_split({all_cats_sql('lower(mesh_major)', lx.EN_LABEL_CATEGORIES)}, '|'), {quote(c)}) AS INTEGER) "
           f'AS "has_{c}"' for c in lx.MAIN_LABELS) + " FROM clinical")
def _(spark, sf):
    from reportlens.operators.rows import label_flags
    df = clinical_reports(spark, sf).withColumn("low_m", tx.lowered("mesh_major")).select(
        "uid", tx.all_categories("low_m", lx.EN_LABEL_CATEGORIES).alias("labels"))
    return label_flags(df, "labels", lx.MAIN_LABELS).drop("labels")
