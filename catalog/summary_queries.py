"""Summaries and ROUGE."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import REPORTS_SQL, reports, table
from catalog.profile_queries import rounded
from catalog.registry import ORACLE, query
from catalog.text_queries import strip_sql
from reportlens.operators import summaries

_SENTS = f"list_filter(list_transform(string_split({{c}}, '.'), lambda s: {strip_sql('s')}), s -> s <> '')".replace("s -> ", "lambda s: ")


def _extract_sql(k: int) -> str:
    return (f"sent AS (SELECT uid, unnest(range(len(ss)))::INTEGER AS pos, unnest(ss) AS sentence FROM (SELECT uid, {_SENTS.format(c='impression')} AS ss FROM reports)), "
            "tf AS (SELECT uid, pos, term, count(*) AS tf FROM (SELECT uid, pos, unnest(regexp_extract_all(lower(sentence), '[\\p{L}\\p{N}_]{2,}')) AS term FROM sent) GROUP BY ALL), "
            "voc AS (SELECT term, ln((1 + (SELECT count(*) FROM sent)::DOUBLE) / (1 + df)) + 1 AS idf FROM (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1)), "
            "wv AS (SELECT uid, pos, term, w / sqrt(sum(w * w) OVER (PARTITION BY uid, pos)) AS w FROM (SELECT uid, pos, term, tf * idf AS w FROM tf JOIN voc USING (term))), "
            "cent AS (SELECT uid, term, sum(w) AS c FROM wv GROUP BY 1, 2), cn AS (SELECT uid, sqrt(sum(c * c)) AS n FROM cent GROUP BY 1), "
            "sco AS (SELECT wv.uid, pos, round(sum(w * c) / (sqrt(sum(w * w)) * any_value(n)), 9) AS score FROM wv JOIN cent ON wv.uid = cent.uid AND wv.term = cent.term JOIN cn ON cn.uid = wv.uid GROUP BY 1, 2), "
            "rk AS (SELECT sent.uid, sent.pos, sentence, row_number() OVER (PARTITION BY sent.uid ORDER BY coalesce(score, 0) DESC, sent.pos) AS rn FROM sent LEFT JOIN sco ON sent.uid = sco.uid AND sent.pos = sco.pos), "
            f"summ AS (SELECT uid, string_agg(sentence, '. ' ORDER BY pos) || '.' AS summary FROM rk WHERE rn <= {k} GROUP BY 1)")


@query("sum1_extractive_summary",
       f"WITH {REPORTS_SQL}, {_extract_sql(2)} SELECT r.uid, coalesce(summary, '') AS summary FROM reports r LEFT JOIN summ s ON r.uid = s.uid")
def _(spark, sf):
    return summaries.extractive_summary(reports(spark, sf), "uid", "impression", 2)


@query("sum2_lead_n",
       f"WITH {REPORTS_SQL} SELECT uid, array_to_string(list_filter(list_transform(string_split(regexp_replace(impression, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), "
       f"lambda s: {strip_sql('s')}), lambda s: s <> '')[1:2], ' ') AS summary FROM reports")
def _(spark, sf):
    return reports(spark, sf).select("uid", summaries.lead_n("impression", 2).alias("summary"))


@query("win4_top_k_in_record",
       "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) <= 2")
def _(spark, sf):
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.struct("l_linenumber", "l_partkey").alias("pos"))
    return summaries.top_k_in_record(d, "l_orderkey", "l_extendedprice", "pos", 2).drop("pos")


_TURNS = ("turns AS (SELECT u.conv_id, u.turn, u.text AS ref, a.text AS pred FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 "
          "WHERE u.role = 'user' AND a.role = 'assistant')")


def turns(spark, sf):
    c = table(spark, sf, "conversations")
    u = c.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("ref"))
    a = c.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("pred"))
    return u.join(a, ["conv_id", "turn"]).withColumn("pair", F.concat_ws("-", "conv_id", "turn"))


def _rouge_sql(source, key, ref, pred, n) -> str:
    """(key, p, r, f) by clipped n-gram counts."""
    def grams(c):
        t = f"regexp_extract_all(lower({c}), '[a-z0-9]+')"
        return t if n == 1 else f"list_transform(range(1, greatest(len({t}), 1)), lambda i: {t}[i] || ' ' || {t}[i + 1])"
    return (f"g{n} AS (SELECT {key}, g, sum(a) AS a, sum(b) AS b FROM (SELECT {key}, unnest({grams(ref)}) AS g, 1 AS a, 0 AS b FROM {source} UNION ALL "
            f"SELECT {key}, unnest({grams(pred)}), 0, 1 FROM {source}) GROUP BY ALL), "
            f"o{n} AS (SELECT {key}, sum(least(a, b)) AS o, sum(a) AS na, sum(b) AS nb FROM g{n} GROUP BY ALL), "
            f"s{n} AS (SELECT {key}, CASE WHEN nb > 0 THEN o / nb ELSE 0 END AS p, CASE WHEN na > 0 THEN o / na ELSE 0 END AS r, "
            f"CASE WHEN o > 0 THEN 2.0::DOUBLE * o / (na + nb) ELSE 0 END AS f FROM o{n})")


for _n in (1, 2):
    @query(f"sum3_rouge_{_n}",
           f"WITH {_TURNS}, keyed AS (SELECT *, conv_id || '-' || turn AS pair FROM turns), {_rouge_sql('keyed', 'pair', 'ref', 'pred', _n)} SELECT k.pair, "
           f"round(coalesce(p, 0)::DOUBLE, 6) AS rouge{_n}_p, round(coalesce(r, 0)::DOUBLE, 6) AS rouge{_n}_r, round(coalesce(f, 0)::DOUBLE, 6) AS rouge{_n}_f FROM keyed k LEFT JOIN s{_n} s ON k.pair = s.pair")
    def _(spark, sf, n=_n):
        return rounded(summaries.rouge_n(turns(spark, sf), "pair", "ref", "pred", n))


def _lcs_sql(source: str, key: str, ref: str, pred: str) -> str:
    """(key, o, na, nb): the common subsequence by rows of its table, a fold in a fold."""
    step = "CASE WHEN a[i[1]] = b[j[1]] THEN r[j[1]] + 1 ELSE greatest(c[j[1]], r[j[1] + 1]) END::INTEGER"
    inner = f"list_reduce(list_prepend([0]::INTEGER[], list_transform(range(1, len(b) + 1), lambda j: [j::INTEGER])), lambda c, j: list_append(c, {step}))"
    rows = f"list_reduce(list_prepend(list_transform(range(len(b) + 1), lambda x: 0::INTEGER), list_transform(range(1, len(a) + 1), lambda i: [i::INTEGER])), lambda r, i: {inner})"
    return (f"lt AS (SELECT {key}, regexp_extract_all(lower({ref}), '[a-z0-9]+') AS a, regexp_extract_all(lower({pred}), '[a-z0-9]+') AS b FROM {source}), "
            f"lc AS (SELECT {key}, len(a) AS na, len(b) AS nb, ({rows})[-1] AS o FROM lt)")


_RL = {"p": "CASE WHEN nb > 0 THEN o / nb ELSE 0 END", "r": "CASE WHEN na > 0 THEN o / na ELSE 0 END", "f": "CASE WHEN o > 0 THEN 2.0::DOUBLE * o / (na + nb) ELSE 0 END"}


@query("sum4_rouge_l",
       f"WITH {_TURNS}, keyed AS (SELECT *, conv_id || '-' || turn AS pair FROM turns), {_lcs_sql('keyed', 'pair', 'ref', 'pred')} SELECT pair, "
       + ", ".join(f"round(({e})::DOUBLE, 6) AS rougeL_{m}" for m, e in _RL.items()) + " FROM lc")
def _(spark, sf):
    return rounded(summaries.rouge_l(turns(spark, sf), "pair", "ref", "pred"))


def _lead(n):
    return lambda df, key, text: df.select(key, summaries.lead_n(text, n, "dot").alias("summary"))


_LEADS = " UNION ALL ".join(f"SELECT 'lead_{n}' AS model, uid, findings AS ref, array_to_string({_SENTS.format(c='impression')}[1:{n}], ' ') AS pred FROM reports WHERE findings <> '' AND impression <> ''" for n in (1, 2))


@query("sum5_evaluate_summaries",
       f"WITH {REPORTS_SQL}, pr AS ({_LEADS}), {_rouge_sql('pr', 'model, uid', 'ref', 'pred', 1)}, {_rouge_sql('pr', 'model, uid', 'ref', 'pred', 2)} "
       "SELECT pr.model, count(*) AS pairs, " + ", ".join(f"round(avg(coalesce(s{n}.{m}, 0))::DOUBLE, 6) AS rouge{n}_{m}" for n in (1, 2) for m in "prf")
       + " FROM pr LEFT JOIN s1 ON s1.model = pr.model AND s1.uid = pr.uid LEFT JOIN s2 ON s2.model = pr.model AND s2.uid = pr.uid GROUP BY 1")
def _(spark, sf):
    s = summaries.evaluate_summaries(reports(spark, sf), "uid", "impression", "findings", {"lead_1": _lead(1), "lead_2": _lead(2)})
    return rounded(s.drop("rougeL_p", "rougeL_r", "rougeL_f"))


@query("sum5_side_by_side",
       f"WITH {REPORTS_SQL}, s AS (SELECT * FROM reports WHERE findings <> '' AND impression <> '' ORDER BY md5('42:' || uid), uid LIMIT 3) " + " UNION ALL ".join(
           f"SELECT 'lead_{n}' AS model, uid, findings AS reference, array_to_string({_SENTS.format(c='impression')}[1:{n}], ' ') AS prediction FROM s" for n in (1, 2)))
def _(spark, sf):
    p = summaries.predictions(reports(spark, sf), "uid", "impression", "findings", {"lead_1": _lead(1), "lead_2": _lead(2)}, n=3)
    return p.select("model", "uid", "reference", "prediction")


_FIRST = "SELECT 'first_words' AS model, uid, findings AS ref, array_to_string(regexp_extract_all(impression, '\\S+')[1:20], ' ') AS pred FROM reports WHERE findings <> '' AND impression <> ''"


@query("udf2_user_summariser", ORACLE["sum5_evaluate_summaries"].replace(_LEADS, _FIRST))
def _(spark, sf):
    first_words = summaries.as_summariser(lambda t: " ".join(t.split()[:20]))
    s = summaries.evaluate_summaries(reports(spark, sf), "uid", "impression", "findings", {"first_words": first_words})
    return rounded(s.drop("rougeL_p", "rougeL_r", "rougeL_f"))
