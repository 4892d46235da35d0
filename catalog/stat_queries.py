"""Splits, tests, evaluation tables, class weights, survival."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import REPORTS_SQL, reports, table, wc
from catalog.profile_queries import LENGTHS_SQL, _SKEW, lengths, melted, rounded
from catalog.registry import query
from reportlens.functions import text as tx
from reportlens.operators import evaluate, models, ordered, splits, stats, survival

_L = f"WITH {LENGTHS_SQL}"


def unit_sql(key: str, seed: int = 42) -> str:
    """The draw of functions/draws.py."""
    return f"((('0x' || md5('{seed}:' || {key})[1:13])::BIGINT + 0.5::DOUBLE) / 4503599627370496)"


@query("spl1_random_split",
       f"SELECT doc_id, CASE WHEN u < 0.7::DOUBLE THEN 0 WHEN u < 0.7::DOUBLE + 0.15::DOUBLE THEN 1 ELSE 2 END::INTEGER AS split FROM (SELECT doc_id, {unit_sql('doc_id')} AS u FROM documents)")
def _(spark, sf):
    return splits.split(table(spark, sf, "documents").select("doc_id"), [0.7, 0.15, 0.15], 42, "doc_id")


_DRIFT = ["findings_words", "impression_words"]


@query("spl2_split_drift",
       f"{_L}, t AS (SELECT *, uid % 3 > 0 AS side, CAST(condition = 'en' AS INTEGER) AS is_en FROM lens) " + " UNION ALL ".join(
           [f"SELECT '{k}' AS kind, '{m}' AS metric, round(a, 6) AS first, round(b, 6) AS second, round({d}, 6) AS diff FROM (SELECT {f.format(w='side')} AS a, {f.format(w='NOT side')} AS b FROM t)"
            for k, m, f, d in [(kind, c, f"{fn}({c}) FILTER (WHERE {{w}})", dd) for c in _DRIFT
                               for kind, fn, dd in (("mean", "avg", "abs(a-b)/a*100"), ("std", "stddev_samp", "abs(a-b)"))]
            + [("share", "is_en", "avg(is_en * 100.0::DOUBLE) FILTER (WHERE {w})", "abs(a-b)")]
            + [("completeness", c, f"avg(CASE WHEN {c} <> '' THEN 100.0::DOUBLE ELSE 0 END) FILTER (WHERE {{w}})", "abs(a-b)") for c in ("findings", "impression")]]))
def _(spark, sf):
    d = lengths(spark, sf).withColumns({"side": F.col("uid") % 3 > 0, "is_en": (F.col("condition") == "en").cast("int")})
    return rounded(splits.split_drift(d, "side", _DRIFT, ["is_en"], ["findings", "impression"]))


# Fold sizes follow from the class sizes; which row goes where is the hash's choice.
@query("spl3_stratified_folds",
       "SELECT lang, CAST(fold AS INTEGER) AS fold, CAST((n - fold + 4) // 5 AS BIGINT) AS n FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1), range(5) t(fold)")
def _(spark, sf):
    d = splits.assign_folds(table(spark, sf, "documents").select("doc_id", "lang"), "lang", 5, 42, "doc_id")
    return d.groupBy("lang", "fold").agg(F.count(F.lit(1)).alias("n"))


_KS = """WITH v AS (SELECT l_extendedprice AS value, count(*) FILTER (WHERE l_returnflag = 'R') AS a, count(*) FILTER (WHERE l_returnflag <> 'R') AS b FROM lineitem GROUP BY 1),
 c AS (SELECT sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER () AS ta, sum(b) OVER () AS tb FROM v WINDOW w AS (ORDER BY value)),
 s AS (SELECT CAST(max(ta) AS BIGINT) AS n1, CAST(max(tb) AS BIGINT) AS n2, max(abs(ca::DOUBLE / ta - cb::DOUBLE / tb)) AS st FROM c),
 l AS (SELECT *, st * sqrt(n1::DOUBLE * n2 / (n1 + n2)) AS lam FROM s)
 SELECT 'l_extendedprice' AS metric, n1, n2, round(st, 6) AS statistic, round(CASE WHEN lam < 0.2 THEN 1 ELSE
 least(greatest(list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END * exp(-2.0::DOUBLE * k * k * lam * lam))), 0), 1) END::DOUBLE, 6) AS p_value FROM l"""


def _ks_sql(source: str, metric: str, side: str) -> str:
    return (_KS.replace("FROM lineitem", f"FROM {source}").replace("l_extendedprice", metric).replace("l_returnflag = 'R'", side)
            .replace("l_returnflag <> 'R'", f"NOT ({side})"))


_MATCH = f"WITH {LENGTHS_SQL} " + " UNION ALL ".join(
    f"SELECT *, p_value > 0.05 AS match FROM ({_ks_sql('lens', m, 'uid % 3 > 0')})" for m in _DRIFT)


@query("spl2_split_match", _MATCH)
def _(spark, sf):
    d = lengths(spark, sf).withColumn("side", F.col("uid") % 3 > 0)
    return rounded(splits.split_match(d, "side", _DRIFT))


@query("tst1_ks_two_sample", _KS)
def _(spark, sf):
    return rounded(stats.ks_two_sample(table(spark, sf, "lineitem"), ["l_extendedprice"], F.col("l_returnflag") == "R"))


def normal_sql(z: str) -> str:
    """Standard normal distribution function: 1/2 + density * (z + z^3/3 + z^5/15 + ...)."""
    series = (f"list_reduce(list_prepend([{z}, {z}]::DOUBLE[], list_transform(range(1, 200), lambda n: [2 * n + 1]::DOUBLE[])), "
              f"lambda s, n: [s[1] * {z} * {z} / n[1], s[2] + s[1] * {z} * {z} / n[1]])[2]")
    return f"(0.5::DOUBLE + exp(-{z} * {z} / 2) / sqrt(2 * pi()) * {series})"


@query("tst2_ks_normal",
       "WITH v AS (SELECT l_extendedprice::DOUBLE AS x, count(*) AS n FROM lineitem WHERE l_extendedprice > 0 GROUP BY 1), "
       "m AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s, count(*)::DOUBLE AS t FROM lineitem WHERE l_extendedprice > 0), "
       "c AS (SELECT (x - m) / s AS z, sum(n) OVER (ORDER BY x) / t AS hi, (sum(n) OVER (ORDER BY x) - n) / t AS lo, t FROM v, m), "
       f"d AS (SELECT max(greatest(hi - f, f - lo)) AS d, any_value(t) AS t FROM (SELECT *, {normal_sql('z')} AS f FROM c)) "
       "SELECT round(d, 6) AS statistic, round(2 * list_sum(list_transform(range(1, 101), lambda k: (-1)::DOUBLE ** (k - 1) * exp(-2 * k * k * d * d * t))), 6) AS \"pValue\" FROM d")
def _(spark, sf):
    d = stats.ks_normal(table(spark, sf, "lineitem"), "l_extendedprice")
    return d.select(F.round("statistic", 6).alias("statistic"), F.round("pValue", 6).alias("pValue"))


_NORM = ["findings_words", "impression_words"]
_SK = _SKEW.replace(", 4) AS", ", 12) AS")


@query("tst3_normality",
       f"{_L}, {melted(_NORM)}, m AS (SELECT metric, count(*) AS n, {_SK} FROM melted GROUP BY 1), "
       "j AS (SELECT metric, n, n / 6 * (skewness * skewness + kurtosis * kurtosis / 4) AS jb FROM m) "
       "SELECT metric, n, round(jb, 3) AS jarque_bera, round(exp(-jb / 2), 6) AS p_value, exp(-jb / 2) > 0.05 AS is_normal FROM j")
def _(spark, sf):
    d = stats.normality(lengths(spark, sf), _NORM)
    return d.select("metric", "n", F.round("jarque_bera", 3).alias("jarque_bera"), F.round("p_value", 6).alias("p_value"), "is_normal")


@query("tst4_mann_whitney",
       "WITH v AS (SELECT value, count(*) FILTER (WHERE event_type = 'click') AS a, count(*)::DOUBLE AS n FROM events GROUP BY 1), "
       "r AS (SELECT a, n, sum(n) OVER (ORDER BY value) - n + (n + 1) / 2 AS mid FROM v), "
       "t AS (SELECT sum(a)::DOUBLE AS n1, sum(n) - sum(a) AS n2, sum(a * mid) AS rs, sum(n*n*n - n) AS ties FROM r) "
       "SELECT 'value' AS metric, n1::BIGINT AS n1, n2::BIGINT AS n2, rs - n1 * (n1 + 1) / 2 AS u, round((rs - n1 * (n1 + 1) / 2 - n1 * n2 / 2) / "
       "sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))), 6) AS z FROM t")
def _(spark, sf):
    return rounded(stats.mann_whitney(table(spark, sf, "events"), ["value"], F.col("event_type") == "click").drop("p_value"))


def _whitney_sql(metric: str) -> str:
    return (f"SELECT '{metric}' AS metric, n1::BIGINT AS n1, n2::BIGINT AS n2, u, round(z, 6) AS z, round(2 * (1 - {normal_sql('abs(z)')}), 6) AS p_value FROM ("
            "SELECT *, (u - n1 * n2 / 2) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM ("
            "SELECT n1, n2, ties, rs - n1 * (n1 + 1) / 2 AS u FROM (SELECT sum(a)::DOUBLE AS n1, sum(n) - sum(a) AS n2, sum(a * mid) AS rs, sum(n*n*n - n) AS ties FROM ("
            "SELECT a, n, sum(n) OVER (ORDER BY value) - n + (n + 1) / 2 AS mid FROM ("
            f"SELECT {metric} AS value, count(*) FILTER (WHERE l_returnflag = 'R') AS a, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1)))))")


@query("tst4_mann_whitney_p", " UNION ALL ".join(map(_whitney_sql, ("l_quantity", "l_extendedprice"))))
def _(spark, sf):
    return rounded(stats.mann_whitney(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], F.col("l_returnflag") == "R"))


# ------------------------------------------------------------- evaluation

_PRED = "pred AS (SELECT doc_id, quality AS label, toxic AS prediction, n_chars::DOUBLE AS score FROM documents JOIN labels USING (doc_id))"


def predictions(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    return d.select("doc_id", F.col("quality").alias("label"), F.col("toxic").alias("prediction"), F.col("n_chars").cast("double").alias("score"))


@query("ev3_auc",
       f"WITH {_PRED}, v AS (SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS q FROM pred GROUP BY 1) "
       "SELECT round(sum(p * (below + q / 2)) / (sum(p)::DOUBLE * sum(q)), 6) AS auc FROM (SELECT p, q, sum(q) OVER (ORDER BY score) - q AS below FROM v)")
def _(spark, sf):
    return rounded(evaluate.auc(predictions(spark, sf)))


_REPORT = ("rep AS (SELECT c AS class, count(*) FILTER (WHERE label = c AND prediction = c) AS tp, count(*) FILTER (WHERE label = c) AS support, "
           "count(*) FILTER (WHERE prediction = c) AS predicted FROM pred, (VALUES (0), (1)) k(c) GROUP BY 1)")
_F1 = "CASE WHEN support + predicted > 0 THEN 2.0::DOUBLE * tp / (support + predicted) ELSE 0 END"


@query("ev4_classification_scores",
       f"WITH {_PRED}, {_REPORT} SELECT round(max(CASE WHEN class = 1 THEN {_F1} END), 6) AS f1, round(avg({_F1}), 6) AS macro_f1, "
       "round(sum(tp) / sum(support), 6) AS accuracy FROM rep")
def _(spark, sf):
    return rounded(evaluate.classification_scores(predictions(spark, sf)))


@query("ev5_confusion_matrix",
       f"WITH {_PRED} SELECT label, count(*) FILTER (WHERE prediction = 0) AS pred_0, count(*) FILTER (WHERE prediction = 1) AS pred_1 FROM pred GROUP BY 1")
def _(spark, sf):
    return evaluate.confusion_matrix(predictions(spark, sf), [0, 1])


@query("ev6_classification_report",
       f"WITH {_PRED}, {_REPORT} SELECT class, round(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END, 6) AS precision, "
       f"round(CASE WHEN support > 0 THEN tp / support ELSE 0 END, 6) AS recall, round({_F1}, 6) AS f1, support FROM rep")
def _(spark, sf):
    return rounded(evaluate.classification_report(predictions(spark, sf)))


@query("ev7_roc_curve",
       f"WITH {_PRED}, v AS (SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS q FROM pred GROUP BY 1) "
       "SELECT score AS threshold, round((sum(q) OVER w)::DOUBLE / sum(q) OVER (), 6) AS fpr, round((sum(p) OVER w)::DOUBLE / sum(p) OVER (), 6) AS tpr FROM v WINDOW w AS (ORDER BY score DESC)")
def _(spark, sf):
    return rounded(evaluate.roc_curve(predictions(spark, sf)))


@query("ev8_leaderboard",
       "WITH m AS (SELECT source AS model, lang AS dataset, unnest(['auc', 'f1', 'macro_f1']) AS metric, unnest([avg(n_chars) / 5000, count(*) / 50, stddev_samp(n_chars) / 3000]) AS value "
       "FROM documents GROUP BY 1, 2), b AS (SELECT dataset, metric, max(value) AS value FROM m GROUP BY 1, 2) "
       "SELECT m.dataset, m.metric, max(m.model) AS model, round(any_value(m.value), 6) AS value, CASE m.metric WHEN 'auc' THEN any_value(m.value) > 0.8 WHEN 'f1' THEN any_value(m.value) > 0.78 END AS meets_target "
       "FROM m JOIN b ON m.dataset = b.dataset AND m.metric = b.metric AND m.value = b.value GROUP BY 1, 2")
def _(spark, sf):
    m = table(spark, sf, "documents").groupBy(F.col("source").alias("model"), F.col("lang").alias("dataset")).agg(
        (F.avg("n_chars") / 5000).alias("auc"), (F.count(F.lit(1)) / 50).alias("f1"), (F.stddev_samp("n_chars") / 3000).alias("macro_f1"))
    return rounded(evaluate.leaderboard(m.unpivot(["model", "dataset"], ["auc", "f1", "macro_f1"], "metric", "value").filter("value IS NOT NULL")))


_WEIGHT = "SELECT doc_id, lang, round((SELECT count(*) FROM documents) / ((SELECT count(DISTINCT lang) FROM documents) * count(*) OVER (PARTITION BY lang)), 6) AS class_weight FROM documents"


@query("jn5_class_weight_join", _WEIGHT)
def _(spark, sf):
    return rounded(models.with_class_weight(table(spark, sf, "documents").select("doc_id", "lang"), "lang"))


@query("ml2_class_weights",
       "SELECT doc_id, quality, round(CASE WHEN quality = 1 THEN (SELECT count(*) FILTER (WHERE quality = 0) / count(*) FILTER (WHERE quality = 1) FROM labels) ELSE 1 END::DOUBLE, 6) AS class_weight FROM labels")
def _(spark, sf):
    return rounded(models.with_class_weight(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "positive"))


@query("ml7_index_labels", "SELECT doc_id, lang, (dense_rank() OVER (ORDER BY lang) - 1)::DOUBLE AS label FROM documents")
def _(spark, sf):
    return models.index_labels(table(spark, sf, "documents").select("doc_id", "lang"), "lang")[0]


# --------------------------------------------------------------- survival

_SURV = "surv AS (SELECT l_quantity AS t, CAST(l_returnflag = 'R' AS INTEGER) AS e, round(l_extendedprice / 1000) AS r, l_linestatus AS g FROM lineitem)"


def survival_rows(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("t"), (F.col("l_returnflag") == "R").cast("int").alias("e"),
        F.round(F.col("l_extendedprice") / 1000).alias("r"), F.col("l_linestatus").alias("g"), "l_discount", "l_tax", "l_extendedprice")


@query("sv3_cox_risk", "SELECT l_orderkey, l_linenumber, l_partkey, round(exp(0.8::DOUBLE * (l_discount - 0.05::DOUBLE) - 1.5::DOUBLE * l_tax), 6) AS risk FROM lineitem")
def _(spark, sf):
    d = survival.cox_risk(table(spark, sf, "lineitem"), {"l_discount": 0.8, "l_tax": -1.5}, {"l_discount": 0.05})
    return d.select("l_orderkey", "l_linenumber", "l_partkey", F.round("risk", 6).alias("risk"))


@query("sv4_concordance",
       f"WITH {_SURV}, c AS (SELECT t, e, r, count(*)::DOUBLE AS n FROM surv GROUP BY 1, 2, 3), p AS (SELECT "
       "coalesce(sum(a.n * b.n) FILTER (WHERE a.r > b.r), 0) AS concordant, coalesce(sum(a.n * b.n) FILTER (WHERE a.r < b.r), 0) AS discordant, "
       "coalesce(sum(a.n * b.n) FILTER (WHERE a.r = b.r), 0) AS tied FROM c a JOIN c b ON a.e = 1 AND (b.t > a.t OR (b.t = a.t AND b.e = 0))) "
       "SELECT concordant, discordant, tied, round((concordant + tied / 2) / (concordant + discordant + tied), 6) AS c_index FROM p")
def _(spark, sf):
    return rounded(survival.concordance(survival_rows(spark, sf), "t", "e", "r"))


@query("sv5_kaplan_meier",
       f"WITH {_SURV}, c AS (SELECT g, t, sum(e) AS deaths, count(*) AS exits FROM surv GROUP BY 1, 2), "
       "r AS (SELECT g, t, deaths, sum(exits) OVER (PARTITION BY g ORDER BY t DESC) AS at_risk FROM c) "
       "SELECT g, t AS time, at_risk::BIGINT AS at_risk, deaths::BIGINT AS deaths, round(product(1 - deaths / at_risk) OVER (PARTITION BY g ORDER BY t), 6) AS survival FROM r")
def _(spark, sf):
    return rounded(survival.kaplan_meier(survival_rows(spark, sf), "t", "e", "g"))


_RISK = "exp(4.0::DOUBLE * l_discount - 3.0::DOUBLE * l_tax)"


@query("sv5_risk_group_curves",
       f"WITH r AS (SELECT l_quantity::DOUBLE AS t, (l_returnflag = 'R')::INT AS e, {_RISK} AS r FROM lineitem), "
       "q AS (SELECT quantile_cont(r, 0.25) AS a, quantile_cont(r, 0.5) AS b, quantile_cont(r, 0.75) AS c FROM r), "
       "g AS (SELECT CASE WHEN r <= a THEN 'Low' WHEN r <= b THEN 'Med-Low' WHEN r <= c THEN 'Med-High' ELSE 'High' END AS risk_group, t, e FROM r, q), "
       "c AS (SELECT risk_group, t, sum(e) AS deaths, count(*) AS exits FROM g GROUP BY 1, 2), "
       "x AS (SELECT risk_group, t, deaths, sum(exits) OVER (PARTITION BY risk_group ORDER BY t DESC) AS at_risk FROM c) "
       "SELECT risk_group, t AS time, at_risk::BIGINT AS at_risk, deaths::BIGINT AS deaths, round(product(1 - deaths / at_risk) OVER (PARTITION BY risk_group ORDER BY t), 6) AS survival FROM x")
def _(spark, sf):
    d = survival.cox_risk(survival_rows(spark, sf), {"l_discount": 4.0, "l_tax": -3.0})
    return rounded(survival.risk_group_curves(d, "t", "e", "risk"))
