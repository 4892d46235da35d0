import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportlens.operators import evaluate, explain, models, survival


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(240, 3))
    y = (x[:, 0] + 0.3 * rng.normal(size=240) > 0.4).astype(int)
    d = spark.createDataFrame([(i, *map(float, x[i]), "yes" if y[i] else "no") for i in range(240)], "uid int, F01_a double, F02_b double, F03_c double, y string")
    return models.prepare(d, ["F01_a", "F02_b", "F03_c"], "y").cache()


COLS = ["F01_a", "F02_b", "F03_c"]


def test_logistic_finds_the_signal(spark, planted):
    pred = models.cross_val_predict(planted, models.logistic(240), 4)
    assert pred.count() == 240 and pred.select("uid").distinct().count() == 240
    m = {r["metric"]: r["value"] for r in models.cross_validate(pred, "lr").collect()}
    assert m["auc"] > 0.95 and m["accuracy"] > 0.85 and m["f1"] > 0.8
    odds = explain.odds_ratios(spark, models.logistic(240).fit(planted), COLS).orderBy(F.desc("odds_ratio")).first()
    assert odds["feature"] == "F01_a" and abs(odds["odds_ratio"] - math.exp(odds["coefficient"])) < 1e-9


def test_balanced_weights_average_one_per_class(planted):
    got = [r["s"] for r in planted.groupBy("label").agg(F.sum("class_weight").alias("s")).collect()]
    assert all(abs(s - 120) < 1e-9 for s in got)


def test_importances_name_the_signal(spark, planted):
    rf = models.forest(trees=15, depth=4).fit(planted)
    assert explain.top_features(explain.tree_importance(spark, rf, COLS), 1) == ["F01_a"]
    perm = {r["feature"]: r["importance"] for r in explain.permutation_importance(rf, planted, COLS, repeats=3).collect()}
    assert perm["F01_a"] > 0.2 and perm["F01_a"] > 5 * max(abs(perm["F02_b"]), abs(perm["F03_c"]))


def test_repeats_and_orders_do_not_lengthen_the_plan(spark, planted):
    rf = models.forest(trees=3, depth=2).fit(planted)

    def size(make):
        return make._jdf.queryExecution().optimizedPlan().toString().count("\n")
    few, many = (size(explain.shapley_sample(rf, planted, COLS, orders=o)) for o in (1, 20))
    assert few == many
    many = explain.permutation_importance(rf, planted, COLS, repeats=12)
    assert {r["feature"] for r in many.collect()} == set(COLS)


def test_shapley_adds_up_at_twenty_orders(spark, planted):
    rf = models.forest(trees=5, depth=3).fit(planted)
    att = explain.shapley_sample(rf, planted, COLS, orders=20)
    assert att.count() == 240 * 3
    # Every row is once per order the background of another one.
    assert abs(att.agg(F.sum("attribution")).first()[0]) < 1e-6


def test_a_failed_fit_ends_the_others(spark, planted):
    class Bad:
        def fit(self, df):
            raise RuntimeError("no fit")
    with pytest.raises(RuntimeError, match="no fit"):
        models.cross_val_predict(planted, Bad(), 3)
    twice = planted.unionByName(planted)  # rows that repeat a key share its fold
    pred = models.cross_val_predict(twice, models.forest(trees=2, depth=2), 3)
    assert pred.count() == 480 and pred.groupBy("uid").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0


def test_folds_predict_the_same_however_many_run_at_once(spark, planted):
    one, four = (sorted(map(tuple, models.cross_val_predict(planted, models.logistic(240), 4, at_once=n).select("uid", "fold", "prediction").collect()))
                 for n in (1, 4))
    assert one == four


def test_softmax_loss_falls_and_probabilities_sum_to_one(spark):
    from pyspark.ml.functions import vector_to_array
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 3))
    y = np.where(x[:, 0] * x[:, 1] > 0, 0, np.where(x[:, 2] > 0, 1, 2))  # no single feature tells
    d = spark.createDataFrame([(i, *map(float, x[i]), "abc"[y[i]]) for i in range(400)], "uid int, F01_a double, F02_b double, F03_c double, y string")
    d = models.prepare(d, COLS, "y").repartition(3).cache()
    model = models.boosted(rounds=14, depth=3, rate=0.3, classes=3).fit(d)
    assert all(b < a for a, b in zip(model.losses, model.losses[1:])) and abs(model.losses[0] - math.log(3)) < 1e-9
    out = model.transform(d).select("label", "prediction", vector_to_array("probability").alias("p")).collect()
    assert all(abs(sum(r["p"]) - 1) < 1e-12 and r["prediction"] == np.argmax(r["p"]) for r in out)
    loss = -np.mean([math.log(r["p"][int(r["label"])]) for r in out])
    assert abs(loss - model.losses[-1]) < 1e-9 and np.mean([r["label"] == r["prediction"] for r in out]) > 0.9
    drawn = models.SoftmaxBoosting(3, rounds=4, depth=2, subsample=0.5, columns=0.67, weight="class_weight").fit(d)
    assert drawn.losses[-1] < drawn.losses[0]
    with pytest.raises(ValueError):
        models.SoftmaxBoosting(2, rounds=1).fit(d)


def test_first_softmax_cut_is_the_best_of_all(spark):
    rng = np.random.default_rng(9)
    x, y = rng.integers(0, 9, size=(120, 2)).astype(float), rng.integers(0, 3, size=120)
    y[x[:, 1] > 5] = 2
    d = models.assemble(spark.createDataFrame([(*map(float, x[i]), int(y[i])) for i in range(120)], "a double, b double, label int"), ["a", "b"])
    model = models.SoftmaxBoosting(3, rounds=1, depth=1, rate=1.0).fit(d)
    for k, feature, cut, value in model.trees:
        g, h = 1 / 3 - (y == k), np.full(120, 2 / 3 * (2 / 3))

        def gain(left):
            part = [(g[m].sum() ** 2 / (h[m].sum() + 1), h[m].sum()) for m in (left, ~left)]
            return (part[0][0] + part[1][0] - g.sum() ** 2 / (h.sum() + 1)) / 2 if min(p[1] for p in part) >= 1 else -1
        best = max(gain(x[:, f] <= v) for f in range(2) for v in range(8))
        left = x[:, feature[0]] <= model.cuts[feature[0]][cut[0]]
        assert abs(gain(left) - best) < 1e-9 and abs(value[1] + g[left].sum() / (h[left].sum() + 1)) < 1e-9


def test_risk_groups_and_their_curves(spark):
    rows = [(float(i % 7 + 1), i % 2, float(i)) for i in range(40)] + [(1.0, 1, None)]
    df = spark.createDataFrame(rows, "t double, e int, r double")
    got = survival.risk_group_curves(df, "t", "e", "r").collect()
    first = {r["risk_group"]: r["at_risk"] for r in got if r["time"] == 1.0}
    assert first == dict.fromkeys(survival.RISK_GROUPS, 10)
    low = [x for x in rows[:10]]
    for r in (r for r in got if r["risk_group"] == "Low"):
        s = 1.0
        for t in sorted({x[0] for x in low if x[0] <= r["time"]}):
            s *= 1 - sum(x[1] for x in low if x[0] == t) / sum(x[0] >= t for x in low)
        assert abs(r["survival"] - s) < 1e-9


def test_shapley_values_add_up(spark, planted):
    from pyspark.ml.functions import vector_to_array
    rf = models.forest(trees=15, depth=4).fit(planted)
    att = explain.shapley_sample(rf, planted, COLS, orders=6)
    total = att.agg(F.sum("attribution")).first()[0]
    # Every row serves once per order as background, so over the table the
    # attributions add up to the sum of predictions minus itself.
    assert abs(total) < 1e-6
    per_row = {r["uid"]: r["s"] for r in att.groupBy("uid").agg(F.sum("attribution").alias("s")).collect()}
    p = {r["uid"]: r["p"] for r in rf.transform(planted).select("uid", vector_to_array("probability")[1].alias("p")).collect()}
    mean = sum(p.values()) / len(p)
    assert np.corrcoef([per_row[u] for u in p], [p[u] - mean for u in p])[0, 1] > 0.85
    assert explain.mean_abs_attribution(att).orderBy(F.desc("mean_abs")).first()["feature"] == "F01_a"


def test_multiclass_boosting_and_report(spark):
    d = spark.createDataFrame([(i, float(i % 3), "abc"[i % 3]) for i in range(90)], "uid int, F01_a double, y string")
    d = models.prepare(d, ["F01_a"], "y")
    pred = models.boosted(rounds=3, depth=2, classes=3).fit(d).transform(d)
    rep = evaluate.classification_report(pred).collect()
    assert len(rep) == 3 and all(r["f1"] == 1.0 and r["support"] == 30 for r in rep)


def test_auc_and_roc_by_hand(spark):
    d = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "label int, score double")
    assert evaluate.auc(d).first()["auc"] == (0.5 + 1 + 0 + 1) / 4
    roc = [tuple(r) for r in evaluate.roc_curve(d).orderBy(F.desc("threshold")).collect()]
    assert roc == [(0.9, 0.5, 0.5), (0.5, 0.5, 1.0), (0.1, 1.0, 1.0)]


def test_macro_f1_counts_classes_only_predicted(spark):
    d = spark.createDataFrame([(0, 0), (0, 2), (1, 1)], "label int, prediction int")
    s = evaluate.classification_scores(d).first()
    assert abs(s["macro_f1"] - (2 / 3 + 1 + 0) / 3) < 1e-12 and abs(s["accuracy"] - 2 / 3) < 1e-12


def test_concordance_matches_brute_force(spark):
    rng = np.random.default_rng(6)
    t, e, r = rng.integers(1, 12, 120), rng.integers(0, 2, 120), rng.integers(0, 9, 120)
    c = d = z = 0
    for i in range(120):
        for j in range(120):
            if e[i] and (t[j] > t[i] or (t[j] == t[i] and not e[j])):
                c, d, z = c + (r[i] > r[j]), d + (r[i] < r[j]), z + (r[i] == r[j])
    df = spark.createDataFrame([(float(a), int(b), float(x)) for a, b, x in zip(t, e, r)], "t double, e int, r double")
    got = survival.concordance(df, "t", "e", "r").first()
    assert (got["concordant"], got["discordant"], got["tied"]) == (c, d, z)


def test_concordance_with_one_risk_level(spark):
    df = spark.createDataFrame([(1.0, 1, 2.0), (2.0, 1, 2.0)], "t double, e int, r double")
    assert tuple(survival.concordance(df, "t", "e", "r").first()) == (0.0, 0.0, 1.0, 0.5)


def test_kaplan_meier_by_hand(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 0), ("a", 3.0, 1), ("a", 3.0, 1)], "g string, t double, e int")
    got = [tuple(r)[1:] for r in survival.kaplan_meier(df, "t", "e", "g").orderBy("time").collect()]
    assert [(x[0], x[1], x[2]) for x in got] == [(1.0, 4, 1), (2.0, 3, 0), (3.0, 2, 2)]
    assert [round(x[3], 9) for x in got] == [0.75, 0.75, 0.0]


def test_cox_recovers_a_planted_effect(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, 2))
    t = rng.exponential(1 / np.exp(0.9 * x[:, 0]))
    e = (t < 2).astype(int)
    df = spark.createDataFrame([(float(min(a, 2)), int(b), float(p), float(q)) for a, b, (p, q) in zip(t, e, x)], "t double, e int, a double, b double")
    fit = survival.cox_fit(df, "t", "e", ["a", "b"], l2=0.0)
    assert max(abs(g) for g in fit["gradient"]) < 1e-6
    assert abs(fit["coef"][0] - 0.9) < 0.15 and abs(fit["coef"][1]) < 0.15
    ridge = survival.cox_fit(df, "t", "e", ["a", "b"], l2=0.1)
    assert abs(ridge["coef"][0]) < abs(fit["coef"][0])
    scored = survival.cox_risk(df, dict(zip(fit["cols"], fit["coef"])))
    assert survival.concordance(scored, "t", "e", "risk").first()["c_index"] > 0.65


def test_text_classifier_takes_the_most_frequent_terms(spark):
    """Bounds on rows, equal totals ordered by term, also where the bounds drop more terms than there are candidates at first."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(60):
        words = [f"w{int(w)}" for w in rng.integers(0, 30, 12)] + ["all"] * 3 + (["twice"] * 20 if i < 2 else []) + ["yes" if i % 2 else "no"]
        rows.append((i, float(i % 2), 1.0, words if i else []))
    df = spark.createDataFrame(rows, "uid int, label double, class_weight double, terms array<string>").repartition(5)
    total, held = {}, {}
    for *_, words in rows:
        for w in words:
            total[w] = total.get(w, 0) + 1
        for w in set(words):
            held[w] = held.get(w, 0) + 1
    for vocab in (1, 2, 10, 500):
        want = sorted((w for w in total if 3 <= held[w] <= 0.95 * 60), key=lambda w: (-total[w], w))[:vocab]
        model = models.text_classifier(60, vocab=vocab).fit(df)
        assert list(model.stages[0].vocabulary) == want
    got = model.transform(df.filter("uid > 0"))
    assert got.filter("prediction = label").count() >= 55 and "terms" in got.columns
