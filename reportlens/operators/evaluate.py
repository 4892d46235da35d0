"""Scores from a table of labels, predictions and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from reportlens.operators import ordered


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction", by=()) -> DataFrame:
    """(by, label, prediction, n) in long form."""
    return pred.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(pred: DataFrame, classes, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row per label, one column ``pred_<class>`` per predicted class."""
    wide = pred.groupBy(F.col(label).alias("label")).agg(
        *[F.count_if(F.col(prediction) == c).alias(f"pred_{c}") for c in classes])
    return wide


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction", by=()) -> DataFrame:
    """(by, class, precision, recall, f1, support); an undefined ratio is 0."""
    n = confusion_counts(pred, label, prediction, by)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    as_label = n.select(*by, F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"))
    as_pred = n.select(*by, F.col("prediction").alias("class"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"))
    c = as_label.unionByName(as_pred).groupBy(*by, "class").agg(*[F.sum(x).alias(x) for x in ("tp", "support", "predicted")])

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return c.select(*by, "class", ratio(F.col("tp"), F.col("predicted")).alias("precision"),
                    ratio(F.col("tp"), F.col("support")).alias("recall"),
                    ratio(2.0 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"), "support")


def classification_scores(pred: DataFrame, label: str = "label", prediction: str = "prediction", positive=1, by=()) -> DataFrame:
    """(by, f1 of the positive class, macro_f1, accuracy)."""
    rep = classification_report(pred, label, prediction, by)
    hits = F.col("recall") * F.col("support")
    return rep.groupBy(*by).agg(
        F.coalesce(F.max(F.when(F.col("class") == positive, F.col("f1"))), F.lit(0.0)).alias("f1"),
        F.avg("f1").alias("macro_f1"), (F.sum(hits) / F.sum("support")).alias("accuracy"))


def _score_counts(pred, label, score, positive, by):
    return pred.filter(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == positive).alias("pos"), F.count_if(F.col(label) != positive).alias("neg"))


def roc_curve(pred: DataFrame, label: str = "label", score: str = "score", positive=1, by=()) -> DataFrame:
    """(by, threshold, fpr, tpr) at every distinct score, highest first."""
    run = ordered.running_sums(_score_counts(pred, label, score, positive, by), "score", ["pos", "neg"], by, descending=True)
    return run.select(*by, F.col("score").alias("threshold"), (F.col("cum_neg") / F.col("total_neg")).alias("fpr"),
                      (F.col("cum_pos") / F.col("total_pos")).alias("tpr"))


def auc(pred: DataFrame, label: str = "label", score: str = "score", positive=1, by=()) -> DataFrame:
    """(by, auc): share of (positive, negative) pairs in order, ties half."""
    run = ordered.running_sums(_score_counts(pred, label, score, positive, by), "score", ["pos", "neg"], by)
    below = F.col("cum_neg") - F.col("neg")
    won = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    keys = by if by else []
    return run.groupBy(*keys).agg((won / (F.max("total_pos").cast("double") * F.max("total_neg"))).alias("auc"))


TARGETS = {"auc": 0.80, "f1": 0.78}  # fixed values: quality targets


def leaderboard(metrics: DataFrame, targets=None) -> DataFrame:
    """Best model per (dataset, metric) of a long metrics table, with its target
    check (null where the metric has no target)."""
    targets = TARGETS if targets is None else targets
    best = metrics.groupBy("dataset", "metric").agg(
        F.max(F.struct(F.col("value"), F.col("model"))).alias("b")).select(
            "dataset", "metric", F.col("b.model").alias("model"), F.col("b.value").alias("value"))
    met = F.lit(None).cast("boolean")
    for m, t in targets.items():
        met = F.when(F.lower("metric") == m, F.col("value") > t).otherwise(met)
    return best.withColumn("meets_target", met)
