"""Classifiers on Spark ML, cross-validation and class weights.

Fits are distributed by Spark ML. Every fold is fitted once and all metrics are
read off its out-of-fold predictions.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor, as_completed
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import CountVectorizerModel, IDF, Normalizer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from reportlens.operators import corpus, evaluate, splits
from reportlens.operators.boosting import SoftmaxBoosting
from reportlens.session import cut_lineage, drop_table


def with_class_weight(df: DataFrame, label: str, mode: str = "balanced", out: str = "class_weight") -> DataFrame:
    """``balanced``: n / (classes * n_class). ``positive``: neg/pos on label 1,
    1 elsewhere. The weights, one per class, are a map in a scalar subquery, so
    that the rows are not shuffled by class. Rows without a label are dropped."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(F.struct(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"),
                                 F.sum(F.when(F.col(label).cast("string") == "1", F.col("_n")).otherwise(0)).alias("pos"))).scalar()
    w = counts.withColumn("_t", totals)
    if mode == "balanced":
        weight = F.col("_t.n") / (F.col("_t.k") * F.col("_n"))
    else:
        weight = F.when(F.col(label).cast("string") == "1", (F.col("_t.n") - F.col("_t.pos")) / F.col("_t.pos")).otherwise(F.lit(1.0))
    key = F.col(label).cast("string")
    weights = w.filter(F.col(label).isNotNull()).agg(F.map_from_entries(F.collect_list(F.struct(key, weight.cast("double"))))).scalar()
    return df.filter(F.col(label).isNotNull()).withColumn("_weights", weights).withColumn(out, F.col("_weights")[key]).drop("_weights")


def index_labels(df: DataFrame, label: str, out: str = "label"):
    """Class codes 0..k-1 in alphabetical order; returns (df, classes)."""
    model = StringIndexer(inputCol=label, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="error").fit(df)
    return model.transform(df), list(model.labels)


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    """Feature vector; nulls count as zero."""
    filled = df.withColumns({f"_x{i}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for i, c in enumerate(cols)})
    names = [f"_x{i}" for i in range(len(cols))]
    return VectorAssembler(inputCols=names, outputCol=out).transform(filled).drop(*names)


def feature_pipeline(out: str = "scaled") -> Pipeline:
    return Pipeline(stages=[StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol=out)])


def logistic(n_rows: int, c: float = 1.0, max_iter: int = 1000, scale: bool = True, weight: str | None = "class_weight"):
    """L2 logistic regression; the penalty is 1 / (C * n) per row."""
    lr = LogisticRegression(featuresCol="scaled" if scale else "features", labelCol="label", maxIter=max_iter,
                            regParam=1.0 / (c * max(n_rows, 1)), elasticNetParam=0.0, standardization=False)
    if weight:
        lr = lr.setWeightCol(weight)
    return Pipeline(stages=[*feature_pipeline().getStages(), lr]) if scale else lr


def forest(trees: int = 300, depth: int = 15, seed: int = 42, min_leaf: int = 1, weight: str | None = "class_weight"):
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed,
                                minInstancesPerNode=min_leaf, cacheNodeIds=True)
    return rf.setWeightCol(weight) if weight else rf


def boosted(rounds: int = 200, depth: int = 6, rate: float = 0.1, subsample: float = 0.8, columns: str = "0.8",
            classes: int = 2, seed: int = 42, weight: str | None = "class_weight"):
    """Gradient-boosted trees; several classes share one softmax objective, on
    all rows and features and without class weights."""
    if classes > 2:
        return SoftmaxBoosting(classes, rounds, depth, rate, seed=seed)
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=rate,
                        subsamplingRate=subsample, featureSubsetStrategy=columns, seed=seed)
    return gbt.setWeightCol(weight) if weight else gbt


def frequent_terms(df: DataFrame, terms: str = "terms", vocab: int = 5000, min_df: int = 3, max_df: float = 0.95) -> list[str]:
    """The ``vocab`` most frequent entries of the array column ``terms``, equal totals ordered by term, of those in at
    least ``min_df`` rows and at most the share ``max_df`` of all."""
    total = df.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("total"))
    # A term in min_df rows has a total of as many: most n-grams go at once.
    total = cut_lineage(total.filter(F.col("total") >= min_df))
    first = F.desc("total"), F.col("term")
    most = df.agg(F.count(F.lit(1)) * max_df).scalar()

    def among(candidates):
        rows = df.select(F.explode(F.array_distinct(terms)).alias("term")).join(candidates.select("term"), "term")
        rows = rows.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter((F.col("df") >= min_df) & (F.col("df") <= most))
        return [r["term"] for r in rows.join(candidates, "term").orderBy(*first).limit(vocab).select("term").collect()]  # at most ``vocab``
    # The bounds seldom drop a frequent term; only if they drop too many, all terms are candidates.
    found = among(F.broadcast(cut_lineage(total.orderBy(*first).limit(2 * vocab)))) if corpus.small(vocab) else []
    return found if len(found) == vocab else among(total)


class TextClassifier(Estimator):
    """TF-IDF of the ``vocab`` most frequent entries of ``terms`` and the classifier ``lr`` on it. The terms are counted
    once and written as vectors, which the weights and the passes of the fit read."""

    def __init__(self, lr: LogisticRegression, vocab: int):
        super().__init__()
        self.lr, self.vocab = lr, vocab

    def _fit(self, df: DataFrame) -> PipelineModel:
        found = frequent_terms(df, "terms", self.vocab)
        if not found:
            raise ValueError("no term is frequent enough for the vocabulary")
        counter = CountVectorizerModel.from_vocabulary(found, inputCol="terms", outputCol="tf")
        counted = cut_lineage(counter.transform(df).drop("terms"))
        rest = Pipeline(stages=[IDF(inputCol="tf", outputCol="tfidf"), Normalizer(inputCol="tfidf", outputCol="features"), self.lr]).fit(counted)
        drop_table(counted)
        return PipelineModel([counter, *rest.stages])


def text_classifier(n_rows: int, stop_words=(), max_iter: int = 2000, weight: str | None = "class_weight", vocab: int = 5000):
    """Word 1-2-gram TF-IDF with multinomial logistic regression over an array
    column ``terms`` (see ``term_column``)."""
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter, regParam=1.0 / max(n_rows, 1),
                            standardization=False, family="auto")
    return TextClassifier(lr.setWeightCol(weight) if weight else lr, vocab)


def term_column(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("terms", corpus.term_list(text, ngrams=(1, 2)))


def prepare(df: DataFrame, cols, label: str, mode: str = "balanced") -> DataFrame:
    """Vector, class code and class weight columns."""
    coded, _ = index_labels(df, label)
    return with_class_weight(assemble(coded, cols), "label", mode)


def _concurrently(spark, work, items, at_once: int):
    """``work`` of every item, ``at_once`` at a time. If one fails, the jobs of the others are cancelled."""
    sc, tag = spark.sparkContext, f"fits-{uuid.uuid4().hex}"

    def tagged(item):
        sc.addJobTag(tag)
        try:
            return work(item)
        finally:
            sc.removeJobTag(tag)

    with ThreadPoolExecutor(at_once) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(tagged), i) for i in items]
        try:
            for f in as_completed(futures):
                f.result()
        except BaseException:
            for f in futures:
                f.cancel()
            sc.cancelJobsWithTag(tag)
            raise
    return [f.result() for f in futures]


def cross_val_predict(df: DataFrame, estimator, k: int, key: str = "uid", label: str = "label", seed: int = 42,
                      at_once: int = 4) -> DataFrame:
    """Out-of-fold predictions: key, label, fold, prediction, probability array.

    Folds are dealt on keys and labels alone; rows that repeat a key share its
    fold. The folded input is written once and ``at_once`` of the k fits run at
    the same time.
    """
    df = cut_lineage(df)
    folds = splits.assign_folds(df.select(key, label).dropDuplicates([key]), label, k, seed, key).select(F.col(key).alias("_key"), "fold")
    folded = cut_lineage(df.join(folds, F.col(key).eqNullSafe(F.col("_key"))).drop("_key"))

    def fit(i):
        return estimator.fit(folded.filter(F.col("fold") != i))

    parts = []
    for i, model in enumerate(_concurrently(df.sparkSession, fit, range(k), at_once)):
        out = model.transform(folded.filter(F.col("fold") == i))
        parts.append(out.select(key, label, "fold", "prediction", vector_to_array("probability").alias("probability")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def cross_validate(pred: DataFrame, model: str, dataset: str = "primary", binary: bool = True) -> DataFrame:
    """Long metrics (dataset, model, metric, value, std) over the folds of a
    ``cross_val_predict`` table; std is the population form over the folds."""
    scores = evaluate.classification_scores(pred, positive=1.0, by=["fold"])
    names = ["macro_f1", "accuracy"] + (["f1"] if binary else [])
    if binary:
        ranked = pred.withColumn("score", F.element_at("probability", 2))
        scores = scores.join(evaluate.auc(ranked, positive=1.0, by=["fold"]), "fold")
        names.append("auc")
    long = scores.unpivot(["fold"], names, "metric", "value")
    return long.groupBy("metric").agg(F.avg("value").alias("value"), F.stddev_pop("value").alias("std")).select(
        F.lit(dataset).alias("dataset"), F.lit(model).alias("model"), "metric", "value", "std")
