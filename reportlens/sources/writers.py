"""Stage tables, metrics and fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from reportlens.sources.readers import _CSV


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by=()) -> None:
    """Write a stage table; parquet is the format between stages, CSV and JSON
    are exports."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(**_CSV, quoteAll=True).csv(path)
    else:
        w.format(fmt).save(path)


def metrics_table(spark: SparkSession, results: dict) -> DataFrame:
    """{dataset: {model: {metric: value}}} -> (dataset, model, metric, value)."""
    data = [(d, m, k, float(v)) for d, models in results.items() for m, scores in models.items() for k, v in scores.items()]
    return spark.createDataFrame(data, "dataset string, model string, metric string, value double")


def save_model(model, path: str) -> None:
    wrapped = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    wrapped.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
