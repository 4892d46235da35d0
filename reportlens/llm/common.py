"""Column expressions, scans and running sums that several operators use."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def travels_by_value(name: str) -> None:
    """Functions of the module ``name`` are sent to the executors with their
    code, so that executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


travels_by_value(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, all else unchanged. A text of one-byte characters takes the
    faster ``lower``, which then changes nothing else."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _UPPER.lower()))


def n_words(c: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")

