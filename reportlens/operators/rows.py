"""Row and column operators: projections, filters, samples, unions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from reportlens.functions import draws, text as tx


# ------------------------------------------------------------- projections

def select_existing(df: DataFrame, cols) -> DataFrame:
    """The listed columns that exist, in the order given."""
    return df.select(*[F.col(f"`{c}`") for c in cols if c in df.columns])


def drop_columns_matching(df: DataFrame, regex: str = r"^(Unnamed.*|EndHere|)$") -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not re.match(regex, c)])


SECONDARY_NAMES = {
    # Second-source column -> unified column.
    "ExamID": "uid",
    "ImageID": "image_id",
    "PatientID": "patient_id",
    "ImageDir": "image_dir",
    "StudyDate": "study_date",
    "PatientPosition": "patient_position",
    "PositionView": "position_view",
    "Projection": "projection",
    "ProjectionMethod": "projection_method",
    "ImageWidth": "image_width",
    "ImageHeight": "image_height",
    "ReportID": "report_id",
    "Findings": "findings",
    "Indication": "indication",
    "Comparison": "comparison",
    "Impression": "impression",
}


def to_unified_schema(df: DataFrame, mapping: dict | None = None, drop=()) -> DataFrame:
    """Rename to the unified schema; names differing only in case are safe."""
    mapping = SECONDARY_NAMES if mapping is None else mapping
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns if c not in drop])


def tag_source(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("dataset_source", F.lit(name))


def fill_text(df: DataFrame, cols) -> DataFrame:
    return df.fillna("", subset=[c for c in cols if c in df.columns])


def feature_columns(df: DataFrame, exclude=()) -> list[str]:
    """Columns named ``F`` + two digits, minus an exclusion list."""
    return [c for c in df.columns if re.match(r"F\d\d", c) and c not in exclude]


def coerce_numeric(df: DataFrame, cols, fill: float | None = 0.0) -> DataFrame:
    def number(c):
        v = F.col(c).try_cast("double")
        return v if fill is None else F.coalesce(v, F.lit(float(fill)))
    return df.withColumns({c: number(c) for c in cols})


def squeeze_all_strings(df: DataFrame, skip=()) -> DataFrame:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]
    return df.withColumns({c: tx.squeeze(c) for c in names}) if names else df


def label_flags(df: DataFrame, labels: str, names, prefix: str = "has_") -> DataFrame:
    """0/1 column per label of an array column."""
    return df.withColumns({prefix + n: F.coalesce(F.array_contains(labels, n), F.lit(False)).cast("int") for n in names})


# ------------------------------------------------------------------ filters

def drop_null_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def both_empty(a: str, b: str, strip: bool = False) -> Column:
    if strip:
        return tx.is_blank(a) & tx.is_blank(b)
    return (F.coalesce(F.col(a), F.lit("")) == "") & (F.coalesce(F.col(b), F.lit("")) == "")


def drop_both_empty(df: DataFrame, a: str = "findings", b: str = "impression", strip: bool = False) -> DataFrame:
    return df.filter(~both_empty(a, b, strip))


def drop_truncated(df: DataFrame, text, min_tokens: int = 5) -> DataFrame:
    return df.filter(tx.word_count(text) >= min_tokens)


def malformed(findings: str = "findings", impression: str = "impression", min_words: int = 3) -> Column:
    return (tx.word_count(findings) < min_words) & (tx.word_count(impression) == 0)


def drop_malformed(df: DataFrame, findings: str = "findings", impression: str = "impression", min_words: int = 3) -> DataFrame:
    return df.filter(~malformed(findings, impression, min_words))


def summary_pairs(df: DataFrame, findings: str = "findings_clean", impression: str = "impression_clean") -> DataFrame:
    """Rows with enough text on both sides to judge a summary."""
    return df.filter((tx.char_count(findings) > 10) & (tx.char_count(impression) > 3))


def positive_only(c) -> Column:
    """The value where it is above zero, else null (ignored by aggregates)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > 0, c)


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """``n`` rows in the order of a seeded hash of the key: the same rows
    whatever the partitioning. Runs as a distributed top-n."""
    return df.orderBy(draws.digest(key, seed), F.col(key)).limit(n)


def head_n(df: DataFrame, n: int, order) -> DataFrame:
    return df.orderBy(order).limit(n)


def top_n(df: DataFrame, col: str, n: int, asc: bool = False, tie: str | None = None) -> DataFrame:
    keys = [F.col(col).asc() if asc else F.col(col).desc()]
    return df.orderBy(*keys, *([F.col(tie)] if tie else [])).limit(n)


# -------------------------------------------------------------- membership

def drop_ids(df: DataFrame, ids: DataFrame, key: str = "uid") -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def keep_in(df: DataFrame, col: str, values) -> DataFrame:
    """Rows whose value is in a Python list or in a one-column DataFrame."""
    if isinstance(values, DataFrame):
        return df.join(values.select(F.col(values.columns[0]).alias(col)), col, "left_semi")
    return df.filter(F.col(col).isin(list(values)))


def union_sources(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def join_on_key(left: DataFrame, right: DataFrame, key: str = "uid") -> DataFrame:
    """Row alignment by id; positions are never used."""
    return left.join(right, key)


def with_global_max(df: DataFrame, cols, prefix: str = "max_") -> DataFrame:
    """Column maxima beside every row. The maxima come from one scalar
    subquery, so no row is moved to attach them."""
    best = df.agg(F.struct(*[F.max(c).alias(c) for c in cols]).alias("m")).scalar()
    return df.withColumn("_best", best).withColumns({prefix + c: F.col(f"_best.{c}") for c in cols}).drop("_best")
