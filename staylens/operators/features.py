"""Admission-time features and the leakage policy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens import config as C
from staylens.functions.columns import age_band, calendar_columns, normalize_category


def normalize_categorical_labels(df: DataFrame, columns=None) -> DataFrame:
    """NULL -> 'Unknown', text, stripped, empty -> 'Unknown' for the present columns."""
    cols = list(columns) if columns is not None else list(C.DEFAULT_CATEGORICAL_COLUMNS)
    exprs = {c: normalize_category(c) for c in cols if c in df.columns}
    return df.withColumns(exprs) if exprs else df


def engineer_admission_time_features(df: DataFrame, admit_col: str = "admittime") -> DataFrame:
    return df.withColumns(calendar_columns(admit_col))


def engineer_demographic_features(df: DataFrame) -> DataFrame:
    """Numeric ``age_at_admit`` (from anchor_age when absent) and its age band."""
    if "age_at_admit" in df.columns:
        age = F.expr("try_cast(age_at_admit AS DOUBLE)")
    elif "anchor_age" in df.columns:
        age = F.expr("try_cast(anchor_age AS DOUBLE)")
    else:
        age = F.lit(None).cast("double")
    out = df.withColumn("age_at_admit", age)
    return out.withColumn("age_band", age_band("age_at_admit"))


def excluded_columns(df: DataFrame) -> list[tuple[str, str]]:
    """(column, reason) for the present excluded columns, sorted by column."""
    return sorted((c, r) for c, r in C.EXCLUDED_COLUMN_REASONS.items() if c in df.columns)


def excluded_columns_with_reasons(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The policy table restricted to ``df``'s columns (empty, not an error, on no match)."""
    return spark.createDataFrame(excluded_columns(df), "column string, reason string")


def safe_feature_columns(df: DataFrame) -> list[str]:
    """Candidate admission-time columns, in order, present and not excluded."""
    excluded = {c for c, _ in excluded_columns(df)}
    return [c for c in C.CANDIDATE_FEATURE_COLUMNS if c in df.columns and c not in excluded]


def build_modeling_dataset(df: DataFrame) -> tuple[DataFrame, list[str], list[tuple[str, str]]]:
    featured = engineer_demographic_features(engineer_admission_time_features(df))
    return featured, safe_feature_columns(featured), excluded_columns(featured)
