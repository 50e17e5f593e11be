"""Data-quality reports: missing values, duplicate ids, sanity summary, integrity checks.

Each report is one aggregation pass (partial aggregation on every partition) whose
single result row is reshaped with ``stack`` / ``unpivot``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions.columns import safe_rate
from staylens.operators.ordered import percentile_columns


def _is_missing(df: DataFrame, name: str):
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def missing_value_report(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """column, missing_count, row_count, missing_rate; missing desc then column asc."""
    cols = list(columns) if columns is not None else list(df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(cols)],
    )
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing_count")) for i, c in enumerate(cols)])
    long = counts.select(F.col("_rows").alias("row_count"), F.inline(entries))
    return long.select(
        "column",
        F.col("missing_count").cast("long").alias("missing_count"),
        F.col("row_count").cast("long").alias("row_count"),
        safe_rate(F.col("missing_count"), F.col("row_count")).alias("missing_rate"),
    ).orderBy(F.col("missing_count").desc(), F.col("column").asc())


def duplicate_admission_report(df: DataFrame, id_col: str = "hadm_id") -> DataFrame:
    """Rows, distinct non-NULL ids, duplicates (NULL ids count as duplicates), rate."""
    agg = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(F.col(id_col)).alias("unique_ids"))
    dup = F.col("total_rows") - F.col("unique_ids")
    return agg.select(
        F.lit(id_col).alias("id_column"),
        "total_rows",
        "unique_ids",
        dup.alias("duplicate_rows"),
        safe_rate(dup, F.col("total_rows")).alias("duplicate_rate"),
    )


def sanity_summary(raw: DataFrame, clean: DataFrame, los_col: str = "los_days", **prefix_kw) -> DataFrame:
    """Raw vs clean row counts, distinct ids and LOS min/median/max (NULL if absent)."""
    raw_n = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    parts = [F.count(F.lit(1)).alias("clean_rows")]
    for c, name in (("hadm_id", "clean_unique_hadm_id"), ("subject_id", "clean_unique_subject_id")):
        parts.append(F.count_distinct(F.col(c)).alias(name) if c in clean.columns else F.lit(None).cast("long").alias(name))
    has_los = los_col in clean.columns
    if has_los:
        parts += [F.min(los_col).cast("double").alias("los_min"), F.max(los_col).cast("double").alias("los_max")]
    clean_agg = clean.agg(*parts)
    if has_los:
        median = percentile_columns(clean, los_col, {"los_median": 0.5}, **prefix_kw)
    else:
        median = clean.sparkSession.range(1).select(F.lit(None).cast("double").alias("los_median"))
        clean_agg = clean_agg.withColumns({"los_min": F.lit(None).cast("double"), "los_max": F.lit(None).cast("double")})
    # Three one-row aggregates: broadcast nested-loop joins of single rows.
    row = raw_n.crossJoin(F.broadcast(clean_agg)).crossJoin(F.broadcast(median))
    dropped = F.col("raw_rows") - F.col("clean_rows")
    return row.select(
        "raw_rows",
        "clean_rows",
        dropped.alias("dropped_rows"),
        safe_rate(dropped, F.col("raw_rows")).alias("drop_rate"),
        "clean_unique_hadm_id",
        "clean_unique_subject_id",
        "los_min",
        "los_median",
        "los_max",
    )


def integrity_checks(cohort: DataFrame, safe_features: Iterable[str] = (), id_col: str = "hadm_id", los_col: str = "los_days") -> DataFrame:
    """check, violations, passed: unique id, positive LOS, no leakage feature."""
    leakage = {"los_days", "dischtime", "discharge_location", "hospital_expire_flag"}
    leaked = len([c for c in safe_features if c in leakage])
    agg = cohort.agg(
        (F.count(F.lit(1)) - F.count_distinct(F.col(id_col))).alias("dup"),
        F.count_if(~(F.coalesce(F.col(los_col) > 0, F.lit(False)))).alias("bad_los"),
    )
    entries = F.array(
        F.struct(F.lit("unique_admission_id").alias("check"), F.col("dup").cast("long").alias("violations")),
        F.struct(F.lit("positive_los").alias("check"), F.col("bad_los").cast("long").alias("violations")),
        F.struct(F.lit("no_leakage_features").alias("check"), F.lit(leaked).cast("long").alias("violations")),
    )
    return agg.select(F.inline(entries)).withColumn("passed", F.col("violations") == 0)


def assert_integrity(checks: DataFrame) -> None:
    """Raise when any check has violations (collects the three-row result)."""
    failed = [r for r in checks.collect() if r["violations"]]
    if failed:
        raise AssertionError("; ".join(f"{r['check']}: {r['violations']} violations" for r in failed))


def feature_overview(df: DataFrame, feature_columns: Iterable[str]) -> DataFrame:
    """feature, dtype, missing_rate, n_unique (distinct non-NULL), sorted by feature."""
    cols = list(feature_columns)
    counts = value_counts(df, cols).groupBy("feature").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("missing"), F.col("n")).otherwise(0)).alias("gone"),
        F.count("value").alias("n_unique"),
    )
    kinds = F.create_map(*[F.lit(x) for c in cols for x in (c, df.schema[c].dataType.simpleString())])
    # Features of an empty table have no counted value.
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return names.join(counts, "feature", "left").select(
        "feature",
        F.element_at(kinds, F.col("feature")).alias("dtype"),
        (F.col("gone").cast("double") / F.col("rows").cast("double")).alias("missing_rate"),
        F.coalesce("n_unique", F.lit(0)).cast("long").alias("n_unique"),
    ).orderBy("feature")


def value_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """feature, value (as text), missing, n: every distinct value of every column, counted in
    one aggregate with partial counts.  A distinct count or a mode is then a small aggregate
    per feature, instead of one Expand per distinct column or one map of all values."""
    def text(c: str):
        floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
        return ((F.col(c) + 0.0) if floating else F.col(c)).cast("string")  # -0.0 is 0.0

    cells = [F.struct(F.lit(c).alias("feature"), text(c).alias("value"), _is_missing(df, c).alias("missing")) for c in columns]
    return df.select(F.inline(F.array(*cells))).groupBy("feature", "value", "missing").agg(F.count(F.lit(1)).alias("n"))
