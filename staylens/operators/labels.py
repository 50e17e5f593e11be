"""Long-stay labels (fixed day count and cohort percentile) and label comparison tables.

The percentile threshold is an exact one-row aggregate (``percentile_columns``) joined
to the rows as a broadcast single row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens import config as C
from staylens.functions.columns import fixed_day_label, label_definition_text, percentile_label, safe_rate
from staylens.operators.ordered import percentile_columns


def percentile_threshold(df: DataFrame, los_col: str = "los_days", percentile: float = C.LONG_STAY_PERCENTILE, name: str = "p90_threshold", **prefix_kw) -> DataFrame:
    """One-row DataFrame with the exact percentile of ``los_col`` (NULL when empty)."""
    return percentile_columns(df, los_col, {name: percentile}, **prefix_kw)


def with_threshold(df: DataFrame, threshold: DataFrame) -> DataFrame:
    return df.crossJoin(F.broadcast(threshold))  # one-row aggregate


def add_long_stay_labels(
    df: DataFrame,
    los_col: str = "los_days",
    fixed_day_threshold: float = C.LONG_STAY_DAYS_THRESHOLD,
    percentile: float = C.LONG_STAY_PERCENTILE,
    keep_threshold: bool = True,
    **prefix_kw,
) -> DataFrame:
    """Both labels; the percentile threshold is kept as ``p90_threshold``."""
    out = with_threshold(df, percentile_threshold(df, los_col, percentile, **prefix_kw)).withColumns(
        {
            "long_stay_gt_7d": fixed_day_label(los_col, fixed_day_threshold),
            "long_stay_gte_p90": percentile_label(los_col, "p90_threshold"),
        }
    )
    return out if keep_threshold else out.drop("p90_threshold")


create_label_columns = add_long_stay_labels


def make_target_label(
    df: DataFrame,
    label_mode: str = C.FINAL_LABEL_MODE,
    los_col: str = "los_days",
    fixed_day_threshold: float = C.LONG_STAY_DAYS_THRESHOLD,
    percentile: float = C.LONG_STAY_PERCENTILE,
    output_col: str = "target_long_stay",
    **prefix_kw,
) -> DataFrame:
    """Target column for ``gt_7d`` or ``gte_p90``; ``target_threshold`` holds the cut."""
    if label_mode == "gt_7d":
        return df.withColumns({output_col: fixed_day_label(los_col, fixed_day_threshold), "target_threshold": F.lit(float(fixed_day_threshold))})
    if label_mode == "gte_p90":
        t = percentile_threshold(df, los_col, percentile, "target_threshold", **prefix_kw)
        return with_threshold(df, t).withColumn(output_col, percentile_label(los_col, "target_threshold"))
    raise ValueError("label_mode must be one of: {'gt_7d', 'gte_p90'}")


def _label_counts(df: DataFrame, los_col: str, fixed_day_threshold: float, percentile: float, **prefix_kw) -> DataFrame:
    """One row: total, fixed-label count, percentile threshold, percentile-label count."""
    labeled = with_threshold(df.select(los_col), percentile_threshold(df, los_col, percentile, **prefix_kw))
    return labeled.agg(
        F.count(F.lit(1)).alias("_total"),
        F.sum(fixed_day_label(los_col, fixed_day_threshold)).alias("_fixed"),
        F.first("p90_threshold", ignorenulls=True).alias("_p"),
        F.sum(percentile_label(los_col, "p90_threshold")).alias("_pct"),
    )


def long_stay_definition_comparison(
    df: DataFrame,
    los_col: str = "los_days",
    fixed_day_threshold: float = C.LONG_STAY_DAYS_THRESHOLD,
    percentile: float = C.LONG_STAY_PERCENTILE,
    **prefix_kw,
) -> DataFrame:
    """definition, threshold_value_days, positive_count, positive_rate (two rows)."""
    counts = _label_counts(df, los_col, fixed_day_threshold, percentile, **prefix_kw)
    total = F.col("_total")
    rows = F.array(
        F.struct(
            F.lit(label_definition_text("gt_7d", fixed_day_threshold, percentile)).alias("definition"),
            F.lit(float(fixed_day_threshold)).alias("threshold_value_days"),
            F.coalesce(F.col("_fixed"), F.lit(0)).cast("long").alias("positive_count"),
        ),
        F.struct(
            F.lit(label_definition_text("gte_p90", fixed_day_threshold, percentile)).alias("definition"),
            F.col("_p").cast("double").alias("threshold_value_days"),
            F.coalesce(F.col("_pct"), F.lit(0)).cast("long").alias("positive_count"),
        ),
    )
    return counts.select(total, F.inline(rows)).select(
        "definition", "threshold_value_days", "positive_count", safe_rate(F.col("positive_count"), total).alias("positive_rate")
    )


def label_prevalence_table(
    df: DataFrame,
    los_col: str = "los_days",
    fixed_day_threshold: float = C.LONG_STAY_DAYS_THRESHOLD,
    percentile: float = C.LONG_STAY_PERCENTILE,
    **prefix_kw,
) -> DataFrame:
    """Comparison plus mode, clarity and note; prevalence is NULL for an empty input."""
    counts = _label_counts(df, los_col, fixed_day_threshold, percentile, **prefix_kw)
    total = F.col("_total")

    def row(mode, threshold, count):
        return F.struct(
            F.lit(mode).alias("label_mode"),
            F.lit(label_definition_text(mode, fixed_day_threshold, percentile)).alias("definition"),
            threshold.cast("double").alias("threshold_value"),
            F.coalesce(count, F.lit(0)).cast("long").alias("positive_count"),
            F.lit(C.LABEL_CLARITY[mode]).alias("business_clarity"),
            F.lit(C.LABEL_NOTE[mode]).alias("interpretability_note"),
        )

    rows = F.array(row("gt_7d", F.lit(float(fixed_day_threshold)), F.col("_fixed")), row("gte_p90", F.col("_p"), F.col("_pct")))
    out = counts.select(total, F.inline(rows))
    prevalence = F.when(total > 0, F.col("positive_count").cast("double") / total.cast("double"))
    return out.select("label_mode", "definition", "threshold_value", "positive_count", prevalence.alias("prevalence"), "business_clarity", "interpretability_note")


def recommend_long_stay_definition(comparison: DataFrame) -> DataFrame:
    """One row: the recommendation text from the fixed-day row's positive rate."""
    lo, hi = C.RECOMMEND_FIXED_RATE_RANGE
    # Both definitions contain "LOS >"; the first row in table order (the fixed-day row,
    # whose text has no ">=") is the one read.
    order = F.when(F.col("definition").contains(">="), F.lit(1)).otherwise(F.lit(0))
    fixed = comparison.where(F.col("definition").contains("LOS >")).agg(
        F.count(F.lit(1)).alias("_n"), F.min_by("positive_rate", order).alias("_rate")
    )
    rate = F.col("_rate")
    text = (
        F.when(F.col("_n") == 0, F.lit(C.RECOMMEND_INSUFFICIENT_TEXT))
        .when((rate >= lo) & (rate <= hi), F.lit(C.RECOMMEND_FIXED_TEXT))
        .otherwise(F.lit(C.RECOMMEND_PERCENTILE_TEXT))
    )
    label = F.when(F.col("_n") == 0, F.lit(None).cast("string")).when((rate >= lo) & (rate <= hi), F.lit("gt_7d")).otherwise(F.lit("gte_p90"))
    return fixed.select(label.alias("recommended_label_mode"), rate.alias("fixed_positive_rate"), text.alias("recommendation"))
