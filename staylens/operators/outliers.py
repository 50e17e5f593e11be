"""Long-stay outlier review: rows whose LOS has global DENSE_RANK (descending) <= N or
PERCENT_RANK (ascending) >= r, with both ranks, the p90 threshold and both labels.

At scale the cut is found by counting cells and only values that can qualify are ranked.
The qualifying values form a prefix of the descending order, so the cohort is first
filtered by the smallest qualifying value and only those rows are joined to ranks.  For
few rows one table of distinct values and their counts gives ranks and threshold alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens import config as C
from staylens.functions.columns import fixed_day_label, percentile_label
from staylens.operators.labels import percentile_threshold, with_threshold
from staylens.operators.ordered import ROWS_PER_BUCKET, top_value_ranks


def long_stay_outlier_review(
    cohort: DataFrame,
    top_n: int = C.OUTLIER_TOP_N,
    min_percent_rank: float = C.OUTLIER_MIN_PERCENT_RANK,
    los_col: str = "los_days",
    fixed_day_threshold: float = C.LONG_STAY_DAYS_THRESHOLD,
    percentile: float = C.LONG_STAY_PERCENTILE,
    **prefix_kw,
) -> DataFrame:
    los = F.col(los_col)
    row_bound = prefix_kw.get("row_bound")
    if row_bound is not None and row_bound <= (prefix_kw.get("rows_per_bucket") or ROWS_PER_BUCKET):
        keep = _ranked_values(cohort, los_col, percentile)
        keep = keep.where((F.col("dense_rank_desc") <= F.lit(top_n)) | (F.col("percent_rank") >= F.lit(float(min_percent_rank))))
        return _finish(cohort.join(keep, on=los_col, how="inner"), cohort, los_col, fixed_day_threshold)
    ranks = top_value_ranks(cohort, los_col, top_n, min_percent_rank, **prefix_kw)
    keep = ranks.where((F.col("dense_rank_desc") <= F.lit(top_n)) | (F.col("percent_rank") >= F.lit(float(min_percent_rank))))
    cut = keep.agg(F.min("_v").alias("_cut"))  # one row
    top = with_threshold(cohort, cut).where(los >= F.col("_cut")).drop("_cut")
    rows = top.join(keep.select(F.col("_v").alias(los_col), "dense_rank_desc", "percent_rank"), on=los_col, how="inner")
    rows = with_threshold(rows, percentile_threshold(cohort, los_col, percentile, "p90_los_days", **prefix_kw))
    return _finish(rows, cohort, los_col, fixed_day_threshold)


def _ranked_values(cohort: DataFrame, los_col: str, percentile: float) -> DataFrame:
    """Distinct values with both ranks and the percentile of all rows; the window holds at
    most as many values as the caller's row bound allows."""
    los = F.col(los_col)
    vc = cohort.where(los.isNotNull()).groupBy(los).agg(F.count(F.lit(1)).alias("_w"))
    everything, down = Window.partitionBy(), Window.orderBy(los.desc())
    ranked = vc.withColumns({
        "dense_rank_desc": F.row_number().over(down).cast("long"),
        "_cum": F.sum("_w").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_n": F.sum("_w").over(everything),
    })
    less, n = F.col("_n") - F.col("_cum"), F.col("_n")
    h = F.lit(float(percentile)) * (n - 1).cast("double")

    def at(rank):
        return F.max(F.when((rank >= less) & (rank < less + F.col("_w")), los.cast("double"))).over(everything)

    low, high = at(F.floor(h)), at(F.ceil(h))
    pct = F.when(n > 1, less.cast("double") / (n - 1).cast("double")).otherwise(F.lit(0.0))
    return ranked.select(los, "dense_rank_desc", pct.alias("percent_rank"), (low + (high - low) * (h - F.floor(h))).alias("p90_los_days"))


def _finish(rows: DataFrame, cohort: DataFrame, los_col: str, fixed_day_threshold: float) -> DataFrame:
    los = F.col(los_col)
    cohort_cols = [c for c in C.COHORT_COLUMNS if c in cohort.columns]
    return rows.select(
        *cohort_cols,
        "p90_los_days",
        fixed_day_label(los_col, fixed_day_threshold).alias("is_long_stay_gt_7d"),
        percentile_label(los_col, "p90_los_days").alias("is_long_stay_gte_p90"),
        F.col("dense_rank_desc").cast("long").alias("los_dense_rank"),
        F.col("percent_rank").alias("los_percent_rank"),
    ).orderBy(los.desc(), F.col("hadm_id").asc_nulls_last())
