"""LOS profiling: summaries, exact percentiles, subgroup rates, concentration, histogram
and density.

Exact percentiles come from :mod:`staylens.operators.ordered` (no single-partition
sort, hot groups split into buckets).  One-row aggregates (thresholds, totals) are
joined as broadcast single rows.  Several subgroup dimensions are handled in one pass
by unpivoting each row into (dimension, value) pairs, the single-scan form of
grouping sets."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens import config as C
from staylens.functions.columns import share, unknown_if_null
from staylens.operators.labels import percentile_threshold, with_threshold
from staylens.operators.ordered import exact_percentiles, percentile_columns


def _scaled(prefix_kw: dict, factor: int) -> dict:
    """The row bound of a relation after each row was repeated ``factor`` times."""
    kw = dict(prefix_kw)
    if kw.get("row_bound") is not None:
        kw["row_bound"] = kw["row_bound"] * factor
    return kw


def _pct_name(p: float) -> str:
    return "median_los_days" if abs(p - 0.5) < 1e-12 else f"p{int(round(p * 100))}_los_days"


def los_summary_table(df: DataFrame, los_col: str = "los_days", **prefix_kw) -> DataFrame:
    """n, mean, median, std (sample), min, p25, p75, p90, p95, p99, max over non-NULL LOS."""
    los = F.col(los_col)
    stats = df.where(los.isNotNull()).agg(
        F.count(F.lit(1)).alias("n_admissions"),
        F.avg(los).alias("mean_los_days"),
        F.stddev_samp(los).alias("std_los_days"),
        F.min(los).cast("double").alias("min_los_days"),
        F.max(los).cast("double").alias("max_los_days"),
    )
    pct = percentile_columns(df, los_col, {n: p for n, p in (("median_los_days", 0.5), ("p25_los_days", 0.25), ("p75_los_days", 0.75), ("p90_los_days", 0.9), ("p95_los_days", 0.95), ("p99_los_days", 0.99))}, **prefix_kw)
    return stats.crossJoin(F.broadcast(pct)).select(
        "n_admissions", "mean_los_days", "median_los_days", "std_los_days", "min_los_days",
        "p25_los_days", "p75_los_days", "p90_los_days", "p95_los_days", "p99_los_days", "max_los_days",
    )


def los_percentile_table(df: DataFrame, los_col: str = "los_days", percentiles: Sequence[float] = C.PERCENTILE_TABLE_DEFAULT, **prefix_kw) -> DataFrame:
    """Rows (percentile, los_days)."""
    return exact_percentiles(df, los_col, list(percentiles), **prefix_kw).select("percentile", F.col("value").alias("los_days"))


def los_overall_summary(
    cohort: DataFrame,
    los_col: str = "los_days",
    fixed_day_threshold: float = C.LONG_STAY_DAYS_THRESHOLD,
    percentile: float = C.LONG_STAY_PERCENTILE,
    **prefix_kw,
) -> DataFrame:
    """Overall statistics, both thresholds and both long-stay shares (15 columns)."""
    los = F.col(los_col)
    names = {_pct_name(p): p for p in C.SUMMARY_PERCENTILES}
    if not any(abs(p - percentile) < 1e-12 for p in names.values()):
        names["_thr"] = percentile
    pct = percentile_columns(cohort, los_col, names, **prefix_kw)
    thr_name = next(n for n, p in names.items() if abs(p - percentile) < 1e-12)
    base = with_threshold(cohort.select(los_col), pct.select(F.col(thr_name).alias("_thr")))
    stats = base.agg(
        F.count(F.lit(1)).alias("n_admissions"),
        F.avg(los).alias("mean_los_days"),
        F.stddev_samp(los).alias("std_los_days"),
        F.min(los).cast("double").alias("min_los_days"),
        F.max(los).cast("double").alias("max_los_days"),
        share(los > F.lit(float(fixed_day_threshold))).alias("long_stay_share_gt_7d"),
        share(los >= F.col("_thr")).alias("long_stay_share_gte_p90"),
    )
    row = stats.crossJoin(F.broadcast(pct))
    return row.select(
        "n_admissions", "mean_los_days", "std_los_days", "min_los_days",
        "p25_los_days", "median_los_days", "p75_los_days", "p90_los_days", "p95_los_days", "p99_los_days",
        "max_los_days",
        F.lit(float(fixed_day_threshold)).alias("long_stay_days_threshold"),
        F.col(thr_name).alias("long_stay_p90_threshold"),
        "long_stay_share_gt_7d", "long_stay_share_gte_p90",
    )


def _unpivot_dimensions(df: DataFrame, dims: Sequence[str], keep: Sequence[str], value_expr=unknown_if_null) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), value_expr(d).alias("dimension_value")) for d in dims])
    return df.select(*keep, F.inline(pairs))


def subgroup_summary(
    cohort: DataFrame,
    dimensions: Sequence[str] = C.SUBGROUP_DIMENSIONS,
    los_col: str = "los_days",
    fixed_day_threshold: float = C.LONG_STAY_DAYS_THRESHOLD,
    percentile: float = C.LONG_STAY_PERCENTILE,
    **prefix_kw,
) -> DataFrame:
    """Per (dimension, value): n, mean, median, both long-stay shares; NULL -> 'Unknown'.

    One scan for all dimensions; the medians are exact and bucketed per group, so the
    largest subgroup is not sorted in one task."""
    los = F.col(los_col)
    dims = [d for d in dimensions if d in cohort.columns]
    base = with_threshold(cohort.select(los_col, *dims), percentile_threshold(cohort, los_col, percentile, "_thr", **prefix_kw))
    long = _unpivot_dimensions(base, dims, [los_col, "_thr"])
    keys = ["dimension", "dimension_value"]
    stats = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_admissions"),
        F.avg(los).alias("mean_los_days"),
        share(los > F.lit(float(fixed_day_threshold))).alias("long_stay_share_gt_7d"),
        share(los >= F.col("_thr")).alias("long_stay_share_gte_p90"),
    )
    med = percentile_columns(long, los_col, {"median_los_days": 0.5}, keys, **_scaled(prefix_kw, len(dims)))
    return stats.join(med, on=keys, how="left").select(
        "dimension", "dimension_value", "n_admissions", "mean_los_days", "median_los_days",
        "long_stay_share_gt_7d", "long_stay_share_gte_p90",
    ).orderBy(F.col("dimension"), F.col("long_stay_share_gte_p90").desc(), F.col("n_admissions").desc())


def subgroup_summary_union(cohort: DataFrame, dimensions: Sequence[str] = C.SUBGROUP_DIMENSIONS, **kw) -> DataFrame:
    """The UNION ALL spelling (one aggregate per dimension), kept to check the single-pass form."""
    parts = [subgroup_summary(cohort, [d], **kw) for d in dimensions if d in cohort.columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def subgroup_long_stay_rates(
    df: DataFrame,
    group_columns: Iterable[str],
    target_columns: Iterable[str] = ("long_stay_gt_7d", "long_stay_gte_p90"),
) -> DataFrame:
    """definition, group_column, group_value (text, NULL kept), n_admissions, long_stay_rate.

    Groups and targets are both unpivoted so one aggregation covers every pair."""
    targets = [t for t in target_columns if t in df.columns]
    groups = [g for g in group_columns if g in df.columns]
    pairs = F.array(
        *[
            F.struct(F.lit(t).alias("definition"), F.lit(g).alias("group_column"), F.col(g).cast("string").alias("group_value"), F.col(t).cast("double").alias("_y"))
            for t in targets
            for g in groups
        ]
    )
    long = df.select(F.inline(pairs))
    return (
        long.groupBy("definition", "group_column", "group_value")
        .agg(F.count("_y").alias("n_admissions"), F.avg("_y").alias("long_stay_rate"))
        .orderBy(F.col("definition"), F.col("group_column"), F.col("long_stay_rate").desc())
    )


def long_stay_share_by(df: DataFrame, dimension: str, target_col: str) -> DataFrame:
    """Mean of the label per value of one dimension, highest first (NULL group kept)."""
    return df.groupBy(dimension).agg(F.avg(F.col(target_col).cast("double")).alias(target_col)).orderBy(F.col(target_col).desc())


def option_lists(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """column, value: sorted distinct non-NULL text values of each column."""
    cols = [c for c in columns if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull()).distinct().orderBy("column", "value")


def bed_day_concentration(cohort: DataFrame, los_col: str = "los_days", fixed_day_threshold: float = C.LONG_STAY_DAYS_THRESHOLD) -> DataFrame:
    """Long-stay share of admissions vs long-stay share of all bed-days (one row)."""
    los = F.col(los_col)
    long_stay = los > F.lit(float(fixed_day_threshold))
    agg = cohort.agg(
        F.count(F.lit(1)).alias("n_admissions"),
        F.count_if(long_stay).alias("long_stay_admissions"),
        F.sum(los).alias("total_bed_days"),
        F.coalesce(F.sum(F.when(long_stay, los)), F.lit(0.0)).alias("long_stay_bed_days"),
    )
    return agg.select(
        "n_admissions",
        F.col("long_stay_admissions").cast("long").alias("long_stay_admissions"),
        F.try_divide(F.col("long_stay_admissions").cast("double"), F.col("n_admissions").cast("double")).alias("long_stay_admission_share"),
        "total_bed_days",
        "long_stay_bed_days",
        F.try_divide(F.col("long_stay_bed_days"), F.col("total_bed_days")).alias("long_stay_bed_day_share"),
    )


def bed_day_concentration_by(
    cohort: DataFrame,
    group_col: str = "admission_location",
    los_col: str = "los_days",
    fixed_day_threshold: float = C.LONG_STAY_DAYS_THRESHOLD,
) -> DataFrame:
    """Per group: admission share, long-stay rate, and share of all long-stay bed-days."""
    los = F.col(los_col)
    long_stay = los > F.lit(float(fixed_day_threshold))
    per = cohort.groupBy(unknown_if_null(group_col).alias("group_value")).agg(
        F.count(F.lit(1)).alias("n_admissions"),
        share(long_stay).alias("long_stay_rate"),
        F.sum(los).alias("bed_days"),
        F.coalesce(F.sum(F.when(long_stay, los)), F.lit(0.0)).alias("long_stay_bed_days"),
    )
    totals = per.agg(F.sum("n_admissions").alias("_n"), F.sum("long_stay_bed_days").alias("_lbd"))
    out = per.crossJoin(F.broadcast(totals))  # one-row aggregate
    return out.select(
        F.lit(group_col).alias("group_column"),
        "group_value",
        "n_admissions",
        (F.col("n_admissions") / F.col("_n")).alias("admission_share"),
        "long_stay_rate",
        "bed_days",
        "long_stay_bed_days",
        F.when(F.col("_lbd") > 0, F.col("long_stay_bed_days") / F.col("_lbd")).alias("long_stay_bed_day_share"),
    )


def admit_period(ts: str | Column = "admittime") -> Column:
    """'Fri-Sun' for Friday to Sunday admissions, 'Mon-Thu' otherwise (NULL time -> NULL)."""
    wd = F.weekday(F.col(ts) if isinstance(ts, str) else ts)
    return F.when(wd >= 4, F.lit("Fri-Sun")).when(wd.isNotNull(), F.lit("Mon-Thu"))


def calendar_subgroup(cohort: DataFrame, los_col: str = "los_days", fixed_day_threshold: float = C.LONG_STAY_DAYS_THRESHOLD, **prefix_kw) -> DataFrame:
    """Fri-Sun vs Mon-Thu: admissions, exact median LOS, long-stay rate."""
    los = F.col(los_col)
    base = cohort.select(los_col, admit_period("admittime").alias("admit_period"))
    stats = base.groupBy("admit_period").agg(
        F.count(F.lit(1)).alias("n_admissions"), share(los > F.lit(float(fixed_day_threshold))).alias("long_stay_rate")
    )
    med = percentile_columns(base, los_col, {"median_los_days": 0.5}, ["admit_period"], **prefix_kw)
    return stats.join(med, on="admit_period", how="left").select("admit_period", "n_admissions", "median_los_days", "long_stay_rate")


def rate_ratio(
    cohort: DataFrame,
    group_col: str = "admission_location",
    base_value: str = "PHYSICIAN REFERRAL",
    los_col: str = "los_days",
    fixed_day_threshold: float = C.LONG_STAY_DAYS_THRESHOLD,
) -> DataFrame:
    """Long-stay rate of each group against the rate of one base group."""
    los = F.col(los_col)
    per = cohort.groupBy(unknown_if_null(group_col).alias("group_value")).agg(
        F.count(F.lit(1)).alias("n_admissions"), share(los > F.lit(float(fixed_day_threshold))).alias("long_stay_rate")
    )
    base = per.where(F.col("group_value") == F.lit(base_value)).agg(F.max("long_stay_rate").alias("base_rate"))
    out = per.crossJoin(F.broadcast(base))  # one-row aggregate
    return out.select(
        F.lit(group_col).alias("group_column"),
        "group_value",
        "n_admissions",
        "long_stay_rate",
        "base_rate",
        F.when(F.col("base_rate") > 0, F.col("long_stay_rate") / F.col("base_rate")).alias("rate_ratio"),
    )


def _range(df: DataFrame, los_col: str) -> DataFrame:
    los = F.col(los_col)
    r = df.where(los.isNotNull()).agg(F.min(los).cast("double").alias("_lo0"), F.max(los).cast("double").alias("_hi0"), F.count(F.lit(1)).alias("_n"), F.stddev_samp(los).alias("_sd"))
    # numpy widens a zero-width range to (v - 0.5, v + 0.5)
    return r.select(
        F.when(F.col("_hi0") > F.col("_lo0"), F.col("_lo0")).otherwise(F.col("_lo0") - 0.5).alias("_lo"),
        F.when(F.col("_hi0") > F.col("_lo0"), F.col("_hi0")).otherwise(F.col("_hi0") + 0.5).alias("_hi"),
        "_n",
        "_sd",
        "_lo0",
        "_hi0",
    )


def los_histogram(df: DataFrame, los_col: str = "los_days", bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; empty bins included."""
    los = F.col(los_col)
    rng = _range(df, los_col)
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    idx = F.least(F.floor((los - F.col("_lo")) * F.lit(float(bins)) / (F.col("_hi") - F.col("_lo"))), F.lit(bins - 1)).cast("int")
    counts = with_threshold(df.where(los.isNotNull()).select(los_col), rng).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n_admissions"))
    grid = rng.where(F.col("_n") > 0).select("_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(F.broadcast(counts), on="bin", how="left")  # at most `bins` rows
    return out.select(
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce(F.col("n_admissions"), F.lit(0)).cast("long").alias("n_admissions"),
    )


# Fast Gauss transform: cells of half this width (in units of sqrt(2) bandwidths), terms of
# the expansion, and the distance beyond which a cell is left out.  The expansion about a
# centre at most r = GAUSS_WIDTH / 2 away is short of at most the sum over n >= GAUSS_TERMS of
# 1.09 (r sqrt 2)^n / sqrt(n!) per unit of weight, below 2e-14 here; a cell left out adds at
# most exp(-(GAUSS_REACH - r)^2), below 2e-20.
GAUSS_WIDTH = 0.5
GAUSS_TERMS = 16
GAUSS_REACH = 7.0


def los_density(df: DataFrame, los_col: str = "los_days", points: int = 200) -> DataFrame:
    """Gaussian kernel density on ``points`` grid values over [min, max] (Scott bandwidth),
    by a fast Gauss transform.

    Each row adds the powers of its distance from its cell's centre to ``GAUSS_TERMS`` sums of
    that cell, in one aggregate with partial sums: the work per row does not depend on the
    number of points.  A point then sums the Hermite expansions of the few cells within
    reach, whose number depends on the ratio of range to bandwidth only."""
    los = F.col(los_col).cast("double")
    rng = _range(df, los_col).where((F.col("_n") > 1) & (F.col("_sd") > 0))  # one row, or none: no density
    rng = rng.select("_lo0", "_hi0", "_n", (F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))).alias("_b"))
    unit = F.col("_b") * F.lit(math.sqrt(2.0))
    place = with_threshold(df.where(los.isNotNull()).select(los.alias("_x")), rng).withColumn("_s", (F.col("_x") - F.col("_lo0")) / unit)
    place = place.withColumn("_cell", F.floor(F.col("_s") / F.lit(GAUSS_WIDTH)))
    off = F.col("_s") - (F.col("_cell") + F.lit(0.5)) * F.lit(GAUSS_WIDTH)
    cells = place.withColumn("_d", off).groupBy("_cell").agg(*[
        F.sum(F.pow("_d", F.lit(float(n))) if n else F.lit(1.0)).alias(f"_m{n}") for n in range(GAUSS_TERMS)
    ])
    moments = F.array(*[F.col(f"_m{n}") / F.lit(float(math.factorial(n))) for n in range(GAUSS_TERMS)])
    cells = cells.select("_cell", moments.alias("_m"))
    step = (F.col("_hi0") - F.col("_lo0")) / F.lit(float(points - 1))
    grid = rng.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    grid = grid.withColumn("los_days", F.col("_lo0") + F.col("point").cast("double") * step)
    grid = grid.withColumn("_u", (F.col("los_days") - F.col("_lo0")) / unit)
    first, last = (F.floor((F.col("_u") + F.lit(d)) / F.lit(GAUSS_WIDTH)) for d in (-GAUSS_REACH, GAUSS_REACH))
    met = grid.withColumn("_cell", F.explode(F.sequence(first, last))).join(cells, "_cell", "left")
    t = F.col("_u") - (F.col("_cell") + F.lit(0.5)) * F.lit(GAUSS_WIDTH)
    # Hermite functions h0 = exp(-t^2), h1 = 2 t h0, h(n+1) = 2 t hn - 2 n h(n-1), as a fold.
    start = F.struct(F.lit(0.0).alias("before"), F.exp(-t * t).alias("h"), F.lit(0.0).alias("n"), F.lit(0.0).alias("total"))

    def fold(acc: Column, m: Column) -> Column:
        after = F.lit(2.0) * F.col("_t") * acc["h"] - F.lit(2.0) * acc["n"] * acc["before"]
        return F.struct(acc["h"].alias("before"), after.alias("h"), (acc["n"] + 1.0).alias("n"), (acc["total"] + m * acc["h"]).alias("total"))

    part = F.when(F.col("_m").isNotNull(), F.aggregate("_m", start, fold)["total"]).otherwise(F.lit(0.0))
    sums = met.withColumn("_t", t).groupBy("point", "los_days", "_n", "_b").agg(F.sum(part).alias("_sum"))
    norm = F.col("_n").cast("double") * F.col("_b") * F.lit(math.sqrt(2.0 * math.pi))
    return sums.select("point", "los_days", (F.col("_sum") / norm).alias("density"))


def target_prevalence(df: DataFrame, target_col: str = "target_long_stay") -> DataFrame:
    return df.agg(F.avg(F.col(target_col).cast("double")).alias("target_prevalence"), F.count(F.lit(1)).alias("n_rows"))
