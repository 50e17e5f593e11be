"""Temp views for SQL users: the three standalone SQL reports as ``spark.sql`` tables.

``register_views(spark, admissions, patients)`` creates

* ``inpatient_cohort``      – cohort, SQL mode, 17 columns
* ``los_summary_stats``     – overall statistics, thresholds and shares (one row)
* ``los_subgroup_summary``  – subgroup summary over the three dimensions
* ``long_stay_outliers``    – outlier review with dense and percent ranks

Each view is the plan of the corresponding operator, so ``spark.sql("SELECT ... FROM
long_stay_outliers WHERE ...")`` is optimized together with the operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staylens import config as C
from staylens.operators.cohort import build_cohort_sql
from staylens.operators.outliers import long_stay_outlier_review
from staylens.operators.profile import los_overall_summary, subgroup_summary


def register_views(
    spark: SparkSession,
    admissions: DataFrame,
    patients: DataFrame,
    top_n: int = C.OUTLIER_TOP_N,
    min_percent_rank: float = C.OUTLIER_MIN_PERCENT_RANK,
    **prefix_kw,
) -> list[str]:
    cohort = build_cohort_sql(admissions, patients)
    summary_input = build_cohort_sql(admissions)
    views = {
        "inpatient_cohort": cohort,
        "los_summary_stats": los_overall_summary(summary_input, **prefix_kw),
        "los_subgroup_summary": subgroup_summary(summary_input, **prefix_kw),
        "long_stay_outliers": long_stay_outlier_review(cohort, top_n, min_percent_rank, **prefix_kw),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
