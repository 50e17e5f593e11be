"""SQL users get the reports as temp views."""

from staylens.plans.views import register_views
from staylens.sources.adapter import adapter_relations

from .conftest import SF_SMALL


def test_views(spark):
    adm, pat = adapter_relations(spark, SF_SMALL)
    names = register_views(spark, adm, pat)
    assert set(names) == {"inpatient_cohort", "los_summary_stats", "los_subgroup_summary", "long_stay_outliers"}
    assert spark.sql("SELECT COUNT(*) FROM inpatient_cohort").first()[0] == 790
    row = spark.sql("SELECT n_admissions, long_stay_share_gt_7d FROM los_summary_stats").first()
    assert row[0] == 790 and 0 < row[1] < 1
    top = spark.sql("SELECT MIN(los_dense_rank), COUNT(*) FROM long_stay_outliers").first()
    assert top[0] == 1 and top[1] == 100
    dims = {r[0] for r in spark.sql("SELECT DISTINCT dimension FROM los_subgroup_summary").collect()}
    assert dims == {"admission_type", "insurance", "hospital_expire_flag"}
