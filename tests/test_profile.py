"""Profiling and quality operators on small hand-made cohorts (edge sizes included)."""

import datetime as dt

import numpy as np
import pytest

from staylens.operators import labels as L
from staylens.operators import profile as P
from staylens.operators import quality as Q


def cohort(spark, los, types=None):
    types = types or ["A"] * len(los)
    base = dt.datetime(2180, 1, 1)
    los = [None if v is None else float(v) for v in los]
    types = [str(t) for t in types]
    rows = [(i, i, base, base + dt.timedelta(days=v) if v is not None else None, t, "X", None, None, v) for i, (v, t) in enumerate(zip(los, types))]
    return spark.createDataFrame(
        rows,
        "hadm_id long, subject_id long, admittime timestamp_ntz, dischtime timestamp_ntz, admission_type string, "
        "insurance string, hospital_expire_flag int, admission_location string, los_days double",
    )


def test_one_row_cohort(spark):
    r = P.los_overall_summary(cohort(spark, [3.5])).collect()[0]
    assert r["n_admissions"] == 1 and r["std_los_days"] is None
    assert r["p25_los_days"] == r["p99_los_days"] == r["median_los_days"] == 3.5


def test_empty_cohort(spark):
    c = cohort(spark, [1.0]).limit(0)
    r = P.los_overall_summary(c).collect()[0]
    assert r["n_admissions"] == 0 and r["mean_los_days"] is None and r["long_stay_p90_threshold"] is None
    cmp_rows = L.long_stay_definition_comparison(c).collect()
    assert [x["positive_rate"] for x in cmp_rows] == [0.0, 0.0]
    assert [x["prevalence"] for x in L.label_prevalence_table(c).collect()] == [None, None]
    rec = L.recommend_long_stay_definition(L.long_stay_definition_comparison(c)).collect()[0]
    assert rec["recommended_label_mode"] == "gte_p90"
    assert P.bed_day_concentration(c).collect()[0]["long_stay_admission_share"] is None


def test_summary_matches_numpy(spark):
    rng = np.random.default_rng(1)
    los = list(np.round(rng.gamma(2, 3, 500), 3))
    r = P.los_summary_table(cohort(spark, los), rows_per_bucket=40).collect()[0]
    a = np.array(los)
    assert r["median_los_days"] == pytest.approx(np.median(a))
    assert r["p90_los_days"] == pytest.approx(np.percentile(a, 90))
    assert r["std_los_days"] == pytest.approx(a.std(ddof=1))


def test_single_pass_subgroups_equal_union(spark):
    rng = np.random.default_rng(2)
    los = list(np.round(rng.gamma(2, 3, 300), 2))
    types = list(rng.choice(["A", "B", "C"], 300, p=[0.7, 0.2, 0.1]))
    c = cohort(spark, los, types)
    one = sorted(map(tuple, P.subgroup_summary(c, ["admission_type", "insurance"], rows_per_bucket=25).collect()))
    union = sorted(map(tuple, P.subgroup_summary_union(c, ["admission_type", "insurance"]).collect()))
    assert [a[:3] for a in one] == [b[:3] for b in union]
    for a, b in zip(one, union):
        assert a[3:] == pytest.approx(b[3:])


def test_histogram_covers_all_rows(spark):
    los = [0.5, 1.0, 1.0, 2.0, 9.5, 10.0]
    h = P.los_histogram(cohort(spark, los), bins=5).orderBy("bin").collect()
    assert [r["n_admissions"] for r in h] == [4, 0, 0, 0, 2]  # width (10 - 0.5) / 5 = 1.9
    assert h[-1]["bin_end"] == pytest.approx(10.0)


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(5)
    los = list(rng.normal(10, 2, 400))
    d = P.los_density(cohort(spark, los), points=200).orderBy("point").collect()
    xs = np.array([r["los_days"] for r in d])
    ys = np.array([r["density"] for r in d])
    assert 0.9 < np.trapezoid(ys, xs) < 1.01
    assert P.los_density(cohort(spark, [2.0, 2.0, 2.0])).count() == 0


def test_quality_reports(spark):
    c = cohort(spark, [1.0, None, 3.0])
    miss = {r["column"]: r["missing_count"] for r in Q.missing_value_report(c, ["los_days", "hadm_id"]).collect()}
    assert miss == {"los_days": 1, "hadm_id": 0}
    dup = Q.duplicate_admission_report(c.unionByName(c.limit(1))).collect()[0]
    assert dup["duplicate_rows"] == 1
    checks = {r["check"]: r["violations"] for r in Q.integrity_checks(c).collect()}
    assert checks["positive_los"] == 1
    with pytest.raises(AssertionError):
        Q.assert_integrity(Q.integrity_checks(c))


def test_density_equals_the_plain_sum(spark):
    import math

    import numpy as np

    from staylens.operators.profile import los_density

    rng = np.random.default_rng(5)
    for values in (np.concatenate((rng.gamma(2, 3, 400), [900.0, 900.0])), rng.normal(1e3, 0.5, 50), np.array([1.0, 2.0])):
        n, h = len(values), values.std(ddof=1) * len(values) ** -0.2
        got = los_density(spark.createDataFrame([(float(v),) for v in values], "los_days double"), points=60).orderBy("point").collect()
        grid = np.array([r["los_days"] for r in got])
        want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) / (n * h * math.sqrt(2 * math.pi))
        assert len(got) == 60 and np.abs(np.array([r["density"] for r in got]) - want).max() <= 1e-11 / h
    assert los_density(spark.createDataFrame([(1.0,), (1.0,), (None,)], "los_days double")).count() == 0
