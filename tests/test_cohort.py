"""Hand-made edge rows: the two cohort modes differ exactly where documented."""

import datetime as dt

import pytest

from staylens.operators.cohort import build_cohort_python, build_cohort_sql

ADM = (
    "subject_id long, hadm_id long, admittime timestamp_ntz, dischtime timestamp_ntz, admission_type string, "
    "admission_location string, discharge_location string, insurance string, language string, marital_status string, "
    "race string, hospital_expire_flag int"
)
PAT = "subject_id long, gender string, anchor_age int, anchor_year int"


def t(day, hour=0):
    return dt.datetime(2180, 5, day, hour)


def adm(subject, hadm, a, d, typ="EMERGENCY"):
    return (subject, hadm, a, d, typ, "EMERGENCY ROOM", "HOME", "Medicare", "ENGLISH", "SINGLE", "A", 0)


@pytest.fixture(scope="module")
def tables(spark):
    rows = [
        adm(20, 1, t(1), None), adm(20, 1, t(2), t(5)),        # first row lacks discharge
        adm(21, 2, t(1), t(1, 0) - dt.timedelta(days=1)), adm(21, 2, t(2), t(4)),  # first row negative
        adm(10, 3, t(3), t(6)), adm(11, 3, t(3), t(6)),        # exact duplicate times
        adm(22, None, t(1), t(2)), adm(23, None, t(1), t(3)),  # NULL hadm_id
        adm(24, 5, t(4), t(4)),                                # equal times
        adm(None, 6, t(1), t(3)),                              # NULL subject
        adm(25, 7, t(1), t(9)),                                # missing anchor_age
        adm(10, 8, t(2), t(3)),                                # duplicated patient
    ]
    pats = [
        (10, "F", 60, 2180), (10, "M", 61, 2181), (20, "F", 30, 2180), (21, "M", 40, 2180), (11, "M", 50, 2180),
        (None, "F", 70, 2180), (25, "M", None, 2180),
    ]
    return spark.createDataFrame(rows, ADM), spark.createDataFrame(pats, PAT)


def by_hadm(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["hadm_id"], []).append(r)
    return out


def test_sql_mode(tables):
    a, p = tables
    got = by_hadm(build_cohort_sql(a, p))
    assert 1 not in got and 2 not in got and 5 not in got
    assert [r["subject_id"] for r in got[3]] == [10, 10]  # subject 10 first; duplicate patient fans out
    assert len(got[None]) == 1                             # one NULL-id row may survive
    assert got[6][0]["gender"] is None                     # NULL subject does not join
    assert len(got[8]) == 2
    assert got[7][0]["age_at_admit"] is None
    assert got[3][0]["los_days"] == pytest.approx(3.0)


def test_python_mode(tables):
    a, p = tables
    got = by_hadm(build_cohort_python(a, p))
    assert [r["los_days"] for r in got[1]] == [pytest.approx(3.0)]  # the later valid row survives
    assert 2 not in got and 5 not in got and None not in got
    assert len(got[3]) == 1 and got[3][0]["subject_id"] == 10
    assert got[6][0]["gender"] == "F" and got[6][0]["age_at_admit"] == 70  # NULL subject matches NULL patient
    assert len(got[8]) == 1 and got[8][0]["gender"] == "F"  # one demographic row per patient (anchor_year first)


def test_cohort_columns(tables):
    a, p = tables
    assert build_cohort_sql(a, p).columns[-2:] == ["age_at_admit", "los_days"]
    assert len(build_cohort_python(a, p).columns) == 17


def test_missing_column_is_reported(tables):
    a, p = tables
    with pytest.raises(ValueError, match="race"):
        build_cohort_sql(a.drop("race"), p)


def test_null_subjects_are_dealt_over_tasks(spark):
    from pyspark.sql import functions as F

    from staylens.operators.cohort import join_patients_sql

    ids = spark.range(6000).select(
        F.col("id").alias("hadm_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 500).alias("subject_id"), F.current_timestamp().alias("admittime")
    )
    patients = spark.range(500).select(
        F.col("id").alias("subject_id"), F.lit("F").alias("gender"), F.lit(40).alias("anchor_age"), F.lit(2020).alias("anchor_year")
    )
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = join_patients_sql(ids, patients)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 6000 and max(sizes) < 1000  # a third of the keys are NULL
        assert out.where("subject_id IS NULL AND gender IS NOT NULL").count() == 0 and out.where("gender = 'F'").count() == 4000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
