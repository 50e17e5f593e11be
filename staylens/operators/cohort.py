"""Cohort construction: one row per admission with length of stay and age.

Two semantics are kept as named modes:

* ``sql``: first row per ``hadm_id`` (admit, discharge NULLS LAST, then subject) over
  all rows, then the validity filter.  An admission whose first row is invalid is
  dropped entirely; NULL ``hadm_id`` rows form one group.  Patients join with ``=``.
* ``python``: one demographic row per patient, a NULL-safe left join, then rows with
  NULL ``hadm_id``/times are dropped, the earliest row per ``hadm_id`` kept, then
  ``los > 0``.  A later valid row can survive where the first one was invalid.

"Keep the first row" uses a window with ``row_number() = 1``; Spark inserts a partial
``WindowGroupLimit`` before the shuffle, so a heavily duplicated id sends at most one
row per map task.  Ties are broken on every remaining column so the result never
depends on file or shuffle order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens import config as C
from staylens.functions.columns import age_at_admit, los_days
from staylens.sources.tables import validate_required_columns

PATIENT_COLUMNS = ("subject_id", "gender", "anchor_age", "anchor_year")
# Tie-break order after the reference keys (fixed, documented; NULLS LAST each).
ADMISSION_TIEBREAK = (
    "admission_type",
    "admission_location",
    "discharge_location",
    "insurance",
    "language",
    "marital_status",
    "race",
    "hospital_expire_flag",
)
PATIENT_TIEBREAK = ("anchor_year", "anchor_age", "gender")


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order`` (window row_number = 1)."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _asc_last(names: Sequence[str], present: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in names if c in present]


def dedup_admissions_sql(admissions: DataFrame) -> DataFrame:
    order = _asc_last(("admittime", "dischtime", "subject_id"), admissions.columns)
    order += _asc_last(ADMISSION_TIEBREAK, admissions.columns)
    return keep_first(admissions, ["hadm_id"], order)


def dedup_patients(patients: DataFrame) -> DataFrame:
    """One demographic row per ``subject_id`` (the four columns only)."""
    validate_required_columns(patients, C.REQUIRED_PATIENTS_COLUMNS, "patients")
    demo = patients.select(*PATIENT_COLUMNS)
    return keep_first(demo, ["subject_id"], _asc_last(PATIENT_TIEBREAK, demo.columns))


# Parts into which rows without a subject are dealt before a join.
NULL_SALTS = 4096


def join_patients_sql(admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """LEFT JOIN patients ON subject_id (plain equality; duplicates fan out as in SQL).

    AQE turns this into a broadcast join when the patient side is small at runtime and
    splits a skewed subject partition otherwise.  A NULL subject meets nobody, so rows
    without one are dealt out by a salt instead of meeting in one task."""
    # Always 0, but not a literal: the optimizer would take a constant out of the join keys.
    p = patients.select(*PATIENT_COLUMNS).withColumn("_salt", F.pmod(F.col("subject_id"), F.lit(1)).cast("int"))
    spread = F.pmod(F.xxhash64("hadm_id", "admittime"), F.lit(NULL_SALTS)).cast("int")
    salted = admissions.withColumn("_salt", F.when(F.col("subject_id").isNull(), spread).otherwise(F.lit(0)))
    return salted.join(p, on=["subject_id", "_salt"], how="left").drop("_salt")


def merge_admissions_patients(admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Left join to one row per patient where a NULL subject matches a NULL subject."""
    validate_required_columns(admissions, C.REQUIRED_ADMISSIONS_COLUMNS, "admissions")
    demo = dedup_patients(patients).withColumnRenamed("subject_id", "_p_subject_id")
    joined = admissions.join(demo, admissions["subject_id"].eqNullSafe(demo["_p_subject_id"]), "left")
    return joined.drop("_p_subject_id")


def derive_stay_columns(df: DataFrame) -> DataFrame:
    cols = {"los_days": los_days("admittime", "dischtime")}
    if {"anchor_age", "anchor_year", "admittime"}.issubset(df.columns):
        cols["age_at_admit"] = age_at_admit("admittime")
    else:
        cols["age_at_admit"] = F.lit(None).cast("int")
    return df.withColumns(cols)


def valid_stay() -> Column:
    return (
        F.col("admittime").isNotNull()
        & F.col("dischtime").isNotNull()
        & (F.col("dischtime") > F.col("admittime"))
        & (F.col("los_days") > 0)
    )


def select_cohort_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in C.COHORT_COLUMNS if c in df.columns])


def build_cohort_sql(admissions: DataFrame, patients: DataFrame | None = None) -> DataFrame:
    """SQL-mode cohort.  Without ``patients`` the demographic columns are omitted
    (the summary queries need none and skip the join)."""
    validate_required_columns(admissions, C.REQUIRED_ADMISSIONS_COLUMNS, "admissions")
    first = dedup_admissions_sql(admissions)
    joined = join_patients_sql(first, patients) if patients is not None else first
    return select_cohort_columns(derive_stay_columns(joined).where(valid_stay()))


def build_cohort_python(admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Python-mode cohort.  Each admission meets at most one demographic row, so the rows
    are filtered and deduplicated on admission columns first and joined after."""
    validate_required_columns(admissions, C.REQUIRED_ADMISSIONS_COLUMNS, "admissions")
    present = admissions.where(F.col("hadm_id").isNotNull() & F.col("admittime").isNotNull() & F.col("dischtime").isNotNull())
    order = _asc_last(("admittime", "dischtime", "subject_id"), present.columns)
    order += _asc_last(ADMISSION_TIEBREAK, present.columns)
    first = keep_first(present, ["hadm_id"], order).where(los_days("admittime", "dischtime") > 0)
    return select_cohort_columns(derive_stay_columns(merge_admissions_patients(first, patients)))


def build_inpatient_cohort(admissions: DataFrame, patients: DataFrame, mode: str = "sql") -> DataFrame:
    if mode == "sql":
        return build_cohort_sql(admissions, patients)
    if mode == "python":
        return build_cohort_python(admissions, patients)
    raise ValueError("mode must be 'sql' or 'python'")


def order_cohort(cohort: DataFrame) -> DataFrame:
    """ORDER BY admittime (hadm_id second, so a hot admit time can still be range-split)."""
    return cohort.orderBy(F.col("admittime").asc_nulls_last(), F.col("hadm_id").asc_nulls_last())
