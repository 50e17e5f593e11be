"""Oracle SQL (DuckDB dialect) for the registered queries.

Every statement starts from the driver tables through the same adapter relations as the
Spark plans (the adapter text is plain SQL that both engines run), then spells the
operator the straightforward way: windows over whole tables, PERCENTILE_CONT, cross
joins with one-row CTEs.  Doubles are rounded to 6 places, counts are BIGINT and small
integers INTEGER, matching the Spark schemas.
"""

from __future__ import annotations

from staylens import config as C
from staylens.plans.oracle_models import model_sql


# --- adapter relations (shared with the Spark adapter; see FIXTURES.md) ---------------
ADAPTER = """
ev AS (
  SELECT event_id, user_id, event_type, ts,
         LEAD(ts, 14) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nts
  FROM events
),
admissions AS (
  SELECT user_id AS subject_id, event_id AS hadm_id, ts AS admittime, nts AS dischtime,
         event_type AS admission_type,
         CASE event_id % 5 WHEN 0 THEN 'TRANSFER FROM HOSPITAL' WHEN 1 THEN 'PHYSICIAN REFERRAL'
              WHEN 2 THEN 'EMERGENCY ROOM' WHEN 3 THEN ' CLINIC ' END AS admission_location,
         CASE event_id % 3 WHEN 0 THEN 'HOME' WHEN 1 THEN 'SNF' END AS discharge_location,
         CASE event_id % 4 WHEN 0 THEN 'Medicare' WHEN 1 THEN 'Medicaid' WHEN 2 THEN 'Private' END AS insurance,
         CASE WHEN event_id % 7 = 0 THEN '' ELSE 'ENGLISH' END AS language,
         CASE event_id % 6 WHEN 0 THEN 'MARRIED' WHEN 1 THEN 'SINGLE ' WHEN 2 THEN 'WIDOWED' END AS marital_status,
         CASE user_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END AS race,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS hospital_expire_flag
  FROM ev
  UNION ALL
  SELECT user_id, event_id, ts + INTERVAL 1 HOUR, nts, event_type, 'CLINIC', 'HOME', 'Private',
         'ENGLISH', 'SINGLE', 'A', 0
  FROM ev WHERE event_id % 50 = 0
  UNION ALL
  SELECT user_id, event_id + 1000000000, ts, ts - INTERVAL 1 DAY, event_type, 'CLINIC', 'HOME',
         'Private', 'ENGLISH', 'SINGLE', 'A', 0
  FROM ev WHERE event_id % 100 = 1
),
patients AS (
  SELECT c_custkey AS subject_id,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(18 + c_custkey % 75 AS INT) AS anchor_age,
         CAST(2020 + c_custkey % 4 AS INT) AS anchor_year
  FROM customer WHERE c_custkey % 10 <> 9
)"""

LOS = "CAST(epoch_us(dischtime) - epoch_us(admittime) AS DOUBLE) / CAST(86400000000 AS DOUBLE)"
AGE = "CAST(anchor_age + (CAST(EXTRACT(YEAR FROM admittime) AS INTEGER) - anchor_year) AS INTEGER)"
ADM_TIE = ", ".join(f"{c} NULLS LAST" for c in ("admission_type", "admission_location", "discharge_location", "insurance", "language", "marital_status", "race", "hospital_expire_flag"))
PAT_TIE = "anchor_year NULLS LAST, anchor_age NULLS LAST, gender NULLS LAST"
COHORT_COLS = ", ".join(C.COHORT_COLUMNS)


def _norm(c: str) -> str:
    t = f"trim(COALESCE(CAST({c} AS VARCHAR), 'Unknown'))"
    return f"CASE WHEN {t} = '' THEN 'Unknown' ELSE {t} END"


COHORTS = f"""
adm_first AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT a.*, ROW_NUMBER() OVER (PARTITION BY hadm_id ORDER BY admittime NULLS LAST, dischtime NULLS LAST,
           subject_id NULLS LAST, {ADM_TIE}) AS rn
    FROM admissions a) WHERE rn = 1
),
cohort_nj AS (
  SELECT *, {LOS} AS los_days FROM adm_first
  WHERE admittime IS NOT NULL AND dischtime IS NOT NULL AND dischtime > admittime
),
cohort_sql AS (
  SELECT {COHORT_COLS} FROM (
    SELECT f.* , p.gender, p.anchor_age, p.anchor_year FROM adm_first f LEFT JOIN patients p ON f.subject_id = p.subject_id
  ) j, LATERAL (SELECT {AGE} AS age_at_admit, {LOS} AS los_days)
  WHERE admittime IS NOT NULL AND dischtime IS NOT NULL AND dischtime > admittime AND los_days > 0
),
pat_first AS (
  SELECT subject_id, gender, anchor_age, anchor_year FROM (
    SELECT subject_id, gender, anchor_age, anchor_year,
           ROW_NUMBER() OVER (PARTITION BY subject_id ORDER BY {PAT_TIE}) AS rn FROM patients) WHERE rn = 1
),
py_first AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT m.*, ROW_NUMBER() OVER (PARTITION BY hadm_id ORDER BY admittime NULLS LAST, dischtime NULLS LAST,
           subject_id NULLS LAST, {ADM_TIE}) AS rn
    FROM (SELECT a.*, p.gender, p.anchor_age, p.anchor_year FROM admissions a
          LEFT JOIN pat_first p ON a.subject_id IS NOT DISTINCT FROM p.subject_id) m
    WHERE hadm_id IS NOT NULL AND admittime IS NOT NULL AND dischtime IS NOT NULL) WHERE rn = 1
),
cohort_py AS (
  SELECT {COHORT_COLS} FROM py_first, LATERAL (SELECT {AGE} AS age_at_admit, {LOS} AS los_days) WHERE los_days > 0
),
cohort_clean AS (
  SELECT * REPLACE ({_norm('gender')} AS gender, {_norm('race')} AS race, {_norm('insurance')} AS insurance,
                    {_norm('marital_status')} AS marital_status, {_norm('admission_type')} AS admission_type,
                    {_norm('language')} AS language)
  FROM cohort_py
),
th AS (SELECT quantile_cont(los_days, 0.9) AS p90 FROM cohort_clean),
labeled AS (
  SELECT c.*, CASE WHEN los_days > 7.0 THEN 1 ELSE 0 END AS long_stay_gt_7d,
         CASE WHEN los_days >= th.p90 THEN 1 ELSE 0 END AS long_stay_gte_p90, th.p90 AS p90_threshold
  FROM cohort_clean c CROSS JOIN th
),
featured AS (
  SELECT c.* REPLACE (CAST(age_at_admit AS DOUBLE) AS age_at_admit),
         CAST(hour(admittime) AS INTEGER) AS admit_hour,
         CAST(isodow(admittime) - 1 AS INTEGER) AS admit_dayofweek,
         CAST(month(admittime) AS INTEGER) AS admit_month,
         CASE WHEN isodow(admittime) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend_admit,
         CASE WHEN age_at_admit >= 0 AND age_at_admit <= 39 THEN '18-39'
              WHEN age_at_admit > 39 AND age_at_admit <= 49 THEN '40-49'
              WHEN age_at_admit > 49 AND age_at_admit <= 59 THEN '50-59'
              WHEN age_at_admit > 59 AND age_at_admit <= 69 THEN '60-69'
              WHEN age_at_admit > 69 AND age_at_admit <= 79 THEN '70-79'
              WHEN age_at_admit > 79 AND age_at_admit <= 120 THEN '80+'
              ELSE 'Unknown' END AS age_band
  FROM cohort_clean c
)"""


def _heuristic(emergency: tuple[str, ...], urgent: tuple[str, ...]) -> str:
    def lst(vals):
        return ", ".join("'" + v + "'" for v in vals)

    age = f"CASE WHEN age_at_admit >= 75 THEN CAST({C.RISK_AGE_75} AS DOUBLE) WHEN age_at_admit >= 65 THEN CAST({C.RISK_AGE_65} AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END"
    typ = (f"CASE WHEN admission_type IN ({lst(emergency)}) THEN CAST({C.RISK_EMERGENCY} AS DOUBLE) "
           f"WHEN admission_type IN ({lst(urgent)}) THEN CAST({C.RISK_URGENT} AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END")
    wk = f"CASE WHEN isodow(admittime) IN (6, 7) THEN CAST({C.RISK_WEEKEND} AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END"
    ins = f"CASE WHEN insurance IN ({lst(C.RISK_INSURANCE_VALUES)}) THEN CAST({C.RISK_INSURANCE} AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END"
    total = f"((((CAST({C.RISK_BASE} AS DOUBLE) + {age}) + {typ}) + {wk}) + {ins})"
    return f"LEAST(GREATEST({total}, CAST({C.RISK_CLIP_LOW} AS DOUBLE)), CAST({C.RISK_CLIP_HIGH} AS DOUBLE))"


SCORED = f"""
scored AS (
  SELECT hadm_id, m.model, CASE WHEN los_days > 7.0 THEN 1 ELSE 0 END AS y_true,
         CASE WHEN m.model = 'score_hash' THEN CAST((hadm_id * 7919) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE)
              WHEN m.model = 'score_tail' AND los_days > 7 THEN CAST(0.3 AS DOUBLE) + CAST(0.7 AS DOUBLE) * (CAST((hadm_id * 7919) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE))
              WHEN m.model = 'score_tail' THEN CAST((hadm_id * 7919) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE)
              ELSE ROUND({_heuristic(('error',), ('purchase',))}, 6) END AS y_score
  FROM cohort_sql CROSS JOIN (VALUES ('score_hash'), ('score_rule'), ('score_tail')) m(model)
),
scored2 AS (SELECT hadm_id, model, y_true, CASE WHEN y_score > 0.5 THEN 1 ELSE 0 END AS y_pred, y_score FROM scored),
sc AS (
  SELECT model, y_score, CAST(SUM(y_true) AS BIGINT) AS pos, CAST(COUNT(*) - SUM(y_true) AS BIGINT) AS neg
  FROM scored2 GROUP BY model, y_score
),
cur AS (
  SELECT model, y_score, pos, neg,
         CAST(SUM(pos) OVER (PARTITION BY model ORDER BY y_score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
         CAST(SUM(neg) OVER (PARTITION BY model ORDER BY y_score DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
         ROW_NUMBER() OVER (PARTITION BY model ORDER BY y_score DESC) AS rk,
         CAST(SUM(pos) OVER (PARTITION BY model) AS BIGINT) AS np_,
         CAST(SUM(neg) OVER (PARTITION BY model) AS BIGINT) AS nn_
  FROM sc
),
bm AS (
  SELECT c.model,
         CAST(c.tp + c.tn AS DOUBLE) / CAST(c.n AS DOUBLE) AS accuracy,
         CASE WHEN c.tp + c.fp > 0 THEN CAST(c.tp AS DOUBLE) / CAST(c.tp + c.fp AS DOUBLE) ELSE 0.0 END AS precision,
         CASE WHEN c.tp + c.fn > 0 THEN CAST(c.tp AS DOUBLE) / CAST(c.tp + c.fn AS DOUBLE) ELSE 0.0 END AS recall,
         CASE WHEN r.np_ > 0 AND r.nn_ > 0 THEN r.auc_s / CAST(r.np_ * r.nn_ AS DOUBLE) END AS roc_auc,
         CASE WHEN r.np_ > 0 THEN r.ap_s ELSE 0.0 END AS pr_auc,
         c.brier AS brier_score
  FROM (SELECT model, COUNT(*) AS n,
               SUM(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS tp,
               SUM(CASE WHEN y_true = 0 AND y_pred = 0 THEN 1 ELSE 0 END) AS tn,
               SUM(CASE WHEN y_true = 0 AND y_pred = 1 THEN 1 ELSE 0 END) AS fp,
               SUM(CASE WHEN y_true = 1 AND y_pred = 0 THEN 1 ELSE 0 END) AS fn,
               AVG(POW(y_score - CAST(y_true AS DOUBLE), 2)) AS brier
        FROM scored2 GROUP BY model) c
  LEFT JOIN (SELECT model, MAX(np_) AS np_, MAX(nn_) AS nn_,
                    SUM(CAST(neg AS DOUBLE) * (CAST(tp - pos AS DOUBLE) + 0.5 * CAST(pos AS DOUBLE))) AS auc_s,
                    SUM((CAST(pos AS DOUBLE) / CAST(np_ AS DOUBLE)) * (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE))) AS ap_s
             FROM cur GROUP BY model) r ON c.model = r.model
),
bm2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN (2.0 * precision * recall) / (precision + recall) ELSE 0.0 END AS f1 FROM bm),
grid AS (SELECT CAST(t AS DOUBLE) AS threshold FROM (VALUES {", ".join(f"({t!r})" for t in C.TUNING_THRESHOLDS)}) g(t)),
tun0 AS (
  SELECT s.model, g.threshold,
         CAST(SUM(CASE WHEN y_true = 1 AND y_score >= g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(SUM(CASE WHEN y_true = 0 AND y_score < g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(SUM(CASE WHEN y_true = 0 AND y_score >= g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(SUM(CASE WHEN y_true = 1 AND y_score < g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM scored2 s CROSS JOIN grid g GROUP BY s.model, g.threshold
),
tun1 AS (
  SELECT *,
         CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) ELSE 0.0 END AS precision,
         CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) ELSE 0.0 END AS recall,
         CASE WHEN tn + fp > 0 THEN CAST(tn AS DOUBLE) / CAST(tn + fp AS DOUBLE) ELSE 0.0 END AS specificity
  FROM tun0
),
tuning AS (
  SELECT model, threshold, precision, recall,
         CASE WHEN precision + recall > 0 THEN (2.0 * precision * recall) / (precision + recall) ELSE 0.0 END AS f1,
         specificity, recall + specificity - 1.0 AS youden_j, tp, tn, fp, fn
  FROM tun1
),
bal AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY f1 DESC, youden_j DESC, threshold ASC) AS rk FROM tuning) WHERE rk = 1
),
rec AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY CASE WHEN recall >= 0.8 THEN 1 ELSE 0 END DESC,
             CASE WHEN recall >= 0.8 THEN precision END DESC NULLS LAST, CASE WHEN recall >= 0.8 THEN f1 END DESC NULLS LAST,
             recall DESC, precision DESC, threshold ASC) AS rk
    FROM tuning) WHERE rk = 1
),
sel AS (
  SELECT b.model, b.threshold AS balanced_threshold, b.f1 AS balanced_f1, b.recall AS balanced_recall, b.precision AS balanced_precision,
         r.threshold AS recall_priority_threshold, r.f1 AS recall_priority_f1, r.recall AS recall_priority_recall,
         r.precision AS recall_priority_precision
  FROM bal b JOIN rec r ON b.model = r.model
),
marked AS (
  SELECT t.*, CASE WHEN t.threshold = s.balanced_threshold THEN 1 ELSE 0 END AS is_balanced,
         CASE WHEN t.threshold = s.recall_priority_threshold THEN 1 ELSE 0 END AS is_recall_priority
  FROM tuning t LEFT JOIN sel s ON t.model = s.model
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def _r(expr: str, alias: str) -> str:
    return f"(ROUND({expr}, 6) + 0.0) AS {alias}"


BASE = _with(ADAPTER, COHORTS)
BASE_SCORED = _with(ADAPTER, COHORTS, SCORED)

_PCTS = [("p25_los_days", 0.25), ("median_los_days", 0.5), ("p75_los_days", 0.75), ("p90_los_days", 0.9), ("p95_los_days", 0.95), ("p99_los_days", 0.99)]


def _pct_cols(col: str = "los_days") -> str:
    return ", ".join(_r(f"quantile_cont({col}, {p})", n) for n, p in _PCTS)


def _linspace_sql(n_bins: int = 10) -> str:
    step = 1.0 / n_bins
    vals = [i * step for i in range(n_bins)] + [1.0]
    return "[" + ", ".join(f"CAST('{v!r}' AS DOUBLE)" for v in vals) + "]"


SQL: dict[str, str] = {}

SQL["cohort_sql"] = BASE + f"SELECT * REPLACE ({_r('los_days', 'los_days')}) FROM cohort_sql ORDER BY admittime, hadm_id"
SQL["cohort_py"] = BASE + f"SELECT * REPLACE ({_r('los_days', 'los_days')}) FROM cohort_py"
SQL["normalized_categories"] = BASE + "SELECT hadm_id, gender, race, insurance, marital_status, admission_type, language, admission_location FROM cohort_clean"

SQL["los_overall"] = BASE + f"""
, t AS (SELECT quantile_cont(los_days, 0.9) AS p90 FROM cohort_nj)
SELECT COUNT(*) AS n_admissions, {_r('AVG(los_days)', 'mean_los_days')}, {_r('STDDEV_SAMP(los_days)', 'std_los_days')},
       {_r('MIN(los_days)', 'min_los_days')}, {_pct_cols()}, {_r('MAX(los_days)', 'max_los_days')},
       {_r('CAST(7.0 AS DOUBLE)', 'long_stay_days_threshold')}, {_r('MAX(t.p90)', 'long_stay_p90_threshold')},
       {_r('AVG(CASE WHEN los_days > 7.0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)', 'long_stay_share_gt_7d')},
       {_r('AVG(CASE WHEN los_days >= t.p90 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)', 'long_stay_share_gte_p90')}
FROM cohort_nj CROSS JOIN t"""

SQL["los_summary"] = BASE + f"""
SELECT COUNT(*) AS n_admissions, {_r('AVG(los_days)', 'mean_los_days')}, {_r('STDDEV_SAMP(los_days)', 'std_los_days')},
       {_r('MIN(los_days)', 'min_los_days')}, {_pct_cols()}, {_r('MAX(los_days)', 'max_los_days')}
FROM cohort_clean WHERE los_days IS NOT NULL"""

SQL["los_percentiles"] = BASE + " UNION ALL ".join(
    f"SELECT {_r(f'CAST({p} AS DOUBLE)', 'percentile')}, {_r(f'quantile_cont(los_days, {p})', 'los_days')} FROM cohort_clean"
    for p in C.PERCENTILE_TABLE_DEFAULT
)

_SUB = " UNION ALL ".join(
    f"""SELECT '{d}' AS dimension, {v} AS dimension_value, COUNT(*) AS n_admissions, {_r('AVG(los_days)', 'mean_los_days')},
       {_r('quantile_cont(los_days, 0.5)', 'median_los_days')},
       {_r('AVG(CASE WHEN los_days > 7.0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)', 'long_stay_share_gt_7d')},
       {_r('AVG(CASE WHEN los_days >= t.p90 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)', 'long_stay_share_gte_p90')}
    FROM cohort_nj CROSS JOIN t GROUP BY {v}"""
    for d, v in (
        ("admission_type", "COALESCE(admission_type, 'Unknown')"),
        ("insurance", "COALESCE(insurance, 'Unknown')"),
        ("hospital_expire_flag", "COALESCE(CAST(hospital_expire_flag AS VARCHAR), 'Unknown')"),
    )
)
SQL["subgroup_summary"] = BASE + f", t AS (SELECT quantile_cont(los_days, 0.9) AS p90 FROM cohort_nj)\nSELECT * FROM ({_SUB}) ORDER BY dimension, long_stay_share_gte_p90 DESC, n_admissions DESC"

SQL["subgroup_summary_union"] = SQL["subgroup_summary"]  # same relation, UNION ALL spelling on the Spark side
SQL["subgroup_rates"] = BASE + " UNION ALL ".join(
    f"""SELECT '{t}' AS definition, '{g}' AS group_column, CAST({g} AS VARCHAR) AS group_value, COUNT({t}) AS n_admissions,
       {_r(f'AVG(CAST({t} AS DOUBLE))', 'long_stay_rate')} FROM labeled GROUP BY {g}"""
    for t in ("long_stay_gt_7d", "long_stay_gte_p90")
    for g in ("admission_type", "insurance", "hospital_expire_flag")
)
SQL["subgroup_share"] = BASE + f"SELECT insurance, {_r('AVG(CAST(long_stay_gt_7d AS DOUBLE))', 'long_stay_gt_7d')} FROM labeled GROUP BY insurance"

_COUNTS = """
, k AS (SELECT COUNT(*) AS total, SUM(long_stay_gt_7d) AS fixed_n, MAX(p90_threshold) AS p, SUM(long_stay_gte_p90) AS pct_n FROM labeled)"""
SQL["definition_comparison"] = BASE + _COUNTS + f"""
SELECT 'LOS > 7 days' AS definition, {_r('CAST(7.0 AS DOUBLE)', 'threshold_value_days')}, CAST(COALESCE(fixed_n, 0) AS BIGINT) AS positive_count,
       {_r('CASE WHEN total > 0 THEN CAST(COALESCE(fixed_n, 0) AS DOUBLE) / CAST(total AS DOUBLE) ELSE 0.0 END', 'positive_rate')} FROM k
UNION ALL
SELECT 'LOS >= p90', {_r('p', 'threshold_value_days')}, CAST(COALESCE(pct_n, 0) AS BIGINT),
       {_r('CASE WHEN total > 0 THEN CAST(COALESCE(pct_n, 0) AS DOUBLE) / CAST(total AS DOUBLE) ELSE 0.0 END', 'positive_rate')} FROM k"""

SQL["label_prevalence"] = BASE + _COUNTS + f"""
SELECT 'gt_7d' AS label_mode, 'LOS > 7 days' AS definition, {_r('CAST(7.0 AS DOUBLE)', 'threshold_value')},
       CAST(COALESCE(fixed_n, 0) AS BIGINT) AS positive_count,
       {_r('CASE WHEN total > 0 THEN CAST(COALESCE(fixed_n, 0) AS DOUBLE) / CAST(total AS DOUBLE) END', 'prevalence')},
       'High' AS business_clarity, '{C.LABEL_NOTE["gt_7d"]}' AS interpretability_note FROM k
UNION ALL
SELECT 'gte_p90', 'LOS >= p90', {_r('p', 'threshold_value')}, CAST(COALESCE(pct_n, 0) AS BIGINT),
       {_r('CASE WHEN total > 0 THEN CAST(COALESCE(pct_n, 0) AS DOUBLE) / CAST(total AS DOUBLE) END', 'prevalence')},
       'Medium', '{C.LABEL_NOTE["gte_p90"]}' FROM k"""

SQL["label_recommendation"] = BASE + _COUNTS + f"""
, r AS (SELECT CASE WHEN total > 0 THEN CAST(COALESCE(fixed_n, 0) AS DOUBLE) / CAST(total AS DOUBLE) ELSE 0.0 END AS rate FROM k)
SELECT CASE WHEN rate >= 0.05 AND rate <= 0.5 THEN 'gt_7d' ELSE 'gte_p90' END AS recommended_label_mode,
       {_r('rate', 'fixed_positive_rate')},
       CASE WHEN rate >= 0.05 AND rate <= 0.5 THEN '{C.RECOMMEND_FIXED_TEXT}' ELSE '{C.RECOMMEND_PERCENTILE_TEXT}' END AS recommendation
FROM r"""

SQL["outlier_review"] = BASE + f"""
, t AS (SELECT quantile_cont(los_days, 0.9) AS p90_los_days FROM cohort_sql),
ranked AS (
  SELECT c.*, DENSE_RANK() OVER (ORDER BY c.los_days DESC) AS los_dense_rank,
         PERCENT_RANK() OVER (ORDER BY c.los_days) AS los_percent_rank, t.p90_los_days,
         CASE WHEN c.los_days > 7.0 THEN 1 ELSE 0 END AS is_long_stay_gt_7d,
         CASE WHEN c.los_days >= t.p90_los_days THEN 1 ELSE 0 END AS is_long_stay_gte_p90
  FROM cohort_sql c CROSS JOIN t
)
SELECT {COHORT_COLS.replace('los_days', _r('los_days', 'los_days'))}, {_r('p90_los_days', 'p90_los_days')},
       is_long_stay_gt_7d, is_long_stay_gte_p90, CAST(los_dense_rank AS BIGINT) AS los_dense_rank, {_r('los_percent_rank', 'los_percent_rank')}
FROM ranked WHERE los_dense_rank <= 100 OR los_percent_rank >= 0.99
ORDER BY los_days DESC, hadm_id"""

SQL["bed_day_concentration"] = BASE + f"""
SELECT COUNT(*) AS n_admissions, CAST(COUNT(*) FILTER (WHERE los_days > 7.0) AS BIGINT) AS long_stay_admissions,
       {_r('CAST(COUNT(*) FILTER (WHERE los_days > 7.0) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)', 'long_stay_admission_share')},
       {_r('SUM(los_days)', 'total_bed_days')},
       {_r('COALESCE(SUM(los_days) FILTER (WHERE los_days > 7.0), 0.0)', 'long_stay_bed_days')},
       {_r('COALESCE(SUM(los_days) FILTER (WHERE los_days > 7.0), 0.0) / SUM(los_days)', 'long_stay_bed_day_share')}
FROM cohort_clean"""

SQL["bed_day_by_location"] = BASE + f"""
, per AS (
  SELECT COALESCE(CAST(admission_location AS VARCHAR), 'Unknown') AS group_value, COUNT(*) AS n_admissions,
         AVG(CASE WHEN los_days > 7.0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END) AS long_stay_rate,
         SUM(los_days) AS bed_days, COALESCE(SUM(los_days) FILTER (WHERE los_days > 7.0), 0.0) AS long_stay_bed_days
  FROM cohort_clean GROUP BY 1
), tot AS (SELECT SUM(n_admissions) AS n_, SUM(long_stay_bed_days) AS lbd FROM per)
SELECT 'admission_location' AS group_column, group_value, n_admissions,
       {_r('CAST(n_admissions AS DOUBLE) / CAST(n_ AS DOUBLE)', 'admission_share')}, {_r('long_stay_rate', 'long_stay_rate')},
       {_r('bed_days', 'bed_days')}, {_r('long_stay_bed_days', 'long_stay_bed_days')},
       {_r('CASE WHEN lbd > 0 THEN long_stay_bed_days / lbd END', 'long_stay_bed_day_share')}
FROM per CROSS JOIN tot"""

SQL["calendar_subgroup"] = BASE + f"""
SELECT admit_period, COUNT(*) AS n_admissions, {_r('quantile_cont(los_days, 0.5)', 'median_los_days')},
       {_r('AVG(CASE WHEN los_days > 7.0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)', 'long_stay_rate')}
FROM (SELECT los_days, CASE WHEN isodow(admittime) >= 5 THEN 'Fri-Sun' WHEN admittime IS NOT NULL THEN 'Mon-Thu' END AS admit_period
      FROM cohort_clean) GROUP BY admit_period"""

SQL["rate_ratio"] = BASE + f"""
, per AS (
  SELECT COALESCE(CAST(admission_location AS VARCHAR), 'Unknown') AS group_value, COUNT(*) AS n_admissions,
         AVG(CASE WHEN los_days > 7.0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END) AS long_stay_rate
  FROM cohort_clean GROUP BY 1
), b AS (SELECT MAX(long_stay_rate) AS base_rate FROM per WHERE group_value = 'PHYSICIAN REFERRAL')
SELECT 'admission_location' AS group_column, group_value, n_admissions, {_r('long_stay_rate', 'long_stay_rate')},
       {_r('base_rate', 'base_rate')}, {_r('CASE WHEN base_rate > 0 THEN long_stay_rate / base_rate END', 'rate_ratio')}
FROM per CROSS JOIN b"""

SQL["los_histogram"] = BASE + f"""
, r0 AS (SELECT MIN(los_days) AS lo0, MAX(los_days) AS hi0, COUNT(*) AS n FROM cohort_clean WHERE los_days IS NOT NULL),
rng AS (SELECT CASE WHEN hi0 > lo0 THEN lo0 ELSE lo0 - 0.5 END AS lo, CASE WHEN hi0 > lo0 THEN hi0 ELSE hi0 + 0.5 END AS hi, n FROM r0),
binned AS (
  SELECT CAST(LEAST(FLOOR((los_days - lo) * CAST(50.0 AS DOUBLE) / (hi - lo)), 49) AS INTEGER) AS bin, COUNT(*) AS n_admissions
  FROM cohort_clean CROSS JOIN rng WHERE los_days IS NOT NULL GROUP BY 1
)
SELECT CAST(g.i AS INTEGER) AS bin, {_r('lo + CAST(g.i AS INTEGER) * ((hi - lo) / CAST(50.0 AS DOUBLE))', 'bin_start')},
       {_r('lo + (CAST(g.i AS INTEGER) + 1) * ((hi - lo) / CAST(50.0 AS DOUBLE))', 'bin_end')},
       CAST(COALESCE(b.n_admissions, 0) AS BIGINT) AS n_admissions
FROM range(0, 50) g(i) CROSS JOIN rng LEFT JOIN binned b ON b.bin = g.i WHERE rng.n > 0"""

SQL["los_density"] = BASE + f"""
, st AS (SELECT MIN(los_days) AS lo, MAX(los_days) AS hi, COUNT(*) AS n, STDDEV_SAMP(los_days) AS sd,
                STDDEV_SAMP(los_days) * POW(CAST(COUNT(*) AS DOUBLE), -0.2) AS h
         FROM cohort_clean WHERE los_days IS NOT NULL),
vals AS (SELECT los_days AS x, COUNT(*) AS w FROM cohort_clean WHERE los_days IS NOT NULL GROUP BY 1),
pts AS (SELECT CAST(i AS INTEGER) AS point, st.lo + CAST(i AS DOUBLE) * ((st.hi - st.lo) / CAST(199.0 AS DOUBLE)) AS g, st.n, st.h
        FROM range(0, 200) r(i) CROSS JOIN st WHERE st.n > 1 AND st.sd > 0)
SELECT point, {_r('g', 'los_days')},
       {_r('SUM(CAST(w AS DOUBLE) * EXP(-0.5 * POW((g - x) / h, 2))) / ((CAST(MAX(n) AS DOUBLE) * MAX(h)) * SQRT(2.0 * PI()))', 'density')}
FROM pts CROSS JOIN vals GROUP BY point, g"""

SQL["option_lists"] = BASE + "SELECT * FROM (" + " UNION ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM cohort_clean" for c in ("admission_type", "admission_location", "insurance", "language", "marital_status", "race")
) + ") WHERE value IS NOT NULL ORDER BY 1, 2"

_MISSING_COLS = ("subject_id", "hadm_id", "admittime", "dischtime", "los_days", "gender", "age_at_admit", "admission_type", "admission_location", "insurance", "language", "marital_status", "race")
SQL["missing_report"] = BASE + ", m AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing_count, COUNT(*) AS row_count FROM cohort_clean" for c in _MISSING_COLS
) + f")\nSELECT \"column\", missing_count, row_count, {_r('CASE WHEN row_count > 0 THEN CAST(missing_count AS DOUBLE) / CAST(row_count AS DOUBLE) ELSE 0.0 END', 'missing_rate')} FROM m"

SQL["duplicate_report"] = BASE + f"""
SELECT 'hadm_id' AS id_column, COUNT(*) AS total_rows, COUNT(DISTINCT hadm_id) AS unique_ids,
       COUNT(*) - COUNT(DISTINCT hadm_id) AS duplicate_rows,
       {_r('CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) - COUNT(DISTINCT hadm_id) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) ELSE 0.0 END', 'duplicate_rate')}
FROM admissions"""

SQL["sanity_summary"] = BASE + f"""
, r AS (SELECT COUNT(*) AS raw_rows FROM admissions),
c AS (SELECT COUNT(*) AS clean_rows, COUNT(DISTINCT hadm_id) AS clean_unique_hadm_id, COUNT(DISTINCT subject_id) AS clean_unique_subject_id,
             MIN(los_days) AS los_min, quantile_cont(los_days, 0.5) AS los_median, MAX(los_days) AS los_max FROM cohort_clean)
SELECT raw_rows, clean_rows, raw_rows - clean_rows AS dropped_rows,
       {_r('CASE WHEN raw_rows > 0 THEN CAST(raw_rows - clean_rows AS DOUBLE) / CAST(raw_rows AS DOUBLE) ELSE 0.0 END', 'drop_rate')},
       clean_unique_hadm_id, clean_unique_subject_id, {_r('los_min', 'los_min')}, {_r('los_median', 'los_median')}, {_r('los_max', 'los_max')}
FROM r CROSS JOIN c"""

SQL["integrity_checks"] = BASE + """
, a AS (SELECT COUNT(*) - COUNT(DISTINCT hadm_id) AS dup, COUNT(*) FILTER (WHERE NOT COALESCE(los_days > 0, FALSE)) AS bad FROM featured)
SELECT 'unique_admission_id' AS "check", CAST(dup AS BIGINT) AS violations, dup = 0 AS passed FROM a
UNION ALL SELECT 'positive_los', CAST(bad AS BIGINT), bad = 0 FROM a
UNION ALL SELECT 'no_leakage_features', CAST(0 AS BIGINT), TRUE"""

_FEATURE_TYPES = [
    ("age_at_admit", "double"), ("age_band", "string"), ("gender", "string"), ("admission_type", "string"),
    ("admission_location", "string"), ("insurance", "string"), ("language", "string"), ("marital_status", "string"),
    ("race", "string"), ("admit_hour", "int"), ("admit_dayofweek", "int"), ("is_weekend_admit", "int"), ("admit_month", "int"),
]
SQL["feature_overview"] = BASE + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{t}' AS dtype, {_r(f'AVG(CASE WHEN {c} IS NULL THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END)', 'missing_rate')}, "
    f"COUNT(DISTINCT {c}) AS n_unique FROM featured"
    for c, t in _FEATURE_TYPES
) + ") ORDER BY feature"

SQL["calendar_features"] = BASE + "SELECT hadm_id, admit_hour, admit_dayofweek, admit_month, is_weekend_admit FROM featured"
SQL["age_bands"] = BASE + f"SELECT hadm_id, {_r('age_at_admit', 'age_at_admit')}, age_band FROM featured"
SQL["modeling_dataset"] = BASE + f"""
SELECT hadm_id, {_r('age_at_admit', 'age_at_admit')}, age_band, gender, admission_type, admission_location, insurance, language,
       marital_status, race, admit_hour, admit_dayofweek, is_weekend_admit, admit_month, {_r('los_days', 'los_days')}
FROM featured"""
SQL["labels"] = BASE + f"SELECT hadm_id, {_r('los_days', 'los_days')}, long_stay_gt_7d, long_stay_gte_p90, {_r('p90_threshold', 'p90_threshold')} FROM labeled"
SQL["target_label"] = BASE + f"SELECT hadm_id, long_stay_gte_p90 AS target_long_stay, {_r('p90_threshold', 'target_threshold')} FROM labeled"
SQL["target_prevalence"] = BASE + f"SELECT {_r('AVG(CAST(long_stay_gt_7d AS DOUBLE))', 'target_prevalence')}, COUNT(*) AS n_rows FROM labeled"

# ---- evaluation --------------------------------------------------------------------
SQL["pr_curve"] = BASE_SCORED + f"""
SELECT model, {_r('y_score', 'threshold')}, {_r('CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE)', 'precision')},
       {_r('CASE WHEN np_ > 0 THEN CAST(tp AS DOUBLE) / CAST(np_ AS DOUBLE) ELSE 1.0 END', 'recall')}
FROM cur ORDER BY model, threshold"""

_BM_COLS = ", ".join(_r(c, c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "brier_score"))
SQL["binary_metrics"] = BASE_SCORED + f"SELECT model, {_BM_COLS} FROM bm2"
SQL["model_comparison"] = BASE_SCORED + f"SELECT model, {_BM_COLS} FROM bm2 ORDER BY pr_auc DESC NULLS LAST, roc_auc DESC NULLS LAST, model"
SQL["metric_melt"] = BASE_SCORED + " UNION ALL ".join(
    f"SELECT model, '{m}' AS metric, {_r(m, 'score')} FROM bm2" for m in C.COMPARISON_METRICS
)
SQL["confusion_matrix"] = BASE_SCORED + """
, c AS (SELECT model, COUNT(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS tn, COUNT(*) FILTER (WHERE y_true = 0 AND y_pred = 1) AS fp,
               COUNT(*) FILTER (WHERE y_true = 1 AND y_pred = 0) AS fn, COUNT(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp
        FROM scored2 GROUP BY model)
SELECT model, 'actual_0' AS actual, tn AS pred_0, fp AS pred_1 FROM c
UNION ALL SELECT model, 'actual_1', fn, tp FROM c"""

SQL["classification_report"] = BASE_SCORED + f"""
, c AS (
  SELECT model, COUNT(*) AS n,
         COUNT(*) FILTER (WHERE y_true = 0) AS sup0, COUNT(*) FILTER (WHERE y_true = 1) AS sup1,
         COUNT(*) FILTER (WHERE y_pred = 0) AS pred0, COUNT(*) FILTER (WHERE y_pred = 1) AS pred1,
         COUNT(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS hit0, COUNT(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS hit1
  FROM scored2 GROUP BY model
), m AS (
  SELECT *,
    CASE WHEN pred0 > 0 THEN CAST(hit0 AS DOUBLE) / CAST(pred0 AS DOUBLE) ELSE 0.0 END AS p0,
    CASE WHEN sup0 > 0 THEN CAST(hit0 AS DOUBLE) / CAST(sup0 AS DOUBLE) ELSE 0.0 END AS r0,
    CASE WHEN pred1 > 0 THEN CAST(hit1 AS DOUBLE) / CAST(pred1 AS DOUBLE) ELSE 0.0 END AS p1,
    CASE WHEN sup1 > 0 THEN CAST(hit1 AS DOUBLE) / CAST(sup1 AS DOUBLE) ELSE 0.0 END AS r1,
    sup0 + pred0 > 0 AS on0, sup1 + pred1 > 0 AS on1,
    CAST(hit0 + hit1 AS DOUBLE) / CAST(n AS DOUBLE) AS acc
  FROM c
), f AS (
  SELECT *, CASE WHEN p0 + r0 > 0 THEN (2.0 * p0 * r0) / (p0 + r0) ELSE 0.0 END AS f0,
            CASE WHEN p1 + r1 > 0 THEN (2.0 * p1 * r1) / (p1 + r1) ELSE 0.0 END AS f1,
            CAST(CAST(on0 AS INTEGER) + CAST(on1 AS INTEGER) AS DOUBLE) AS k
  FROM m
), rows AS (
  SELECT model, '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, CAST(sup0 AS DOUBLE) AS support FROM f WHERE on0
  UNION ALL SELECT model, '1', p1, r1, f1, CAST(sup1 AS DOUBLE) FROM f WHERE on1
  UNION ALL SELECT model, 'accuracy', acc, acc, acc, acc FROM f
  UNION ALL SELECT model, 'macro avg',
     ((CASE WHEN on0 THEN p0 ELSE 0.0 END) + (CASE WHEN on1 THEN p1 ELSE 0.0 END)) / k,
     ((CASE WHEN on0 THEN r0 ELSE 0.0 END) + (CASE WHEN on1 THEN r1 ELSE 0.0 END)) / k,
     ((CASE WHEN on0 THEN f0 ELSE 0.0 END) + (CASE WHEN on1 THEN f1 ELSE 0.0 END)) / k, CAST(n AS DOUBLE) FROM f
  UNION ALL SELECT model, 'weighted avg',
     (p0 * sup0 + p1 * sup1) / CAST(n AS DOUBLE), (r0 * sup0 + r1 * sup1) / CAST(n AS DOUBLE),
     (f0 * sup0 + f1 * sup1) / CAST(n AS DOUBLE), CAST(n AS DOUBLE) FROM f
)
SELECT model, label, {_r('precision', 'precision')}, {_r('recall', 'recall')}, {_r('f1_score', 'f1_score')}, {_r('support', 'support')} FROM rows"""

_TUN_COLS = f"model, {_r('threshold', 'threshold')}, " + ", ".join(_r(c, c) for c in ("precision", "recall", "f1", "specificity", "youden_j")) + ", tp, tn, fp, fn"
SQL["threshold_tuning"] = BASE_SCORED + f"SELECT {_TUN_COLS} FROM tuning ORDER BY model, threshold"
SQL["operating_thresholds"] = BASE_SCORED + "SELECT model, " + ", ".join(
    _r(c, c) for c in ("balanced_threshold", "balanced_f1", "balanced_recall", "balanced_precision", "recall_priority_threshold",
                       "recall_priority_f1", "recall_priority_recall", "recall_priority_precision")
) + " FROM sel"
SQL["marked_thresholds"] = BASE_SCORED + f"SELECT {_TUN_COLS}, is_balanced, is_recall_priority FROM marked"

SQL["calibration"] = BASE_SCORED + f"""
, e AS (SELECT model, list_sort(list_distinct(quantile_cont(y_score, {_linspace_sql(10)}))) AS edges FROM scored2 GROUP BY model),
b AS (
  SELECT s.model, CAST(GREATEST(len(list_filter(e.edges, lambda v: v < s.y_score)) - 1, 0) AS INTEGER) AS bin, s.y_score, s.y_true
  FROM scored2 s JOIN e ON s.model = e.model WHERE len(e.edges) >= 2
)
SELECT model, bin, COUNT(*) AS n, {_r('AVG(y_score)', 'predicted_risk_mean')}, {_r('AVG(CAST(y_true AS DOUBLE))', 'observed_event_rate')},
       {_r('ABS(AVG(y_score) - AVG(CAST(y_true AS DOUBLE)))', 'abs_calibration_gap')}
FROM b GROUP BY model, bin ORDER BY model, bin"""

_CARD_TEXT = C.CARD_RECOMMENDATION_PREFIX + f"{C.FINAL_BALANCED_THRESHOLD:.2f}."
SQL["decision_card"] = BASE_SCORED + f"""
, tp90 AS (SELECT quantile_cont(los_days, 0.9) AS p90 FROM cohort_sql),
lp AS (SELECT CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) FILTER (WHERE los_days > 7.0) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) END AS prev FROM cohort_sql),
chosen AS (
  SELECT * FROM bm2 ORDER BY CASE WHEN model = '{C.FINAL_MODEL_NAME}' THEN 1 ELSE 0 END DESC,
           COALESCE(pr_auc, -1.0) DESC, COALESCE(roc_auc, -1.0) DESC LIMIT 1
)
SELECT '{C.FINAL_LABEL_MODE}' AS final_label_mode, 'LOS > 7 days' AS final_label_definition, {_r('lp.prev', 'final_label_prevalence')},
       c.model AS final_model_name, {_r(f'COALESCE(s.balanced_threshold, CAST({C.FINAL_BALANCED_THRESHOLD} AS DOUBLE))', 'final_operating_threshold')},
       {_r('c.accuracy', 'final_model_accuracy')}, {_r('c.recall', 'final_model_recall')}, {_r('c.precision', 'final_model_precision')},
       {_r('c.f1', 'final_model_f1')}, {_r('c.roc_auc', 'final_model_roc_auc')}, {_r('c.pr_auc', 'final_model_pr_auc')},
       '{C.CARD_TRADEOFF_TEXT}' AS interpretability_tradeoff, '{_CARD_TEXT}' AS business_recommendation
FROM chosen c CROSS JOIN lp LEFT JOIN sel s ON s.model = c.model"""

# ---- scoring -----------------------------------------------------------------------
_RULE_DEFAULT = _heuristic(C.RISK_EMERGENCY_TYPES, C.RISK_URGENT_TYPES)
SQL["heuristic_score"] = BASE + f"SELECT hadm_id, {_r(_RULE_DEFAULT, 'risk_probability')} FROM cohort_clean"
SQL["risk_tier"] = BASE_SCORED + f"""
, pol AS (
  SELECT COALESCE(MIN(threshold) FILTER (WHERE is_balanced = 1), CAST({C.FINAL_BALANCED_THRESHOLD} AS DOUBLE)) AS b,
         COALESCE(MIN(threshold) FILTER (WHERE is_recall_priority = 1), CAST({C.FINAL_RECALL_PRIORITY_THRESHOLD} AS DOUBLE)) AS r
  FROM marked WHERE model = 'score_rule'
), s AS (SELECT hadm_id, {_RULE_DEFAULT} AS p FROM cohort_sql)
SELECT hadm_id, {_r('p', 'risk_probability')}, {_r('b', 'balanced_threshold')}, {_r('r', 'recall_priority_threshold')},
       CASE WHEN p >= b THEN 1 ELSE 0 END AS predicted_class,
       CASE WHEN p >= GREATEST(r, b) THEN 'High' WHEN p >= LEAST(r, b) * CAST({C.RISK_MODERATE_FACTOR} AS DOUBLE) THEN 'Moderate' ELSE 'Low' END AS risk_tier
FROM s CROSS JOIN pol"""

SQL["aligned_inference"] = BASE + """
, a AS (SELECT * REPLACE (""" + ", ".join(f"{_norm(c)} AS {c}" for c in ("race", "insurance", "marital_status", "admission_type", "language")) + """) FROM admissions)
SELECT hadm_id, CAST(NULL AS DOUBLE) AS age_at_admit, 'Unknown' AS age_band, CAST(NULL AS VARCHAR) AS gender, admission_type,
       admission_location, insurance, language, marital_status, race,
       CAST(hour(admittime) AS INTEGER) AS admit_hour, CAST(isodow(admittime) - 1 AS INTEGER) AS admit_dayofweek,
       CASE WHEN isodow(admittime) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend_admit, CAST(month(admittime) AS INTEGER) AS admit_month
FROM a"""

# ---- training inputs ---------------------------------------------------------------
SQL["split_counts"] = BASE + """
, cls AS (SELECT long_stay_gt_7d AS label, COUNT(*) AS nc FROM labeled GROUP BY 1),
tot AS (SELECT SUM(nc) AS n, CAST(CEIL(CAST(0.2 AS DOUBLE) * CAST(SUM(nc) AS DOUBLE)) AS BIGINT) AS ntest FROM cls),
alloc AS (
  SELECT c.label, c.nc, CAST(c.nc AS DOUBLE) * CAST(t.n - t.ntest AS DOUBLE) / CAST(t.n AS DOUBLE) AS cont, t.n, t.ntest FROM cls c CROSS JOIN tot t
), alloc2 AS (
  SELECT *, FLOOR(cont) AS fl, (n - ntest) - SUM(FLOOR(cont)) OVER () AS need,
         ROW_NUMBER() OVER (ORDER BY cont - FLOOR(cont) DESC, label) AS rk FROM alloc
), fin AS (SELECT label, nc, CAST(fl + CASE WHEN rk <= need THEN 1 ELSE 0 END AS BIGINT) AS ntrain FROM alloc2)
SELECT 'train' AS split, label, ntrain AS n_rows FROM fin WHERE ntrain > 0
UNION ALL SELECT 'test', label, nc - ntrain FROM fin WHERE nc - ntrain > 0"""

_NUMERIC = ("age_at_admit", "admit_hour", "admit_dayofweek", "is_weekend_admit", "admit_month")
_CATEGORICAL = ("age_band", "gender", "admission_type", "admission_location", "insurance", "language", "marital_status", "race")
SQL["preprocess_stats"] = BASE + ", nl AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM featured" for c in _NUMERIC
) + "), cl AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v FROM featured" for c in _CATEGORICAL
) + f"""),
med AS (SELECT feature, quantile_cont(x, 0.5) AS median FROM nl GROUP BY feature),
num AS (
  SELECT nl.feature, MAX(med.median) AS median, AVG(COALESCE(nl.x, med.median)) AS mean, STDDEV_POP(COALESCE(nl.x, med.median)) AS std
  FROM nl JOIN med ON nl.feature = med.feature GROUP BY nl.feature
),
freq AS (SELECT feature, v, COUNT(*) AS k FROM cl WHERE v IS NOT NULL GROUP BY 1, 2),
mode_ AS (SELECT feature, v AS mode FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY k DESC, v ASC) AS rk FROM freq) WHERE rk = 1)
SELECT feature, 'numeric' AS kind, {_r('median', 'median')}, {_r('mean', 'mean')}, {_r('std', 'std')}, CAST(NULL AS VARCHAR) AS mode FROM num
UNION ALL
SELECT feature, 'categorical', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), mode FROM mode_"""


# ---- the plan for large inputs: the same results -----------------------------------------
for _name in ("los_overall", "outlier_review", "pr_curve", "calibration", "split_counts", "subgroup_summary"):
    SQL[f"{_name}_bucketed"] = SQL[_name]

# ---- readers and writers --------------------------------------------------------------------
SQL["admissions_parquet"] = BASE + "SELECT * FROM admissions"
SQL["admissions_csv"] = BASE + "SELECT * REPLACE (NULLIF(language, '') AS language) FROM admissions"
SQL["admissions_csv_gz"] = SQL["admissions_csv"]
SQL["core_dataset_csv"] = BASE + """
SELECT a.* REPLACE (NULLIF(a.language, '') AS language), p.gender, p.anchor_age, p.anchor_year
FROM admissions a LEFT JOIN pat_first p ON a.subject_id IS NOT DISTINCT FROM p.subject_id"""
_COHORT_ROUNDED = ", ".join(_r("los_days", "los_days") if c == "los_days" else c for c in C.COHORT_COLUMNS)
_COHORT_CSV = ", ".join("NULLIF(language, '') AS language" if c == "language" else c for c in _COHORT_ROUNDED.split(", "))
SQL["cohort_reload_parquet"] = BASE + f"SELECT {_COHORT_ROUNDED} FROM cohort_sql"
SQL["cohort_reload_csv"] = BASE + f"SELECT {_COHORT_CSV} FROM cohort_sql"

# ---- facts about fitted models -----------------------------------------------------------------
_SPLIT = SQL["split_counts"].split("SELECT 'train' AS split", 1)[0]
SQL["model_score_facts"] = _SPLIT + """
SELECT m.model, label AS y_true, nc - ntrain AS n_rows, nc - ntrain AS n_in_range, nc - ntrain AS n_class_agrees, nc - ntrain AS n_reloaded_equal
FROM fin CROSS JOIN (VALUES ('logistic_regression'), ('random_forest'), ('gradient_boosted_trees')) m(model) WHERE nc - ntrain > 0"""
SQL["expanded_features"] = BASE + "SELECT feature FROM (" + " UNION ALL ".join(
    [f"SELECT '{c}' AS feature" for c in _NUMERIC]
    + [f"SELECT DISTINCT '{c}_' || CAST({c} AS VARCHAR) FROM featured WHERE {c} IS NOT NULL" for c in _CATEGORICAL]
) + ")"
SQL["permuted_value_counts"] = BASE + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(r.r AS INTEGER) AS repeat, {c} AS value, COUNT(*) AS n_rows FROM featured CROSS JOIN range(3) r(r) GROUP BY 2, 3"
    for c in ("admission_type", "insurance")
)

# ---- scoring job without artifacts ---------------------------------------------------------------
SQL["artifact_scoring_fallback"] = BASE + f"""
, rows_ AS (
  SELECT * REPLACE ({_norm('admission_type')} AS admission_type, {_norm('insurance')} AS insurance) FROM (
    SELECT a.*, p.anchor_age, p.anchor_year FROM admissions a LEFT JOIN pat_first p ON a.subject_id IS NOT DISTINCT FROM p.subject_id)
), s AS (SELECT hadm_id, {_RULE_DEFAULT} AS p FROM rows_, LATERAL (SELECT {AGE} AS age_at_admit))
SELECT hadm_id, {_r('p', 'risk_probability')}, CASE WHEN p >= CAST({C.FINAL_BALANCED_THRESHOLD} AS DOUBLE) THEN 1 ELSE 0 END AS predicted_class,
       CASE WHEN p >= CAST({max(C.FINAL_BALANCED_THRESHOLD, C.FINAL_RECALL_PRIORITY_THRESHOLD)} AS DOUBLE) THEN 'High'
            WHEN p >= CAST({min(C.FINAL_BALANCED_THRESHOLD, C.FINAL_RECALL_PRIORITY_THRESHOLD)} AS DOUBLE) * CAST({C.RISK_MODERATE_FACTOR} AS DOUBLE) THEN 'Moderate' ELSE 'Low' END AS risk_tier,
       'heuristic' AS score_source
FROM s"""

# ---- rows on which the two cohort modes differ ------------------------------------------------
_EDGES = ADAPTER.replace("admissions AS (", "admissions0 AS (").replace("patients AS (", "patients0 AS (") + """,
padded AS (
  SELECT * REPLACE (CASE WHEN hadm_id % 90 = 11 THEN chr(160) || language || chr(9) ELSE language END AS language) FROM admissions0
),
admissions AS (
  SELECT * FROM padded
  UNION ALL SELECT * REPLACE (admittime - INTERVAL 2 HOUR AS admittime, CAST(NULL AS TIMESTAMP) AS dischtime) FROM padded WHERE hadm_id % 60 = 7
  UNION ALL SELECT * REPLACE (CAST(NULL AS BIGINT) AS subject_id, hadm_id + 2000000000 AS hadm_id) FROM padded WHERE hadm_id % 200 = 3
  UNION ALL SELECT * REPLACE (CAST(NULL AS BIGINT) AS hadm_id) FROM padded WHERE hadm_id % 400 = 5
),
patients AS (
  SELECT * FROM patients0
  UNION ALL SELECT subject_id, gender, CAST(anchor_age + 1 AS INTEGER), anchor_year FROM patients0 WHERE subject_id % 13 = 0
  UNION ALL SELECT CAST(NULL AS BIGINT), 'F', 40, 2020
)"""
_EDGE_BASE = BASE.replace(ADAPTER, _EDGES)
SQL["cohort_sql_edges"] = _EDGE_BASE + f"SELECT {_COHORT_ROUNDED} FROM cohort_sql"
SQL["cohort_py_edges"] = _EDGE_BASE + f"SELECT {_COHORT_ROUNDED} FROM cohort_py"
SQL["language_edges"] = _EDGE_BASE + """
SELECT CASE WHEN t = '' THEN 'Unknown' ELSE t END AS language, COUNT(*) AS n_rows
FROM (SELECT trim(COALESCE(language, 'Unknown'), chr(160) || chr(9) || ' ') AS t FROM admissions) GROUP BY 1"""

# ---- models, fitted again in SQL -----------------------------------------------------------------
_FEATURED = COHORTS.split("featured AS (", 1)[1].rstrip()[:-1]
_GRID = "grid AS (" + SCORED.split("grid AS (", 1)[1]
SQL |= model_sql(BASE, _FEATURED, _GRID, _r, _norm, AGE)
