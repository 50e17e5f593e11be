"""Fixed policy values of the analysis.

These are values the results depend on (thresholds, column lists, labels and
message texts); they are stated here once, in natural order, and used by the
operators.
"""

from __future__ import annotations

# --- fixed values: long-stay label policy -------------------------------------------
LONG_STAY_DAYS_THRESHOLD: float = 7.0
LONG_STAY_PERCENTILE: float = 0.90
DEFAULT_LABEL_MODE: str = "gt_7d"
LABEL_MODES: tuple[str, ...] = ("gt_7d", "gte_p90")
DEFAULT_SEED: int = 42

# --- fixed values: final selection defaults ------------------------------------------
FINAL_LABEL_MODE: str = "gt_7d"
FINAL_MODEL_NAME: str = "random_forest"
RECALL_PRIORITY_MIN_RECALL: float = 0.80
FINAL_BALANCED_THRESHOLD: float = 0.40
FINAL_RECALL_PRIORITY_THRESHOLD: float = 0.40

# --- fixed values: table names and file suffixes (searched in this order) ------------
ADMISSIONS_TABLE_BASENAME = "admissions"
PATIENTS_TABLE_BASENAME = "patients"
SUPPORTED_TABLE_EXTENSIONS: tuple[str, ...] = (".csv.gz", ".csv", ".parquet")

# --- fixed values: required input columns --------------------------------------------
REQUIRED_ADMISSIONS_COLUMNS: tuple[str, ...] = (
    "subject_id",
    "hadm_id",
    "admittime",
    "dischtime",
    "admission_type",
    "admission_location",
    "discharge_location",
    "insurance",
    "language",
    "marital_status",
    "race",
    "hospital_expire_flag",
)
REQUIRED_PATIENTS_COLUMNS: tuple[str, ...] = ("subject_id", "gender", "anchor_age", "anchor_year")
ADMISSION_TIMESTAMP_COLUMNS: tuple[str, ...] = (
    "admittime",
    "dischtime",
    "deathtime",
    "edregtime",
    "edouttime",
)

# --- fixed values: cohort output column order -----------------------------------------
COHORT_COLUMNS: tuple[str, ...] = (
    "subject_id",
    "hadm_id",
    "admittime",
    "dischtime",
    "admission_type",
    "admission_location",
    "discharge_location",
    "insurance",
    "language",
    "marital_status",
    "race",
    "hospital_expire_flag",
    "gender",
    "anchor_age",
    "anchor_year",
    "age_at_admit",
    "los_days",
)

# --- fixed values: categorical cleanup defaults (admission_location is not included) --
DEFAULT_CATEGORICAL_COLUMNS: tuple[str, ...] = (
    "gender",
    "race",
    "insurance",
    "marital_status",
    "admission_type",
    "language",
)
UNKNOWN = "Unknown"

# --- fixed values: subgroup dimensions of the SQL summary -----------------------------
SUBGROUP_DIMENSIONS: tuple[str, ...] = ("admission_type", "insurance", "hospital_expire_flag")
SUMMARY_PERCENTILES: tuple[float, ...] = (0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
PERCENTILE_TABLE_DEFAULT: tuple[float, ...] = (0.50, 0.75, 0.90, 0.95, 0.99)

# --- fixed values: outlier review parameters ------------------------------------------
OUTLIER_TOP_N: int = 100
OUTLIER_MIN_PERCENT_RANK: float = 0.99

# --- fixed values: age bands (right-closed bins, lowest edge included) ----------------
AGE_BAND_EDGES: tuple[int, ...] = (0, 39, 49, 59, 69, 79, 120)
AGE_BAND_LABELS: tuple[str, ...] = ("18-39", "40-49", "50-59", "60-69", "70-79", "80+")

# --- fixed values: weekend days (Monday = 0 ... Sunday = 6) ---------------------------
WEEKEND_DAYS: tuple[int, ...] = (5, 6)

# --- fixed values: excluded columns and their reasons ---------------------------------
EXCLUDED_COLUMN_REASONS: dict[str, str] = {
    "subject_id": "Identifier column; can cause memorization and is not clinically meaningful.",
    "hadm_id": "Admission identifier; should never be used as predictive signal.",
    "admittime": "Raw timestamp; replaced by engineered time features.",
    "dischtime": "Not known at admission; direct outcome leakage.",
    "deathtime": "Future event relative to admission; leakage.",
    "los_days": "Target-defining variable; direct leakage.",
    "discharge_location": "Determined near/after discharge; leakage for admission-time prediction.",
    "hospital_expire_flag": "Outcome-adjacent endpoint; excluded from default model inputs.",
    "anchor_year": "De-identification anchor metadata; not clinically actionable.",
    "long_stay_gt_7d": "Target label, not predictor.",
    "long_stay_gte_p90": "Target label, not predictor.",
    "target_long_stay": "Target label, not predictor.",
}

# --- fixed values: candidate admission-time feature columns, in order -----------------
CANDIDATE_FEATURE_COLUMNS: tuple[str, ...] = (
    "age_at_admit",
    "age_band",
    "gender",
    "admission_type",
    "admission_location",
    "insurance",
    "language",
    "marital_status",
    "race",
    "admit_hour",
    "admit_dayofweek",
    "is_weekend_admit",
    "admit_month",
)

# --- fixed values: heuristic fallback risk score --------------------------------------
RISK_BASE = 0.08
RISK_AGE_75 = 0.18
RISK_AGE_65 = 0.10
RISK_EMERGENCY = 0.22
RISK_URGENT = 0.12
RISK_WEEKEND = 0.04
RISK_INSURANCE = 0.03
RISK_INSURANCE_VALUES: tuple[str, ...] = ("Medicaid", "Self Pay")
RISK_EMERGENCY_TYPES: tuple[str, ...] = ("EMERGENCY",)
RISK_URGENT_TYPES: tuple[str, ...] = ("URGENT",)
RISK_CLIP_LOW = 0.01
RISK_CLIP_HIGH = 0.95
RISK_MODERATE_FACTOR = 0.6

# --- fixed values: threshold grid 0.05 ... 0.95 (rounded to 2 places) -----------------
TUNING_THRESHOLDS: tuple[float, ...] = tuple(round(0.05 * i, 2) for i in range(1, 20))

# --- fixed values: label prevalence texts ---------------------------------------------
LABEL_CLARITY = {"gt_7d": "High", "gte_p90": "Medium"}
LABEL_NOTE = {
    "gt_7d": "Simple fixed threshold for operations",
    "gte_p90": "Distribution-relative threshold",
}

# --- fixed values: label recommendation texts -----------------------------------------
RECOMMEND_FIXED_RATE_RANGE = (0.05, 0.50)
RECOMMEND_FIXED_TEXT = (
    "Recommend primary label: LOS > 7 days, because prevalence is operationally "
    "manageable and interpretation is straightforward for non-technical stakeholders."
)
RECOMMEND_PERCENTILE_TEXT = (
    "Recommend primary label: LOS >= p90, because fixed-threshold prevalence appears "
    "too extreme for balanced monitoring/modeling in this cohort."
)
RECOMMEND_INSUFFICIENT_TEXT = "Insufficient comparison data to recommend a definition."

# --- fixed values: decision card texts ------------------------------------------------
CARD_TRADEOFF_TEXT = (
    "Random Forest improves predictive discrimination; Logistic retained for "
    "coefficient-level interpretation."
)
CARD_RECOMMENDATION_PREFIX = (
    "Use gt_7d label and Random Forest for admission-time risk flagging; "
    "start with balanced threshold "
)

# --- fixed values: model comparison metrics (melt order) ------------------------------
COMPARISON_METRICS: tuple[str, ...] = ("roc_auc", "pr_auc", "f1", "recall", "precision")

# --- fixed values: missing-value tokens read as NULL from CSV (pandas defaults) -------
CSV_NULL_TOKENS: tuple[str, ...] = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
