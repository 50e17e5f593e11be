"""Stateless column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it stays
inside whole-stage code generation and works on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from staylens import config as C

__all__ = [
    "MICROS_PER_DAY",
    "col_of",
    "los_days",
    "age_at_admit",
    "safe_rate",
    "share",
    "fixed_day_label",
    "percentile_label",
    "strip_text",
    "normalize_category",
    "unknown_if_null",
    "calendar_columns",
    "weekend_flag",
    "age_band",
    "heuristic_risk_score",
    "risk_tier",
    "clip",
    "label_definition_text",
]

MICROS_PER_DAY = 86_400_000_000.0

# Characters Python's str.strip() removes (str.isspace): ASCII whitespace, the
# information separators 0x1c-0x1f, and the Unicode White_Space set.
_STRIPPED = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def los_days(admit: str | Column = "admittime", disch: str | Column = "dischtime") -> Column:
    """Length of stay in fractional days (NULL when either time is NULL)."""
    micros = F.timestamp_diff("MICROSECOND", col_of(admit), col_of(disch))
    return micros.cast("double") / F.lit(MICROS_PER_DAY)


def age_at_admit(admit: str | Column = "admittime") -> Column:
    """anchor_age + (year(admit) - anchor_year); NULL if any input is NULL."""
    return F.col("anchor_age") + (F.year(col_of(admit)) - F.col("anchor_year"))


def safe_rate(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, 0.0 when the denominator is zero."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def share(condition: Column) -> Column:
    """Aggregate: fraction of rows meeting ``condition`` (double, NULL on no rows)."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def fixed_day_label(los: str | Column = "los_days", days: float = C.LONG_STAY_DAYS_THRESHOLD) -> Column:
    """1 when LOS > days, else 0 (NULL LOS gives 0)."""
    return F.when(col_of(los) > F.lit(float(days)), F.lit(1)).otherwise(F.lit(0))


def percentile_label(los: str | Column, threshold: str | Column) -> Column:
    """1 when LOS >= threshold, else 0 (NULL LOS or threshold gives 0)."""
    return F.when(col_of(los) >= col_of(threshold), F.lit(1)).otherwise(F.lit(0))


def strip_text(c: str | Column) -> Column:
    return F.btrim(col_of(c), F.lit(_STRIPPED))


def normalize_category(c: str | Column) -> Column:
    """NULL -> 'Unknown', cast to text, strip whitespace, empty -> 'Unknown'."""
    stripped = strip_text(F.coalesce(col_of(c).cast("string"), F.lit(C.UNKNOWN)))
    return F.when(stripped == F.lit(""), F.lit(C.UNKNOWN)).otherwise(stripped)


def unknown_if_null(c: str | Column) -> Column:
    """COALESCE(x::text, 'Unknown') as used for subgroup keys."""
    return F.coalesce(col_of(c).cast("string"), F.lit(C.UNKNOWN))


def weekend_flag(ts: str | Column) -> Column:
    """1 for Saturday/Sunday (Monday = 0 numbering), 0 otherwise or NULL."""
    return F.when(F.weekday(col_of(ts)).isin(*C.WEEKEND_DAYS), F.lit(1)).otherwise(F.lit(0))


def calendar_columns(ts: str | Column = "admittime") -> dict[str, Column]:
    t = col_of(ts)
    return {
        "admit_hour": F.hour(t),
        "admit_dayofweek": F.weekday(t),
        "admit_month": F.month(t),
        "is_weekend_admit": weekend_flag(t),
    }


def age_band(age: str | Column) -> Column:
    """Right-closed bands over (0,39],(39,49],...,(79,120] with 0 included; else Unknown."""
    a = col_of(age)
    edges, labels = C.AGE_BAND_EDGES, C.AGE_BAND_LABELS
    expr = F.when((a >= F.lit(edges[0])) & (a <= F.lit(edges[1])), F.lit(labels[0]))
    for lo, hi, label in zip(edges[1:-1], edges[2:], labels[1:]):
        expr = expr.when((a > F.lit(lo)) & (a <= F.lit(hi)), F.lit(label))
    return expr.otherwise(F.lit(C.UNKNOWN))


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def heuristic_risk_score(
    age: str | Column = "age_at_admit",
    admission_type: str | Column = "admission_type",
    weekend: str | Column = "is_weekend_admit",
    insurance: str | Column = "insurance",
    emergency_types: Iterable[str] = C.RISK_EMERGENCY_TYPES,
    urgent_types: Iterable[str] = C.RISK_URGENT_TYPES,
    insurance_values: Iterable[str] = C.RISK_INSURANCE_VALUES,
) -> Column:
    """Additive fallback score, summed term by term in a fixed order, clipped."""
    a, t = col_of(age), col_of(admission_type)
    age_term = F.when(a >= 75, F.lit(C.RISK_AGE_75)).when(a >= 65, F.lit(C.RISK_AGE_65)).otherwise(F.lit(0.0))
    type_term = (
        F.when(t.isin(*emergency_types), F.lit(C.RISK_EMERGENCY))
        .when(t.isin(*urgent_types), F.lit(C.RISK_URGENT))
        .otherwise(F.lit(0.0))
    )
    weekend_term = F.when(col_of(weekend) == 1, F.lit(C.RISK_WEEKEND)).otherwise(F.lit(0.0))
    ins_term = F.when(col_of(insurance).isin(*insurance_values), F.lit(C.RISK_INSURANCE)).otherwise(F.lit(0.0))
    score = (((F.lit(C.RISK_BASE) + age_term) + type_term) + weekend_term) + ins_term
    return clip(score, C.RISK_CLIP_LOW, C.RISK_CLIP_HIGH)


def risk_tier(probability: str | Column, balanced: str | Column, recall_priority: str | Column) -> Column:
    """High at or above the larger threshold, Moderate at or above 0.6 x the smaller."""
    p, b, r = col_of(probability), col_of(balanced), col_of(recall_priority)
    low_cut = F.least(r, b) * F.lit(C.RISK_MODERATE_FACTOR)
    high_cut = F.greatest(r, b)
    return F.when(p >= high_cut, F.lit("High")).when(p >= low_cut, F.lit("Moderate")).otherwise(F.lit("Low"))


def label_definition_text(mode: str, days: float = C.LONG_STAY_DAYS_THRESHOLD, percentile: float = C.LONG_STAY_PERCENTILE) -> str:
    if mode == "gt_7d":
        return f"LOS > {days:.0f} days"
    if mode == "gte_p90":
        return f"LOS >= p{int(percentile * 100)}"
    raise ValueError("label_mode must be one of: {'gt_7d', 'gte_p90'}")
