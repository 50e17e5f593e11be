"""Relations every registered query starts from: the adapter tables, both cohorts and
a scored relation built without training (three deterministic scores)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions.columns import fixed_day_label, heuristic_risk_score, weekend_flag
from staylens.operators.cohort import build_cohort_python, build_cohort_sql, order_cohort
from staylens.operators.features import build_modeling_dataset, normalize_categorical_labels
from staylens.sources.adapter import adapter_relations

# Event types standing in for admission types in the fixture heuristic score.
FIXTURE_EMERGENCY_TYPES = ("error",)
FIXTURE_URGENT_TYPES = ("purchase",)
HASH_MULTIPLIER = 7919
HASH_MODULUS = 1000


_HELD: list[DataFrame] = []
_BUCKETS: dict = {}


def reused(df: DataFrame) -> DataFrame:
    """Persist a relation that one query reads several times (bucket planning, one-row
    thresholds, the main pass); the next query releases it.  Blocks lost with an executor
    are recomputed from lineage."""
    _HELD.append(df)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def release() -> None:
    """Unpersist what the query before has held."""
    while _HELD:
        held = _HELD.pop()
        if held.sparkSession.sparkContext._jsc is not None:
            held.unpersist()


@contextmanager
def bucket_rows(rows: int):
    """Inside, the ordered operators take ``rows`` rows per bucket, so that small inputs
    run the plan meant for large ones."""
    _BUCKETS["rows_per_bucket"] = rows
    try:
        yield
    finally:
        _BUCKETS.clear()


def relations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return adapter_relations(spark, sf_dir)


def cohort_sql(spark: SparkSession, sf_dir: str, with_patients: bool = True, ordered: bool = False) -> DataFrame:
    adm, pat = relations(spark, sf_dir)
    cohort = build_cohort_sql(adm, pat if with_patients else None)
    return order_cohort(cohort) if ordered else cohort


def cohort_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    adm, pat = relations(spark, sf_dir)
    return build_cohort_python(adm, pat)


def cohort_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Python-mode cohort after categorical cleanup (the notebook's working table)."""
    return normalize_categorical_labels(cohort_python(spark, sf_dir))


def modeling_dataset(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    featured, safe, _ = build_modeling_dataset(cohort_clean(spark, sf_dir))
    return featured, safe


def scored_relation(cohort: DataFrame) -> DataFrame:
    """hadm_id, model, y_true, y_pred, y_score for three untrained scores: a hash
    score with many values, the fallback heuristic (few values, heavy ties) and a score
    whose lowest values hold no positives."""
    y_true = fixed_day_label("los_days")
    hash_score = ((F.col("hadm_id") * HASH_MULTIPLIER) % HASH_MODULUS).cast("double") / F.lit(float(HASH_MODULUS))
    rule_score = F.round(
        heuristic_risk_score(
            age="age_at_admit",
            admission_type="admission_type",
            weekend=weekend_flag("admittime"),
            insurance="insurance",
            emergency_types=FIXTURE_EMERGENCY_TYPES,
            urgent_types=FIXTURE_URGENT_TYPES,
        ),
        6,
    )
    # No positive row scores below 0.3, so the curve's low end lies behind full recall.
    tail_score = F.when(y_true == 1, F.lit(0.3) + F.lit(0.7) * hash_score).otherwise(hash_score)
    scores = {"score_hash": hash_score, "score_rule": rule_score, "score_tail": tail_score}
    both = cohort.select(
        "hadm_id",
        y_true.alias("y_true"),
        F.inline(F.array(*[F.struct(F.lit(name).alias("model"), value.alias("y_score")) for name, value in scores.items()])),
    )
    return both.select("hadm_id", "model", "y_true", F.when(F.col("y_score") > 0.5, 1).otherwise(0).alias("y_pred"), "y_score")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_relation(cohort_sql(spark, sf_dir))


def bounded(df: DataFrame) -> tuple[DataFrame, dict]:
    """The relation, persisted since it is read again, and ``{"row_bound": n}``.  Counting it
    fills the cache; the bound then sizes every ordered step without another job."""
    df = reused(df)
    return df, {"row_bound": df.count(), **_BUCKETS}
