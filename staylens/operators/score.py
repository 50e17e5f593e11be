"""Batch scoring of whole admission tables: feature alignment, model or heuristic
score, class at the balanced threshold and a plain-language tier.

The policy (thresholds, model name) is a one-row relation resolved from the marked
tuning table, then the saved bundle, then the fixed defaults; it is joined to the
rows as a broadcast single row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens import config as C
from staylens.functions.columns import heuristic_risk_score, risk_tier
from staylens.operators.features import engineer_admission_time_features, engineer_demographic_features
from staylens.operators.linear import score_by_relation


def align_for_inference(df: DataFrame, feature_columns: Sequence[str]) -> DataFrame:
    """Derive calendar and age features, add absent feature columns as NULL, keep the
    id (when present) and the features in training order."""
    out = engineer_demographic_features(engineer_admission_time_features(df)) if "admittime" in df.columns else engineer_demographic_features(df)
    missing = {c: F.lit(None).cast("string") for c in feature_columns if c not in out.columns}
    out = out.withColumns(missing) if missing else out
    keep = [c for c in ("hadm_id",) if c in out.columns and c not in feature_columns]
    return out.select(*keep, *feature_columns)


def add_heuristic_score(df: DataFrame, out_col: str = "risk_probability", **kw) -> DataFrame:
    base = df if "is_weekend_admit" in df.columns else engineer_admission_time_features(df)
    return base.withColumn(out_col, heuristic_risk_score(**kw))


def resolve_policy(
    spark: SparkSession,
    marked_tuning: DataFrame | None = None,
    bundle_meta: dict | None = None,
    card: DataFrame | None = None,
    model: str | None = None,
) -> DataFrame:
    """One row: balanced_threshold, recall_priority_threshold, final_model_name."""
    meta = bundle_meta or {}
    bal_default = float(meta.get("balanced_threshold", C.FINAL_BALANCED_THRESHOLD))
    rec_default = float(meta.get("recall_priority_threshold", C.FINAL_RECALL_PRIORITY_THRESHOLD))
    name_default = str(meta.get("primary_model_name", C.FINAL_MODEL_NAME))
    base = spark.range(1).select(F.lit(bal_default).alias("_bd"), F.lit(rec_default).alias("_rd"), F.lit(name_default).alias("_nd"))
    if marked_tuning is not None:
        # Thresholds of the named model: the argument's, else the card's or bundle's; a table
        # of a single model needs no name.
        name = F.lit(model) if model is not None else F.lit(name_default)
        if model is None and card is not None:
            marked_tuning = marked_tuning.crossJoin(F.broadcast(card.agg(F.first("final_model_name").alias("_named"))))
            name = F.coalesce(F.col("_named"), name)
        models = marked_tuning.agg(F.min("model").alias("_lo"), F.max("model").alias("_hi"))
        t = marked_tuning.crossJoin(F.broadcast(models)).where((F.col("model") == name) | ((F.col("_lo") == F.col("_hi")) & F.lit(model is None)))
        picked = t.agg(
            F.min(F.when(F.col("is_balanced") == 1, F.col("threshold"))).alias("_bt"),
            F.min(F.when(F.col("is_recall_priority") == 1, F.col("threshold"))).alias("_rt"),
        )
        base = base.crossJoin(F.broadcast(picked))  # one-row aggregate
    else:
        base = base.withColumns({"_bt": F.lit(None).cast("double"), "_rt": F.lit(None).cast("double")})
    if card is not None:
        base = base.crossJoin(F.broadcast(card.agg(F.first("final_model_name").alias("_cn"))))
    else:
        base = base.withColumn("_cn", F.lit(None).cast("string"))
    return base.select(
        F.coalesce("_bt", "_bd").alias("balanced_threshold"),
        F.coalesce("_rt", "_rd").alias("recall_priority_threshold"),
        F.coalesce("_cn", "_nd").alias("final_model_name"),
    )


def apply_policy(scored: DataFrame, policy: DataFrame, prob_col: str = "risk_probability") -> DataFrame:
    """Class at the balanced threshold and tier from both thresholds."""
    out = scored.crossJoin(F.broadcast(policy.select("balanced_threshold", "recall_priority_threshold")))
    return out.withColumns(
        {
            "predicted_class": F.when(F.col(prob_col) >= F.col("balanced_threshold"), 1).otherwise(0),
            "risk_tier": risk_tier(prob_col, "balanced_threshold", "recall_priority_threshold"),
        }
    )


def score_with_model(model, df: DataFrame, feature_columns: Sequence[str], prob_col: str = "risk_probability") -> DataFrame:
    """Model probability of the positive class for every row (Arrow-free, JVM side)."""
    from staylens.operators.ml import positive_probability

    out = model.transform(align_for_inference(df, feature_columns))
    return out.withColumn(prob_col, positive_probability(out)).drop("probability", "rawPrediction", "prediction", "features")


def score_admissions(
    df: DataFrame,
    policy: DataFrame,
    model=None,
    feature_columns: Sequence[str] | None = None,
    relation: DataFrame | None = None,
    **heuristic_kw,
) -> DataFrame:
    """Score a whole table with a linear model's relation or with the model when usable,
    else the heuristic fallback."""
    if relation is not None and feature_columns:
        scored = score_by_relation(align_for_inference(df, feature_columns), relation).withColumn("score_source", F.lit("model"))
    elif model is not None and feature_columns:
        scored = score_with_model(model, df, feature_columns).withColumn("score_source", F.lit("model"))
    else:
        feats = engineer_demographic_features(engineer_admission_time_features(df))
        scored = add_heuristic_score(feats, **heuristic_kw).withColumn("score_source", F.lit("heuristic"))
    return apply_policy(scored, policy)


def score_from_artifacts(
    spark: SparkSession,
    admissions: DataFrame,
    patients: DataFrame | None,
    bundle_folder: str,
    tables_folder: str | None = None,
    **heuristic_kw,
) -> DataFrame:
    """Score a whole admissions table from what a batch run saved: the model bundle, the
    decision card and the marked tuning table.  Without a usable bundle or model the rows
    get the heuristic score; without the tables the bundle's, then the fixed thresholds."""
    from staylens.operators.cohort import derive_stay_columns, merge_admissions_patients
    from staylens.operators.features import normalize_categorical_labels
    from staylens.sources.artifacts import load_model_bundle
    from staylens.sources.tables import path_exists, read_table

    def saved(name: str) -> DataFrame | None:
        for ext in ("parquet", "csv"):
            path = f"{str(tables_folder).rstrip('/')}/{name}.{ext}"
            if tables_folder and path_exists(spark, path):
                return read_table(spark, path)
        return None

    bundle = load_model_bundle(spark, bundle_folder)
    tuning, card = saved("threshold_tuning"), saved("final_model_card")
    if tuning is not None:
        tuning = tuning.withColumns({"threshold": F.col("threshold").cast("double"), "is_balanced": F.col("is_balanced").cast("int"), "is_recall_priority": F.col("is_recall_priority").cast("int")})
    policy = resolve_policy(spark, tuning, bundle, card)
    name = policy.first()["final_model_name"]  # one row
    model, relation = (bundle or {}).get("models", {}).get(name), (bundle or {}).get("relations", {}).get(name)
    rows = merge_admissions_patients(admissions, patients) if patients is not None else admissions
    rows = normalize_categorical_labels(derive_stay_columns(rows))
    return score_admissions(rows, policy, model=model, feature_columns=(bundle or {}).get("feature_columns"), relation=relation, **heuristic_kw)
