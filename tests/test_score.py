"""Batch scoring: model path, heuristic fallback, policy resolution order, alignment."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staylens.operators import ml as M
from staylens.operators.score import align_for_inference, resolve_policy, score_admissions

SCHEMA = "hadm_id long, admittime timestamp_ntz, admission_type string, insurance string, age_at_admit int, target_long_stay int"


@pytest.fixture(scope="module")
def admissions(spark):
    rows = [(i, dt.datetime(2024, 1, 1 + i % 7, i % 24), ["EMERGENCY", "URGENT", "ELECTIVE"][i % 3], ["Medicaid", "Medicare"][i % 2], 20 + i % 70, int(i % 3 == 0)) for i in range(300)]
    return spark.createDataFrame(rows, SCHEMA)


def test_policy_resolution_order(spark):
    marked = spark.createDataFrame(
        [("m", 0.3, 1, 0), ("m", 0.35, 0, 1), ("x", 0.9, 1, 1)], "model string, threshold double, is_balanced int, is_recall_priority int"
    )
    p = resolve_policy(spark, marked, model="m").collect()[0]
    assert (p["balanced_threshold"], p["recall_priority_threshold"], p["final_model_name"]) == (0.3, 0.35, "random_forest")
    p = resolve_policy(spark, marked.where("is_balanced = 0 AND model = 'm'"), {"balanced_threshold": 0.2, "primary_model_name": "lr"}).collect()[0]
    assert (p["balanced_threshold"], p["recall_priority_threshold"], p["final_model_name"]) == (0.2, 0.35, "lr")
    p = resolve_policy(spark).collect()[0]
    assert (p["balanced_threshold"], p["recall_priority_threshold"]) == (0.4, 0.4)


def test_fallback_and_model_scoring(spark, admissions):
    policy = resolve_policy(spark)
    fb = score_admissions(admissions, policy)
    assert fb.select("score_source").distinct().collect()[0][0] == "heuristic"
    assert fb.where("risk_probability < 0.01 OR risk_probability > 0.95").count() == 0
    feats = ["age_at_admit", "admission_type", "insurance", "admit_hour", "is_weekend_admit", "gender"]
    train = align_for_inference(admissions, feats).join(admissions.select("hadm_id", "target_long_stay"), "hadm_id")
    model = M.train_model(train, feats, "logistic_regression")
    scored = score_admissions(admissions, policy, model=model, feature_columns=feats)
    rows = scored.collect()
    assert len(rows) == 300 and {r["score_source"] for r in rows} == {"model"}
    assert all((r["predicted_class"] == 1) == (r["risk_probability"] >= 0.4) for r in rows)
    assert {r["risk_tier"] for r in rows} <= {"High", "Moderate", "Low"}


def test_alignment_adds_absent_features(spark, admissions):
    out = align_for_inference(admissions.drop("age_at_admit"), ["age_at_admit", "age_band", "gender", "admit_month"])
    assert out.columns == ["hadm_id", "age_at_admit", "age_band", "gender", "admit_month"]
    r = out.where(F.col("hadm_id") == 1).collect()[0]
    assert r["age_at_admit"] is None and r["age_band"] == "Unknown" and r["gender"] is None and r["admit_month"] == 1
