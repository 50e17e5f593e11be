"""Column expressions: bands, cleanup, weekend, labels, heuristic score, tiers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staylens.functions.columns import (
    age_band,
    fixed_day_label,
    heuristic_risk_score,
    normalize_category,
    percentile_label,
    risk_tier,
    weekend_flag,
)
from staylens.operators.labels import add_long_stay_labels
from staylens.sources.tables import nan_to_null


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_age_bands(spark):
    ages = [0, 17, 39, 40, 79, 80, 120, 121, -1, None]
    df = spark.createDataFrame([(a,) for a in ages], "a int")
    assert col_values(df, age_band("a")) == ["18-39", "18-39", "18-39", "40-49", "70-79", "80+", "80+", "Unknown", "Unknown", "Unknown"]


def test_category_cleanup(spark):
    vals = [None, "", "  ", "a\t", " a", "A", " CLINIC "]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    assert col_values(df, normalize_category("c")) == ["Unknown", "Unknown", "Unknown", "a", "a", "A", "CLINIC"]


def test_weekend_flag(spark):
    days = [dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6), dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 8), None]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    assert col_values(df, weekend_flag("t")) == [0, 1, 1, 0, 0]


def test_labels_at_limits(spark):
    df = spark.createDataFrame([(7.0,), (None,), (float("nan"),), (1.0,), (10.0,)], "los double")
    df = nan_to_null(df)
    assert col_values(df, fixed_day_label("los")) == [0, 0, 0, 0, 1]
    labeled = add_long_stay_labels(df, los_col="los").orderBy(F.col("los").asc_nulls_last())
    rows = labeled.collect()
    p90 = rows[0]["p90_threshold"]
    assert p90 == pytest.approx(7.0 + 0.8 * (10.0 - 7.0))  # h = 0.9 * (3 - 1) = 1.8
    assert [r["long_stay_gte_p90"] for r in rows] == [0, 0, 1, 0, 0]


def test_percentile_label_inclusive(spark):
    df = spark.createDataFrame([(5.0, 5.0), (4.999, 5.0), (None, 5.0)], "los double, t double")
    assert col_values(df, percentile_label("los", "t")) == [1, 0, 0]


def test_heuristic_score_and_clip(spark):
    rows = [(80, "EMERGENCY", 1, "Medicaid"), (66, "URGENT", 0, "Medicare"), (None, None, 0, None), (70, "ELECTIVE", 1, "Self Pay")]
    df = spark.createDataFrame(rows, "age int, typ string, wk int, ins string")
    got = col_values(df, heuristic_risk_score("age", "typ", "wk", "ins"))
    assert got == pytest.approx([0.08 + 0.18 + 0.22 + 0.04 + 0.03, 0.08 + 0.10 + 0.12, 0.08, 0.08 + 0.10 + 0.04 + 0.03])


def test_risk_tiers(spark):
    df = spark.createDataFrame([(0.40,), (0.24,), (0.2399,)], "p double")
    assert col_values(df, risk_tier("p", F.lit(0.40), F.lit(0.40))) == ["High", "Moderate", "Low"]
