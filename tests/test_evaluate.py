"""Evaluation operators against direct numpy definitions, ties and edge cases included."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylens.operators import evaluate as E

SCHEMA = "model string, hadm_id long, y_true int, y_pred int, y_score double"


def scored_df(spark, model, y, s):
    rows = [(model, i, int(a), int(b > 0.5), float(b)) for i, (a, b) in enumerate(zip(y, s))]
    return spark.createDataFrame(rows, SCHEMA)


def ref_auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = s[y == 1], s[y == 0]
    if len(pos) == 0 or len(neg) == 0:
        return None
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def ref_ap(y, s):
    y, s = np.asarray(y), np.asarray(s)
    P = y.sum()
    if P == 0:
        return 0.0
    ap = 0.0
    for t in np.unique(s):
        sel = s >= t
        prec = y[sel].sum() / sel.sum()
        ap += (y[s == t].sum() / P) * prec
    return ap


def ref_pr_table(y, s):
    y, s = np.asarray(y), np.asarray(s)
    P = y.sum()
    thr = sorted(np.unique(s), reverse=True)
    rows = []
    for t in thr:
        sel = s >= t
        tp = y[sel].sum()
        rows.append((t, tp / sel.sum(), tp / P if P else 1.0))
    return sorted(rows)


@pytest.fixture(scope="module")
def random_scored(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    s = np.round(np.clip(0.3 * y + rng.random(400) * 0.7, 0, 1), 2)  # many ties
    return y, s, scored_df(spark, "m", y, s)


def test_binary_metrics(random_scored):
    y, s, df = random_scored
    r = E.binary_metrics(df, rows_per_bucket=37).collect()[0]
    yp = (s > 0.5).astype(int)
    tp, fp, fn = ((y == 1) & (yp == 1)).sum(), ((y == 0) & (yp == 1)).sum(), ((y == 1) & (yp == 0)).sum()
    p, rc = tp / (tp + fp), tp / (tp + fn)
    assert r["accuracy"] == pytest.approx((y == yp).mean())
    assert r["precision"] == pytest.approx(p) and r["recall"] == pytest.approx(rc)
    assert r["f1"] == pytest.approx(2 * p * rc / (p + rc))
    assert r["roc_auc"] == pytest.approx(ref_auc(y, s))
    assert r["pr_auc"] == pytest.approx(ref_ap(y, s))
    assert r["brier_score"] == pytest.approx(np.mean((s - y) ** 2))


@pytest.mark.parametrize("per", [13, 100000])
def test_pr_table(random_scored, per):
    y, s, df = random_scored
    got = [(r["threshold"], r["precision"], r["recall"]) for r in E.threshold_table(df, rows_per_bucket=per).collect()]
    exp = ref_pr_table(y, s)
    assert len(got) == len(exp)
    for a, b in zip(got, exp):
        assert a == pytest.approx(b)


def test_every_distinct_score_is_a_threshold(spark):
    df = scored_df(spark, "m", [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])
    got = [(r["threshold"], r["precision"], r["recall"]) for r in E.threshold_table(df).collect()]
    assert got == [(0.1, 0.5, 1.0), (0.35, pytest.approx(2 / 3), 1.0), (0.4, 0.5, 0.5), (0.8, 1.0, 0.5)]


def test_single_class(spark):
    df = scored_df(spark, "m", [0, 0, 0], [0.1, 0.6, 0.3])
    r = E.binary_metrics(df).collect()[0]
    assert r["roc_auc"] is None and r["pr_auc"] == 0.0 and r["precision"] == 0.0 and r["recall"] == 0.0 and r["f1"] == 0.0


def test_perfect_and_constant(spark):
    perfect = E.binary_metrics(scored_df(spark, "m", [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])).collect()[0]
    assert perfect["roc_auc"] == 1.0 and perfect["pr_auc"] == 1.0
    const = scored_df(spark, "m", [0, 1, 0, 1], [0.3, 0.3, 0.3, 0.3])
    assert E.binary_metrics(const).collect()[0]["roc_auc"] == 0.5
    assert E.calibration_table(const).count() == 0


def test_tuning_and_selection(random_scored):
    y, s, df = random_scored
    tuning = E.threshold_tuning(df)
    rows = {r["threshold"]: r for r in tuning.collect()}
    assert len(rows) == 19
    for t, r in rows.items():
        pred = s >= t
        assert r["tp"] == ((y == 1) & pred).sum() and r["fp"] == ((y == 0) & pred).sum()
        assert r["tn"] == ((y == 0) & ~pred).sum() and r["fn"] == ((y == 1) & ~pred).sum()
    sel = E.select_operating_thresholds(tuning).collect()[0]
    best = sorted(rows.values(), key=lambda r: (-r["f1"], -r["youden_j"], r["threshold"]))[0]
    assert sel["balanced_threshold"] == best["threshold"]
    cands = [r for r in rows.values() if r["recall"] >= 0.8]
    rp = sorted(cands, key=lambda r: (-r["precision"], -r["f1"], r["threshold"]))[0]
    assert sel["recall_priority_threshold"] == rp["threshold"]


def test_tied_f1_picks_lower_threshold(spark):
    tuning = spark.createDataFrame(
        [("m", 0.3, 0.5, 0.9, 0.6, 0.2), ("m", 0.4, 0.5, 0.9, 0.6, 0.2), ("m", 0.5, 0.4, 0.5, 0.6, 0.1)],
        "model string, threshold double, f1 double, recall double, precision double, youden_j double",
    )
    sel = E.select_operating_thresholds(tuning).collect()[0]
    assert sel["balanced_threshold"] == 0.3 and sel["recall_priority_threshold"] == 0.3


def test_unreachable_recall_floor(spark):
    tuning = spark.createDataFrame(
        [("m", 0.3, 0.5, 0.6, 0.6, 0.2), ("m", 0.4, 0.5, 0.6, 0.7, 0.2), ("m", 0.5, 0.4, 0.5, 0.9, 0.1)],
        "model string, threshold double, f1 double, recall double, precision double, youden_j double",
    )
    assert E.select_operating_thresholds(tuning).collect()[0]["recall_priority_threshold"] == 0.4


def test_calibration_bins_match_quantile_rule(random_scored):
    y, s, df = random_scored
    cal = E.calibration_table(df, rows_per_bucket=50).collect()
    edges = np.unique(np.quantile(s, np.linspace(0, 1, 11)))
    bins = np.maximum((edges[None, :] < s[:, None]).sum(axis=1) - 1, 0)
    exp = {b: ((bins == b).sum(), s[bins == b].mean(), y[bins == b].mean()) for b in np.unique(bins)}
    assert len(cal) == len(exp)
    for r in cal:
        n, ps, oy = exp[r["bin"]]
        assert r["n"] == n and r["predicted_risk_mean"] == pytest.approx(ps) and r["observed_event_rate"] == pytest.approx(oy)


def test_classification_report_rows(spark):
    df = scored_df(spark, "m", [0, 0, 0], [0.1, 0.2, 0.3])
    labels = [r["label"] for r in E.classification_report(df).collect()]
    assert labels == ["0", "accuracy", "macro avg", "weighted avg"]
    acc = [r for r in E.classification_report(df).collect() if r["label"] == "accuracy"][0]
    assert acc["precision"] == acc["support"] == 1.0


def test_metric_melt_and_card(spark, random_scored):
    _, _, df = random_scored
    metrics = E.binary_metrics(df.unionByName(df.withColumn("model", F.lit("other"))))
    assert E.metric_melt(metrics).count() == 10
    prevalence = spark.createDataFrame([("gt_7d", "LOS > 7 days", 0.3)], "label_mode string, definition string, prevalence double")
    card = E.final_recommendation_card(metrics, prevalence).collect()[0]
    assert card["final_model_name"] in ("m", "other") and card["final_operating_threshold"] == 0.4
    assert card["business_recommendation"].endswith("0.40.")


def test_evaluation_bundle_holds_the_single_reports(random_scored):
    scored = random_scored[2]
    bundle = E.evaluate_classifier(scored)
    single = {
        "metrics": E.binary_metrics(scored), "confusion_matrix": E.confusion_matrix(scored),
        "classification_report": E.classification_report(scored), "threshold_table": E.threshold_table(scored),
    }
    assert set(bundle) == set(single)
    for name, df in single.items():
        assert sorted(map(str, bundle[name].collect())) == sorted(map(str, df.collect()))
