"""Classifier evaluation over one long scored table (``model, y_true, y_pred, y_score``).

Every metric is computed per ``model`` in Spark.  Curves and ranking metrics use one
row per (model, distinct score) with positive/negative counts, ordered in buckets by
:func:`ordered_prefix`, so ties are counted rather than sorted and no model's scores
are sorted in a single task.  Threshold grids and decile edges are tiny, bounded
tables joined by model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens import config as C
from staylens.functions.columns import label_definition_text
from staylens.operators.ordered import OrderKey, exact_percentiles, ordered_prefix


def _div0(num: Column, den: Column) -> Column:
    """num / den as double, 0.0 when den is 0 (zero_division=0)."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) > 0, (F.lit(2.0) * p * r) / (p + r)).otherwise(F.lit(0.0))


def score_counts(scored: DataFrame) -> DataFrame:
    """model, y_score, pos, neg (one row per distinct score)."""
    y = F.col("y_true").cast("long")
    return scored.groupBy("model", "y_score").agg(F.sum(y).alias("pos"), (F.count(F.lit(1)) - F.sum(y)).alias("neg"))


def _curve(scored: DataFrame, **prefix_kw) -> DataFrame:
    """Per distinct score (descending): tp/fp at threshold ``score`` plus model totals."""
    vc = score_counts(scored)
    pref = ordered_prefix(
        vc, ["model"], [OrderKey("y_score", ascending=False)], {"pos": "pos", "neg": "neg"},
        **prefix_kw,
    )
    totals = vc.groupBy("model").agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return pref.join(F.broadcast(totals), on="model", how="inner").select(  # one row per model
        "model", "y_score", "pos", "neg", "n_pos", "n_neg", F.col("_cum_pos").alias("tp"), F.col("_cum_neg").alias("fp")
    )


def threshold_table(scored: DataFrame, **prefix_kw) -> DataFrame:
    """Precision and recall at every distinct score, ascending by threshold (the endpoint
    row of the curve, which has no threshold, is not included)."""
    return _curve(scored, **prefix_kw).select(
        "model",
        F.col("y_score").alias("threshold"),
        (F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")).alias("precision"),
        F.when(F.col("n_pos") > 0, F.col("tp").cast("double") / F.col("n_pos").cast("double")).otherwise(F.lit(1.0)).alias("recall"),
    ).orderBy("model", "threshold")


def binary_metrics(scored: DataFrame, **prefix_kw) -> DataFrame:
    """model, accuracy, precision, recall, f1, roc_auc, pr_auc, brier_score."""
    y, yp, s = F.col("y_true"), F.col("y_pred"), F.col("y_score")
    counts = scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((y == 1) & (yp == 1)).alias("tp"),
        F.count_if((y == 0) & (yp == 0)).alias("tn"),
        F.count_if((y == 0) & (yp == 1)).alias("fp"),
        F.count_if((y == 1) & (yp == 0)).alias("fn"),
        F.avg(F.pow(s - y.cast("double"), 2)).alias("brier_score"),
    )
    c = _curve(scored, **prefix_kw)
    above = (F.col("tp") - F.col("pos")).cast("double")
    ranked = c.groupBy("model").agg(
        F.first("n_pos").alias("n_pos"),
        F.first("n_neg").alias("n_neg"),
        F.sum(F.col("neg").cast("double") * (above + F.lit(0.5) * F.col("pos").cast("double"))).alias("_auc"),
        F.sum(
            F.when(F.col("n_pos") > 0, (F.col("pos").cast("double") / F.col("n_pos").cast("double")) * (F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")))
        ).alias("_ap"),
    )
    precision = _div0(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _div0(F.col("tp"), F.col("tp") + F.col("fn"))
    out = counts.join(ranked, on="model", how="left")
    return out.select(
        "model",
        ((F.col("tp") + F.col("tn")).cast("double") / F.col("n").cast("double")).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
        F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), F.col("_auc") / (F.col("n_pos") * F.col("n_neg")).cast("double")).alias("roc_auc"),
        F.when(F.col("n_pos") > 0, F.col("_ap")).otherwise(F.lit(0.0)).alias("pr_auc"),
        "brier_score",
    )


def compare_model_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.col("pr_auc").desc_nulls_last(), F.col("roc_auc").desc_nulls_last(), F.col("model"))


def metric_melt(metrics: DataFrame, names: Sequence[str] = C.COMPARISON_METRICS) -> DataFrame:
    present = [m for m in names if m in metrics.columns]
    return metrics.unpivot("model", present, "metric", "score")


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """model, actual (actual_0 / actual_1), pred_0, pred_1 (labels fixed to 0 and 1)."""
    y, yp = F.col("y_true"), F.col("y_pred")
    agg = scored.groupBy("model").agg(
        F.count_if((y == 0) & (yp == 0)).alias("tn"), F.count_if((y == 0) & (yp == 1)).alias("fp"),
        F.count_if((y == 1) & (yp == 0)).alias("fn"), F.count_if((y == 1) & (yp == 1)).alias("tp"),
    )
    rows = F.array(
        F.struct(F.lit("actual_0").alias("actual"), F.col("tn").alias("pred_0"), F.col("fp").alias("pred_1")),
        F.struct(F.lit("actual_1").alias("actual"), F.col("fn").alias("pred_0"), F.col("tp").alias("pred_1")),
    )
    return agg.select("model", F.inline(rows))


def classification_report(scored: DataFrame) -> DataFrame:
    """Per class present in y or y_pred, then accuracy (its value in every column),
    macro and support-weighted averages; zero divisions give 0."""
    y, yp = F.col("y_true"), F.col("y_pred")
    agg = scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(y == k).alias(f"sup{k}") for k in (0, 1)],
        *[F.count_if(yp == k).alias(f"pred{k}") for k in (0, 1)],
        *[F.count_if((y == k) & (yp == k)).alias(f"hit{k}") for k in (0, 1)],
    )
    for k in (0, 1):
        p, r = _div0(F.col(f"hit{k}"), F.col(f"pred{k}")), _div0(F.col(f"hit{k}"), F.col(f"sup{k}"))
        agg = agg.withColumns({f"p{k}": p, f"r{k}": r}).withColumn(f"f{k}", _f1(F.col(f"p{k}"), F.col(f"r{k}")))
        agg = agg.withColumn(f"on{k}", (F.col(f"sup{k}") + F.col(f"pred{k}")) > 0)
    present = F.col("on0").cast("int") + F.col("on1").cast("int")

    def macro(m):
        return (F.when(F.col("on0"), F.col(f"{m}0")).otherwise(0.0) + F.when(F.col("on1"), F.col(f"{m}1")).otherwise(0.0)) / present.cast("double")

    def weighted(m):
        return (F.col(f"{m}0") * F.col("sup0") + F.col(f"{m}1") * F.col("sup1")) / F.col("n").cast("double")

    acc = (F.col("hit0") + F.col("hit1")).cast("double") / F.col("n").cast("double")

    def row(label, p, r, f, sup, keep):
        return F.when(keep, F.struct(F.lit(label).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"), sup.cast("double").alias("support")))

    rows = F.array(
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("sup0"), F.col("on0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("sup1"), F.col("on1")),
        row("accuracy", acc, acc, acc, acc, F.lit(True)),
        row("macro avg", macro("p"), macro("r"), macro("f"), F.col("n"), F.lit(True)),
        row("weighted avg", weighted("p"), weighted("r"), weighted("f"), F.col("n"), F.lit(True)),
    )
    return agg.select("model", F.inline(F.filter(rows, lambda x: x.isNotNull())))


def threshold_tuning(scored: DataFrame, thresholds: Sequence[float] = C.TUNING_THRESHOLDS) -> DataFrame:
    """Metrics at fixed thresholds (``score >= t``).  Each row falls in one of
    len(thresholds) + 1 score bands; band counts are suffix-summed, so the grid costs one
    aggregation, not one pass (or one cross-join copy) per threshold."""
    ts = sorted(float(t) for t in thresholds)
    grid = F.array(*[F.lit(t) for t in ts])
    y = F.col("y_true").cast("long")
    band = F.size(F.filter(grid, lambda t: t <= F.col("y_score")))
    per = scored.groupBy("model", band.alias("band")).agg(F.sum(y).alias("pos"), (F.count(F.lit(1)) - F.sum(y)).alias("neg"))
    agg = per.groupBy("model").agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        *[F.sum(F.when(F.col("band") >= k + 1, F.col("pos")).otherwise(0)).alias(f"tp{k}") for k in range(len(ts))],
        *[F.sum(F.when(F.col("band") >= k + 1, F.col("neg")).otherwise(0)).alias(f"fp{k}") for k in range(len(ts))],
    )
    rows = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"tp{k}").alias("tp"), F.col(f"fp{k}").alias("fp")) for k, t in enumerate(ts)])
    long = agg.select("model", "n_pos", "n_neg", F.inline(rows))
    tp, fp = F.col("tp"), F.col("fp")
    tn, fn = F.col("n_neg") - fp, F.col("n_pos") - tp
    precision, recall, specificity = _div0(tp, tp + fp), _div0(tp, tp + fn), _div0(tn, tn + fp)
    out = long.withColumns({"precision": precision, "recall": recall, "specificity": specificity})
    out = out.withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    out = out.withColumn("youden_j", F.col("recall") + F.col("specificity") - F.lit(1.0))
    return out.select(
        "model", "threshold", "precision", "recall", "f1", "specificity", "youden_j",
        tp.cast("long").alias("tp"), tn.cast("long").alias("tn"), fp.cast("long").alias("fp"), fn.cast("long").alias("fn"),
    ).orderBy("model", "threshold")


def select_operating_thresholds(tuning: DataFrame, recall_min: float = C.RECALL_PRIORITY_MIN_RECALL) -> DataFrame:
    """Balanced: max (f1, youden_j).  Recall priority: among recall >= recall_min the max
    (precision, f1), else the max (recall, precision).  Ties go to the lower threshold."""
    row = F.struct("threshold", "f1", "recall", "precision")
    neg_t = -F.col("threshold")
    ok = F.col("recall") >= F.lit(float(recall_min))
    sel = tuning.groupBy("model").agg(
        F.max_by(row, F.struct("f1", "youden_j", neg_t)).alias("b"),
        F.max_by(row, F.when(ok, F.struct("precision", "f1", neg_t))).alias("rc"),
        F.max_by(row, F.struct("recall", "precision", neg_t)).alias("rf"),
    )
    r = F.coalesce(F.col("rc"), F.col("rf"))
    return sel.select(
        "model",
        F.col("b.threshold").alias("balanced_threshold"), F.col("b.f1").alias("balanced_f1"),
        F.col("b.recall").alias("balanced_recall"), F.col("b.precision").alias("balanced_precision"),
        r["threshold"].alias("recall_priority_threshold"), r["f1"].alias("recall_priority_f1"),
        r["recall"].alias("recall_priority_recall"), r["precision"].alias("recall_priority_precision"),
    )


def mark_selected_thresholds(tuning: DataFrame, selection: DataFrame) -> DataFrame:
    sel = selection.select("model", "balanced_threshold", "recall_priority_threshold")
    out = tuning.join(sel, on="model", how="left")
    return out.withColumns(
        {
            "is_balanced": F.when(F.col("threshold") == F.col("balanced_threshold"), 1).otherwise(0),
            "is_recall_priority": F.when(F.col("threshold") == F.col("recall_priority_threshold"), 1).otherwise(0),
        }
    ).drop("balanced_threshold", "recall_priority_threshold")


def _linspace(n_bins: int) -> list[float]:
    step = 1.0 / n_bins
    return [i * step for i in range(n_bins)] + [1.0]


def calibration_table(scored: DataFrame, n_bins: int = 10, **prefix_kw) -> DataFrame:
    """Quantile bins of the score (exact interpolated edges, duplicates dropped,
    right-closed, lowest included): n, mean predicted, observed rate, absolute gap.
    A model whose edges collapse to one value has no rows."""
    edges_long = exact_percentiles(scored, "y_score", _linspace(n_bins), ["model"], **prefix_kw)
    edges = edges_long.groupBy("model").agg(F.array_sort(F.array_distinct(F.collect_list("value"))).alias("_edges"))
    edges = edges.where(F.size("_edges") >= 2)  # at most n_bins + 1 values per model
    s = F.col("y_score")
    binned = scored.join(F.broadcast(edges), on="model", how="inner").withColumn(
        "bin", F.greatest(F.size(F.filter("_edges", lambda e: e < s)) - 1, F.lit(0))
    )
    out = binned.groupBy("model", "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(s).alias("predicted_risk_mean"),
        F.avg(F.col("y_true").cast("double")).alias("observed_event_rate"),
    )
    return out.withColumn("abs_calibration_gap", F.abs(F.col("predicted_risk_mean") - F.col("observed_event_rate"))).orderBy("model", "bin")


def final_recommendation_card(
    metrics: DataFrame,
    prevalence: DataFrame,
    selection: DataFrame | None = None,
    final_label_mode: str = C.FINAL_LABEL_MODE,
    final_model_name: str = C.FINAL_MODEL_NAME,
    final_operating_threshold: float = C.FINAL_BALANCED_THRESHOLD,
) -> DataFrame:
    """One-row decision card.  The named model, else the best PR-AUC model; the tuned
    balanced threshold of that model replaces the configured one when a selection is
    given, while the recommendation text keeps the configured value."""
    named = F.when(F.col("model") == F.lit(final_model_name), 1).otherwise(0)
    rank_key = F.struct(named, F.coalesce(F.col("pr_auc"), F.lit(-1.0)), F.coalesce(F.col("roc_auc"), F.lit(-1.0)), F.lit(0))
    chosen = metrics.agg(F.max_by(F.struct(*metrics.columns), rank_key).alias("m")).select("m.*")
    label = prevalence.where(F.col("label_mode") == final_label_mode).agg(
        F.first("definition").alias("final_label_definition"), F.first("prevalence").alias("final_label_prevalence")
    )
    card = chosen.crossJoin(F.broadcast(label))  # one row each
    threshold = F.lit(float(final_operating_threshold))
    if selection is not None:
        card = card.join(selection.select("model", "balanced_threshold"), on="model", how="left")
        threshold = F.coalesce(F.col("balanced_threshold"), threshold)
    text = C.CARD_RECOMMENDATION_PREFIX + f"{float(final_operating_threshold):.2f}."
    return card.select(
        F.lit(final_label_mode).alias("final_label_mode"),
        "final_label_definition",
        F.col("final_label_prevalence").cast("double").alias("final_label_prevalence"),
        F.col("model").alias("final_model_name"),
        threshold.alias("final_operating_threshold"),
        F.col("accuracy").alias("final_model_accuracy"),
        F.col("recall").alias("final_model_recall"),
        F.col("precision").alias("final_model_precision"),
        F.col("f1").alias("final_model_f1"),
        F.col("roc_auc").alias("final_model_roc_auc"),
        F.col("pr_auc").alias("final_model_pr_auc"),
        F.lit(C.CARD_TRADEOFF_TEXT).alias("interpretability_tradeoff"),
        F.lit(text).alias("business_recommendation"),
    )


def evaluate_classifier(scored: DataFrame, **prefix_kw) -> dict[str, DataFrame]:
    """The evaluation bundle for every model in the scored table."""
    return {
        "metrics": binary_metrics(scored, **prefix_kw),
        "confusion_matrix": confusion_matrix(scored),
        "classification_report": classification_report(scored),
        "threshold_table": threshold_table(scored, **prefix_kw),
    }


__all__ = [
    "binary_metrics", "calibration_table", "classification_report", "compare_model_metrics", "confusion_matrix",
    "evaluate_classifier", "final_recommendation_card", "label_definition_text", "mark_selected_thresholds",
    "metric_melt", "score_counts", "select_operating_thresholds", "threshold_table", "threshold_tuning",
]
