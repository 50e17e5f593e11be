"""Registered queries: one Spark plan per operator of the inventory.

Each callable takes ``(spark, sf_dir)``, builds its inputs from the driver tables
through the adapter, and returns a DataFrame.  Double columns are rounded to 6 places
(the same rounding is applied in the oracle SQL) so engine-specific last-bit differences
in sums and averages do not hide real mismatches."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens import config as C
from staylens.operators import evaluate as E
from staylens.operators import labels as L
from staylens.operators import profile as P
from staylens.operators import quality as Q
from staylens.operators.features import engineer_admission_time_features, engineer_demographic_features, normalize_categorical_labels
from staylens.operators.boost import gain_importance, train_boosted
from staylens.operators.forest import bag_weights
from staylens.operators.linear import linear_relation, optimality
from staylens.operators.ml import (
    feature_names,
    logistic_importance,
    permutation_importance,
    permuted_copies,
    predict_scores,
    preprocess_stats,
    run_baseline_model_suite,
    split_counts,
    stratified_split,
    train_model,
    tree_importance,
)
from staylens.operators.outliers import long_stay_outlier_review
from staylens.operators.score import add_heuristic_score, align_for_inference, apply_policy, resolve_policy, score_admissions, score_from_artifacts
from staylens.plans import fixtures as X
from staylens.session import checkpoint_dir
from staylens.operators.cohort import build_cohort_python, build_cohort_sql
from staylens.sources.adapter import edge_relations
from staylens.sources.artifacts import load_model_bundle, save_model_bundle
from staylens.sources.sinks import save_dataframe, save_report_tables
from staylens.sources.tables import load_admissions, load_cohort, load_core_admissions_dataset

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}

MISSING_REPORT_COLUMNS = (
    "subject_id", "hadm_id", "admittime", "dischtime", "los_days", "gender", "age_at_admit",
    "admission_type", "admission_location", "insurance", "language", "marital_status", "race",
)
OPTION_COLUMNS = ("admission_type", "admission_location", "insurance", "language", "marital_status", "race")
SUBGROUP_RATE_COLUMNS = ("admission_type", "insurance", "hospital_expire_flag")
FIXTURE_POLICY_MODEL = "score_rule"


def present(df: DataFrame) -> DataFrame:
    """Round double columns to 6 places for comparison (+ 0.0 turns -0.0 into 0.0)."""
    exprs = {f.name: F.round(F.col(f.name), 6) + F.lit(0.0) for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(exprs) if exprs else df


def query(name: str):
    def register(fn):
        def run(spark, sf_dir):
            X.release()
            return present(fn(spark, sf_dir))

        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn

    return register


# ---- cohort ------------------------------------------------------------------------
@query("cohort_sql")
def q_cohort_sql(spark, sf):
    """P5 SQL mode (W1 + J1 + P1-P4), ordered by admit time (T1)."""
    return X.cohort_sql(spark, sf, ordered=True)


@query("cohort_py")
def q_cohort_py(spark, sf):
    """P5 Python mode (J2 + W2)."""
    return X.cohort_python(spark, sf)


@query("normalized_categories")
def q_normalized(spark, sf):
    """P9 categorical cleanup."""
    cols = ["hadm_id", *C.DEFAULT_CATEGORICAL_COLUMNS, "admission_location"]
    return X.cohort_clean(spark, sf).select(*cols)


# ---- profiling ---------------------------------------------------------------------
@query("los_overall")
def q_los_overall(spark, sf):
    """A2 overall summary with both thresholds and shares."""
    c, kw = X.bounded(X.cohort_sql(spark, sf, with_patients=False))
    return P.los_overall_summary(c, **kw)


@query("los_summary")
def q_los_summary(spark, sf):
    """A1 eleven LOS statistics."""
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return P.los_summary_table(c, **kw)


@query("los_percentiles")
def q_los_percentiles(spark, sf):
    """A3 percentile table."""
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return P.los_percentile_table(c, **kw)


@query("subgroup_summary")
def q_subgroup_summary(spark, sf):
    """A8 subgroup summary over three dimensions in one pass."""
    c, kw = X.bounded(X.cohort_sql(spark, sf, with_patients=False))
    return P.subgroup_summary(c, **kw)


@query("subgroup_summary_union")
def q_subgroup_summary_union(spark, sf):
    """U1: the same subgroup summary as a UNION ALL of one aggregate per dimension."""
    c, kw = X.bounded(X.cohort_sql(spark, sf, with_patients=False))
    return P.subgroup_summary_union(c, **kw)


@query("subgroup_rates")
def q_subgroup_rates(spark, sf):
    """A9 long-form subgroup rates for both labels."""
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return P.subgroup_long_stay_rates(L.add_long_stay_labels(c, **kw), SUBGROUP_RATE_COLUMNS)


@query("subgroup_share")
def q_subgroup_share(spark, sf):
    """A10 single-dimension long-stay share."""
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return P.long_stay_share_by(L.add_long_stay_labels(c, **kw), "insurance", "long_stay_gt_7d")


@query("definition_comparison")
def q_definition_comparison(spark, sf):
    """A6 two-row definition comparison."""
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return L.long_stay_definition_comparison(c, **kw)


@query("label_prevalence")
def q_label_prevalence(spark, sf):
    """A7 label prevalence table."""
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return L.label_prevalence_table(c, **kw)


@query("label_recommendation")
def q_label_recommendation(spark, sf):
    """A22 label recommendation."""
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return L.recommend_long_stay_definition(L.long_stay_definition_comparison(c, **kw))


@query("outlier_review")
def q_outlier_review(spark, sf):
    """T2 (W3, W4) long-stay outlier review."""
    c, kw = X.bounded(X.cohort_sql(spark, sf))
    return long_stay_outlier_review(c, **kw)


@query("bed_day_concentration")
def q_bed_days(spark, sf):
    """A16 overall bed-day concentration."""
    return P.bed_day_concentration(X.cohort_clean(spark, sf))


@query("bed_day_by_location")
def q_bed_days_by(spark, sf):
    """A16 admission share vs long-stay bed-day share by admission location."""
    return P.bed_day_concentration_by(X.cohort_clean(spark, sf), "admission_location")


@query("calendar_subgroup")
def q_calendar(spark, sf):
    """A17 Fri-Sun vs Mon-Thu."""
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return P.calendar_subgroup(c, **kw)


@query("rate_ratio")
def q_rate_ratio(spark, sf):
    """A18 rate ratio against the physician-referral group."""
    return P.rate_ratio(X.cohort_clean(spark, sf), "admission_location", "PHYSICIAN REFERRAL")


@query("los_histogram")
def q_histogram(spark, sf):
    """A19 50-bin histogram."""
    return P.los_histogram(X.cohort_clean(spark, sf), bins=50)


@query("los_density")
def q_density(spark, sf):
    """A20 Gaussian density on a 200-point grid."""
    return P.los_density(X.cohort_clean(spark, sf), points=200)


@query("option_lists")
def q_option_lists(spark, sf):
    """A15 sorted distinct values per column."""
    return P.option_lists(X.cohort_clean(spark, sf), OPTION_COLUMNS)


# ---- quality -----------------------------------------------------------------------
@query("missing_report")
def q_missing(spark, sf):
    """A11 missing-value report."""
    return Q.missing_value_report(X.cohort_clean(spark, sf), MISSING_REPORT_COLUMNS)


@query("duplicate_report")
def q_duplicates(spark, sf):
    """A12 duplicate admission ids on the raw admissions."""
    adm, _ = X.relations(spark, sf)
    return Q.duplicate_admission_report(adm, "hadm_id")


@query("sanity_summary")
def q_sanity(spark, sf):
    """A13 raw vs clean sanity summary."""
    adm, _ = X.relations(spark, sf)
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return Q.sanity_summary(adm, c, **kw)


@query("integrity_checks")
def q_integrity(spark, sf):
    """A23 integrity checks."""
    featured, safe = X.modeling_dataset(spark, sf)
    return Q.integrity_checks(featured, safe)


@query("feature_overview")
def q_feature_overview(spark, sf):
    """A14 feature overview of the safe features."""
    featured, safe = X.modeling_dataset(spark, sf)
    return Q.feature_overview(featured, safe)


# ---- features and labels -----------------------------------------------------------
@query("calendar_features")
def q_calendar_features(spark, sf):
    """F1 calendar features."""
    return engineer_admission_time_features(X.cohort_clean(spark, sf)).select(
        "hadm_id", "admit_hour", "admit_dayofweek", "admit_month", "is_weekend_admit"
    )


@query("age_bands")
def q_age_bands(spark, sf):
    """F2 age and age band."""
    return engineer_demographic_features(X.cohort_clean(spark, sf)).select("hadm_id", "age_at_admit", "age_band")


@query("modeling_dataset")
def q_modeling_dataset(spark, sf):
    """F5 modeling dataset restricted to id, safe features and LOS."""
    featured, safe = X.modeling_dataset(spark, sf)
    return featured.select("hadm_id", *safe, "los_days")


@query("labels")
def q_labels(spark, sf):
    """F6 / P6 / P7 both labels with the p90 threshold."""
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return L.add_long_stay_labels(c, **kw).select("hadm_id", "los_days", "long_stay_gt_7d", "long_stay_gte_p90", "p90_threshold")


@query("target_label")
def q_target_label(spark, sf):
    """P8 target label in percentile mode."""
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return L.make_target_label(c, "gte_p90", **kw).select("hadm_id", "target_long_stay", "target_threshold")


@query("target_prevalence")
def q_target_prevalence(spark, sf):
    """A21 target prevalence of the fixed-day label."""
    return P.target_prevalence(L.make_target_label(X.cohort_clean(spark, sf), "gt_7d"))


# ---- evaluation on the fixture scores -----------------------------------------------
@query("pr_curve")
def q_pr_curve(spark, sf):
    """E1 precision/recall at every distinct score."""
    s, kw = X.bounded(X.scored(spark, sf))
    return E.threshold_table(s, **kw)


@query("binary_metrics")
def q_binary_metrics(spark, sf):
    """E2-E5 accuracy, precision, recall, F1, ROC-AUC, average precision, Brier."""
    s, kw = X.bounded(X.scored(spark, sf))
    return E.binary_metrics(s, **kw)


@query("model_comparison")
def q_model_comparison(spark, sf):
    """E9 metrics sorted by PR-AUC then ROC-AUC."""
    s, kw = X.bounded(X.scored(spark, sf))
    return E.compare_model_metrics(E.binary_metrics(s, **kw))


@query("metric_melt")
def q_metric_melt(spark, sf):
    """E18 metrics in long form."""
    s, kw = X.bounded(X.scored(spark, sf))
    return E.metric_melt(E.binary_metrics(s, **kw))


@query("confusion_matrix")
def q_confusion(spark, sf):
    """E6 confusion matrix."""
    return E.confusion_matrix(X.scored(spark, sf))


@query("classification_report")
def q_report(spark, sf):
    """E7 classification report."""
    return E.classification_report(X.scored(spark, sf))


@query("threshold_tuning")
def q_tuning(spark, sf):
    """E10 threshold tuning grid."""
    return E.threshold_tuning(X.scored(spark, sf))


@query("operating_thresholds")
def q_operating(spark, sf):
    """E11 balanced and recall-priority thresholds."""
    return E.select_operating_thresholds(E.threshold_tuning(X.scored(spark, sf)))


@query("marked_thresholds")
def q_marked(spark, sf):
    """E12 tuning table with the chosen thresholds marked."""
    tuning = E.threshold_tuning(X.scored(spark, sf))
    return E.mark_selected_thresholds(tuning, E.select_operating_thresholds(tuning))


@query("calibration")
def q_calibration(spark, sf):
    """E13 decile calibration."""
    s, kw = X.bounded(X.scored(spark, sf))
    return E.calibration_table(s, **kw)


@query("decision_card")
def q_card(spark, sf):
    """E17 final decision card (named model absent -> best PR-AUC model)."""
    scored, kw = X.bounded(X.scored(spark, sf))
    metrics = E.binary_metrics(scored, **kw)
    prevalence = L.label_prevalence_table(X.cohort_sql(spark, sf), **kw)
    selection = E.select_operating_thresholds(E.threshold_tuning(scored))
    return E.final_recommendation_card(metrics, prevalence, selection)


# ---- scoring -----------------------------------------------------------------------
@query("heuristic_score")
def q_heuristic(spark, sf):
    """R1 fallback score over the whole cohort."""
    return add_heuristic_score(X.cohort_clean(spark, sf)).select("hadm_id", "risk_probability")


@query("risk_tier")
def q_risk_tier(spark, sf):
    """R4 + R5 + R7: heuristic score, thresholds from the marked tuning table, tier."""
    cohort = X.cohort_sql(spark, sf)
    tuning = X.reused(E.threshold_tuning(X.scored_relation(cohort)))  # 19 rows per model, read twice
    marked = E.mark_selected_thresholds(tuning, E.select_operating_thresholds(tuning))
    policy = resolve_policy(spark, marked, model=FIXTURE_POLICY_MODEL)
    scored = add_heuristic_score(cohort)
    return apply_policy(scored, policy).select("hadm_id", "risk_probability", "balanced_threshold", "recall_priority_threshold", "predicted_class", "risk_tier")


@query("aligned_inference")
def q_aligned(spark, sf):
    """R2 inference alignment of the admissions table to the training feature order."""
    adm, _ = X.relations(spark, sf)
    feats = list(C.CANDIDATE_FEATURE_COLUMNS)
    return align_for_inference(normalize_categorical_labels(adm), feats)


# ---- training inputs (value-checked) -------------------------------------------------
@query("split_counts")
def q_split_counts(spark, sf):
    """M1 exact stratified split counts."""
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return split_counts(stratified_split(L.make_target_label(c, "gt_7d"), **kw))


@query("preprocess_stats")
def q_preprocess(spark, sf):
    """M2 fit statistics (median, mean, population std, mode) over the modeling dataset."""
    featured, safe = X.modeling_dataset(spark, sf)
    _, kw = X.bounded(featured)
    return preprocess_stats(featured, safe, **kw)


# ---- training: fitted again by the oracle SQL ------------------------------------------------
def _train_test(spark, sf):
    featured, safe = X.modeling_dataset(spark, sf)
    featured, kw = X.bounded(featured.select("hadm_id", "los_days", *safe))  # what the models read
    split = X.reused(stratified_split(L.make_target_label(featured, "gt_7d"), **kw))
    split.count()  # fills the cache, so that the rows before the split need not be kept
    featured.unpersist()
    return split.where(F.col("split") == "train"), split.where(F.col("split") == "test"), safe, kw


@query("split_membership")
def q_split_membership(spark, sf):
    """M1: which rows are train and test."""
    c, kw = X.bounded(X.cohort_clean(spark, sf))
    return stratified_split(L.make_target_label(c, "gt_7d"), **kw).select("hadm_id", "target_long_stay", "split")


@query("model_scores")
def q_model_scores(spark, sf):
    """M3 + M6: class-balanced logistic regression scored on the test split."""
    train, test, safe, _ = _train_test(spark, sf)
    model = train_model(train, safe, "logistic_regression")
    return predict_scores(model, test, "logistic_regression")


# The gradient per unit of class weight below which a fitted column counts as optimal.
GRADIENT_BOUND = 1e-9


@query("linear_optimality")
def q_linear_optimality(spark, sf):
    """M3 + E14: every coefficient, and whether the penalised loss is flat in it."""
    train, _, safe, _ = _train_test(spark, sf)
    found = optimality(train, linear_relation(spark, train_model(train, safe, "logistic_regression")))
    flat = F.abs("gradient") <= F.col("loss_scale") * GRADIENT_BOUND
    return found.select("feature", "coefficient", flat.alias("gradient_is_zero"))


@query("feature_importance")
def q_feature_importance(spark, sf):
    """E14 + T4: top-20 logistic coefficients by absolute value, with expanded names."""
    train, _, safe, _ = _train_test(spark, sf)
    return logistic_importance(spark, train_model(train, safe, "logistic_regression"), top_n=20)


def _boosted_round(spark, sf):
    train, _, safe, kw = _train_test(spark, sf)
    return train_boosted(train, safe, rounds=1, max_depth=2, **kw)


@query("boosted_round")
def q_boosted_round(spark, sf):
    """M5: splits, gains and leaves of one boosting round of depth 2, rows and columns drawn."""
    return _boosted_round(spark, sf).node_table(spark)


@query("boosted_importance")
def q_boosted_importance(spark, sf):
    """M5 + E15: gain importance of that round's columns."""
    model = _boosted_round(spark, sf)
    return gain_importance(model.node_table(spark), model.columns)


@query("forest_bags")
def q_forest_bags(spark, sf):
    """M4: rows, bag size and weight per tree and class of 20 trees."""
    train, _, _, _ = _train_test(spark, sf)
    return bag_weights(train, 20)


@query("tree_importance")
def q_tree_importance(spark, sf):
    """E15: importances of a small forest from its node table, against the fitted model's."""
    train, test, safe, _ = _train_test(spark, sf)
    model = train_model(train, safe, "random_forest", num_trees=3)
    names = feature_names(model, test)
    fitted = spark.createDataFrame(list(zip(names, model.stages[-1].featureImportances.toArray().tolist())), "feature string, fitted double")
    made = tree_importance(model, names, top_n=len(names)).join(fitted, "feature")
    return made.select("feature", (F.abs(F.col("importance") - F.col("fitted")) <= 1e-9).alias("equals_fitted"))


@query("permutation_importance")
def q_permutation_importance(spark, sf):
    """E16 + T4: accuracy drop per permuted raw feature, 20 repeats, top 20."""
    train, test, safe, kw = _train_test(spark, sf)
    model = train_model(train, safe, "logistic_regression")
    return permutation_importance(model, test, safe, n_repeats=20, top_n=20, **kw)


@query("model_risk_scoring")
def q_model_risk_scoring(spark, sf):
    """R3 + R5 + R4 with a model: logistic regression trained on the train split, its test
    scores tuned into a policy, then the whole cohort scored by the model's relation."""
    train, test, safe, kw = _train_test(spark, sf)
    model = train_model(train, safe, "logistic_regression")
    tuning = E.threshold_tuning(predict_scores(model, test, "logistic_regression"))
    marked = E.mark_selected_thresholds(tuning, E.select_operating_thresholds(tuning))
    policy = resolve_policy(spark, marked, {"primary_model_name": "logistic_regression"})
    featured, _ = X.modeling_dataset(spark, sf)
    scored = score_admissions(featured, policy, feature_columns=safe, relation=linear_relation(spark, model))
    return scored.select("hadm_id", "risk_probability", "predicted_class", "risk_tier", "score_source")


# ---- the plan for large inputs, value-checked on small ones --------------------------------
BUCKETED = ("los_overall", "outlier_review", "pr_curve", "calibration", "split_counts", "subgroup_summary")
BUCKET_ROWS = 500


def _bucketed(name: str) -> None:
    def fn(spark, sf):
        with X.bucket_rows(BUCKET_ROWS):
            return REGISTRY[name](spark, sf)

    fn.__doc__ = f"{REGISTRY[name].__doc__}  In buckets of {BUCKET_ROWS} rows, as for large inputs."
    REGISTRY[f"{name}_bucketed"] = fn


for _name in BUCKETED:
    _bucketed(_name)


# ---- readers and writers: written to the shared folder, read back --------------------------
def _folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}"


def _saved_admissions(spark, sf, suffix: str):
    folder = _folder(spark)
    save_dataframe(X.relations(spark, sf)[0], f"{folder}/admissions.{suffix}")
    return load_admissions(spark, folder)


@query("admissions_csv")
def q_admissions_csv(spark, sf):
    """S2 + S3 + S5 + S9: derived admissions as CSV and back."""
    return _saved_admissions(spark, sf, "csv")


@query("admissions_csv_gz")
def q_admissions_csv_gz(spark, sf):
    """S2 + S5 + S9: derived admissions as gz CSV and back."""
    return _saved_admissions(spark, sf, "csv.gz")


@query("admissions_parquet")
def q_admissions_parquet(spark, sf):
    """S2 + S5 + S9: derived admissions as Parquet and back."""
    return _saved_admissions(spark, sf, "parquet")


@query("core_dataset_csv")
def q_core_dataset(spark, sf):
    """S6 + S7: both tables as CSV, ids written with a fraction point, loaded and merged."""
    adm, pat = X.relations(spark, sf)
    folder = _folder(spark)
    save_dataframe(adm.withColumn("subject_id", F.col("subject_id").cast("double")), f"{folder}/admissions.csv")
    pointed = {c: F.concat(F.col(c).cast("string"), F.lit(".0")) for c in ("subject_id", "anchor_age", "anchor_year")}
    save_dataframe(pat.withColumns(pointed), f"{folder}/patients.csv")
    return load_core_admissions_dataset(spark, folder, folder)


@query("cohort_reload_csv")
def q_cohort_reload_csv(spark, sf):
    """S11 + S12: the cohort written as CSV and reloaded."""
    path = save_dataframe(X.cohort_sql(spark, sf), f"{_folder(spark)}/cohort.csv")
    return load_cohort(spark, path)


@query("cohort_reload_parquet")
def q_cohort_reload_parquet(spark, sf):
    """S11: the cohort written as Parquet and reloaded."""
    path = save_report_tables({"cohort": X.cohort_sql(spark, sf)}, _folder(spark))["cohort"]
    return load_cohort(spark, path)


# ---- facts about fitted models that do not depend on the fit ---------------------------------
@query("model_score_facts")
def q_model_score_facts(spark, sf):
    """M3-M6 + S10: small models of all kinds, saved and reloaded; per model and class the
    test rows, scores inside [0, 1], classes equal to (score > 0.5), reloaded scores equal."""
    train, test, safe, _ = _train_test(spark, sf)
    models, scored, _ = run_baseline_model_suite(train, test, safe, num_trees=3, boost_rounds=2)
    folder = _folder(spark)
    save_model_bundle(spark, folder, models, {"feature_columns": safe})
    again = None
    for name, model in load_model_bundle(spark, folder)["models"].items():
        part = predict_scores(model, test, name).select("model", "hadm_id", F.col("y_score").alias("again"))
        again = part if again is None else again.unionByName(part)
    s = F.col("y_score")
    return scored.join(again, ["model", "hadm_id"]).groupBy("model", "y_true").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if((s >= 0) & (s <= 1)).alias("n_in_range"),
        F.count_if(F.col("y_pred") == (s > 0.5).cast("int")).alias("n_class_agrees"),
        F.count_if(s == F.col("again")).alias("n_reloaded_equal"),
    )


@query("expanded_features")
def q_expanded_features(spark, sf):
    """E14: expanded input names of a model fitted to the whole modeling table."""
    featured, safe = X.modeling_dataset(spark, sf)
    rows = X.reused(L.make_target_label(featured, "gt_7d"))
    model = train_model(rows, safe, "logistic_regression")
    names = [(n,) for n in feature_names(model, rows)]
    return spark.createDataFrame(names, "feature string")


@query("permuted_value_counts")
def q_permuted_value_counts(spark, sf):
    """E16: in every permuted copy the permuted column keeps its exact value counts."""
    featured, _ = X.modeling_dataset(spark, sf)
    featured, kw = X.bounded(featured)
    _, copies = permuted_copies(featured, ["admission_type", "insurance"], 3, **kw)
    value = F.when(F.col("_feature") == "insurance", F.col("insurance")).otherwise(F.col("admission_type"))
    return copies.groupBy(F.col("_feature").alias("feature"), F.col("_r").alias("repeat"), value.alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


# ---- scoring job from saved artifacts ----------------------------------------------------------
@query("artifact_scoring_fallback")
def q_artifact_fallback(spark, sf):
    """R3 + R4 + R5 + R7: no bundle at hand, so every admission gets the heuristic score."""
    adm, pat = X.relations(spark, sf)
    scored = score_from_artifacts(spark, adm, pat, _folder(spark))
    return scored.select("hadm_id", "risk_probability", "predicted_class", "risk_tier", "score_source")


@query("artifact_scoring")
def q_artifact_scoring(spark, sf):
    """R2 + R3 + R4 + R5 + R7 + S10: bundle, card and tuning table saved, loaded, and used
    to score all admissions."""
    train, test, safe, kw = _train_test(spark, sf)
    model = train_model(train, safe, "logistic_regression")
    scored = X.reused(predict_scores(model, test, "logistic_regression"))
    tuning = X.reused(E.threshold_tuning(scored))
    selection = E.select_operating_thresholds(tuning)
    card = E.final_recommendation_card(E.binary_metrics(scored, **kw), L.label_prevalence_table(X.cohort_sql(spark, sf), **kw), selection,
                                       final_model_name="logistic_regression")
    folder = _folder(spark)
    save_report_tables({"threshold_tuning": E.mark_selected_thresholds(tuning, selection), "final_model_card": card}, f"{folder}/tables")
    save_model_bundle(spark, f"{folder}/bundle", {"logistic_regression": model}, {"feature_columns": safe, "primary_model_name": "logistic_regression"})
    adm, pat = X.relations(spark, sf)
    out = score_from_artifacts(spark, adm, pat, f"{folder}/bundle", f"{folder}/tables")
    return out.select("hadm_id", "risk_probability", "predicted_class", "risk_tier", "score_source")


# ---- rows on which the two cohort modes differ ---------------------------------------------------
@query("cohort_sql_edges")
def q_cohort_sql_edges(spark, sf):
    """P5 SQL mode on the edge rows: an invalid first row drops the admission, NULL subjects
    match nobody, duplicated patients fan out."""
    return build_cohort_sql(*edge_relations(spark, sf))


@query("cohort_py_edges")
def q_cohort_py_edges(spark, sf):
    """P5 Python mode on the edge rows: later valid rows survive, NULL subjects match the
    NULL patient, one row per patient."""
    return build_cohort_python(*edge_relations(spark, sf))


@query("language_edges")
def q_language_edges(spark, sf):
    """P9 cleanup of text padded with a no-break space and a tab."""
    adm, _ = edge_relations(spark, sf)
    return normalize_categorical_labels(adm).groupBy("language").agg(F.count(F.lit(1)).alias("n_rows"))
