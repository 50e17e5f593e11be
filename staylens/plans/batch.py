"""End-to-end batch job: cohort -> quality -> profile -> features -> labels -> split ->
models -> evaluation -> policy -> importances -> calibration -> packaging.

The cleaned cohort is checkpointed once (reliable checkpoint in the cluster's shared
``spark.checkpoint.dir``) because about ten reports read it; everything else is a lazy
plan written straight to the output folder.

Usage::

    python -m staylens.plans.batch --admissions <path> --patients <path> --out <folder>
    python -m staylens.plans.batch --driver-tables /root/testdata/sf0.01 --out <folder> \
        --master local[8] --driver-memory 16g
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens import config as C
from staylens.operators import evaluate as E
from staylens.operators import labels as L
from staylens.operators import ml as M
from staylens.operators import profile as P
from staylens.operators import quality as Q
from staylens.operators.cohort import build_cohort_python
from staylens.operators.features import build_modeling_dataset, excluded_columns_with_reasons, normalize_categorical_labels
from staylens.session import build_session, materialize
from staylens.sources.adapter import adapter_relations
from staylens.sources.artifacts import save_model_bundle
from staylens.sources.sinks import save_dataframe, save_report_tables
from staylens.sources.tables import load_admissions, load_patients

MISSING_COLUMNS = (
    "subject_id", "hadm_id", "admittime", "dischtime", "los_days", "gender", "age_at_admit",
    "admission_type", "admission_location", "insurance", "language", "marital_status", "race",
)


def run(
    spark: SparkSession,
    admissions: DataFrame,
    patients: DataFrame,
    out: str,
    *,
    include_boosted: bool = True,
    num_trees: int = 400,
    boost_rounds: int = 300,
    permutation_repeats: int = 20,
    seed: int = C.DEFAULT_SEED,
    fmt: str = "parquet",
) -> dict:
    out = out.rstrip("/")
    cohort = materialize(normalize_categorical_labels(build_cohort_python(admissions, patients)))
    kw = {"row_bound": cohort.count()}  # reads the checkpoint files

    checks = Q.integrity_checks(cohort)
    Q.assert_integrity(checks)
    save_dataframe(cohort, f"{out}/interim/cohort_base.{fmt}")

    featured, safe, _ = build_modeling_dataset(cohort)
    labeled = M.stratified_split(L.make_target_label(L.add_long_stay_labels(featured, **kw), C.FINAL_LABEL_MODE), seed=seed, **kw)
    labeled = materialize(labeled)
    train = labeled.where(F.col("split") == "train")
    test = labeled.where(F.col("split") == "test")

    models, scored, boosted_status = M.run_baseline_model_suite(
        train, test, safe, include_boosted=include_boosted, seed=seed, num_trees=num_trees, boost_rounds=boost_rounds
    )
    scored = materialize(scored)
    evaluation = E.evaluate_classifier(scored, **kw)
    metrics = E.compare_model_metrics(evaluation["metrics"])
    prevalence = L.label_prevalence_table(labeled, **kw)
    names = [r["model"] for r in metrics.select("model").collect()]  # one row per model
    final_model = C.FINAL_MODEL_NAME if C.FINAL_MODEL_NAME in names else names[0]
    final_scored = scored.where(F.col("model") == final_model)
    tuning = E.threshold_tuning(final_scored)
    selection = E.select_operating_thresholds(tuning, C.RECALL_PRIORITY_MIN_RECALL)
    marked = E.mark_selected_thresholds(tuning, selection)
    card = E.final_recommendation_card(metrics, prevalence, selection, final_model_name=final_model)
    sel = selection.first()  # one row

    tables = {
        "missing_report": Q.missing_value_report(cohort, MISSING_COLUMNS),
        "duplicate_report": Q.duplicate_admission_report(cohort),
        "sanity_summary": Q.sanity_summary(admissions, cohort, **kw),
        "los_summary": P.los_summary_table(cohort, **kw),
        "los_percentiles": P.los_percentile_table(cohort, **kw),
        "definition_comparison": L.long_stay_definition_comparison(cohort, **kw),
        "subgroup_rates": P.subgroup_long_stay_rates(L.add_long_stay_labels(cohort, **kw), C.SUBGROUP_DIMENSIONS),
        "label_prevalence": prevalence,
        "model_metrics": metrics,
        "confusion_matrix": evaluation["confusion_matrix"],
        "classification_report": evaluation["classification_report"],
        "threshold_table": evaluation["threshold_table"],
        "threshold_tuning": marked,
        "final_model_card": card,
        "feature_importance_logistic": M.logistic_importance(spark, models["logistic_regression"]),
        "feature_importance_random_forest": M.tree_importance(models["random_forest"], M.feature_names(models["random_forest"], test)),
        "feature_importance_permutation": M.permutation_importance(models[final_model], test, safe, n_repeats=permutation_repeats, seed=seed),
        "excluded_features": excluded_columns_with_reasons(spark, featured),
        "calibration": E.calibration_table(final_scored, **kw),
    }
    paths = save_report_tables(tables, f"{out}/tables", fmt)
    save_model_bundle(
        spark,
        f"{out}/models/baseline_models",
        models,
        {
            "primary_label_mode": C.FINAL_LABEL_MODE,
            "primary_model_name": final_model,
            "feature_columns": safe,
            "boosted_status": boosted_status,
            "long_stay_days_threshold": C.LONG_STAY_DAYS_THRESHOLD,
            "balanced_threshold": sel["balanced_threshold"],
            "recall_priority_threshold": sel["recall_priority_threshold"],
        },
    )
    return {"tables": paths, "final_model": final_model, "feature_columns": safe}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--admissions")
    ap.add_argument("--patients")
    ap.add_argument("--driver-tables", help="derive the inputs from the driver tables folder")
    ap.add_argument("--out", required=True)
    ap.add_argument("--num-trees", type=int, default=400)
    ap.add_argument("--boost-rounds", type=int, default=300)
    ap.add_argument("--permutation-repeats", type=int, default=20)
    ap.add_argument("--no-boosted", action="store_true")
    ap.add_argument("--master", help="e.g. local[8]; on a cluster the submit settings apply")
    ap.add_argument("--driver-memory", help="driver heap for a local session, e.g. 16g")
    args = ap.parse_args(argv)
    extra = {"spark.driver.memory": args.driver_memory} if args.driver_memory else None
    spark = build_session(master=args.master, extra=extra)
    if args.driver_tables:
        adm, pat = adapter_relations(spark, args.driver_tables)
    else:
        adm, pat = load_admissions(spark, args.admissions), load_patients(spark, args.patients)
    result = run(spark, adm, pat, args.out, include_boosted=not args.no_boosted, num_trees=args.num_trees,
                 boost_rounds=args.boost_rounds, permutation_repeats=args.permutation_repeats)
    print(result)


if __name__ == "__main__":
    main()
