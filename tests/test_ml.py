"""Training pieces: exact split counts, exact fit statistics, planted signal, bundles."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from staylens.operators import evaluate as E
from staylens.operators import ml as M


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(11)
    n = 5000
    age = rng.integers(18, 95, n).astype(float)
    typ = rng.choice(["EMERGENCY", "URGENT", "ELECTIVE"], n)
    logit = -3.0 + 0.04 * age + 1.2 * (typ == "EMERGENCY")
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(int)
    age[rng.random(n) < 0.05] = np.nan
    rows = [(i, None if np.isnan(a) else float(a), str(t), int(v)) for i, (a, t, v) in enumerate(zip(age, typ, y))]
    return spark.createDataFrame(rows, "hadm_id long, age_at_admit double, admission_type string, target_long_stay int")


def test_split_counts_exact(planted):
    split = M.stratified_split(planted, cell_rows=500)
    counts = {(r["split"], r["label"]): r["n_rows"] for r in M.split_counts(split).collect()}
    n = planted.count()
    n_test = int(np.ceil(0.2 * n))
    assert counts[("test", 0)] + counts[("test", 1)] == n_test
    pos = planted.where("target_long_stay = 1").count()
    assert abs(counts[("test", 1)] - 0.2 * pos) <= 1
    again = {(r["split"], r["label"]): r["n_rows"] for r in M.split_counts(M.stratified_split(planted.repartition(5))).collect()}
    assert again == counts
    ids_a = {r["hadm_id"] for r in split.where("split = 'test'").collect()}
    ids_b = {r["hadm_id"] for r in M.stratified_split(planted.repartition(3)).where("split = 'test'").collect()}
    assert ids_a == ids_b  # membership does not depend on partitioning


def test_fit_stats_exact(spark):
    df = spark.createDataFrame([(0.1, "a"), (0.2, "a"), (0.4, "b"), (0.6, "b"), (None, None)], "x double, c string")
    stats = {r["feature"]: r for r in M.preprocess_stats(df, ["x", "c"]).collect()}
    assert stats["x"]["median"] == pytest.approx(0.3)  # interpolated midpoint, not an element
    filled = np.array([0.1, 0.2, 0.4, 0.6, 0.3])
    assert stats["x"]["mean"] == pytest.approx(filled.mean()) and stats["x"]["std"] == pytest.approx(filled.std())
    assert stats["c"]["mode"] == "a"  # tie -> smallest


def test_unseen_category_is_zero_vector(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    pre, _ = M.fit_preprocessor(train, ["c", "x"])
    out = pre.transform(spark.createDataFrame([("z", 1.0), ("a", 1.0)], "c string, x double"))
    vecs = [r[0] for r in out.select(vector_to_array("c__ohe")).collect()]
    assert vecs == [[0.0, 0.0], [1.0, 0.0]]


def test_planted_signal_and_bundle(spark, planted, tmp_dir):
    split = M.stratified_split(planted).persist()
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    models, scored, status = M.run_baseline_model_suite(train, test, ["age_at_admit", "admission_type"], include_boosted=True, num_trees=20, boost_rounds=10)
    metrics = {r["model"]: r for r in E.binary_metrics(scored).collect()}
    assert status == "trained" and set(metrics) == {"logistic_regression", "random_forest", "gradient_boosted_trees"}
    assert metrics["logistic_regression"]["roc_auc"] > 0.7
    assert metrics["random_forest"]["roc_auc"] > 0.65
    names = M.feature_names(models["logistic_regression"], test)
    assert "admission_type_EMERGENCY" in names and "age_at_admit" in names
    imp = M.logistic_importance(spark, models["logistic_regression"]).collect()
    assert imp[0]["abs_coefficient"] >= imp[-1]["abs_coefficient"]

    from staylens.sources.artifacts import load_model_bundle, save_model_bundle

    save_model_bundle(spark, tmp_dir, {"logistic_regression": models["logistic_regression"]}, {"balanced_threshold": 0.4, "feature_columns": ["age_at_admit", "admission_type"]})
    bundle = load_model_bundle(spark, tmp_dir)
    assert bundle["balanced_threshold"] == 0.4
    a = M.predict_scores(models["logistic_regression"], test, "m").orderBy("hadm_id").collect()
    b = M.predict_scores(bundle["models"]["logistic_regression"], test, "m").orderBy("hadm_id").collect()
    assert [r["y_score"] for r in a] == pytest.approx([r["y_score"] for r in b])


def test_permutation_importance_finds_signal(spark, planted):
    split = M.stratified_split(planted).persist()
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    model = M.train_model(train, ["age_at_admit", "admission_type"], "logistic_regression")
    imp = {r["feature"]: r for r in M.permutation_importance(model, test, ["age_at_admit", "admission_type"], n_repeats=3).collect()}
    assert set(imp) == {"age_at_admit", "admission_type"}
    assert max(r["importance_mean"] for r in imp.values()) > 0


def test_split_at_scale_equals_small_path(planted):
    small = {r["hadm_id"]: r["split"] for r in M.stratified_split(planted).select("hadm_id", "split").collect()}
    big = {r["hadm_id"]: r["split"] for r in M.stratified_split(planted, cell_rows=3).select("hadm_id", "split").collect()}
    assert small == big


def test_split_is_the_same_at_every_size(spark):
    rows = [(i % 30 if i % 11 else None, i % 3 % 2, i) for i in range(1000)]  # few ids, NULL ids
    df = spark.createDataFrame(rows, "hadm_id long, target_long_stay int, x int")
    for size in (0.25, 0.33):
        results = []
        for kw in ({}, {"rows_per_bucket": 100, "cell_rows": 100}, {"rows_per_bucket": 7, "cell_rows": 1}):
            out = M.stratified_split(df, test_size=size, **kw)
            assert out.count() == 1000
            results.append({(r["x"]) for r in out.where("split = 'test'").collect()})
        assert len(results[0]) == int(np.ceil(size * 1000)) and results[0] == results[1] == results[2]


def test_permuted_copies_are_permutations(spark, planted):
    small = planted.limit(200).persist()
    _, copies = M.permuted_copies(small, ["age_at_admit", "admission_type"], 3)
    assert copies.count() == 200 * 6
    want = sorted((r[0] for r in small.select("admission_type").collect()))
    for r in range(3):
        own = copies.where(f"_r = {r}")
        assert sorted(x[0] for x in own.where("_feature = 'admission_type'").select("admission_type").collect()) == want
        same = own.where("_feature = 'age_at_admit'").join(small.select("hadm_id", "admission_type"), ["hadm_id", "admission_type"])
        assert same.count() == 200  # the other columns stay
