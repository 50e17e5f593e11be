"""The batch job runs end to end on the smallest driver tables (small forests)."""

from staylens.plans import batch
from staylens.sources.adapter import adapter_relations
from staylens.sources.artifacts import load_model_bundle

from .conftest import SF_SMALL


def test_batch_job(spark, tmp_dir):
    adm, pat = adapter_relations(spark, SF_SMALL)
    res = batch.run(spark, adm, pat, tmp_dir, num_trees=5, boost_rounds=3, permutation_repeats=2)
    assert res["final_model"] == "random_forest"
    card = spark.read.parquet(res["tables"]["final_model_card"]).collect()
    assert len(card) == 1 and card[0]["final_label_definition"] == "LOS > 7 days"
    marked = spark.read.parquet(res["tables"]["threshold_tuning"])
    assert marked.where("is_balanced = 1").count() == 1
    bundle = load_model_bundle(spark, f"{tmp_dir}/models/baseline_models")
    assert set(bundle["models"]) == {"logistic_regression", "random_forest", "gradient_boosted_trees"}
