"""Checkpoint folder resolution and reliable materialization."""

from pyspark.sql import functions as F

from staylens.session import checkpoint_dir, materialize


def test_checkpoint_dir_and_materialize(spark):
    folder = checkpoint_dir(spark)
    assert folder and spark.sparkContext.getCheckpointDir() == folder
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    m = materialize(df)
    assert m.agg(F.sum("x")).first()[0] == 9900
    assert "LogicalRDD" in m._jdf.queryExecution().logical().toString()  # lineage cut
