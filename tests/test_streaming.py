"""Streaming scoring gives the same rows as the batch form of the same columns."""

import datetime as dt
import os

from staylens.streaming.scoring import score_stream, start_scoring

SCHEMA = (
    "subject_id long, hadm_id long, admittime timestamp_ntz, dischtime timestamp_ntz, admission_type string, "
    "admission_location string, discharge_location string, insurance string, language string, marital_status string, "
    "race string, hospital_expire_flag int, age_at_admit int"
)


def test_stream_equals_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    rows = [
        (1, 10, dt.datetime(2024, 1, 6, 8), None, "EMERGENCY", "ER", None, "Medicaid", "ENGLISH", "SINGLE", "A", 0, 80),
        (2, 11, dt.datetime(2024, 1, 8, 9), None, "URGENT", "ER", None, "Medicare", "ENGLISH", "SINGLE", "B", 0, 50),
        (3, 12, dt.datetime(2024, 1, 9, 9), None, None, None, None, None, None, None, None, None, None),
    ]
    batch = spark.createDataFrame(rows, SCHEMA)
    batch.write.parquet(src)
    stream = spark.readStream.schema(batch.schema).parquet(src)
    q = score_stream(stream).writeStream.format("memory").queryName("scored_test").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = sorted(map(tuple, spark.sql("SELECT * FROM scored_test").collect()))
    exp = sorted(map(tuple, score_stream(batch).collect()))
    assert got == exp and len(got) == 3
    assert {r[0]: r[4] for r in got}[10] == "High"


def test_parquet_sink_with_checkpoint(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    spark.createDataFrame([(1, 10, dt.datetime(2024, 1, 6, 8), None, "EMERGENCY", "ER", None, "Medicaid", "ENGLISH", "SINGLE", "A", 0, 80)], SCHEMA).write.parquet(src)
    q = start_scoring(spark, spark.readStream.schema(SCHEMA).parquet(src), out, query_name="scoring_sink_test", checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(out).count() == 1
