"""Streaming admission scoring.

Admissions arriving as a stream get the same stateless columns as the batch job:
calendar and age features, the fallback risk score, the class at the balanced threshold
and the risk tier.  The policy thresholds are resolved once (a one-row batch result)
before the stream starts; no state is kept, so any output mode and sink work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from staylens import config as C
from staylens.functions.columns import heuristic_risk_score, risk_tier
from staylens.operators.features import engineer_admission_time_features, engineer_demographic_features, normalize_categorical_labels
from staylens.session import checkpoint_dir


def score_stream(
    admissions: DataFrame,
    balanced_threshold: float = C.FINAL_BALANCED_THRESHOLD,
    recall_priority_threshold: float = C.FINAL_RECALL_PRIORITY_THRESHOLD,
    **heuristic_kw,
) -> DataFrame:
    """Stateless scoring columns over a (streaming or batch) admissions DataFrame."""
    feats = engineer_demographic_features(engineer_admission_time_features(normalize_categorical_labels(admissions)))
    b, r = F.lit(float(balanced_threshold)), F.lit(float(recall_priority_threshold))
    scored = feats.withColumn("risk_probability", heuristic_risk_score(**heuristic_kw))
    return scored.select(
        "hadm_id",
        "admittime",
        "risk_probability",
        F.when(F.col("risk_probability") >= b, 1).otherwise(0).alias("predicted_class"),
        risk_tier("risk_probability", b, r).alias("risk_tier"),
    )


def start_scoring(
    spark: SparkSession,
    source: DataFrame,
    sink_path: str,
    query_name: str = "staylens_scoring",
    checkpoint: str | None = None,
    trigger_seconds: int | None = None,
    **score_kw,
) -> StreamingQuery:
    """Write scored admissions as Parquet, checkpointing progress in the shared folder."""
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/{query_name}"
    writer = (
        score_stream(source, **score_kw)
        .writeStream.format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", ckpt)
        .queryName(query_name)
        .outputMode("append")
    )
    if trigger_seconds:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()
