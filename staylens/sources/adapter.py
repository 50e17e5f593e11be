"""Adapter: admissions and patients relations derived from the driver tables.

The driver tables hold no hospital data, so the test relations are derived from
``events`` (stays) and ``customer`` (patients).  A stay runs from an event to the same
user's 14th later event; extra branches inject duplicate ids and negative stays; some
customers are left out; text carries NULLs, blanks and padding on purpose.

The three branches are produced in one pass (an ``explode`` of branch tags) and the
"14th later event" is a bucketed LEAD, so a user holding a large share of all events
does not end up in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.operators.ordered import OrderKey, lead_within

STAY_EVENT_OFFSET = 14
DUPLICATE_EVERY = 50
NEGATIVE_EVERY = 100
NEGATIVE_ID_SHIFT = 1_000_000_000


# Schemas of the driver tables the adapter reads (given, so no inference job runs).
DRIVER_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(DRIVER_SCHEMAS[name]) if name in DRIVER_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(c, mapping: dict[int, str], modulus: int):
    expr = None
    for k, v in mapping.items():
        expr = F.when((c % modulus) == k, F.lit(v)) if expr is None else expr.when((c % modulus) == k, F.lit(v))
    return expr


def admissions_from_events(events: DataFrame, **prefix_kw) -> DataFrame:
    ev = events.select("event_id", "user_id", "event_type", "ts")
    ev = lead_within(ev, ["user_id"], [OrderKey("ts"), OrderKey("event_id")], "ts", STAY_EVENT_OFFSET, "nts", **prefix_kw)
    eid, uid = F.col("event_id"), F.col("user_id")
    branches = F.filter(
        F.array(F.lit(1), F.lit(2), F.lit(3)),
        lambda b: (b == 1) | ((b == 2) & ((eid % DUPLICATE_EVERY) == 0)) | ((b == 3) & ((eid % NEGATIVE_EVERY) == 1)),
    )
    rows = ev.withColumn("_branch", F.explode(branches))
    b = F.col("_branch")
    first = b == 1

    def pick(first_value, other_value):
        return F.when(first, first_value).otherwise(other_value)

    return rows.select(
        uid.alias("subject_id"),
        F.when(b == 3, eid + F.lit(NEGATIVE_ID_SHIFT)).otherwise(eid).alias("hadm_id"),
        F.when(b == 2, F.col("ts") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts")).alias("admittime"),
        F.when(b == 3, F.col("ts") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("nts")).alias("dischtime"),
        F.col("event_type").alias("admission_type"),
        pick(
            _case(eid, {0: "TRANSFER FROM HOSPITAL", 1: "PHYSICIAN REFERRAL", 2: "EMERGENCY ROOM", 3: " CLINIC "}, 5),
            F.lit("CLINIC"),
        ).alias("admission_location"),
        pick(_case(eid, {0: "HOME", 1: "SNF"}, 3), F.lit("HOME")).alias("discharge_location"),
        pick(_case(eid, {0: "Medicare", 1: "Medicaid", 2: "Private"}, 4), F.lit("Private")).alias("insurance"),
        pick(F.when((eid % 7) == 0, F.lit("")).otherwise(F.lit("ENGLISH")), F.lit("ENGLISH")).alias("language"),
        pick(_case(eid, {0: "MARRIED", 1: "SINGLE ", 2: "WIDOWED"}, 6), F.lit("SINGLE")).alias("marital_status"),
        pick(
            F.when((uid % 4) == 0, F.lit("A")).when((uid % 4) == 1, F.lit("B")).when((uid % 4) == 2, F.lit("C")).otherwise(F.lit("D")),
            F.lit("A"),
        ).alias("race"),
        pick(F.when(F.col("event_type") == "error", F.lit(1)).otherwise(F.lit(0)), F.lit(0)).alias("hospital_expire_flag"),
    )


def patients_from_customers(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.where((k % 10) != 9).select(
        k.alias("subject_id"),
        F.when((k % 2) == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        (F.lit(18) + (k % 75)).cast("int").alias("anchor_age"),
        (F.lit(2020) + (k % 4)).cast("int").alias("anchor_year"),
    )


def adapter_relations(spark: SparkSession, sf_dir: str, **prefix_kw) -> tuple[DataFrame, DataFrame]:
    events = read_driver_table(spark, sf_dir, "events")
    customer = read_driver_table(spark, sf_dir, "customer")
    return admissions_from_events(events, **prefix_kw), patients_from_customers(customer)


def edge_relations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The adapter relations with the rows on which the cohort modes differ: a first row
    without discharge, NULL subjects and ids, duplicated and NULL patients, and text padded
    with a no-break space and a tab."""
    adm, pat = adapter_relations(spark, sf_dir)
    hid = F.col("hadm_id")
    adm = adm.withColumn("language", F.when(hid % 90 == 11, F.concat(F.lit("\u00a0"), F.col("language"), F.lit("\t"))).otherwise(F.col("language")))
    branches = F.filter(
        F.array(*[F.lit(i) for i in range(4)]),
        lambda b: (b == 0) | ((b == 1) & (hid % 60 == 7)) | ((b == 2) & (hid % 200 == 3)) | ((b == 3) & (hid % 400 == 5)),
    )
    rows = adm.withColumn("_b", F.explode(branches))
    b = F.col("_b")
    rows = rows.withColumns(
        {
            "admittime": F.when(b == 1, F.col("admittime") - F.expr("INTERVAL 2 HOURS")).otherwise(F.col("admittime")),
            "dischtime": F.when(b != 1, F.col("dischtime")),
            "subject_id": F.when(b != 2, F.col("subject_id")),
            "hadm_id": F.when(b == 2, hid + F.lit(2 * NEGATIVE_ID_SHIFT)).when(b != 3, hid),
        }
    ).drop("_b")
    twice = pat.where(F.col("subject_id") % 13 == 0).withColumn("anchor_age", (F.col("anchor_age") + 1).cast("int"))
    nobody = pat.sparkSession.range(1).select(
        F.lit(None).cast("bigint").alias("subject_id"), F.lit("F").alias("gender"), F.lit(40).alias("anchor_age"), F.lit(2020).alias("anchor_year")
    )
    return rows.select(*[c for c in adm.columns]), pat.union(twice).union(nobody)
