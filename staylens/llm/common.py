"""Shared helpers: tables in the shared folder, row keys, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.session import checkpoint_dir, share_package

# Rows per Arrow batch handed to Python: whole texts can be long, so batches stay small.
ARROW_ROWS = 256


def arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of an Arrow batch, which bounds a Python worker's memory, and let
    workers import this package wherever the driver was started."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    share_package(spark)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage: later jobs survive lost executors without recomputing, and see one
    fixed version of the rows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`store` that nothing reads any more."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            jvm = df.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def row_key(*columns: str):
    """64-bit key of a row's identity; equal rows share it, nulls are allowed."""
    return F.xxhash64(*[F.col(c) for c in columns])


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns as one struct, so that working columns cannot clash with theirs."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def unpacked(df: DataFrame, like: DataFrame, name: str = "row") -> DataFrame:
    return df.select(*[F.col(f"{name}.`{c}`").alias(c) for c in like.columns])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (id, component), component = least id.

    Alternating large-star and small-star rounds.  Every round only groups by node with
    partial minima and joins, so a hub of any degree is split by Spark's skew join instead
    of meeting one task; it writes one table to the shared folder and deletes the one
    before.  The rounds end as soon as the links are stars, which a further round would
    leave as they are.  Only nodes that have an edge appear.  Nothing is collected but one
    counter a round.
    """
    links = store(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    for _ in range(max_rounds):
        # Stars: every node has one link to a lower one, and no lower one has a link itself.
        parents = links.groupBy("u").agg(F.count("*").alias("n"))
        many = parents.where("n > 1").select("u")
        inner = links.select(F.col("v").alias("u")).distinct().join(parents, "u", "left_semi")
        if many.union(inner).limit(1).count() == 0:
            break
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: every larger neighbour of u points at the least of u and its neighbours.
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its smaller neighbours point at the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        smaller = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, links = links, store(smaller.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(before)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
