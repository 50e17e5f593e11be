"""A training corpus from raw documents: five stages, each one operator of ``staylens.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet to the shared checkpoint folder and rereads it as the next stage's documents.  All
but the last return the columns of ``documents``.

1. ``toxicity``: documents that score 0.5 or more go.
2. ``line_dedup``: lines of recurring templates go if a kept line stands for them; a document
   that would keep no words goes only if all of it stands elsewhere character by character.
3. ``simhash_near_dedup``: of each SimHash group the document of least id stays.
4. ``decontaminate``: documents that contain a benchmark item go.
5. ``pack``: the rest as token sequences of at most 2048 tokens, one row per piece.

Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns: as
each operator's module says; no stage fails on them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from staylens.llm import decontaminate, linededup, pack, simhash, toxicity
from staylens.llm.common import store

TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(toxicity.training_rows(docs, _table(spark, sf_dir, "labels")))
    return toxicity.reject(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, words=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack.pack_documents(docs, public_tokenizers.path(TOKENIZER)).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pack", pack_sequences),
]

# The classifier and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
