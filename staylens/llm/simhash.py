"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are 64 majority bits over the XXH64 of word shingles.  Two fingerprints
link when at most ``radius`` bits differ.  ``2**(radius + 1) - 1`` structured bit masks
(every bit has a non-zero vector over GF(2); mask v keeps the bits orthogonal to v)
guarantee that each such pair agrees on all kept bits of at least one mask: the vectors
of the differing bits span at most ``radius`` dimensions, so some v is orthogonal to all.

Cases: null text counts as empty; a text without words has fingerprint 0 and links like
any other; a null id takes part, but a component is named by its least non-null id (null
if it has none); repeated rows get the same result each; an empty table gives no rows;
other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, components, packed, row_key, store, unpacked

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
BITS = 64
# Buckets up to this many distinct fingerprints are compared pair by pair; larger ones
# go through the one-bit neighbourhoods, which is exact as well and linear in their size.
PAIRWISE = 32


def simhash(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Fingerprint of one UTF-8 text as a signed 64-bit integer."""
    parts = text.lower().split()  # on bytes: only A-Z are lowered, only ASCII space splits
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > words:
        pairs = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    else:
        pairs = iter([(0, len(joined))])
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(BITS, np.int64), 0
    while chunk := [digest(joined[s:e], seed) for (s, e), _ in zip(pairs, range(16384))]:
        bits = np.unpackbits(np.array(chunk, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(chunk)
        if len(chunk) < 16384:
            break
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], words: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = [simhash(t or b"", words, seed) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key"), pa.array(fps, pa.int64())], names=["id", "key", "fp"]
        )


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, seed: int = SEED
) -> DataFrame:
    """(id, key, fp): ``key`` identifies the row by its id and text."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text")
    )
    return rows.mapInArrow(lambda it: _fingerprint_batches(it, words, seed), "id long, key long, fp long")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The masks as signed 64-bit integers."""
    n = 2 ** (radius + 1) - 1
    masks = []
    for v in range(1, n + 1):
        mask = sum(1 << i for i in range(BITS) if ((1 + i % n) & v).bit_count() % 2 == 0)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect exactly the pairs
    within ``radius``: small buckets give their pairs, large ones a star per shared
    neighbour, whose members are all within the radius of each other."""
    masks = covering_masks(radius)
    keyed = store(
        fps.select(
            "fp",
            F.explode(
                F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(masks)])
            ).alias("s"),
        ).select("fp", "s.t", "s.k"),
        "masked",
    )
    sizes = store(keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    small = keyed.join(sizes.where(F.col("n") <= PAIRWISE), ["t", "k"])
    lists = small.groupBy("t", "k").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    pairs = (
        lists.select("fps", F.posexplode("fps").alias("i", "a"))
        .select("a", F.explode(F.slice("fps", F.col("i") + 2, F.lit(PAIRWISE))).alias("b"))
        .where(_apart("a", "b") <= radius)
        .select("a", "b")
    )
    large = keyed.join(sizes.where(F.col("n") > PAIRWISE), ["t", "k"]).select("fp").distinct()
    return pairs.union(_neighbours(large) if radius == 2 else _cleared(large, radius))


def _neighbours(fps: DataFrame) -> DataFrame:
    """Stars for radius 2: two fingerprints are within 2 bits exactly when some value is
    within one bit of both, so all that share such a value link to the least of them."""
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_bit(i))) for i in range(BITS)])
    met = fps.select("fp", F.explode(near).alias("k"))
    centre = met.groupBy("k").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z").select("k", "a")
    return met.join(store(centre, "centres"), "k").where("a <> fp").select("a", F.col("fp").alias("b"))


def _bit(i: int) -> int:
    return (1 << i) - (1 << 64) if i == 63 else 1 << i


def _cleared(fps: DataFrame, radius: int) -> DataFrame:
    """Stars for any radius: fingerprints that agree after clearing the same ``radius``
    bits differ in those bits only, so every pair of a star is a link."""
    from itertools import combinations

    cuts = []
    for bits in combinations(range(BITS), radius):
        mask = (1 << 64) - 1 - sum(1 << i for i in bits)
        cuts.append(mask - (1 << 64) if mask >> 63 else mask)
    table = fps.sparkSession.createDataFrame([(i, m) for i, m in enumerate(cuts)], "c int, m long")
    met = fps.join(F.broadcast(table)).select("fp", "c", F.col("fp").bitwiseAND(F.col("m")).alias("k"))
    centre = met.groupBy("c", "k").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z").select("c", "k", "a")
    return met.join(store(centre, "centres"), ["c", "k"]).where("a <> fp").select("a", F.col("fp").alias("b"))


def classify(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(id, key, fp, component_id) for a stored table (id, key, fp)."""
    distinct = store(fps.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fps")
    labels = components(links(distinct, radius))
    named = distinct.join(labels, F.col("fp") == F.col("id"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    named = store(named, "labelled-fps")
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_fp = named.join(names, "component").select("fp", "component_id")
    return fps.join(of_fp, "fp").select("id", "key", "fp", "component_id")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    seed: int = SEED,
) -> DataFrame:
    """One row per input row: (id, key, fp, component_id)."""
    return classify(store(fingerprints(docs, id_col, text_col, words, seed), "fingerprints"), radius)


def keep_first(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """``docs`` with one row per group: the row of the group's least id (a group without
    ids keeps its row of least key)."""
    found = near_duplicates(docs, id_col, text_col, words, radius)
    fps = found.groupBy("fp", "component_id").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "key")).alias("best"))
    # Groups without any id: their component_id is null; the least key over the fingerprint stands for them.
    kept = (
        fps.where("component_id IS NULL OR best.id = component_id")
        .groupBy(F.coalesce("component_id", F.col("fp")).alias("g"), F.col("component_id").isNull().alias("unnamed"))
        .agg(F.min("best").alias("best"))
        .select(F.col("best.key").alias("key"))
    )
    rows = packed(docs).withColumn("key", row_key(f"row.{id_col}", f"row.{text_col}"))
    one = rows.join(kept, "key").dropDuplicates(["key"])
    return unpacked(one, docs)
