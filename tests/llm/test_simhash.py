"""SimHash near-duplicates against brute force."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from staylens.llm import simhash as S

SF = "/root/testdata/sf0.001"


def brute_fp(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(fps))]


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    fps = [brute_fp(r.text) for r in rows]
    want = {r.doc_id: (f, rows[c].doc_id) for r, f, c in zip(rows, fps, brute_components(fps), strict=True)}
    got = S.near_duplicates(docs).collect()
    assert {r.id: (r.fp % 2**64, r.component_id) for r in got} == want


def test_native_hash_is_sparks(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b ç")).alias("h")).first()
    assert xxhash.xxh64_intdigest("a b ç".encode(), 42) == row.h % 2**64


def test_every_pair_within_the_radius_meets_in_a_table():
    masks = [m % 2**64 for m in S.covering_masks(2)]
    for i in range(64):
        for j in range(i + 1):
            diff = (1 << i) | (1 << j)
            assert any(m & diff == 0 for m in masks)


def test_large_buckets_are_exact(spark):
    rng = random.Random(1)
    fps = {rng.getrandbits(64) for _ in range(20)}
    base = rng.getrandbits(64)
    for _ in range(150):  # one crowded neighbourhood, far over PAIRWISE per bucket
        fps.add(base ^ (1 << rng.randrange(12)) ^ (1 << rng.randrange(12)) ^ (1 << rng.randrange(64)))
    fps = sorted(f - 2**64 if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(i, 1000 + i, f) for i, f in enumerate(fps)], "id long, key long, fp long")
    got = {r.id: r.component_id for r in S.classify(df).collect()}
    assert got == dict(enumerate(brute_components([f % 2**64 for f in fps])))
    other = {r.id: r.component_id for r in S.classify(df, radius=1).collect()}
    assert all(other[i] >= got[i] for i in got)


def test_odd_rows(spark):
    rows = [
        (5, None, "x"), (4, "", "y"), (3, " \n\t", "z"), (7, "one two", None), (8, "ONE  two", None),
        (9, "word " * 50_000, None), (9, "word " * 50_000, None), (None, "left alone here now", None), (6, "left alone here now", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = {(r.id, r.component_id) for r in S.near_duplicates(docs).collect()}
    assert got == {(5, 3), (4, 3), (3, 3), (7, 7), (8, 7), (9, 9), (None, 6), (6, 6)}
    kept = S.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6, 7, 9]
    assert S.near_duplicates(docs.limit(0)).count() == 0
