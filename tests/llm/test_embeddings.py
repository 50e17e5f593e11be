"""Embedding near-duplicates against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylens.llm import embeddings as E


def brute(ids, x, threshold=0.9):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= threshold
    np.fill_diagonal(link, False)
    label = np.arange(len(x))
    while True:
        new = np.array([min([label[i], *label[link[i]]]) for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    least = {k: min(ids[i] for i in np.flatnonzero(label == k)) for k in set(label)}
    return {ids[i]: (int(link[i].sum()), least[label[i]]) for i in range(len(x))}


def planted(rng, n=400, dim=24):
    base = rng.standard_normal((n, dim))
    rows = [base]
    for spread, size in ((0.08, 150), (0.18, 60), (0.3, 40)):  # tight to ragged groups
        rows.append(rng.standard_normal(dim) + spread * rng.standard_normal((size, dim)))
    chain = [rng.standard_normal(dim)]
    for _ in range(30):  # long chains of links
        chain.append(chain[-1] + 0.05 * np.linalg.norm(chain[-1]) * rng.standard_normal(dim) / np.sqrt(dim) * 6)
    return np.concatenate([*rows, np.array(chain), base[:20] * 3.0, base[:5]])


@pytest.mark.parametrize("partitions", [1, 7])
def test_all_links_and_components(spark, partitions):
    x = planted(np.random.default_rng(4))
    ids = np.random.default_rng(5).permutation(len(x)) + 100
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>, label int")
    rows = E.near_duplicates(df.repartition(partitions), passes=40).collect()
    want = brute(ids.tolist(), x)
    assert {r.id: (r.n_links, r.component_id) for r in rows} == want
    assert all(r.kept == (r.id == r.component_id) for r in rows)


def test_window_narrower_than_the_group(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.standard_normal(8) + 0.02 * rng.standard_normal((300, 8)), rng.standard_normal((50, 8))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = {r.id: r.n_links for r in E.near_duplicates(df, window=4, passes=6).collect()}
    assert all(rows[i] >= 299 for i in range(300))


def test_keys_order_by_leading_hashes():
    x = np.random.default_rng(1).standard_normal((10, 6))
    k = E.keys(x, 3, 9)
    assert k.shape == (10, 3) and (k >= 0).all() and (E.keys(x * 7, 3, 9) == k).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, "a"), (2, [], "a"), (3, [0.0, 0.0], "a"), (4, [1.0, None], "a"), (5, [1.0, nan], "a"), (6, [inf, 1.0], "a"),
            (9, [1.0, 2.0], "b"), (8, [2.0, 4.0], "b"), (8, [2.0, 4.0], "b"), (None, [1.0, 2.0], "b"), (7, [1.0, 2.0, 0.0], "c"),
            (None, [5.0, -1.0, 3.0], "d"), (None, [5.0, -1.0, 3.0], "d")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, uid string")
    got = sorted(((r.id, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df).collect()), key=str)
    assert got == sorted(
        [(i, 0, i, True) for i in range(1, 7)] + [(9, 3, 8, False), (8, 3, 8, True), (8, 3, 8, True), (None, 3, 8, False), (7, 0, 7, True)]
        + [(None, 1, None, False)] * 2, key=str)
    assert E.near_duplicates(df.limit(0)).count() == 0
    assert E.near_duplicates(df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))).count() == len(rows)


def test_passes_follow_the_number_of_vectors():
    agree = 1 - np.arccos(0.9) / np.pi
    assert E.passes_for(0) == E.passes_for(1000) == E.PASSES
    for n in (50_000, 10**6, 10**7, 10**8):
        found = agree ** np.log2(2 * n / E.WINDOW)
        assert (1 - found) ** E.passes_for(n) <= E.MISS
        assert E.passes_for(n) == E.PASSES or E.MISS < (1 - found) ** (E.passes_for(n) - 2)


@pytest.mark.parametrize("window", [E.WINDOW, 64])
def test_half_of_the_vectors_crowd_around_one_direction(spark, window):
    """Cosine 0.9 with the direction, about 0.81 with each other: production settings, and a
    window as narrow as among eight times the vectors."""
    rng, n, crowd, dim = np.random.default_rng(2), 9000, 4500, 64
    x = rng.standard_normal((n, dim))
    axis = rng.standard_normal(dim)
    axis /= np.linalg.norm(axis)
    off = x[:crowd] - np.outer(x[:crowd] @ axis, axis)
    x[:crowd] = 0.9 * axis + np.sqrt(1 - 0.81) * off / np.linalg.norm(off, axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = (x @ x.T >= 0.9).sum(1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.id: r.n_links for r in E.near_duplicates(df, window=window).collect()}
    assert linked.sum() > 400 and sum(got.values()) >= 0.99 * linked.sum()
    assert all(got[i] <= linked[i] for i in range(n))


def test_default_passes_keep_the_miss_bound(spark):
    rng, n, dim = np.random.default_rng(8), 4000, 64
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    w = rng.standard_normal((n, dim))
    w -= (w * x).sum(1, keepdims=True) * x
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    y = 0.9001 * x + np.sqrt(1 - 0.9001**2) * w  # pairs just above the threshold
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))], "vec_id long, embedding array<double>")
    found = E.near_duplicates(df, window=1).where("n_links > 0").count() / 2  # a window as narrow as among 500,000 vectors
    assert found >= n * (1 - 2.5 * E.MISS)
