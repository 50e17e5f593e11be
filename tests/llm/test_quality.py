"""Weak-label quality: EM on simulated labellers, features by definition, labelled data, odd rows."""

from collections import Counter

import numpy as np
import pytest

from staylens.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_em_recovers_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.8
    accuracy, cover = np.array([0.95, 0.9, 0.8, 0.7, 0.85]), np.array([0.9, 0.8, 0.9, 0.7, 0.5])
    right = rng.random((len(truth), 5)) < accuracy
    vote = np.where(right == truth[:, None], Q.GOOD, Q.BAD)
    vote[rng.random(vote.shape) > cover] = Q.ABSTAIN
    patterns, counts = np.unique(vote, axis=0, return_counts=True)
    model = Q.expectation_maximisation(patterns, counts.astype(float))
    assert model.share == pytest.approx(0.8, abs=0.03)
    assert np.abs(model.accuracies() - accuracy).max() < 0.04
    assert ((model.posterior(vote) >= 0.5) == truth).mean() > 0.93


def test_features_by_definition():
    texts = ["a b b ab%% AB", "", "b ab%%"]
    doc, bucket = Q.hashed(texts)
    by = [Counter(bucket[doc == i].tolist()) for i in range(3)]
    assert [sum(b.values()) for b in by] == [15, 0, 6] and by[0][1] == 1 and by[2][1] == 0  # one repeated word
    words = [set(bucket[: len(bucket) // 3][doc[: len(doc) // 3] == i].tolist()) for i in range(3)]
    assert words[2] < words[0] and len(words[0]) == 4
    whole, parts = Q.hashed(["x y! " * 50])[1], Q.hashed(["x y! " * 50, "z"])
    assert sorted(whole) == sorted(parts[1][parts[0] == 0])


def test_votes():
    assert Q.votes("") == Q.votes("one two") == "0" * len(Q.LABELLERS)
    noisy = dict(zip(Q.LABELLERS, Q.votes("THE!! END!! OF$$ ALL## THINGS%% IS!! NEAR**"), strict=True))
    assert noisy["signs"] == noisy["capitals"] == str(Q.BAD)


def test_against_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = Q.classify(docs, Q.train(docs)).join(labels, Q.F.col("id") == Q.F.col("doc_id")).collect()
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in got]) > 0.95
    assert np.mean([r.score >= 0.5 for r in got if r.quality == 1]) > 0.97


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "some ordinary words that stand here today.", "c"), (3, "%% ## !! $$ && **", "d"),
            (3, "%% ## !! $$ && **", "e"), (4, "word other " * 100_000, "f"), (5, "x" * 200_000, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    models = Q.train(docs)
    got = Q.classify(docs, models).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in got)
    assert len({r.posterior for r in got if r.id in (1, 2)}) == 1
    assert len({(r.votes, r.posterior, r.score) for r in got if r.id == 3}) == 1
    assert Q.classify(docs.limit(0), Q.train(docs.limit(0))).count() == 0
    assert Q.classify(docs.limit(2), Q.train(docs.where("doc_id < 3"))).count() == 2
