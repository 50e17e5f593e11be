"""Quality classifier without gold labels: weak labellers, EM, and a hashed linear scorer.

1. Heuristic labellers vote good, bad or abstain on every document (:data:`LABELLERS`).
2. Spark counts the vote patterns of all documents (at most 3 ** labellers of them).
   Expectation-maximisation over the pattern counts estimates each labeller's accuracy per
   class and the classes' shares, and gives every pattern a posterior of good quality.
3. The posteriors of ``SAMPLE`` documents (by hash order, a documented bound) train a
   logistic scorer on hashed features: words, pairs of neighbouring word shapes, and
   whether a word repeats the one before.  It scores every whole text.

Cases: null and empty texts, and texts below ``MIN_WORDS`` words, get only abstentions from
the labellers, so their posterior is the estimated share of good documents; a text without
words scores by the scorer's constant; null ids are carried; repeated rows get equal
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, row_key, store
from .words import mix, slices

ABSTAIN, GOOD, BAD = 0, 1, 2
MIN_WORDS = 5
SAMPLE = 6000
BUCKETS = 1 << 16
CHARS = 1 << 20
EPOCHS = 200
KEEP = 0.75

_SIGNS = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")
# Byte classes: 0 space, 1 lower case or beyond ASCII, 2 upper case, 3 digit, 4 sentence sign, 5 other sign.
_CLASS = np.full(256, 5, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[97:123] = 1
_CLASS[128:] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[33, 39, 44, 45, 46, 58, 59, 63]] = 4


def measures(text: str) -> dict[str, float]:
    """What the labellers look at, over the whole text."""
    words = text.split()
    n = max(1, len(words))
    lines = [line for line in text.split("\n") if line.strip()] or [""]
    size = np.fromiter(map(len, words), np.int64, len(words))
    kinds = np.bincount(_CLASS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=6)
    letters = max(1, int(kinds[1] + kinds[2]))
    return {
        "words": len(words),
        "signs": float(kinds[5] + kinds[4]) / max(1, int(kinds[1:].sum())),
        "capitals": float(kinds[2]) / letters,
        "digits": float(kinds[3]) / max(1, int(kinds[1:].sum())),
        "stutter": sum(map(eq, words, words[1:])) / n,
        "lone": len(_SIGNS.findall(text)) / n,
        "distinct": len(set(words)) / n,
        "mean": float(size.sum()) / n,
        "short": float((size <= 3).sum()) / n,
        "repeated": 1 - len(set(lines)) / len(lines),
        "closed": sum(line.rstrip()[-1:] in ".!?:;\"'”»" for line in lines) / len(lines),
        "lines": len(lines),
    }


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


# Name and rule of every labeller; the rules overlap on purpose.
LABELLERS = {
    "signs": lambda m: _vote(m["signs"] > 0.12, m["signs"] < 0.05),
    "capitals": lambda m: _vote(m["capitals"] > 0.25, m["capitals"] < 0.08),
    "digits": lambda m: _vote(m["digits"] > 0.2, False),
    "stutter": lambda m: _vote(m["stutter"] > 0.15, False),
    "lone signs": lambda m: _vote(m["lone"] > 0.15, False),
    "distinct words": lambda m: _vote(m["distinct"] < 0.3 and m["words"] < 400, m["distinct"] > 0.4),
    "word length": lambda m: _vote(not 2.5 <= m["mean"] <= 9, 3.5 <= m["mean"] <= 6.5),
    "short words": lambda m: _vote(m["short"] < 0.08, 0.2 <= m["short"] <= 0.6),
    "repeated lines": lambda m: _vote(m["repeated"] > 0.3 and m["lines"] > 2, False),
    "closed lines": lambda m: _vote(m["closed"] < 0.4, m["closed"] > 0.9),
}


def votes(text: str) -> str:
    """One digit per labeller."""
    if len(text.split(None, MIN_WORDS)) < MIN_WORDS:
        return str(ABSTAIN) * len(LABELLERS)
    m = measures(text)
    return "".join(str(rule(m)) for rule in LABELLERS.values())


@dataclass
class WeakModel:
    """Share of good documents and, per class and labeller, the odds of each vote."""

    share: float
    table: np.ndarray  # class (bad, good) x labeller x vote

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        log = np.log([1 - self.share, self.share]) + np.stack(
            [np.log(self.table[c][np.arange(patterns.shape[1]), patterns]).sum(1) for c in (0, 1)], axis=1
        )
        out = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
        return np.where((patterns == ABSTAIN).all(1), self.share, out)  # not judged: no evidence

    def accuracies(self) -> np.ndarray:
        """Per labeller, how often a vote that is no abstention is right."""
        hit = (1 - self.share) * self.table[0][:, BAD] + self.share * self.table[1][:, GOOD]
        cast = (1 - self.share) * (1 - self.table[0][:, ABSTAIN]) + self.share * (1 - self.table[1][:, ABSTAIN])
        return hit / np.maximum(cast, 1e-12)


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> WeakModel:
    """Dawid-Skene estimates from distinct vote patterns and their counts, from the share of good votes."""
    judged = (patterns != ABSTAIN).any(1)
    if not judged.any():
        return WeakModel(0.5, np.full((2, patterns.shape[1], 3), 1 / 3))
    patterns, counts = patterns[judged], counts[judged]
    good, bad = (patterns == GOOD).sum(1), (patterns == BAD).sum(1)
    # One bad vote speaks louder at the start: most labellers find one kind of fault each.
    p = (good + 1) / (good + 3 * bad + 1.5)
    model = None
    for _ in range(rounds):
        weight = np.stack([(1 - p) * counts, p * counts])
        table = np.stack([
            np.stack([(w[:, None] * (patterns == v)).sum(0) for v in (ABSTAIN, GOOD, BAD)], axis=1) + 0.5 for w in weight
        ])
        table /= table.sum(2, keepdims=True)
        share = float(np.clip(weight[1].sum() / max(counts.sum(), 1e-9), 1e-3, 1 - 1e-3))
        model = WeakModel(share, table)
        new = model.posterior(patterns)
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return model


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every feature of ``texts``."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    kind = _CLASS[data]
    inside = kind > 0
    edge = np.diff(np.concatenate(([False], inside)).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = end - start
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    at = np.flatnonzero(inside)
    place = np.arange(len(at)) - np.repeat(first, size)
    power = np.cumprod(np.full(4096, 0x100000001B3, np.uint64))
    word = mix(np.add.reduceat(mix(data[at].astype(np.uint64) + np.uint64(1)) * power[place % 4096], first))
    # Shape: kinds of character in order, runs collapsed (signs keep their character).
    value = np.where(kind[at] == 5, data[at].astype(np.uint64) + np.uint64(256), kind[at].astype(np.uint64))
    turn = np.ones(len(at), bool)
    turn[1:] = (value[1:] != value[:-1]) | (place[1:] == 0)
    step = np.cumsum(turn) - 1
    step = step - np.repeat(step[first], size)
    shape = mix(np.add.reduceat(np.where(turn, mix(value + np.uint64(9)) * power[step % 4096], np.uint64(0)), first))
    ends = np.cumsum([len(r) + 1 for r in raw])
    doc = np.searchsorted(ends, start, side="right")
    same = np.concatenate(([False], (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])))
    before = np.concatenate(([np.uint64(0)], np.where(doc[1:] == doc[:-1], shape[:-1], np.uint64(0))))
    pair = mix(shape * np.uint64(3) + before)
    mask = np.uint64(BUCKETS - 1)
    bucket = np.concatenate([word & mask, pair & mask, np.where(same, 1, 0).astype(np.uint64)])
    return np.tile(doc, 3), bucket.astype(np.int64)


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        doc, bucket = hashed(texts)
        total = np.bincount(doc, self.weights[bucket], len(texts))
        n = np.maximum(np.bincount(doc, minlength=len(texts)), 1)
        return 1 / (1 + np.exp(-np.clip(total / n + self.bias, -30, 30)))


def fit_scorer(doc: np.ndarray, bucket: np.ndarray, value: np.ndarray, target: np.ndarray, ridge: float = 1e-6) -> Scorer:
    """Logistic regression on posterior labels, ``KEEP`` of the weight on good; ``value`` is
    a feature's share of its document's features."""
    n = len(target)
    good, bad = KEEP * target / max(target.sum(), 1e-9), (1 - KEEP) * (1 - target) / max((1 - target).sum(), 1e-9)
    weight, share = good + bad, good / np.maximum(good + bad, 1e-12)
    w, b, gw, gb = np.zeros(BUCKETS), 0.0, np.full(BUCKETS, 1e-12), 1e-12
    for _ in range(EPOCHS):
        z = np.bincount(doc, w[bucket] * value, n) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - share)
        grad = np.bincount(bucket, error[doc] * value, BUCKETS) + ridge * w
        gw += grad * grad
        gb += error.sum() ** 2
        w -= grad / np.sqrt(gw) * (np.abs(grad) > 1e-15)
        b -= 0.1 * error.sum() / np.sqrt(gb)
    return Scorer(w, float(b))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[WeakModel, Scorer]:
    """Both models from unlabelled ``docs``."""
    spark = docs.sparkSession
    arrow_batches(spark)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [votes(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(own, pa.string())], names=["key", "votes"])

    rows = _rows(docs, id_col, text_col)
    voted = store(rows.mapInArrow(vote, "key long, votes string"), "votes")
    patterns = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()  # 3 ** labellers at most
    if not patterns:
        return WeakModel(0.5, np.full((2, len(LABELLERS), 3), 1 / 3)), Scorer(np.zeros(BUCKETS), 0.0)
    table = np.array([[int(c) for c in r.votes] for r in patterns])
    model = expectation_maximisation(table, np.array([float(r.n) for r in patterns]))
    # Sample: by hash order, half of the places for either side of the posterior.
    good = dict(zip((r.votes for r in patterns), model.posterior(table).tolist(), strict=True))
    order = F.xxhash64(F.lit("quality sample"), "key")
    side = spark.createDataFrame([(k, v) for k, v in good.items()], "votes string, good double")
    marked = voted.where(F.col("votes").rlike("[12]")).join(F.broadcast(side), "votes").select("key", "good").distinct()
    chosen = marked.where("good >= 0.5").orderBy(order).limit(SAMPLE // 2).union(marked.where("good < 0.5").orderBy(order).limit(SAMPLE // 2))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            buckets, values = [], []
            for t in texts:
                _, b = hashed([t])
                kept, times = np.unique(b, return_counts=True)
                buckets.append(kept)
                values.append(times / max(1, len(b)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("good"), pa.array(buckets, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                names=["key", "good", "bucket", "value"],
            )

    sample = rows.join(F.broadcast(store(chosen, "quality-sample")), "key")  # at most SAMPLE keys
    made = store(sample.mapInArrow(features, "key long, good double, bucket array<int>, value array<float>").dropDuplicates(["key"]), "quality-features")
    got = made.orderBy("key").toArrow()
    if not got.num_rows:
        return model, Scorer(np.zeros(BUCKETS), 0.0)
    size = got.column("bucket").combine_chunks().value_lengths().to_numpy()
    doc = np.repeat(np.arange(got.num_rows), size)
    flat = lambda c: got.column(c).combine_chunks().flatten().to_numpy()
    return model, fit_scorer(doc, flat("bucket"), flat("value"), got.column("good").to_numpy())


def classify(docs: DataFrame, models: tuple[WeakModel, Scorer], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, votes, posterior, score) of every document."""
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(models)  # fixed size

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weak, scorer = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            own = [votes(t) for t in texts]
            posterior = weak.posterior(np.array([[int(c) for c in v] for v in own])) if own else np.zeros(0)
            scores = [scorer.scores(texts[a:b]) for a, b in slices([len(t) for t in texts], CHARS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(own, pa.string()), pa.array(posterior), pa.array(np.concatenate(scores or [np.zeros(0)]))],
                names=["id", "votes", "posterior", "score"],
            )

    return _rows(docs, id_col, text_col).select("id", "text").mapInArrow(score, "id long, votes string, posterior double, score double")
