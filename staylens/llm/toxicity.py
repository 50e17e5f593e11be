"""Toxicity scores from a subsequence string-kernel SVM with Nystroem landmarks.

Units are the white-space tokens of a text with everything but letters removed
(``i.d.i*ot`` -> ``idiot``); three or more single letters in a row make one unit
(``i d i o t``), and so do two neighbouring words that begin like a learned pair.  The kernel
of two units counts common subsequences of three letters, each weighted by ``DECAY`` per
letter it spans, so gaps and inserted characters only weaken a match; it is normalised to 1
for equal units.  Longer units (words run together, scripts without spaces) are read in
overlapping windows, which are learned and scored like units.

Training (labels of documents; a document is toxic through some of its units):
1. Document frequencies of stems over the training documents, per class: beginnings of
   units, whole short units, stretches anywhere in long units, and pairs of neighbouring
   words none of which tells by itself.  The fewest significant stems that explain the toxic
   documents are landmarks, with frequent clean stems beside.
2. A linear SVM (squared hinge) on the Nystroem features of windows: those of toxic
   documents that hold a found stem against those of clean documents.
3. ``ROUNDS`` - 1 times: the worst window of each sampled document joins the training
   windows, so that clean look-alikes become negatives (the most frequent also landmarks)
   and variants of insults positives.
4. A logistic curve turns the margins of the two worst windows of a document (the second
   only above the bound) and the number of its windows above the bound into a score.

The SVM on Nystroem features is a weighted sum of kernels with the landmarks, hence one
weight per letter triple: scoring a window needs neither landmarks nor pairs.  Margins below
``FLOOR``, where the hinge is flat, count as ``FLOOR``; a window whose margin a lower bound of
its norm shows to be there needs no norm.

The ``OWN`` most frequent letters have codes of their own, all others share the remaining
codes by a hash.  Insults of fewer than three letters are out of reach.

Bounds of the fit: ``PER_CLASS`` labelled documents of each class, ``SAMPLE`` of them for
steps 2 to 4, ``STEMS`` stems out of ``CANDIDATES``, pairs out of the ``PAIRS`` most frequent
of the toxic class, ``UNITS`` windows.  Scores cover every row.

Cases: null, empty or letterless texts have no units and get the score of the curve at the
lowest margin; without labels of both classes every score is 0; null ids are carried;
repeated rows get equal scores; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, discard, packed, store, unpacked

DECAY = 0.6
LETTERS = 64
OWN = 48  # letters with a code of their own
WINDOW = 12  # marked letters compared at a time; longer units are read in overlapping windows
STEP = 4
PER_CLASS = 20_000  # labelled documents of a class to learn from
SAMPLE = 3000
ROUNDS = 4
SHARE = 0.2  # weight of the toxic class in the curve
STEMS = 96
UNITS = 6_000
CANDIDATES = 2000
PAIRS = 20_000
HARD = 64  # look-alike landmarks added per round
BEGIN, END = "^", "$"  # letters that mark the ends of a unit
PREFIXES = (4, 5, 6, 7, 8)
WHOLE = (3, 8)  # letters of units that are stems as a whole, and of words of a pair
INFIXES = (3, 4, 6)
FLOOR = -1.0  # least margin, and that of a text without units
CACHE = 400_000

_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_]\s+){2,}[^\W\d_](?!\S)")
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def tokens(text: str, pairs: re.Pattern | None = None) -> list[str]:
    """Lower-cased tokens, spaced-out words included; a pair of words keeps the space."""
    low = text.lower()
    out = low.split() + ["".join(run.split()) for run in _SPACED.findall(low)]
    return out + [" ".join(m) for m in pairs.findall(low)] if pairs else out


def unit(token: str) -> str:
    return token if token.isalpha() else _NOT_LETTERS.sub("", token)


def units_of(text: str | None, pairs: re.Pattern | None = None) -> set[str]:
    return {unit(t) for t in set(tokens(text or "", pairs))}


def windows(u: str) -> list[str]:
    """A marked unit in stretches the kernel can take at once."""
    u = BEGIN + u + END
    if len(u) <= WINDOW:
        return [u]
    last = len(u) - WINDOW
    return [u[i : i + WINDOW] for i in [*range(0, last, STEP), last]]


def stems(window: str) -> set[str]:
    """What a window may be known by: beginnings of the unit, a whole short unit, stretches
    of a long unit."""
    begins, ends = window[0] == BEGIN, window[-1] == END
    core = window[begins : len(window) - ends]
    out = {BEGIN + core[:n] for n in PREFIXES if begins and len(core) >= n}
    if begins and ends:
        if WHOLE[0] <= len(core) <= WHOLE[1]:
            out.add(window)
    else:
        out.update(core[i : i + n] for n in INFIXES for i in range(len(core) - n + 1))
    return out


def word_pairs(text: str | None) -> set[str]:
    """Neighbouring words of the lengths ``WHOLE``, joined by a space."""
    words = [unit(t) for t in (text or "").lower().split()]
    fits = [WHOLE[0] <= len(w) <= WHOLE[1] for w in words]
    return {f"{a} {b}" for a, b, x, y in zip(words, words[1:], fits, fits[1:], strict=False) if x and y}


def pair_pattern(pairs: list[str]) -> re.Pattern | None:
    """Two neighbouring words that begin like a pair."""
    if not pairs:
        return None
    starts = sorted({tuple(w[:3] for w in p.split(" ")) for p in pairs})
    # Two groups whatever the number of pairs: the words; the choice is in look-aheads.
    ahead = "|".join(rf"{re.escape(a)}[^\W\d_]*[\W\d_]+{re.escape(b)}" for a, b in starts)
    return re.compile(rf"(?<![^\W\d_])(?={ahead})([^\W\d_]+)(?=[\W\d_]+([^\W\d_]+))")


@lru_cache(maxsize=None)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3)
    return at, (DECAY ** (at[:, 2] - at[:, 0] + 1)).astype(np.float32)


class Kernel:
    """Subsequence kernel over ``LETTERS`` codes."""

    def __init__(self, alphabet: str):
        self.alphabet = alphabet[:OWN]
        points = np.arange(0x110000, dtype=np.uint32)
        self.code = (OWN + (points * np.uint32(0x9E3779B1) >> np.uint32(16)) % (LETTERS - OWN)).astype(np.uint8)
        self.code[[ord(c) for c in self.alphabet]] = np.arange(len(self.alphabet))

    def by_length(self, units: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions in ``units``, letter codes) of the units of each length above 2."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        codes = self.code[np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int32)
        start = np.cumsum(sizes) - sizes
        for n in np.unique(sizes[sizes > 2]):
            where = np.flatnonzero(sizes == n)
            for part in np.array_split(where, 1 + len(where) * int(n) ** 3 // 4_000_000):
                yield part, codes[start[part][:, None] + np.arange(n)]

    @staticmethod
    def features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Triple codes and weights of units of one length."""
        at, weight = _triples(codes.shape[1])
        return (codes[:, at[:, 0]] * LETTERS + codes[:, at[:, 1]]) * LETTERS + codes[:, at[:, 2]], weight

    @staticmethod
    def norms(triple: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Square roots of the kernels of units with themselves."""
        row = np.arange(len(triple))[:, None] * LETTERS**3
        each, place = np.unique((triple + row).ravel(), return_inverse=True)
        sums = np.bincount(place, weights=np.tile(weight, len(triple)))
        return np.sqrt(np.bincount(each // LETTERS**3, weights=sums * sums))

    def dense(self, u: str) -> np.ndarray:
        """Normalised feature vector over all triples."""
        out = np.zeros(LETTERS**3, np.float32)
        for _, codes in self.by_length([u]):
            triple, weight = self.features(codes)
            np.add.at(out, triple[0], weight)
            out /= self.norms(triple, weight)[0]
        return out

    def basis(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(row of each triple, features): the normalised features of ``units`` as columns
        over the triples that any of them has; row 0, for all other triples, is zero."""
        row = np.zeros(LETTERS**3, np.int32)
        sparse = [(np.flatnonzero(d), d[np.flatnonzero(d)]) for d in map(self.dense, units)]
        used = np.unique(np.concatenate([at for at, _ in sparse]))
        row[used] = np.arange(1, len(used) + 1)
        features = np.zeros((len(used) + 1, len(units)), np.float32)
        for m, (at, values) in enumerate(sparse):
            features[row[at], m] = values
        return row, features

    def against(self, units: list[str], vectors: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
        """Products of the units' normalised features with ``vectors``, whose rows are
        the triples, or what ``row`` maps them to."""
        out = np.zeros((len(units), vectors.shape[1]), np.float32)
        for where, codes in self.by_length(units):
            triple, weight = self.features(codes)
            norm = self.norms(triple, weight)
            at = triple if row is None else row[triple]
            for part in np.array_split(np.arange(len(where)), 1 + triple.size * vectors.shape[1] // 4_000_000):
                out[where[part]] = np.einsum("ntm,t->nm", vectors[at[part]], weight) / norm[part, None]
        return out


@dataclass
class Model:
    """Weight per letter triple, bias, the curve from margins to scores, and pairs of words."""

    alphabet: str
    weights: np.ndarray
    bias: float
    curve: list[float] = field(default_factory=list)
    landmarks: list[str] = field(default_factory=list)
    pairs: list[str] = field(default_factory=list)

    def __post_init__(self):
        self._set_up()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._set_up()

    def _set_up(self):
        self._kernel = Kernel(self.alphabet)
        self._pattern = pair_pattern(self.pairs)
        self._above: dict[str, tuple[float, str]] = {}  # tokens above the floor
        self._floor: set[str] = set()  # the others

    def margins(self, units: list[str]) -> np.ndarray:
        """Margins of windows, ``FLOOR`` at least."""
        out = np.full(len(units), FLOOR)
        for where, codes in self._kernel.by_length(units):
            triple, weight = self._kernel.features(codes)
            total = np.einsum("nt,t->n", self.weights[triple], weight)
            # Weights are positive, so the norm is at least that of all different triples.
            least = float(np.sqrt((weight * weight).sum()))
            near = np.flatnonzero(self.bias + np.maximum(total, 0) / least > FLOOR - 1e-4)
            if len(near):
                out[where[near]] = np.maximum(FLOOR, np.round(total[near] / self._kernel.norms(triple[near], weight) + self.bias, 5))
        return out

    def _learn_tokens(self, new: list[str]) -> None:
        parts = [windows(u) if len(u) > 2 else [] for u in map(unit, new)]
        flat = [w for p in parts for w in p]
        margin = self.margins(flat)
        best: dict[int, tuple[float, str]] = {}
        owner = np.repeat(np.arange(len(new)), np.fromiter(map(len, parts), np.int64, len(parts)))
        for i in np.flatnonzero(margin > FLOOR):
            found, at = (float(margin[i]), flat[i]), int(owner[i])
            if at not in best or (-found[0], found[1]) < (-best[at][0], best[at][1]):
                best[at] = found
        self._above.update((new[i], found) for i, found in best.items())
        self._floor.update(t for i, t in enumerate(new) if i not in best)

    def worst(self, texts: list[str]) -> list[tuple[float, float, int, int, str]]:
        """Margins of the two worst distinct windows (the worst of each token), numbers of
        distinct windows above the bound and of distinct tokens, worst window."""
        sets = [set(tokens(t, self._pattern)) for t in texts]
        if len(self._above) + len(self._floor) > CACHE:
            self._above.clear()
            self._floor.clear()
        self._learn_tokens(list(set().union(*sets) - self._floor - self._above.keys()))
        out = []
        for s in sets:
            above = {w: m for m, w in map(self._above.__getitem__, s - self._floor)}
            found = sorted(((m, w) for w, m in above.items()), key=lambda f: (-f[0], f[1]))
            top, second = ([f[0] for f in found[:2]] + [FLOOR, FLOOR])[:2]
            out.append((top, second, sum(f[0] > 0 for f in found), len(s), found[0][1] if found else ""))
        return out

    def scores(self, found: list[tuple]) -> np.ndarray:
        return _logistic((_curve_inputs(found) * np.array(self.curve)).sum(axis=1)) if found else np.zeros(0)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _curve_inputs(found: list[tuple]) -> np.ndarray:
    """Constant, worst margin up to 1, second worst above the bound, windows above the bound:
    one clear insult tells, whatever the margins of clean words are."""
    top, second, above = np.array([f[:3] for f in found], float).reshape(-1, 3).T
    return np.column_stack([np.ones(len(top)), np.minimum(top, 1), np.maximum(second, 0), np.log1p(above)])


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Squared-hinge SVM by Newton steps; the last column of ``x`` is the constant."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        slack = 1 - y * (x @ w)
        active = slack > 0
        xa, ca = x[active], weight[active]
        step = np.linalg.solve((xa * ca[:, None]).T @ xa + np.diag(penalty), (xa * (ca * y[active])[:, None]).sum(0))
        if np.abs(step - w).max() < 1e-6:
            return step
        w = step
    return w


def fit_curve(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 1e-2) -> np.ndarray:
    """Ridge logistic regression by Newton steps; ``share`` of the weight is on class 1."""
    weight = np.where(y > 0, share / max(1, (y > 0).sum()), (1 - share) / max(1, (y <= 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = _logistic(x @ w)
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _stem_batches(batches: Iterator[pa.RecordBatch], found) -> Iterator[pa.RecordBatch]:
    """Partial document frequencies, per class, of what ``found`` sees in a text."""
    counts: dict[str, list[int]] = {}

    def flush():
        names = list(counts)
        out = pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([counts[s][1] for s in names], pa.int64()), pa.array([counts[s][0] for s in names], pa.int64())],
            names=["stem", "toxic", "clean"],
        )
        counts.clear()
        return out

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            for stem in found(text):
                counts.setdefault(stem, [0, 0])[toxic] += 1
            if len(counts) > 200_000:
                yield flush()
    yield flush()


def _text_stems(text: str | None) -> set[str]:
    return {s for u in units_of(text) if len(u) > 2 for w in windows(u) for s in stems(w)}


def _counted(rows: DataFrame, found) -> DataFrame:
    """(stem, toxic, clean): documents that hold it."""
    return (
        rows.mapInArrow(lambda it: _stem_batches(it, found), "stem string, toxic long, clean long")
        .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def _significant(counts: DataFrame, docs: tuple[int, int]) -> tuple[DataFrame, float]:
    """Stems of the toxic class with their ``gain``, best first, and the least gain."""
    # Log-likelihood of the stem's split between the classes against the classes' shares:
    # above log(number of stems) it is no chance find among them.
    share = docs[1] / sum(docs)
    q = (F.col("toxic") + 1e-9) / (F.col("toxic") + F.col("clean"))
    gain = F.col("toxic") * F.log(q / share) + F.col("clean") * F.log((1 - q + 1e-9) / (1 - share))
    least = float(np.log(max(2, counts.count()))) + 3
    found = counts.withColumn("gain", gain).where((q > share) & (F.col("toxic") > 5 * F.col("clean")) & (F.col("gain") > least))
    return found.orderBy(F.desc("gain"), "stem").limit(CANDIDATES), least


def _pairs(labelled: DataFrame, known: list[str], docs: tuple[int, int]) -> list[tuple[str, float]]:
    """Significant pairs of words (with gain per document) no word of which is known."""
    often = _counted(labelled.where("toxic = 1"), word_pairs).where("toxic >= 3").orderBy(F.desc("toxic"), "stem").limit(PAIRS)
    names = frozenset(r.stem for r in often.collect())  # PAIRS short strings at most
    if not names:
        return []
    shared = labelled.sparkSession.sparkContext.broadcast(names)
    counts = store(_counted(labelled, lambda text: word_pairs(text) & shared.value), "pairs")
    told = set(known)
    alone = lambda pair: not any(stems(w) & told for word in pair.split(" ") for w in windows(word))
    found, _ = _significant(counts, docs)
    out = [(r.stem, r.gain / r.toxic) for r in found.collect() if alone(r.stem)]
    discard(counts)
    return out


def _stems(labelled: DataFrame, sample: DataFrame, docs: tuple[int, int]) -> tuple[list[str], list[str]]:
    """Stems of the toxic class, best first, and frequent clean stems."""
    counts = store(_counted(labelled, _text_stems).where("toxic + clean >= 3"), "stems")
    found, least = _significant(counts, docs)
    found = [(r.stem, r.gain / r.toxic) for r in found.collect()]
    good = (
        counts.where(F.col("stem").startswith(BEGIN) & ~F.col("stem").endswith(END) & (F.length("stem") >= 6) & (F.col("clean") > F.col("toxic")))
        .orderBy(F.desc("clean"), "stem").limit(STEMS // 2).collect()
    )
    discard(counts)
    found += _pairs(labelled, [s for s, _ in found], docs)
    return _cover(sample.where("toxic = 1"), found, least), [r.stem for r in good]


def _related(a: str, b: str) -> bool:
    """One stem says what the other says."""
    if " " in a or " " in b:
        return a == b
    a, b = a.rstrip(END), b.rstrip(END)
    if a[0] == BEGIN and b[0] == BEGIN:
        return a.startswith(b) or b.startswith(a)
    a, b = a.lstrip(BEGIN), b.lstrip(BEGIN)
    return a in b or b in a


def _cover(toxic: DataFrame, found: list[tuple[str, float]], least: float) -> list[str]:
    """The fewest stems that explain the sampled toxic documents: the best by gain over
    documents that hold fewer than two chosen ones, until no stem is significant.  Words
    that only accompany insults (say, of one document copied many times) drop out."""
    place = {s: i for i, (s, _) in enumerate(found)}

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            held = [
                sorted(place[s] for s in (_text_stems(text) | word_pairs(text)) if s in place) for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int32()))], names=["held"])

    rows = [r.held for r in toxic.mapInArrow(batches, "held array<int>").collect()]  # SAMPLE rows of at most 2 * CANDIDATES
    member = np.zeros((len(rows), len(found)), bool)
    for i, held in enumerate(rows):
        member[i, held] = True
    worth = np.array([g for _, g in found])
    chosen: list[int] = []
    covered = np.zeros(len(rows), np.int64)
    free = np.ones(len(found), bool)
    while len(chosen) < STEMS and free.any():
        gain = member[covered < 2].sum(0) * worth * free
        best = int(gain.argmax())
        if gain[best] < least:
            break
        chosen.append(best)
        covered += member[:, best]
        free &= np.array([not _related(s, found[best][0]) for s, _ in found])
    return [found[i][0] for i in chosen]


def train(labelled: DataFrame) -> Model:
    """Model from rows (id, text, toxic in 0 and 1)."""
    spark = labelled.sparkSession
    arrow_batches(spark)
    numbers = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    docs = (numbers.get(0, 0), numbers.get(1, 0))
    if not all(docs):
        return Model("", np.zeros(LETTERS**3, np.float32), FLOOR, [-30.0, 0.0, 0.0, 0.0])
    order = F.xxhash64(F.lit("toxicity sample"), "id")
    chosen = labelled.where("toxic = 1").orderBy(order).limit(SAMPLE).union(labelled.where("toxic = 0").orderBy(order).limit(SAMPLE))
    # A limit ends in one task; the passes over the sample should not.
    sample = store(chosen.repartition(max(4, spark.sparkContext.defaultParallelism), "id"), "toxicity-sample")
    bad, good = _stems(labelled, sample, docs)
    pairs = [s for s in bad if " " in s]
    bad = [s for s in bad if " " not in s]
    units = _sample_units(sample, bad, pairs)
    letters = Counter(c for u, _, _ in units for c in u)
    kernel = Kernel("".join(c for c, _ in sorted(letters.items(), key=lambda p: (-p[1], p[0]))))
    landmarks = [*bad, *(w for p in pairs for w in windows(unit(p))), *good]
    if not (bad or pairs):
        return Model("", np.zeros(LETTERS**3, np.float32), FLOOR, [-30.0, 0.0, 0.0, 0.0])
    known = {u: (y, n) for u, y, n in units}
    model = None
    for round_ in range(ROUNDS):
        if round_:
            rows = _apply(sample.select("id", "text", "toxic"), model, keep_toxic=True).collect()  # 2 * SAMPLE rows at most
            hard: Counter = Counter()
            for r in rows:
                if r.toxic == 0 and r.unit:
                    known[r.unit] = (-1.0, known.get(r.unit, (0, 0))[1] + 1)
                    hard[r.unit] += 1
            clean = {u for u, (y, _) in known.items() if y < 0}
            for r in rows:
                if r.toxic == 1 and r.top > 0 and r.unit not in clean:
                    known[r.unit] = (1.0, known.get(r.unit, (0, 0))[1] + 1)
            landmarks += [u for u, n in sorted(hard.items(), key=lambda p: (-p[1], p[0])) if n and u not in landmarks][:HARD]
        row, vectors = kernel.basis(landmarks)
        values, basis = np.linalg.eigh(vectors.T @ vectors + 1e-3 * np.eye(len(landmarks)))
        whiten = basis / np.sqrt(np.maximum(values, 1e-6)) @ basis.T
        names = sorted(known)
        y = np.array([known[u][0] for u in names])
        count = np.log1p(np.array([known[u][1] for u in names], float))
        x = kernel.against(names, vectors, row).astype(float) @ whiten
        weight = count * np.where(y > 0, 1 / max(1e-9, count[y > 0].sum()), 1 / max(1e-9, count[y < 0].sum())) * len(y) / 2
        w = fit_svm(np.column_stack([x, np.ones(len(x))]), y, weight)
        weights = (vectors @ (whiten @ w[:-1])).astype(np.float32)[row]
        model = Model(kernel.alphabet, weights, float(w[-1]), [0.0] * 4, list(landmarks), pairs)
    rows = _apply(sample.select("id", "text", "toxic"), model, keep_toxic=True).collect()
    found = [(r.top, r.second, r.above) for r in rows]
    model.curve = fit_curve(_curve_inputs(found), np.array([float(r.toxic) for r in rows]), SHARE).tolist()
    return model


def _sample_units(sample: DataFrame, bad: list[str], pairs: list[str]) -> list[tuple[str, float, int]]:
    """(window, label, documents): windows of toxic documents that hold a toxic stem or pair
    and windows of clean documents, at most ``UNITS`` of either."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, both, pattern = set(bad), {unit(p) for p in pairs}, pair_pattern(pairs)
        for batch in it:
            rows = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                units = [u for u in units_of(text, pattern) if len(u) > 2]
                rows += [(w, toxic) for w in {w for u in units for w in windows(u) if not toxic or u in both or stems(w) & told}]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], names=["u", "toxic"])

    counts = sample.mapInArrow(batches, "u string, toxic int").groupBy("u").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    counts = store(counts, "units")
    pos = counts.where("bad > 5 * good").orderBy(F.desc("bad"), "u").limit(UNITS).collect()
    neg = counts.where("bad <= 5 * good").orderBy(F.desc("good"), F.xxhash64("u")).limit(UNITS).collect()
    return [(r.u, 1.0, r.bad) for r in pos] + [(r.u, -1.0, r.good) for r in neg]


def _apply(rows: DataFrame, model: Model, keep_toxic: bool = False) -> DataFrame:
    """(id[, toxic], top, second, above, n, unit, score) for rows (id, text[, toxic])."""
    spark = rows.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # LETTERS ** 3 weights, whatever the data

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in it:
            found = model.worst([t or "" for t in batch.column("text").to_pylist()])
            own = [batch.column("id")] + ([batch.column("toxic")] if keep_toxic else [])
            parts = list(zip(*found, strict=True)) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*own, *(pa.array(p, k) for p, k in zip(parts, (pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.string()), strict=True)),
                 pa.array(model.scores(found), pa.float64())],
                names=["id"] + ["toxic"] * keep_toxic + ["top", "second", "above", "n", "unit", "score"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"id {kind}" + ", toxic int" * keep_toxic + ", top double, second double, above long, n long, unit string, score double")


def training_rows(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS
) -> DataFrame:
    """Stored (id, text, toxic): at most ``per_class`` labelled ids of each class, by hash
    order, outside the held-out fifth.  The bounded id list is broadcast, so no text of
    ``docs`` is shuffled."""
    marks = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
        .where(~held_out("id"))
    )
    order = F.xxhash64(F.lit("toxicity labels"), "id")
    chosen = marks.where("toxic = 1").orderBy(order).limit(per_class).union(marks.where("toxic = 0").orderBy(order).limit(per_class))
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return store(own.join(F.broadcast(store(chosen, "toxicity-ids")), "id"), "toxicity-training")


def held_out(id_col: str, folds: int = 5):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, top, second, above, n, unit, score) of every document; ``unit`` is its worst window,
    marked at the ends of its unit."""
    return _apply(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), model)


def reject(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more."""
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = batch.column("row")
            texts = rows.field(rows.type.get_field_index(text_col)).to_pylist()
            scores = shared.value.scores(shared.value.worst([t or "" for t in texts]))
            yield batch.filter(pa.array(scores < threshold, pa.bool_()))

    rows = packed(docs)
    return unpacked(rows.mapInArrow(batches, rows.schema), docs)
