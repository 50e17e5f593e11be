"""Language identification with hyperdimensional profiles.

Every letter (and the gap between words) has a random vector of +1 and -1.  A letter
n-gram is bound into one vector: the product of its letters' vectors, each permuted by its
place (rotated by ``n - 1 - place``).  A text is the bundle (sum) of its n-gram vectors, a
language prototype the bundle of all its training texts.  A text gets the language whose
prototype has the largest cosine with it; the cosine, at least 0, is the score.

Prototypes are bundled from n-gram counts per language, which Spark sums over all training
documents; n-gram vectors are made where they are needed from the letters' code points, so
no table of n-grams is shared.  Whole texts are read, in chunks of ``CHARS`` characters.

Cases: null text, or text without letters, is ``und`` with score 0; so is every text when
no training document has a language; ties go to the first language in order; documents
with a null id are not learned from and not held out; repeated rows get equal results; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, store

DIM = 1024
N = 3
SEED = 11
CHARS = 1 << 19  # of text at a time
DOCS = 64  # texts bundled by one matrix product
CACHED = 40_000  # n-gram vectors kept per worker
LANGUAGES = 10_000
GAP = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per BMP code point its lower-case letter, or the gap."""
    return np.array([_letter(c) for c in range(1 << 16)], np.int64)


@lru_cache(maxsize=1 << 16)
def _letter(c: int) -> int:
    if 0xD800 <= c < 0xE000 or not chr(c).isalpha():
        return GAP
    low = chr(c).lower()
    return ord(low) if len(low) == 1 else c


def symbols(text: str, before: np.ndarray, last: bool) -> np.ndarray:
    """Letters of a stretch of text behind the symbols ``before``, with one gap between
    words, and one at the end of the ``last`` stretch."""
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    table = _letters()
    code = table[np.minimum(cp, len(table) - 1)]
    beyond = cp >= len(table)
    if beyond.any():
        code[beyond] = [_letter(c) for c in cp[beyond].tolist()]
    code = np.concatenate((before, code, np.full(int(last), GAP)))
    return code[(code != GAP) | np.concatenate(([True], code[:-1] != GAP))]


def grams(text: str, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram codes, counts) of a text, 21 bits per letter."""
    parts, tail = [], np.array([GAP])
    for start in range(0, max(1, len(text)), CHARS):
        s = symbols(text[start : start + CHARS], tail, start + CHARS >= len(text))
        tail = s[-(n - 1) :]
        if len(s) >= n:
            code = np.zeros(len(s) - n + 1, np.int64)
            for k in range(n):
                code = (code << 21) | s[k : k + len(code)]
            parts.append(np.unique(code, return_counts=True))
    if len(parts) == 1:
        return parts[0]
    codes = np.concatenate([c for c, _ in parts] or [np.zeros(0, np.int64)])
    keys, at = np.unique(codes, return_inverse=True)
    return keys, np.bincount(at, np.concatenate([m for _, m in parts] or [[]]), len(keys)).astype(np.int64)


class Space:
    """Vectors of letters and n-grams."""

    def __init__(self, dim: int = DIM, n: int = N, seed: int = SEED):
        self.dim, self.n, self.seed = dim, n, seed
        self.letters: dict[int, np.ndarray] = {}
        self.row: dict[int, int] = {}
        self.bound = np.zeros((0, dim), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.default_rng([self.seed, code]).integers(0, 2, self.dim)
            self.letters[code] = (2 * bits - 1).astype(np.int8)
        return self.letters[code]

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """Bound vectors of n-gram codes, one per row."""
        new = [c for c in codes.tolist() if c not in self.row]
        if len(self.row) + len(new) > CACHED:
            self.row, self.bound, new = {}, self.bound[:0], codes.tolist()
        if new:
            made = np.ones((len(new), self.dim), np.int8)
            for place in range(self.n):
                letter = (np.array(new) >> (21 * (self.n - 1 - place))) & ((1 << 21) - 1)
                for c in np.unique(letter):
                    made[letter == c] *= np.roll(self.letter(int(c)), self.n - 1 - place)
            base = len(self.bound)
            self.row.update((c, base + i) for i, c in enumerate(new))
            self.bound = np.concatenate([self.bound, made])
        return self.bound[[self.row[c] for c in codes.tolist()]]

    def bundles(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Bundle of every (codes, counts) as a row."""
        if not texts:
            return np.zeros((0, self.dim), np.float32)
        codes = np.unique(np.concatenate([c for c, _ in texts]))
        counts = np.zeros((len(texts), len(codes)), np.float32)
        for i, (c, m) in enumerate(texts):
            counts[i, np.searchsorted(codes, c)] = m
        out = np.zeros((len(texts), self.dim), np.float32)
        for start in range(0, len(codes), CACHED // 4):  # a long text can have many n-grams
            part = codes[start : start + CACHED // 4]
            out += counts[:, start : start + len(part)] @ self.vectors(part).astype(np.float32)
        return out


def _count_batches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """(lang, gram, times) summed over a task, handed on when the table grows large."""
    counts: dict[str, dict[int, int]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, table in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(table), pa.string()), pa.array(list(table), pa.int64()), pa.array(list(table.values()), pa.int64())],
                names=["lang", "gram", "times"],
            )
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            table = counts.setdefault(lang, {})
            before = len(table)
            for c, m in zip(*(a.tolist() for a in grams(text, n)), strict=True):
                table[c] = table.get(c, 0) + m
            held += len(table) - before
        if held > 500_000:
            yield from flush()
            held = 0
    yield from flush()


def prototypes(training: DataFrame, dim: int = DIM, n: int = N, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes (unit rows) from rows (lang, text)."""
    spark = training.sparkSession
    arrow_batches(spark)
    rows = training.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counts = store(
        rows.mapInArrow(lambda it: _count_batches(it, n), "lang string, gram long, times long").groupBy("lang", "gram").agg(F.sum("times").alias("times")),
        "grams",
    )

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = Space(dim, n, seed), {}
        for batch in batches:
            lang = np.array(batch.column("lang").to_pylist(), object)
            for name in set(lang.tolist()):
                own = lang == name
                part = space.vectors(batch.column("gram").to_numpy()[own]).astype(np.int64)
                sums[name] = sums.get(name, 0) + batch.column("times").to_numpy()[own] @ part
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dim, pa.string()), pa.array(np.arange(dim), pa.int32()), pa.array(total, pa.int64())], names=["lang", "i", "x"]
            )

    arrow_batches(spark, 4096)
    sums = store(counts.mapInArrow(bundle, "lang string, i int, x long").groupBy("lang", "i").agg(F.sum("x").alias("x")), "prototypes")
    if sums.select("lang").distinct().count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    table: dict[str, np.ndarray] = {}
    for r in sums.collect():  # at most LANGUAGES vectors
        table.setdefault(r.lang, np.zeros(dim))[r.i] = r.x
    names = sorted(k for k, v in table.items() if v.any())
    matrix = np.array([table[k] / np.linalg.norm(table[k]) for k in names], np.float32).reshape(len(names), dim)
    return names, matrix


def held_out(id_col: str):
    """Every third document by the crc32 of its id is kept from learning."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(
    docs: DataFrame, languages: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text", n: int = N, seed: int = SEED
) -> DataFrame:
    """(id, lang_pred, score) of every document."""
    spark = docs.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(languages)  # at most LANGUAGES vectors

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        space = Space(matrix.shape[1], n, seed)
        for batch in it:
            texts = [grams(t or "", n) for t in batch.column("text").to_pylist()]
            best, score = ["und"] * len(texts), np.zeros(len(texts))
            for start in range(0, len(texts) if names else 0, DOCS):
                x = space.bundles(texts[start : start + DOCS])
                length = np.linalg.norm(x, axis=1)
                cosine = (x @ matrix.T) / np.maximum(length, 1e-9)[:, None]
                for i in np.flatnonzero(length > 0):
                    k = int(cosine[i].argmax())
                    best[start + i], score[start + i] = names[k], min(1.0, max(0.0, float(cosine[i, k])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(best, pa.string()), pa.array(score)], names=["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(batches, "id long, lang_pred string, score double")


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, text) of the documents to learn from."""
    return docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
