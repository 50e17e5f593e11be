"""Document scores by cross-entropy difference of two n-gram models.

A target model (documents named by an id table) and a background model (other documents,
matched in size) are character ``ORDER``-gram models over one shared vocabulary, taken from
the character counts of the whole corpus: a character is one token of 16 bits, and should
there be more than ``VOCABULARY`` different ones, each of the rarest is spelled as two tokens
of its own, so no two characters are ever taken for one.  Both models are smoothed the same way (Witten-Bell, interpolated down to single tokens).
Every token of a document has a loss under either model; the mean difference, target less
background, is the score: below 0 the document looks more like the target.

Scale: documents are dealt by a hash of their id into blocks of about ``BLOCK_BYTES`` of
text, whose number follows from the size of all texts alone.  A block counts its distinct n-grams, Spark adds the counts of all blocks, derives
the probabilities with joins on n-gram codes, and gives each block the losses of just its
own n-grams.  So no model is ever held whole, by the driver or a task, and what is gathered
grows with the corpus.  In each block, background documents are taken in hash order until
they match its target text, so the models match overall.

Cases: null and empty texts have no tokens and score 0; a null id is never a target;
repeated rows get equal scores; without target or background text every score is 0; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, store

ORDER = 4
TOKEN_BITS = 16
VOCABULARY = 63_000  # codes from 1 on; 0 stands before a text
# A character outside the vocabulary is spelled as its high and its low part.
LOW_PARTS = 1024
HIGH_PARTS = 0x110000 // LOW_PARTS
BLOCK_BYTES = 8 << 20
_POINTS = 0x110000


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def vocabulary(docs: DataFrame, text_col: str = "text") -> list[int]:
    """Code points of the most frequent characters over all texts."""
    arrow_batches(docs.sparkSession)

    def count(batches):
        total = np.zeros(_POINTS, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    part = np.bincount(points(text))
                    total[: len(part)] += part
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["c", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "c long, n long")
    top = rows.groupBy("c").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "c").limit(VOCABULARY).collect()
    return [r.c for r in top]


def coder(chars: list[int]) -> np.ndarray:
    """Token of every code point, 0 if it is spelled."""
    table = np.zeros(_POINTS, np.uint32)
    table[np.array(chars, np.int64)] = np.arange(1, len(chars) + 1)
    return table


def kinds_of_tokens(chars: list[int]) -> int:
    """Size of the vocabulary, with the start and an unseen token."""
    return len(chars) + 2 + (HIGH_PARTS + LOW_PARTS if len(chars) >= VOCABULARY else 0)


def tokens_of(text: str, table: np.ndarray) -> np.ndarray:
    cp = points(text)
    tokens = table[cp]
    spelled = tokens == 0
    if not spelled.any():
        return tokens
    out = np.repeat(tokens, 1 + spelled)
    at = (np.cumsum(1 + spelled) - 1)[spelled]  # of the low part
    out[at - 1] = VOCABULARY + 1 + cp[spelled] // LOW_PARTS
    out[at] = VOCABULARY + 1 + HIGH_PARTS + cp[spelled] % LOW_PARTS
    return out


def grams(text: str, table: np.ndarray) -> np.ndarray:
    """Code of the n-gram that ends at each token, 16 bits per token, last token lowest."""
    tokens = np.concatenate((np.zeros(ORDER - 1, np.uint64), tokens_of(text, table).astype(np.uint64)))
    n = len(tokens) - ORDER + 1
    code = np.zeros(n, np.uint64)
    for k in range(ORDER):
        code = (code << np.uint64(TOKEN_BITS)) | tokens[k : k + n]
    return code.view(np.int64)


def blocks(rows: DataFrame, number: int) -> DataFrame:
    """Adds the block of rows (id, ...); rows without an id are dealt by their text."""
    text = F.col("text") if "text" in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("block", F.pmod(F.when(F.col("id").isNull(), F.xxhash64(text)).otherwise(F.xxhash64("id")), F.lit(number)))


def count_block(docs: pa.Table, target: set, table: np.ndarray, block: int) -> pa.Table:
    """(block, gram, t, b): distinct n-grams with their target and background counts."""
    ids, texts = docs.column("id").to_pylist(), [t or "" for t in docs.column("text").to_pylist()]
    place = docs.column("place").to_pylist()
    role = np.array([1 if i in target else 0 for i in ids])
    wanted = sum(len(t) for t, r in zip(texts, role, strict=True) if r == 1)
    for i in sorted(np.flatnonzero(role == 0), key=lambda i: (place[i], texts[i])):
        if wanted <= 0:
            break
        role[i] = 2
        wanted -= len(texts[i])
    codes = [grams(t, table) for t in texts]
    empty = np.zeros(0, np.int64)
    keys = np.unique(np.concatenate(codes or [empty]))
    counts = []
    for own in (1, 2):
        got, n = np.unique(np.concatenate([c for c, r in zip(codes, role, strict=True) if r == own] or [empty]), return_counts=True)
        full = np.zeros(len(keys), np.int64)
        full[np.searchsorted(keys, got)] = n
        counts.append(full)
    return pa.table({"block": pa.array(np.full(len(keys), block), pa.int64()), "gram": pa.array(keys), "t": counts[0], "b": counts[1]})


def losses(counts: DataFrame, size: int) -> DataFrame:
    """(gram, loss_t, loss_b) in nats for a table (gram, t, b) of all n-grams met, over
    ``size`` kinds of tokens (V).

    Witten-Bell: p(w | h) = (c(h w) + N(h) p(w | shorter h)) / (c(h) + N(h)) with N(h) the
    number of different tokens behind h, from p(w) = (c(w) + 1) / (c + V)."""
    table, below = counts, None
    levels = [store(table, f"grams-{ORDER}")]
    for order in range(ORDER - 1, 0, -1):  # counts of shorter n-grams: the first token dropped
        mask = (1 << TOKEN_BITS * order) - 1
        shorter = levels[-1].groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
        levels.append(store(shorter, f"grams-{order}"))
    total = levels[-1].agg(F.coalesce(F.sum("t"), F.lit(0)).alias("t"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    below = levels[-1].select("gram", *[((F.col(s) + 1) / (total[s] + size)).alias(f"p{s}") for s in ("t", "b")])
    for order in range(2, ORDER + 1):
        level = levels[ORDER - order]
        context = F.shiftrightunsigned("gram", TOKEN_BITS).alias("context")
        seen = store(
            level.groupBy(context).agg(*[e for s in ("t", "b") for e in (F.sum(s).alias(f"c{s}"), F.sum((F.col(s) > 0).cast("long")).alias(f"n{s}"))]),
            f"contexts-{order}",
        )
        shorter = store(below, f"probabilities-{order - 1}").withColumnRenamed("gram", "rest")
        rows = level.withColumns({"context": F.shiftrightunsigned("gram", TOKEN_BITS), "rest": F.col("gram").bitwiseAND(F.lit((1 << TOKEN_BITS * (order - 1)) - 1))})
        rows = rows.join(seen, "context").join(shorter, "rest")
        smooth = lambda s: F.when(F.col(f"c{s}") > 0, (F.col(s) + F.col(f"n{s}") * F.col(f"p{s}")) / (F.col(f"c{s}") + F.col(f"n{s}"))).otherwise(F.col(f"p{s}"))
        below = rows.select("gram", smooth("t").alias("pt"), smooth("b").alias("pb"))
    return store(below.select("gram", (-F.log("pt")).alias("loss_t"), (-F.log("pb")).alias("loss_b")), "losses")


def score_block(docs: pa.Table, known: pa.Table, table: np.ndarray) -> pa.Table:
    """(id, n_tokens, loss_target, loss_background, score) of a block's documents."""
    gram = known.column("gram").to_numpy()
    order = np.argsort(gram)
    gram = gram[order]
    t, b = known.column("loss_t").to_numpy()[order], known.column("loss_b").to_numpy()[order]
    rows = []
    for text in docs.column("text").to_pylist():
        at = np.searchsorted(gram, grams(text or "", table))
        n = len(at)
        lt, lb = (float(t[at].sum()) / n, float(b[at].sum()) / n) if n else (0.0, 0.0)
        rows.append((n, lt, lb, lt - lb))
    columns = list(zip(*rows, strict=True)) if rows else [()] * 4
    return pa.table([docs.column("id").combine_chunks() if len(rows) else pa.array([], pa.int64()), *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.float64(), pa.float64(), pa.float64()), strict=True))],
                    names=["id", "n_tokens", "loss_target", "loss_background", "score"])


def score(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_tokens, loss_target, loss_background, score) of every document; the target
    documents are those whose id stands in the first column of ``target_ids``."""
    spark = docs.sparkSession
    chars = vocabulary(docs, text_col)
    shared = spark.sparkContext.broadcast(chars)  # at most VOCABULARY numbers
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    number = max(1, math.ceil(size / block_bytes))
    dealt = blocks(rows.withColumn("place", F.xxhash64(F.lit("background"), "id")), number)
    marks = blocks(target_ids.select(F.col(target_ids.columns[0]).cast("long").alias("id")).where("id IS NOT NULL").distinct(), number)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"block": pa.array([], pa.int64()), "gram": pa.array([], pa.int64()), "t": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        return count_block(left, set(right.column("id").to_pylist()), coder(shared.value), left.column("block")[0].as_py())

    counted = store(dealt.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(count, "block long, gram long, t long, b long"), "block-grams")
    totals = counted.groupBy("gram").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
    known = store(counted.select("block", "gram").join(losses(totals, kinds_of_tokens(chars)), "gram"), "block-losses")

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        return score_block(left, right, coder(shared.value))

    return (
        dealt.select("id", "text", "block").groupBy("block").cogroup(known.groupBy("block"))
        .applyInArrow(judge, "id long, n_tokens long, loss_target double, loss_background double, score double")
    )
