"""Best-fit packing of token sequences by exact complements.

1. Every text becomes token ids plus an end id; longer ones are cut into pieces of
   ``size`` tokens (the first piece takes the remainder).  One pass over the documents,
   stored once; each task also numbers its pieces per length.
2. Only the histogram of lengths (at most ``size`` rows) reaches the driver.  The plan
   consumes, from the longest length down, single lengths, pair sums and triple sums that
   fill a gap exactly, under availability counts; the rest is packed best-fit decreasing.
   A plan entry covers all sequences of one composition, so its size depends on ``size``
   and not on the number of documents.
3. A piece's rank among equal lengths (task-local number plus the counts of earlier
   tasks) selects its entry, hence its sequence and offset.

Cases: null text is an empty text (one piece: the end id); ids may be null or repeat, each
row is packed; ties between equal lengths go by task and position; an empty table gives no
rows; other columns are ignored.  The string of a special token in a text becomes that
token's id, as ``tokenizers`` has it.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import arrow_batches, store

SIZE = 2048
END_ID = 0

# The split pattern that byte-level BPE files imply.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Both libraries class these characters alike; texts with others take the slower one.
_PLAIN = re.compile("[\x09\x0a\x0d\x20-\x7e¡-¬®-ɏ‐-‧€]*")


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function text -> ids for a tokenizer file, loaded once per Python worker.

    ``tokenizers`` defines the ids.  For a plain byte-level BPE file, texts of common
    characters go through ``tiktoken`` with the same vocabulary: same ids, less time.
    """
    slow = Tokenizer.from_file(path)

    def by_tokenizers(text: str) -> list[int]:
        return slow.encode(text, add_special_tokens=False).ids

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre = spec.get("pre_tokenizer") or {}
    plain = (
        spec["model"].get("type") == "BPE"
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
        and not spec.get("normalizer")
    )
    if not plain:
        return by_tokenizers
    special = {t["content"] for t in spec.get("added_tokens", [])}
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        # Added tokens standing in a text are ids of their own, which only tokenizers knows.
        if len(text) > 1_000_000 or not _PLAIN.fullmatch(text) or any(token in text for token in special):
            return by_tokenizers(text)
        return fast.encode_ordinary(text)

    return encode


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be shorter."""
    first = n % size or size
    return [(0, first), *((s, size) for s in range(first, n, size))]


def _piece_batches(
    batches: Iterator[pa.RecordBatch], path: str, size: int, end_id: int, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    encode, task, seen = encoder(path), TaskContext.get().partitionId(), defaultdict(int)
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = np.array([*encode(text or ""), end_id], "<u4")
            for piece, (start, length) in enumerate(cuts(len(ids), size)):
                part = ids[start : start + length]
                rows.append((doc, piece, start, length, zlib.crc32(part.tobytes()), task, seen[length]) + ((part,) if with_ids else ()))
                seen[length] += 1
        columns = list(zip(*rows, strict=True)) if rows else [()] * (7 + with_ids)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()] + [pa.list_(pa.int64())] * with_ids
        names = ["id", "piece", "start", "length", "ids_crc32", "task", "local"] + ["ids"] * with_ids
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, local[, ids]): the cut token sequences."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, piece int, start long, length long, ids_crc32 long, task int, local long" + ", ids array<long>" * with_ids
    return rows.mapInArrow(lambda it: _piece_batches(it, tokenizer, size, end_id, with_ids), schema)


def compositions(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) that use up ``counts``.

    Complements of up to three, two or one parts are tried; the plan with the fewest
    sequences is used, the one with the most exact complements among equals.
    """
    plans = [_exact_first(counts, size, parts) for parts in (3, 2, 1)]
    return min(plans, key=lambda plan: sum(n for _, n in plan))


def _exact_first(counts: dict[int, int], size: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    """Exact complements of at most ``most`` parts first, then best-fit decreasing."""
    have = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        have[length] = n
    plan: list[tuple[tuple[int, ...], int]] = []

    def use(parts: tuple[int, ...]) -> bool:
        """Take as many sequences of ``parts`` as the counts allow."""
        lengths, times = np.unique(parts, return_counts=True)
        n = int((have[lengths] // times).min())
        if n:
            have[lengths] -= n * times
            plan.append((parts, n))
        return n > 0

    def pair(total: int, top: int) -> list[tuple[int, int]]:
        """Available pairs with this sum, larger part first."""
        a = np.arange(min(top, total - 1), (total - 1) // 2, -1)
        return [(int(x), total - int(x)) for x in a[(have[a] > 0) & (have[total - a] > 0)]] if len(a) else []

    rest: dict[int, int] = {}
    for longest in range(size, 0, -1):
        gap = size - longest
        if gap == 0:
            use((longest,))
        elif have[longest]:
            top = min(longest, gap)
            if most >= 1 and have[gap]:
                use((longest, gap))
            for two in pair(gap, top) if most >= 2 and have[longest] else ():
                if use((longest, *two)) and not have[longest]:
                    break
            first = min(top, gap - 2)
            while most >= 3 and have[longest] and first * 3 >= gap:
                if have[first]:
                    for two in pair(gap - first, first):
                        if use((longest, first, *two)) and not (have[longest] and have[first]):
                            break
                first -= 1
        if have[longest]:
            rest[longest] = int(have[longest])
            have[longest] = 0  # no exact complement left
    return plan + _best_fit(rest, size)


def _best_fit(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: equal bins move together."""
    bins: dict[int, list[list]] = defaultdict(list)  # gap -> [[lengths, number], ...]
    open_gaps = np.zeros(size + 1, bool)

    def add(parts: tuple[int, ...], n: int) -> None:
        gap = size - sum(parts)
        bins[gap].append([parts, n])
        open_gaps[gap] = True

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fit = np.flatnonzero(open_gaps[length:])
            if not len(fit):
                per = size // length
                if left >= per:
                    add((length,) * per, left // per)
                if left % per:
                    add((length,) * (left % per), 1)
                break
            gap = length + int(fit[0])
            group = bins[gap][-1]
            n = min(left, group[1])
            group[1] -= n
            if not group[1]:
                bins[gap].pop()
                open_gaps[gap] = bool(bins[gap])
            add((*group[0], length), n)
            left -= n
    return [(parts, n) for groups in bins.values() for parts, n in groups]


def placement(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, offset) in rank order."""
    used: dict[int, int] = defaultdict(int)
    entries: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for parts, n in plan:
        offset = 0
        for length in parts:
            entries[length].append((used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return {length: np.array(rows, np.int64) for length, rows in entries.items()}


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """``cut`` (a stored table from :func:`pieces`) with sequence_id and offset."""
    spark = cut.sparkSession
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = store(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "length-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    table = spark.sparkContext.broadcast(placement(compositions(histogram, size)))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            for value in np.unique(length):
                own, entries = length == value, table.value[int(value)]
                at = np.searchsorted(entries[:, 0], rank[own], side="right") - 1
                sequence[own] = entries[at, 1] + rank[own] - entries[at, 0]
                offset[own] = entries[at, 2]
            yield frame.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    ranked = (
        cut.join(counts.select("task", "length", "before"), ["task", "length"])
        .withColumn("rank", F.col("before") + F.col("local"))
        .select(*[c for c in cut.columns if c not in ("task", "local")], "rank")
    )
    fields = ", ".join(f"`{n}` {t}" for n, t in ranked.dtypes if n != "rank")
    return ranked.mapInPandas(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, **columns) -> DataFrame:
    """Tokenize, cut and pack ``docs``: one row per piece."""
    return pack(store(pieces(docs, tokenizer, size=size, end_id=end_id, **columns), "pieces"), size)
