"""Benchmark decontamination by template canonicalisation.

Words become typed placeholders: numbers, units behind a number, and names (capitalised
words).  Windows of ``WINDOW`` words of documents and items meet by their 64-bit hashes, in
any of four readings: own words; numbers and units as placeholders; also capitalised words
inside a sentence; also those that open a sentence or line.  So neither case nor line
breaks hide a copy, and opening names are found.  Where they meet, the slots (placeholders) are lined up,
in each stretch of the document that is at most ``STRETCH`` times as long as the item by
itself: every value of the item must stand for one value of the stretch, and different
names for different names; windows that break the assignment do not count.  The most
frequent values are tried, then those of each alignment of item and stretch, and the best
counts.  A document is contaminated by an item if in one stretch consistent windows cover
``SIMILARITY`` of the item's windows.  So verbatim passages and re-parameterised questions
are found alike, however often a document repeats the template.

A reading that leaves a window fewer than ``LITERALS`` ordinary words is not used, so runs
of numbers or names are no template.  An item shorter than a window is one window as a
whole.  In an item of a single window opening words are literal, since nothing else in it
tells "Define" from a name.

Scale: documents are never shuffled.  The item index goes to the executors in blocks of at
most ``BLOCK_BYTES`` of benchmark text, each block a further pass over the documents, so a
benchmark of any size is handled with bounded memory.

Cases: null or wordless texts match nothing; null ids are carried; repeated documents or
items give a row each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, packed, row_key, store, unpacked
from .words import Words, mix, slices

WINDOW = 5
SIMILARITY = 0.8
LITERALS = 2
STRETCH = 1.5
BLOCK_BYTES = 4 << 20
CHARS = 1 << 20  # of text canonicalised at a time

NUMBER, UNIT, NAME = 1, 2, 3
INNER, EVERY = 2, 3  # of the readings of a text

# Common unit words that may follow a number.
UNITS = """
mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres
mg g kg t lb lbs oz gram grams kilogram kilograms ton tons tonne tonnes pound pounds ounce ounces
ml cl l liter liters litre litres gallon gallons cup cups
s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
mph kmh degree degrees celsius fahrenheit percent
dollar dollars euro euros cent cents
""".split()


@dataclass
class Templates:
    """Words of texts, the slot kind of each in the widest reading (every capitalised word
    is a name), and the kinds in the readings windows are hashed by, widest last."""

    words: Words
    kind: np.ndarray
    readings: tuple[np.ndarray, ...]

    @classmethod
    def of(cls, texts: list[str]) -> Templates:
        words = Words(texts)
        own = np.zeros(len(words.hash), np.int8)
        typed = own.copy()
        typed[words.number] = NUMBER
        if len(typed) > 1:
            unit = np.isin(words.hash, _unit_hashes()) & ~words.number
            follows = np.concatenate(([False], words.number[:-1] & (words.doc[1:] == words.doc[:-1])))
            typed[unit & follows] = UNIT
        inner = np.where((typed == 0) & words.capital & ~words.opens, np.int8(NAME), typed)
        every = np.where((typed == 0) & words.capital, np.int8(NAME), typed)
        return cls(words, every, (own, typed, inner, every))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, hash, reading) of every window of ``size`` words inside one text, in
        each reading that differs from the narrower ones."""
        n = len(self.kind) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int8)
        inside = np.flatnonzero(self.words.doc[:n] == self.words.doc[size - 1 :])
        firsts, hashes, numbers = [], [], []
        before = None
        for number, kind in enumerate(self.readings):
            at = inside
            if before is not None:
                changed = np.concatenate(([0], np.cumsum(kind != before)))
                literal = np.concatenate(([0], np.cumsum(kind == 0)))
                new = (changed[size:] > changed[:-size]) & (literal[size:] - literal[:-size] >= min(LITERALS, size))
                at = inside[new[inside]]
            source = np.where(kind > 0, mix(kind.astype(np.uint64) + np.uint64(77)), self.words.hash)
            h = np.full(len(at), size, np.uint64)
            for k in range(size):
                h = mix(h + source[at + k])
            firsts.append(at)
            hashes.append(h)
            numbers.append(np.full(len(at), number, np.int8))
            before = kind
        return np.concatenate(firsts), np.concatenate(hashes), np.concatenate(numbers)


_units: list[np.ndarray] = []


def _unit_hashes() -> np.ndarray:
    if not _units:
        _units.append(Words([" ".join(UNITS)]).hash)
    return _units[0]


class ItemIndex:
    """Window hashes of a block of benchmark items."""

    def __init__(self, texts: list[str], window: int = WINDOW):
        self.templates = Templates.of(texts)
        doc = self.templates.words.doc
        self.first = np.searchsorted(doc, np.arange(len(texts) + 1))
        sizes = np.diff(self.first)
        self.size = np.minimum(sizes, window)  # of each item's windows
        self.count = np.maximum(sizes - window, 0) + 1
        hashes, items, places = [], [], []
        for size in np.unique(self.size[self.size > 0]):
            at, h, reading = self.templates.windows(int(size))
            own = (self.size[doc[at]] == size) & ((reading < EVERY) | (self.count[doc[at]] > 1))
            hashes.append(h[own])
            items.append(doc[at][own])
            places.append(at[own] - self.first[doc[at][own]])
        empty = np.zeros(0, np.int64)
        self.sizes = [int(s) for s in np.unique(self.size[self.size > 0])]
        h = np.concatenate(hashes) if hashes else empty.astype(np.uint64)
        order = np.argsort(h, kind="stable")
        # (kind, hash) of the words that are slots wherever they stand: no opening words
        inner = self.templates.readings[INNER]
        self.slots = set(zip(inner[inner > 0].tolist(), self.templates.words.hash[inner > 0].tolist(), strict=True))
        self.item = (np.concatenate(items) if items else empty)[order]
        self.place = (np.concatenate(places) if places else empty)[order]
        self.hash, self.begin, self.times = np.unique(h[order], return_index=True, return_counts=True)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.hash & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def meetings(self, found: Templates) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word in the texts, item, window of the item) that meet in any reading."""
        out = []
        for size in self.sizes:
            at, h, _ = found.windows(size)
            maybe = self.bits[(h & np.uint64((1 << 20) - 1)).astype(np.int64)]
            at, h = at[maybe], h[maybe]
            slot = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            hit = self.hash[slot] == h
            at, slot = at[hit], slot[hit]
            times = self.times[slot]
            entry = np.repeat(self.begin[slot], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            out.append((np.repeat(at, times), self.item[entry], self.place[entry]))
        if not out:
            return (np.zeros(0, np.int64),) * 3
        at, item, place = (np.concatenate(c) for c in zip(*out, strict=True))
        order = np.lexsort((place, item, at))  # a window may meet in several readings
        at, item, place = at[order], item[order], place[order]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 0) | (np.diff(item) != 0) | (np.diff(place) != 0)
        return at[new], item[new], place[new]


def _stretches(at: np.ndarray, place: np.ndarray, span: int, need: int) -> list[tuple[int, int, int]]:
    """(distinct windows, low, high) of every longest run of meetings within ``span`` words
    that holds ``need`` windows, fullest first; ``at`` ascends."""
    ends = np.searchsorted(at, at + span, side="right")
    at_end, have, high, out = 0, Counter(), 0, []
    places = place.tolist()
    for low, end in enumerate(ends.tolist()):
        while high < end:
            have[places[high]] += 1
            high += 1
        if end > at_end and len(have) >= need:
            out.append((len(have), low, end))
        at_end = max(at_end, end)
        have[places[low]] -= 1
        if not have[places[low]]:
            del have[places[low]]
    return sorted(out, key=lambda r: (-r[0], r[1]))


def _assign(ranked: list[tuple[int, int, int]]) -> dict[tuple[int, int], int]:
    """One value per slot, different ones for different names, the first ranked first."""
    value: dict[tuple[int, int], int] = {}
    taken: dict[int, int] = {}
    for kind, x, y in ranked:
        if (kind, x) in value or (kind == NAME and taken.get(y, x) != x):
            continue
        value[kind, x] = y
        if kind == NAME:
            taken[y] = x
    return value


def _assignments(bound: list[list[tuple[int, int, int]]], lag: list[int]) -> Iterator[dict[tuple[int, int], int]]:
    """Slot assignments of a stretch worth trying: the most frequent values, then for each
    alignment (``lag``: first word less window of the item) the values nearest to it, so
    that of several copies in the stretch each is read by its own values."""
    votes = Counter(pair for pairs in bound for pair in pairs)
    value = _assign(sorted(votes, key=lambda p: (-votes[p], p)))
    yield value
    if all(value.get((kind, x)) == y for kind, x, y in votes):
        return
    where: dict[tuple[int, int, int], set[int]] = {}
    for pairs, own in zip(bound, lag, strict=True):
        for pair in pairs:
            where.setdefault(pair, set()).add(own)
    for own, _ in Counter(lag).most_common():
        yield _assign(sorted(votes, key=lambda p: (min(abs(g - own) for g in where[p]), -votes[p], p)))


def _best(index: ItemIndex, found: Templates, item: int, at: np.ndarray, place: np.ndarray, span: int, need: int) -> tuple[int, int, int, int]:
    """Most windows of the item within ``span`` words that agree with one slot assignment:
    (number, first, last, slots).  The assignment is sought in each stretch by itself."""
    order = np.lexsort((place, at))
    at, place = at[order], place[order]
    step = np.arange(int(index.size[item]))
    mine, theirs = int(index.first[item]) + place[:, None] + step, at[:, None] + step
    kinds = index.templates.kind[mine]
    row, column = np.nonzero(kinds)
    a, b = index.templates.words.hash[mine[row, column]], found.words.hash[theirs[row, column]]
    bound: list[list[tuple[int, int, int]]] = [[] for _ in range(len(at))]
    for r, *pair in zip(row.tolist(), kinds[row, column].tolist(), a.tolist(), b.tolist(), strict=True):
        bound[r].append(tuple(pair))
    lag = (at - place).tolist()
    best = (0, 0, 0, 0)
    for most, low, high in _stretches(at, place, span, need):
        if most <= best[0]:
            break
        for value in _assignments(bound[low:high], lag[low:high]):
            good = [r for r in range(low, high) if all(value.get((k, x)) == y for k, x, y in bound[r])]
            met, first, last = _densest(at[good], place[good], span)
            if met > best[0]:
                # an opening word that stays the same is no slot
                slots = sum(x != y or (k, x) in index.slots for (k, x), y in value.items())
                best = (met, first, last, slots)
            if met == most:
                break
    return best


def _densest(at: np.ndarray, place: np.ndarray, span: int) -> tuple[int, int, int]:
    """Most distinct windows of the item within ``span`` words: (number, first, last)."""
    order = np.argsort(at, kind="stable")
    at, place = at[order], place[order]
    have: Counter = Counter()
    best, low = (0, 0, 0), 0
    for high in range(len(at)):
        have[int(place[high])] += 1
        while at[high] - at[low] > span:
            have[int(place[low])] -= 1
            if not have[int(place[low])]:
                del have[int(place[low])]
            low += 1
        if len(have) > best[0]:
            best = (len(have), int(at[low]), int(at[high]))
    return best


def matches(index: ItemIndex, texts: list[str], similarity: float = SIMILARITY, stretch: float = STRETCH) -> list[tuple]:
    """(text, item, windows met, windows, slots, start, end) of every contamination."""
    found = Templates.of(texts)
    at, item, place = index.meetings(found)
    doc = found.words.doc[at]
    pair, members = np.unique(doc * len(index.count) + item, return_inverse=True)
    order = np.argsort(members, kind="stable")
    groups = np.split(order, np.cumsum(np.bincount(members, minlength=len(pair)))[:-1]) if len(pair) else []
    out = []
    for code, group in zip(pair.tolist(), groups, strict=True):
        d, i = divmod(code, len(index.count))
        need = math.ceil(similarity * int(index.count[i]) - 1e-9)
        if len(np.unique(place[group])) < need:
            continue
        words = int(index.first[i + 1] - index.first[i])
        met, low, high, slots = _best(index, found, i, at[group], place[group], math.ceil(stretch * words), need)
        if met >= need:
            last = high + int(index.size[i]) - 1
            out.append((d, i, met, int(index.count[i]), slots, int(found.words.start[low]), int(found.words.end[last])))
    return out


def _match_batches(batches: Iterator[pa.RecordBatch], items, window: int, similarity: float) -> Iterator[pa.RecordBatch]:
    ids, texts = items.value
    index = ItemIndex(texts, window)
    names = ["id", "key", "item_id", "met", "windows", "slots", "start", "end"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    for batch in batches:
        docs = [t or "" for t in batch.column("text").to_pylist()]
        id_, key = batch.column("id").to_pylist(), batch.column("key").to_pylist()
        rows = []
        for a, b in slices([len(t) for t in docs], CHARS):
            rows += [(id_[a + d], key[a + d], ids[i], *rest) for d, i, *rest in matches(index, docs[a:b], similarity)]
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    similarity: float = SIMILARITY,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, key, item_id, met, windows, slots, start, end): one row per document and item;
    ``start`` and ``end`` bound the passage in the text, ``key`` identifies the row."""
    spark = docs.sparkSession
    arrow_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).where("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    blocks = math.ceil(size / block_bytes) or 1
    schema = "id long, key long, item_id long, met int, windows int, slots int, start long, `end` long"
    out = None
    for block in range(blocks):  # one bounded block of benchmark text at a time
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).orderBy("id", "text").collect()
        shared = spark.sparkContext.broadcast(([r.id for r in own], [r.text for r in own]))
        part = rows.mapInArrow(lambda it, s=shared: _match_batches(it, s, window, similarity), schema)
        out = part if out is None else out.union(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated documents."""
    found = contaminated(docs, benchmark, id_col, text_col, **options).select("key").distinct()
    rows = packed(docs).withColumn("key", row_key(f"row.{id_col}", f"row.{text_col}"))
    return unpacked(rows.join(store(found, "contaminated"), "key", "left_anti"), docs)
