"""Fill-in-middle transformation over a compressed set of unit boundaries.

A text is a sequence of units (words with the white space before them, or single code
points).  The last code point of every unit goes into a :class:`BoundarySet`: containers of
2^16 positions each, kept as a sorted array, a bitmap or runs, whichever is smallest, with
the cumulative cardinality before each container.  A cut after k units is a binary search
over the cumulative cardinalities and a select inside one container.  Text is scanned one
container at a time, so a very long text needs its own bytes, its output and the compressed
set, never an array of all its characters.

The digits that choose form and cuts come from a hash of the seed and the id, so a
recomputed task makes the same choice.

Cases: null text counts as empty; an empty text, or one that holds a marker, stays plain; a
null id is hashed as the empty string; repeated rows get the same result each; an empty
table gives no rows; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches

SEED = 42
PLAIN_FROM = 50  # h3 % 100 from here on leaves the text plain
SPM_BELOW = 80  # h4 % 100 below this puts the suffix first
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

CONTAINER = 1 << 16  # positions of one container
ARRAY_MAX = 4096  # a longer array is larger than a bitmap
_WORDS = CONTAINER // 64


class BoundarySet:
    """Sorted positions by containers of 2^16, with their cumulative cardinalities."""

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.containers: list[tuple[str, object]] = []
        self.before = [0]  # positions before each container; the last entry is their number

    def __len__(self) -> int:
        return self.before[-1]

    def append(self, key: int, low: np.ndarray) -> None:
        """Add the container ``key``: its positions, ascending, less than 2^16."""
        if len(low) == 0:
            return
        breaks = np.flatnonzero(np.diff(low.astype(np.int32)) != 1)
        runs = len(breaks) + 1
        if 4 * runs < min(2 * len(low), 8 * _WORDS):
            first = low[np.concatenate(([0], breaks + 1))].astype(np.int64)
            lengths = np.diff(np.concatenate(([-1], breaks, [len(low) - 1])))
            held: tuple[str, object] = ("run", (first, np.concatenate(([0], np.cumsum(lengths)))))
        elif len(low) <= ARRAY_MAX:
            held = ("array", low.astype(np.uint16))
        else:
            bits = np.zeros(CONTAINER, np.uint8)
            bits[low] = 1
            held = ("bitmap", np.packbits(bits, bitorder="little").view("<u8"))
        self.keys.append(key)
        self.containers.append(held)
        self.before.append(len(self) + len(low))

    def select(self, rank: int) -> int:
        """The position of rank ``rank``, from 0."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        at = int(np.searchsorted(self.before, rank, side="right")) - 1
        kind, held = self.containers[at]
        local = rank - self.before[at]
        if kind == "array":
            low = int(held[local])
        elif kind == "run":
            first, starts = held
            run = int(np.searchsorted(starts, local, side="right")) - 1
            low = int(first[run]) + local - int(starts[run])
        else:
            ones = np.cumsum(np.bitwise_count(held))
            word = int(np.searchsorted(ones, local, side="right"))
            inside = local - (int(ones[word - 1]) if word else 0)
            bits = np.unpackbits(held[word : word + 1].view(np.uint8), bitorder="little")
            low = word * 64 + int(np.flatnonzero(bits)[inside])
        return self.keys[at] * CONTAINER + low


def boundaries(text: str, unit: str = "words") -> BoundarySet:
    """The last code point of every unit of ``text``: ``words`` are runs of other characters
    with the white space before them (white space at the end is a unit of its own),
    ``chars`` are single code points."""
    found = BoundarySet()
    for key, start in enumerate(range(0, len(text), CONTAINER)):
        code = np.frombuffer(text[start : start + CONTAINER + 1].encode("utf-32-le"), "<u4")
        here = min(CONTAINER, len(text) - start)
        if unit == "chars":
            found.append(key, np.arange(here))
            continue
        space = (code == 32) | ((code >= 9) & (code <= 13))
        ends = np.empty(here, bool)
        inner = len(code) - 1
        ends[:inner] = ~space[:inner] & space[1:]
        if inner < here:
            ends[inner] = True
        found.append(key, np.flatnonzero(ends))
    return found


def cut_offsets(found: BoundarySet, first: int, second: int) -> tuple[int, int]:
    """Code points before the cuts after the smaller and the larger of ``first`` and
    ``second`` units."""
    small, large = sorted((first, second))
    return tuple(found.select(k - 1) + 1 if k else 0 for k in (small, large))


def transform(text: str, h: tuple[int, int, int, int], unit: str, plain_from: int, spm_below: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    found = boundaries(text, unit)
    n = len(found)
    if n == 0 or h[2] % 100 >= plain_from or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    a, b = cut_offsets(found, h[0] % (n + 1), h[1] % (n + 1))
    before, middle, after = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_below:
        return n, "spm", a, b - a, "".join((SUFFIX, after, PREFIX, before, MIDDLE, middle))
    return n, "psm", a, b - a, "".join((PREFIX, before, SUFFIX, after, MIDDLE, middle))


_NAMES = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def _batches(batches: Iterator[pa.RecordBatch], unit: str, plain_from: int, spm_below: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = zip(*(batch.column(f"h{i}").to_pylist() for i in range(1, 5)), strict=True)
        rows = [
            transform(text.as_py() or "", h, unit, plain_from, spm_below)
            for text, h in zip(batch.column("text"), hashes, strict=True)
        ]
        columns = zip(*rows, strict=True) if rows else [()] * len(_KINDS)
        arrays = [pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], names=_NAMES)


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    unit: str = "words",
    plain_from: int = PLAIN_FROM,
    spm_below: int = SPM_BELOW,
) -> DataFrame:
    """One row per row of ``docs``: (id, n, form, prefix_chars, middle_chars, output).

    ``n`` is the number of units; ``output`` is the text in its form, to be undone by
    :func:`restored`; the two lengths are in code points and null where the form is plain.
    """
    arrow_batches(docs.sparkSession)
    named = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), named), 256)
    hashed = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *hashed)
    return rows.mapInArrow(
        lambda it: _batches(it, unit, plain_from, spm_below),
        "id long, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restored(output: Column, form: Column) -> Column:
    """The text that :func:`fill_in_middle` was given.  A transformed text holds no marker of
    its own, so each marker of the output stands once, and no marker can begin before it."""
    body = F.substr(output, F.lit(len(PREFIX) + 1))

    def parts(between: str) -> tuple[Column, Column, Column]:
        rest = F.substring_index(body, between, -1)
        return F.substring_index(body, between, 1), F.substring_index(rest, MIDDLE, 1), F.substring_index(rest, MIDDLE, -1)

    before, after, middle = parts(SUFFIX)
    psm = F.concat(before, middle, after)
    after, before, middle = parts(PREFIX)
    spm = F.concat(before, middle, after)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
