"""Vectorised words of many texts: boundaries, case and 64-bit hashes with numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_MULT = np.uint64(0x9E3779B97F4A7C15)
_PERIOD = 1 << 12


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, ...]:
    """Per BMP code point: word character, digit, upper case, lower-case form."""
    chars = [chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(1 << 16)]
    word = np.array([c.isalnum() for c in chars])
    digit = np.array([c.isdigit() for c in chars])
    upper = np.array([c.isupper() for c in chars])
    lower = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars], np.uint32)
    return word, digit, upper, lower


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    return np.cumprod(np.full(_PERIOD, 0x100000001B3, np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * _MULT
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Words:
    """Words of the concatenation of ``texts``: maximal runs of letters and digits, and of
    digits joined by single points or commas.

    Arrays, one element per word: ``doc`` (index of its text), ``start`` and ``end`` (in
    its text), ``hash`` (of the lower-cased word), ``number`` (begins with a digit),
    ``capital`` (begins in upper case) and ``opens`` (first word of a sentence or line).
    """

    def __init__(self, texts: list[str]):
        word, digit, upper, lower = _tables()
        joined = "\n".join(texts)
        cp = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        low = np.minimum(cp, 0xFFFF).astype(np.uint16)  # beyond the BMP: one class, not a word
        is_digit = digit[low]
        inside = word[low] | (cp > 0xFFFF)
        joint = ((cp == 44) | (cp == 46))
        if len(cp) > 2:
            inside[1:-1] |= joint[1:-1] & is_digit[:-2] & is_digit[2:]
        edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        size = end - start
        at = np.repeat(start, size)
        chars = np.flatnonzero(inside)
        value = np.where(cp[chars] > 0xFFFF, cp[chars], lower[low[chars]]).astype(np.uint64)
        value = mix(value + np.uint64(1)) * _powers()[(chars - at) % _PERIOD]
        first = np.concatenate(([0], np.cumsum(size)[:-1])) if len(size) else np.zeros(0, np.int64)
        self.hash = mix(np.add.reduceat(value, first) + size.astype(np.uint64)) if len(size) else np.zeros(0, np.uint64)
        self.number = is_digit[start]
        self.capital = upper[low[start]]
        # A word opens a sentence if . ! ? : or a line break stands between it and the word before.
        stops = np.cumsum(np.isin(cp, (10, 13, 33, 46, 58, 63)) & ~inside)
        before = stops[np.maximum(start - 1, 0)]
        self.opens = np.ones(len(start), bool)
        self.opens[1:] = before[1:] > stops[np.maximum(end[:-1] - 1, 0)]
        offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        self.doc = np.searchsorted(offsets, start, side="right") - 1
        self.start = start - offsets[self.doc]
        self.end = end - offsets[self.doc]


def slices(lengths: list[int], most: int):
    """Consecutive index ranges whose lengths add up to at most ``most`` (or hold one text)."""
    begin, total = 0, 0
    for i, n in enumerate(lengths):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield begin, len(lengths)
