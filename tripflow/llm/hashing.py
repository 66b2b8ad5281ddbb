"""Vectorised 64-bit hashes of the words of many texts at once.

A word is a run of bytes other than space and \\x09-\\x0D, which in UTF-8
is the same as a run of such code points.  Texts are taken in groups of
about 128 kB, so memory doesn't depend on the batch; a longer text
is hashed in parts cut at white space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 17

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    """An independent hash of each value for each seed."""
    with np.errstate(over="ignore"):
        return mix(x + np.uint64((seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as doubles in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 4096)
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)]))
    return _powers


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the index of the text it stands in."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    begins[inner] |= word[inner]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    number = np.cumsum(begins) - 1
    at = np.arange(n) - starts[np.maximum(number, 0)]
    powers = _power_table(int(at[word].max()) + 1)
    with np.errstate(over="ignore"):
        part = (data.astype(np.uint64) + np.uint64(1)) * powers[np.where(word, at, 0)]
        part[~word] = 0
        total = np.add.reduceat(part, starts)
    return mix(total), np.searchsorted(offsets, starts, side="right") - 1


# Letters by case, digits, and each other character by itself; bytes of
# characters beyond ASCII count as lower-case letters.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x61:0x7B] = _CLASS[0x80:] = 1
_CLASS[0x41:0x5B] = 2
_CLASS[0x30:0x3A] = 3


def shape_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``word_hashes``, of each word's sequence of character classes,
    in which a class that follows itself counts once."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    begins[inner] |= word[inner]
    kind = _CLASS[data]
    turns = begins.copy()
    turns[1:] |= word[1:] & (kind[1:] != kind[:-1])
    at = np.flatnonzero(turns)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(begins[at])
    rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    powers = _power_table(int(rank.max()) + 1)
    with np.errstate(over="ignore"):
        total = np.add.reduceat((kind[at].astype(np.uint64) + np.uint64(1)) * powers[rank], first)
    return mix(total), np.searchsorted(offsets, at[first], side="right") - 1


def _long_text(data: np.ndarray, hashes=word_hashes) -> np.ndarray:
    parts, begin, n = [], 0, len(data)
    while begin < n:
        end = min(n, begin + GROUP_BYTES)
        if end < n:
            spaces = np.flatnonzero(_SPACE[data[begin:end]])
            if len(spaces):
                end = begin + int(spaces[-1]) + 1
            else:  # one word longer than a group
                later = np.flatnonzero(_SPACE[data[end:]])
                end = end + int(later[0]) + 1 if len(later) else n
        parts.append(hashes(data[begin:end], np.array([0, end - begin]))[0])
        begin = end
    return np.concatenate(parts)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and where each text begins."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def hashed_texts(column: pa.Array, shapes: bool = False) -> Iterator[tuple]:
    """(first text, texts, word hashes, text of each word counted from the
    first) for groups of consecutive texts; with ``shapes``, the words'
    shape hashes as a fifth."""
    if not len(column):
        return
    data, offsets = text_buffer(column)
    first, n = 0, len(column)
    while first < n:
        limit = np.searchsorted(offsets, offsets[first] + GROUP_BYTES, side="right") - 1
        last = int(min(max(limit, first + 1), n))
        own = data[offsets[first] : offsets[last]]
        if last == first + 1 and len(own) > GROUP_BYTES:
            hashes = _long_text(own)
            found = (hashes, np.zeros(len(hashes), np.int64), *([_long_text(own, shape_hashes)] if shapes else []))
        else:
            begins = offsets[first : last + 1] - offsets[first]
            found = (*word_hashes(own, begins), *([shape_hashes(own, begins)[0]] if shapes else []))
        yield (first, last - first, *found)
        first = last
