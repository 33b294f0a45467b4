"""Words of whole texts, a batch at a time: positions and 64-bit hashes from the bytes, without a Python loop over words.

A word is a maximal run of bytes other than 0x20 and 0x09 to 0x0D, so `[^\\x20\\x09-\\x0D]+` of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes whose words are hashed at once; a text over it is cut between words.
SLICE = 1 << 20

_rng = np.random.default_rng(0x51175)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit hash over all of it."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, SLICE + 4096)
        _powers[:] = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, x, np.uint64)])) for x in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


#: White space and ASCII punctuation: what lies between words in the sense of a dictionary.
PUNCTUATION = _SPACE.copy()
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


@dataclass
class Words:
    """Words of the texts first .. first + n - 1 of a batch: their doc (from 0), byte range in `data`, hash."""

    first: int
    n: int
    data: np.ndarray
    offsets: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def bounds(self) -> np.ndarray:
        """Where the words of each doc begin; n + 1 numbers."""
        return np.searchsorted(self.doc, np.arange(self.n + 1))


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def _hashed(data: np.ndarray, begins: np.ndarray, lower: bool, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of the words of `data`; a text begins at each of `begins`."""
    word = ~space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[begins] = True
    left = np.concatenate([[False], word[:-1]])
    start = np.flatnonzero(word & (~left | edge[:-1]))
    right = np.concatenate([word[1:], [False]])
    end = np.flatnonzero(word & (~right | edge[1:])) + 1
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _TABLE)[data] * up[: len(data)], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return start, end, mix(h ^ (end - start).astype(np.uint64))


def _long(data: np.ndarray, lower: bool, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As _hashed for one text of any length, a slice at a time; a slice ends at white space."""
    parts, at = [], 0
    while at < len(data):
        to = min(at + SLICE, len(data))
        while to < len(data) and not space[data[to]]:
            gap = np.flatnonzero(space[data[to : to + SLICE]])
            to = to + int(gap[0]) if len(gap) else min(to + SLICE, len(data))
        s, e, h = _hashed(data[at:to], np.zeros(1, np.int64), lower, space)
        parts.append((s + at, e + at, h))
        at = to
    return tuple(np.concatenate(x) for x in zip(*parts))  # type: ignore[return-value]


def words(column, lower: bool = False, space: np.ndarray = _SPACE) -> Iterator[Words]:
    """The words of an Arrow string column, in groups of whole texts of about SLICE bytes. space: the bytes between words."""
    data, offs = buffers(column)
    n, at = len(offs) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + SLICE, "right")) - 1)
        part, begins = data[offs[at] : offs[to]], offs[at : to + 1] - offs[at]
        if len(part) == 0:
            start = end = np.zeros(0, np.int64)
            h = np.zeros(0, np.uint64)
        elif len(part) > SLICE:
            start, end, h = _long(part, lower, space)
        else:
            start, end, h = _hashed(part, begins, lower, space)
        yield Words(at, to - at, part, begins, np.searchsorted(begins[1:], start, "right"), start, end, h)
        at = to


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k successive word hashes; len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * np.uint64(0xD6E8FEB86659FD93) + h[i : i + n]
    return mix(total)
