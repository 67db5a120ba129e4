"""Word-shingle hashes of many texts at once, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from fieldlens.llm.shared import _LOWER

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_STEP = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


@dataclass
class Shingles:
    """Hashes in text order; text i has rows first[i] .. first[i] + count[i]."""

    hashes: np.ndarray
    first: np.ndarray
    count: np.ndarray
    _buffer: bytes
    _word_from: np.ndarray
    _word_to: np.ndarray
    _word_at: np.ndarray
    _words: int

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first)), self.count)

    def text_of(self, text: int, row: int) -> str:
        """The shingle's words, joined by one space."""
        a = self._word_at[text] + row - self.first[text]
        b = min(a + self._words, self._word_at[text + 1])
        return b" ".join(self._buffer[self._word_from[i]:self._word_to[i]] for i in range(a, b)).decode("utf-8", "replace")


def shingles(texts: list[str | None], words: int) -> Shingles:
    """All ``words``-word shingles of each text, repeats included; a shorter text has its whole sequence as one, an empty one none."""
    raw = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER) for t in texts]
    buffer = b"\n".join(raw) + b"\n"
    data = np.frombuffer(buffer, np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    offsets = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
    word_at = np.searchsorted(start, offsets)
    up, down = _powers(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)))
    word = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    n = np.diff(word_at)
    count = np.where(n >= words, n - words + 1, (n > 0).astype(np.int64))
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    head = np.repeat(word_at[:-1] - first, count) + np.arange(int(count.sum()))
    last = np.repeat(word_at[1:], count)
    total = np.zeros(len(head), np.uint64)
    padded = np.concatenate((word, np.zeros(words, np.uint64)))
    for j in range(words):
        part = padded[head + j] * np.uint64(2 * j + 3)
        total = mixed(total + (part if j == 0 else np.where(head + j < last, part, np.uint64(0))))
    return Shingles(total, first, count, buffer, start, end, word_at, words)
