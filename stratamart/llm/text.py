"""Words and n-grams of whole batches of texts, as numpy arrays.

A word is a longest run of bytes other than space and 0x09-0x0D. Texts are taken as UTF-8, in blocks of at
most ``BLOCK_TEXTS`` whole texts and about ``BLOCK_BYTES``, so that memory follows the block (or the one longest text), not the batch.
Word and n-gram hashes have 64 bits: a polynomial of the bytes modulo 2**64, mixed at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18
BLOCK_TEXTS = 1 << 12

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(hashes: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    out = hashes ^ (hashes >> np.uint64(32))
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xC2B2AE3D27D4EB4F)
    out ^= out >> np.uint64(32)
    return out


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept up to the block size, made anew for a longer text."""
    if base in _powers and len(_powers[base]) >= n:
        return _powers[base][:n]
    table = np.full(max(n, 1), base, dtype=np.uint64)
    table[0] = 1
    table = np.cumprod(table, dtype=np.uint64)
    if n <= 2 * BLOCK_BYTES:
        _powers[base] = table
    return table


@dataclass
class Block:
    """Some whole texts, one after the other: text i is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def _edges(self) -> tuple[np.ndarray, np.ndarray]:
        inside = ~_SPACE[self.data]
        n = len(inside)
        start, end = np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=bool)
        start[:n] = inside
        start[1:n] &= ~inside[:-1]
        end[1:] = inside
        end[1:n] &= ~inside[1:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        start[cuts] = inside[cuts]
        end[cuts] = inside[cuts - 1]
        return np.flatnonzero(start), np.flatnonzero(end)

    @property
    def starts(self) -> np.ndarray:
        return self._edges[0]

    @property
    def ends(self) -> np.ndarray:
        return self._edges[1]

    @cached_property
    def word_offsets(self) -> np.ndarray:
        """Words of text i are ``word_offsets[i]`` to ``word_offsets[i + 1]``."""
        return np.searchsorted(self.starts, self.offsets)

    @cached_property
    def words_per_text(self) -> np.ndarray:
        return np.diff(self.word_offsets)

    @cached_property
    def word_hashes(self) -> np.ndarray:
        n = len(self.data)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=sums[1:])
        raw = (sums[self.ends] - sums[self.starts]) * powers(_BASE_INVERSE, n + 1)[self.starts]
        return mix(raw)

    def ngrams(self, n: int, whole_if_short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words, text after text, and the text offsets into them.

        ``whole_if_short``: a text with 1 to n - 1 words has one n-gram, made of all its words.
        """
        words, counts = self.word_hashes, self.words_per_text
        if len(words) == 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(len(self) + 1, dtype=np.int64)
        spread = np.zeros(len(words), dtype=np.uint64)
        for i in range(min(n, len(words))):
            spread[: len(words) - i] += words[i:] * np.uint64(pow(_BASE, i + 1, 1 << 64))
        left = self.word_offsets[1:][text_of(self.word_offsets)] - np.arange(len(words))  # words to the text's end
        keep = left >= n
        made = np.maximum(counts - n + 1, 0)
        if whole_if_short:
            short = np.flatnonzero((counts > 0) & (counts < n))
            for t in short:
                at, size = self.word_offsets[t], counts[t]
                own = words[at : at + size]
                spread[at] = sum(int(w) * pow(_BASE, i + 1, 1 << 64) for i, w in enumerate(own)) % (1 << 64)
                keep[at] = True
            made[short] = 1
        return mix(spread[keep]), np.concatenate([[0], np.cumsum(made)])


def text_of(offsets: np.ndarray) -> np.ndarray:
    """The text of each item, given the texts' offsets into the items."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def sums_per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each text's items; 0 for a text without items."""
    total = np.zeros(len(values) + 1, dtype=values.dtype if values.dtype != bool else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of an Arrow array in order; null counts as empty. A text beyond ``most`` is a block of its own."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), first + BLOCK_TEXTS, len(texts))
        own = offsets[first : last + 1]
        yield Block(first, data[own[0] : own[-1]], own - own[0])
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A to Z in lower case."""
    return np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)


def char_ngrams(data: np.ndarray, offsets: np.ndarray, n: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of ``n`` bytes (up to 7) inside one text, and the texts' offsets into them."""
    if len(data) < n:
        return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets), dtype=np.int64)
    size = len(data) - n + 1
    packed = np.full(size, n, dtype=np.uint64)
    for i in range(n):
        packed <<= np.uint64(8)
        packed |= data[i : i + size]
    packed *= np.uint64(_BASE)
    packed >>= np.uint64(64 - n_buckets.bit_length() + 1)
    keep = np.ones(size, dtype=bool)
    for i in range(1, n):  # runs that cross into the next text
        cuts = offsets[1:-1] - i
        keep[cuts[(cuts >= 0) & (cuts < size)]] = False
    made = np.concatenate([[0], np.cumsum(np.maximum(np.diff(offsets) - n + 1, 0))])
    return packed.astype(np.uint32)[keep], made


def distinct_per_text(buckets: np.ndarray, texts: np.ndarray, n: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct buckets of each of ``n`` texts, and the texts' offsets into them; n x buckets must fit 32 bits."""
    keys = texts.astype(np.uint32)
    keys *= np.uint32(n_buckets)
    keys += buckets
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return keys % np.uint32(n_buckets), np.searchsorted(keys, np.arange(n + 1, dtype=np.int64) * n_buckets)
