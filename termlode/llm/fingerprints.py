"""Fingerprints of words and word windows for a whole Arrow batch at once.

A batch of texts is one byte buffer; word borders, word hashes and window hashes are
numpy operations over it. A word is a run of bytes other than space and 09-0D.
A word's hash adds up a scrambled number for each of its bytes and places, so equal words
give equal numbers wherever they stand, and no pattern of letters cancels out. Windows of a
few words are polynomials over the hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes handled at a time; a longer document is a slice of its own.
SLICE_BYTES = 1 << 19

_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_STEPS = (0xC2B2AE3D27D4EB4F, 0x2545F4914F6CDD1D)
_MASK = (1 << 64) - 1

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """Words of several texts: byte borders, and the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more than texts

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    @property
    def position(self) -> np.ndarray:
        """Number of each word within its text."""
        return np.arange(len(self.starts)) - np.repeat(self.first[:-1], self.counts)

    def hashes(self, kind: int = 0) -> np.ndarray:
        """A 64-bit hash per word; the two kinds are independent."""
        lengths = self.ends - self.starts
        ends = np.cumsum(lengths)
        place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
        own = self.data[place + np.repeat(self.starts, lengths)]
        terms = mix((place << 8 | own).astype(np.uint64) * np.uint64(_BASES[kind]) + np.uint64(_STEPS[kind]))
        sums = np.zeros(len(place) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        own = sums[ends] - sums[ends - lengths]
        return mix(own + lengths.astype(np.uint64) * np.uint64(_STEPS[1 - kind]))

    def windows(self, size: int, kind: int = 0, hashes: np.ndarray | None = None) -> np.ndarray:
        """Hash of the ``size`` words from each word on; see :meth:`whole_windows`."""
        of_words = self.hashes(kind) if hashes is None else hashes
        power, span, part = _STEPS[kind], 1, of_words
        total, done, step = None, 0, 1
        while True:
            if size & span:
                if total is None:
                    total = part.copy()
                else:
                    total[: max(0, len(total) - done)] += part[done:] * np.uint64(step)
                done += span
                step = step * power & _MASK
            if done >= size:
                return mix(total)
            longer = part.copy()
            longer[: max(0, len(part) - span)] += part[span:] * np.uint64(power)
            part, span, power = longer, span * 2, power * power & _MASK

    def whole_windows(self, size: int) -> np.ndarray:
        """Indices of the words at which a window of ``size`` words of one text begins."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.starts))
        return np.flatnonzero(left >= size)


def slices(texts: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``slice_bytes`` bytes, one row at least."""
    ends = np.cumsum(byte_lengths(texts))
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + slice_bytes, "right")))
        yield low, high
        low = high


def byte_lengths(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def split_words(texts: pa.Array, table: np.ndarray | None = None, space=IS_SPACE) -> Words:
    """Words of the texts, each byte passed through ``table`` first; null has none."""
    lengths = byte_lengths(texts)
    borders = np.concatenate([[0], np.cumsum(lengths)])
    data = np.frombuffer(
        b"".join(value.as_buffer() for value in texts.cast(pa.binary()) if value.is_valid),
        np.uint8,
    )
    if table is not None:
        data = table[data]
    is_word = ~space[data] if len(data) else np.zeros(0, bool)
    new_text = np.zeros(len(data) + 1, bool)
    new_text[borders] = True
    before = np.concatenate([[False], is_word[:-1]])
    after = np.concatenate([is_word[1:], [False]])
    starts = np.flatnonzero(is_word & (~before | new_text[:-1]))
    ends = np.flatnonzero(is_word & (~after | new_text[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, borders))
