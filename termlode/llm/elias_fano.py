"""Monotone numbers in Elias-Fano form, and n-gram tries of such sequences, two levels each.

Everything is a view of one byte string, so a level that lies in a buffer is used where it
lies. All lookups are numpy operations over many queries at once.
"""

from __future__ import annotations

import numpy as np

# Queries answered at a time.
_CHUNK = 1 << 15

# For each byte the place of its first, second, ... one.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_PLACES = np.argsort(1 - _BITS, axis=1, kind="stable").ravel()

# All bytes of a word alike.
_FIRST, _LAST = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_PAIRS, _FOURS, _EIGHTS = (np.uint64(b * 0x0101010101010101) for b in (0x55, 0x33, 0x0F))


def _u64(n: int) -> np.uint64:
    return np.uint64(n)


def _ones_upto(words: np.ndarray) -> np.ndarray:
    """In each byte the ones of a word up to and with that byte, the lowest first."""
    words = words - ((words >> _u64(1)) & _PAIRS)
    words = (words & _FOURS) + ((words >> _u64(2)) & _FOURS)
    return ((words + (words >> _u64(4))) & _EIGHTS) * _FIRST


def join_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays as one byte string: their number, types and lengths, then 8-byte aligned data."""
    arrays = [np.ascontiguousarray(array) for array in arrays]
    head = np.array([len(arrays)], "<i8").tobytes() + b"".join(
        array.dtype.str.encode().ljust(8) + np.array([array.nbytes], "<i8").tobytes()
        for array in arrays
    )
    return head + b"".join(array.tobytes() + bytes(-array.nbytes % 8) for array in arrays)


def split_arrays(data) -> list[np.ndarray]:
    """Views of the arrays in a buffer of :func:`join_arrays`."""
    data = np.frombuffer(data, np.uint8)
    number = int(data[:8].view("<i8")[0])
    at, arrays = 8 + 16 * number, []
    for i in range(number):
        head = data[8 + 16 * i : 24 + 16 * i]
        size = int(np.frombuffer(head[8:].tobytes(), "<i8")[0])
        arrays.append(np.frombuffer(data[at : at + size], head[:8].tobytes().decode().strip()))
        at += size + -size % 8
    return arrays


class EliasFano:
    """A non-decreasing sequence; ``arrays`` are all it is made of."""

    def __init__(self, size: np.ndarray, low: np.ndarray, high: np.ndarray, before: np.ndarray):
        self.n, self.width = int(size[0]), int(size[1])
        self.arrays = (size, low, high, before)
        self._low, self._high, self._before = low, high, before

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        largest = int(values[-1]) if n else 0
        width = max(0, (largest // max(n, 1)).bit_length() - 1)
        octets = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(n, 8)
        bits = np.unpackbits(octets, axis=1, count=width or None, bitorder="little")[:, :width]
        # Whole words, and one behind the last that is read.
        low = np.zeros((n * width + 63) // 64 * 8 + 8, np.uint8)
        low[: (n * width + 7) // 8] = np.packbits(bits, bitorder="little")
        places = (values >> width) + np.arange(n)
        length = -(-((largest >> width) + n + 1) // 64) * 64
        ones = np.zeros(length, np.uint8)
        ones[places] = 1
        before = np.concatenate([[0], np.cumsum(ones.reshape(-1, 64).sum(axis=1, dtype=np.int64))])
        return cls(
            np.array([n, width], "<i8"), low, np.packbits(ones, bitorder="little"), before.astype("<i8")
        )

    def _select(self, rank: np.ndarray, zeros: bool) -> np.ndarray:
        """Place of the ``rank``-th one or zero, counted from 0."""
        before = np.arange(len(self._before)) * 64 - self._before if zeros else self._before
        word = np.searchsorted(before, rank, "right") - 1
        word = np.minimum(word, len(before) - 2)
        chunk = self._high.view("<u8")[word]
        if zeros:
            chunk = ~chunk
        left = (rank - before[word]).astype(np.uint64)
        upto = _ones_upto(chunk)
        # As many bytes as end with no more ones than are left to pass.
        passed = ((((left * _FIRST) | _LAST) - upto) & _LAST) >> _u64(7)
        byte = (passed * _FIRST >> _u64(56)) << _u64(3)
        left -= ((upto << _u64(8)) >> byte) & _u64(255)
        place = _PLACES[((((chunk >> byte) & _u64(255)) << _u64(3)) | left).astype(np.int64)]
        return word * 64 + byte.astype(np.int64) + place

    def _low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.int64)
        bit = i * self.width
        words, at, shift = self._low.view("<u8"), bit >> 6, (bit & 63).astype(np.uint64)
        found = (words[at] >> shift) | ((words[at + 1] << _u64(1)) << (_u64(63) - shift))
        return (found & _u64((1 << self.width) - 1)).astype(np.int64)

    def _get(self, i: np.ndarray) -> np.ndarray:
        return ((self._select(i, False) - i) << self.width) | self._low_bits(i)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at the places ``i``."""
        return _chunked(self._get, i)

    def _successor(self, x: np.ndarray) -> np.ndarray:
        high, low = x >> self.width, x & ((1 << self.width) - 1)
        top = len(self._high) * 8 - self.n - 1
        over = high > top
        high = np.minimum(high, top)
        end = np.minimum(self._select(high, True) - high, self.n)
        begin = np.where(high > 0, self._select(np.maximum(high - 1, 0), True) - (high - 1), 0)
        begin = np.minimum(begin, self.n)
        while (open_ := begin < end).any():
            middle = (begin + end) >> 1
            smaller = open_ & (self._low_bits(np.where(open_, middle, 0)) < low)
            begin = np.where(smaller, middle + 1, begin)
            end = np.where(open_ & ~smaller, middle, end)
        return np.where(over, self.n, begin)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value that is not less than each ``x``; n if there is none."""
        return _chunked(self._successor, x) if self.n else np.zeros(len(x), np.int64)


def _chunked(function, *columns: np.ndarray) -> np.ndarray:
    parts = [
        function(*(column[low : low + _CHUNK] for column in columns))
        for low in range(0, len(columns[0]), _CHUNK)
    ]
    return np.concatenate([*parts, np.zeros(0, np.int64)])


class Trie:
    """Contexts, pointers to the words after each, those words, and a code for each of them.

    The words after a context are kept relative to the last entry of the context before, which
    makes them one rising sequence through all contexts. Looking one up is a search for the
    successor of that base and the word, within the context's range.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, words: EliasFano, codes: np.ndarray):
        self._contexts, self._pointers, self._words, self._codes = contexts, pointers, words, codes

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, codes: np.ndarray) -> Trie:
        """From distinct pairs in the order of (context, word)."""
        new = np.diff(context, prepend=-1).astype(bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(context)) - 1 if len(first) else first
        # A base is all that the contexts before took: their last word each, and one.
        base = np.concatenate([[0], np.cumsum(word[last] + 1)[:-1]]) if len(first) else first
        relative = word + np.repeat(base, np.diff(first, append=len(context)))
        return cls(
            EliasFano.of(context[first]),
            EliasFano.of(np.append(first, len(context))),
            EliasFano.of(relative),
            codes,
        )

    @property
    def arrays(self) -> tuple[np.ndarray, ...]:
        return (*self._contexts.arrays, *self._pointers.arrays, *self._words.arrays, self._codes)

    @property
    def own_codes(self) -> np.ndarray:
        """The codes of all pairs, by place."""
        return self._codes

    def to_bytes(self) -> bytes:
        return join_tries(self)

    @classmethod
    def view(cls, data) -> Trie:
        return split_tries(data)[0]

    @classmethod
    def of_arrays(cls, arrays: list[np.ndarray]) -> Trie:
        return cls(*(EliasFano(*arrays[i : i + 4]) for i in (0, 4, 8)), arrays[12])

    def codes(self, context: np.ndarray, word: np.ndarray, absent: int) -> np.ndarray:
        """The code of each pair, ``absent`` where the trie does not have it."""
        return np.append(self._codes.astype(np.int64), absent)[self.places(context, word)]

    def places(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The place of each pair among all, -1 where the trie does not have it.

        Pairs of one context are best put side by side: it is looked up once a run.
        """
        found = np.full(len(context), -1, np.int64)
        if not self._contexts.n or not len(context):
            return found
        new = np.flatnonzero(np.diff(context, prepend=-1))
        often = np.diff(new, append=len(context))
        place = self._contexts.successor(context[new])
        known = np.flatnonzero(place < self._contexts.n)
        known = known[self._contexts.get(place[known]) == context[new[known]]]
        begin, end = self._pointers.get(place[known]), self._pointers.get(place[known] + 1)
        base = np.where(begin > 0, self._words.get(np.maximum(begin - 1, 0)) + 1, 0)
        often = often[known]
        query = np.repeat(new[known] - (np.cumsum(often) - often), often) + np.arange(often.sum())
        wanted = np.repeat(base, often) + word[query]
        at = self._words.successor(wanted)
        inside = np.flatnonzero(at < np.repeat(end, often))
        same = inside[self._words.get(at[inside]) == wanted[inside]]
        found[query[same]] = at[same]
        return found


_ARRAYS = 13


def join_tries(*tries: Trie) -> bytes:
    """Tries as one byte string, for a model of more levels: the contexts of each but the first
    are the places of the pairs of the one before."""
    return join_arrays(*(array for trie in tries for array in trie.arrays))


def split_tries(data) -> list[Trie]:
    """Views of the tries in a buffer of :func:`join_tries`."""
    arrays = split_arrays(data)
    return [Trie.of_arrays(arrays[i : i + _ARRAYS]) for i in range(0, len(arrays), _ARRAYS)]
