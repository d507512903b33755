"""Rising sequences in little more than their information, and an n-gram trie made of them.

A number is split: its low bits are packed side by side, its high part is written in unary
into one bit vector, where runs of ones are the numbers with the same high part. All searches
are made for many numbers at once. A structure is one buffer; reading it copies nothing, so
it can lie in a memory-mapped file as well as in a row of a table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_HALVES = [np.uint64(s) for s in (32, 16, 8, 4, 2, 1)]


@dataclass(frozen=True)
class EliasFano:
    """``n`` numbers that never fall, none below zero."""

    n: int
    width: int
    lows: np.ndarray
    highs: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        lows = _words(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"))
        unary = np.zeros(n + (top >> width) + 1, dtype=np.uint8)
        unary[(values >> np.uint64(width)).astype(np.int64) + np.arange(n)] = 1
        highs = _words(np.packbits(unary, bitorder="little"))
        ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(highs), dtype=np.uint64))).astype(np.uint64)
        return cls(n, width, lows, highs, ranks)

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.width], dtype=np.uint64), self.lows, self.highs, self.ranks]

    @classmethod
    def read(cls, arrays: list[np.ndarray]) -> EliasFano:
        head, lows, highs, ranks = arrays
        return cls(int(head[0]), int(head[1]), lows, highs, ranks)

    def low(self, places: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(places), dtype=np.uint64)
        at = places.astype(np.uint64) * np.uint64(self.width)
        word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        first = self.lows[word] >> bit
        # a shift by 64 bits is none: what does not reach into the next word takes nothing
        second = np.where(bit > 0, self.lows[word + 1] << ((np.uint64(64) - bit) & np.uint64(63)), np.uint64(0))
        return (first | second) & np.uint64((1 << self.width) - 1)

    def access(self, places: np.ndarray) -> np.ndarray:
        """The numbers at these places."""
        high = self._select(places.astype(np.uint64), ones=True) - places
        return (high << self.width) | self.low(places).astype(np.int64)

    def find(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of each value within [low, high), or -1: successor search.

        The numbers with the value's high part are a run, found by two selections of zeros;
        halving on the low bits finds the first in it that is not smaller.
        """
        values = values.astype(np.int64)
        part = values >> self.width
        zeros = 64 * len(self.highs) - int(self.ranks[-1])
        inside = part < zeros
        part = np.where(inside, part, 0)
        begin = np.where(part > 0, self._select(np.maximum(part - 1, 0).astype(np.uint64), ones=False) - part + 1, 0)
        end = np.minimum(self._select(part.astype(np.uint64), ones=False) - part, high)
        begin = np.maximum(begin, low)
        end = np.where(inside, end, begin)
        rest = values.astype(np.uint64) & np.uint64((1 << self.width) - 1)
        at, stop = begin.copy(), end
        moving = np.flatnonzero(at < stop)
        stop = stop.copy()
        while len(moving):
            middle = (at[moving] + stop[moving]) // 2
            less = self.low(middle) < rest[moving]
            at[moving] = np.where(less, middle + 1, at[moving])
            stop[moving] = np.where(less, stop[moving], middle)
            moving = moving[at[moving] < stop[moving]]
        found = np.full(len(values), -1, dtype=np.int64)
        there = np.flatnonzero(at < end)
        there = there[self.low(at[there]) == rest[there]]
        found[there] = at[there]
        return found

    def _select(self, ranks: np.ndarray, ones: bool) -> np.ndarray:
        """Where the one (or zero) of each rank, counted from 0, stands in the bit vector."""
        before = self.ranks if ones else np.arange(len(self.ranks), dtype=np.uint64) * np.uint64(64) - self.ranks
        word = np.searchsorted(before, ranks, side="right") - 1
        bits = self.highs[word] if ones else ~self.highs[word]
        left = ranks - before[word]
        at = word.astype(np.uint64) * np.uint64(64)
        for half in _HALVES:
            counted = np.bitwise_count(bits & ((np.uint64(1) << half) - np.uint64(1))).astype(np.uint64)
            over = left >= counted
            left = np.where(over, left - counted, left)
            bits = np.where(over, bits >> half, bits)
            at = np.where(over, at + half, at)
        return at.astype(np.int64)


def _words(packed: np.ndarray) -> np.ndarray:
    """Bytes as 64-bit words, one word more than needed."""
    out = np.zeros(8 * (len(packed) // 8 + 2), dtype=np.uint8)
    out[: len(packed)] = packed
    return out.view(np.uint64)


@dataclass(frozen=True)
class Trie:
    """Contexts, each with a penalty for what it has not seen, and their successors, each with
    the quantised probability of the two in turn.

    The successors of context c stand at pointers[c] to pointers[c + 1]. Their numbers start
    anew in every context; so that the whole level rises, the number before the context's
    first successor is added to each of its own, and a search adds it too.
    """

    contexts: EliasFano
    pointers: EliasFano
    successors: EliasFano
    codes: np.ndarray
    penalties: np.ndarray

    @classmethod
    def of(cls, contexts: np.ndarray, starts: np.ndarray, successors: np.ndarray, codes: np.ndarray, penalties: np.ndarray) -> Trie:
        """From contexts, the place of each one's first successor, and the rising successors."""
        sizes = np.diff(np.append(starts, len(successors)))
        last = successors[starts + sizes - 1] if len(starts) else successors
        base = np.cumsum(last) - last
        return cls(
            EliasFano.of(contexts),
            EliasFano.of(np.append(starts, len(successors))),
            EliasFano.of(successors + np.repeat(base, sizes)),
            codes.astype(np.uint16),
            penalties.astype(np.int32),
        )

    def find_contexts(self, contexts: np.ndarray) -> np.ndarray:
        """The number of each context, or -1."""
        nothing = np.zeros(len(contexts), dtype=np.int64)
        return self.contexts.find(contexts, nothing, nothing + self.contexts.n)

    def find(self, numbers: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """The place of each successor within the context of that number, or -1."""
        found = np.full(len(numbers), -1, dtype=np.int64)
        known = np.flatnonzero(numbers >= 0)
        if len(known):
            each, at = np.unique(numbers[known], return_inverse=True)
            low, high = self.pointers.access(each), self.pointers.access(each + 1)
            base = np.where(low > 0, self.successors.access(np.maximum(low - 1, 0)), 0)
            found[known] = self.successors.find(successors[known] + base[at], low[at], high[at])
        return found

    def to_bytes(self) -> bytes:
        arrays = [a for level in (self.contexts, self.pointers, self.successors) for a in level.arrays()]
        arrays += [self.codes, self.penalties]
        body = []
        for array in arrays:
            raw = array.tobytes()
            body += [len(raw).to_bytes(8, "little"), raw, bytes(-len(raw) % 8)]
        return b"".join(body)

    @classmethod
    def read(cls, buffer) -> Trie:
        """The trie in a buffer, such as a mapped file; nothing is copied."""
        view, arrays, at = memoryview(buffer), [], 0
        for number in range(14):
            size = int.from_bytes(view[at : at + 8], "little")
            kind = (np.uint16, np.int32)[number - 12] if number >= 12 else np.uint64
            arrays.append(np.frombuffer(view[at + 8 : at + 8 + size], dtype=kind))
            at += 8 + size + -size % 8
        levels = [EliasFano.read(arrays[i : i + 4]) for i in (0, 4, 8)]
        return cls(*levels, *arrays[12:])
