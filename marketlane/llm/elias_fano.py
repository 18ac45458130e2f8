"""Elias-Fano sequences and a two-part n-gram level over them, for whole arrays of queries at a time.

An increasing sequence of ``n`` numbers keeps the ``l`` low bits of each number
packed and the high parts as unary bucket counts: about ``2 + log2(u / n)`` bits
each.  A search goes to the bucket of the high part by selecting zeros and halves
the low bits inside it.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

#: Numbers whose low bits are packed at a time.
SLICE = 1 << 16


def _select_in_word(words: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``rank`` (from 0) in each 64-bit word."""
    at = np.zeros(len(words), dtype=np.uint64)
    ranks = ranks.astype(np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        mask = np.uint64((1 << width) - 1)
        below = np.bitwise_count((words >> at) & mask).astype(np.int64)
        right = ranks >= below
        ranks = ranks - np.where(right, below, 0)
        at += np.where(right, np.uint64(width), np.uint64(0))
    return at.astype(np.int64)


class EliasFano:
    """An increasing (not strictly) sequence of unsigned numbers below 2^63."""

    def __init__(self, n: int, l: int, upper: np.ndarray, low: np.ndarray):
        self.n, self.l, self.upper, self.low = n, l, upper, low
        ones = np.bitwise_count(upper).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones
        self.at_byte = np.ndarray(shape=(max(1, len(low) - 7),), dtype="<u8", buffer=low, strides=(1,))

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        l = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (values >> np.uint64(l)).astype(np.int64)
        size = n + (int(high[-1]) if n else 0) + 2
        bits = np.zeros(-(-size // 64) * 64, dtype=np.uint8)
        bits[high + np.arange(n)] = 1
        upper = np.packbits(bits, bitorder="little").view("<u8")
        plain = np.ascontiguousarray(values.astype("<u8", copy=False)).view(np.uint8).reshape(-1, 8)[:, : -(-l // 8)]
        # Slices of a multiple of eight numbers end at whole bytes.
        cuts = range(0, n, SLICE) if l else ()
        low = [np.packbits(np.unpackbits(plain[a : a + SLICE], axis=1, bitorder="little")[:, :l].ravel(), bitorder="little") for a in cuts]
        return cls(n, l, upper, np.concatenate([*low, np.zeros(16, np.uint8)]))

    def _low(self, i: np.ndarray) -> np.ndarray:
        bit = i * self.l
        return (self.at_byte[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.l) - 1)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Place of the zero number ``k`` in the upper bits."""
        word = np.searchsorted(self.zeros, k, side="right") - 1
        return word * 64 + _select_in_word(~self.upper[word], k - self.zeros[word])

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i, side="right") - 1
        place = word * 64 + _select_in_word(self.upper[word], i - self.ones[word])
        return ((place - i).astype(np.uint64) << np.uint64(self.l)) | self._low(i)

    def numbers(self) -> np.ndarray:
        """The whole sequence, for as many queries as it has numbers."""
        i = np.arange(self.n)
        high = np.flatnonzero(np.unpackbits(self.upper.view(np.uint8), bitorder="little"))[: self.n] - i
        return (high.astype(np.uint64) << np.uint64(self.l)) | self._low(i)

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first number not below each ``x``, looking only in its bucket, and whether it equals ``x``."""
        x = x.astype(np.uint64)
        if not self.n:
            return np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=bool)
        if len(x) >= self.n:
            own = self.numbers()
            at = np.searchsorted(own, x)
            return at, own[np.minimum(at, self.n - 1)] == x
        high = (x >> np.uint64(self.l)).astype(np.int64)
        buckets = int(self.zeros[-1])
        inside = high < buckets
        h = np.where(inside, high, 0)
        lo = np.where(h > 0, self._zero(np.maximum(h - 1, 0)) - h + 1, 0)
        hi = np.minimum(self._zero(h) - h, self.n)
        lo = np.minimum(lo, hi)
        end, want = hi.copy(), x & np.uint64((1 << self.l) - 1)
        for _ in range(64):
            open_ = lo < hi
            if not open_.any():
                break
            middle = (lo + hi) >> 1
            less = open_ & (self._low(np.minimum(middle, self.n - 1)) < want)
            hi = np.where(open_ & ~less, middle, hi)
            lo = np.where(less, middle + 1, lo)
        equal = inside & (lo < end)
        equal &= self._low(np.minimum(lo, self.n - 1)) == want
        return lo, equal

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.l], dtype=np.int64), self.upper, self.low]

    @classmethod
    def from_parts(cls, head: np.ndarray, upper: np.ndarray, low: np.ndarray) -> EliasFano:
        return cls(int(head[0]), int(head[1]), upper.view("<u8"), low.view(np.uint8))


class TrieLevel:
    """Contexts, a monotone pointer per context, its successors, and quantised probabilities.

    Contexts are increasing hashes below 2^63.  Successor words get dense numbers within the
    level; a context's successors are increasing numbers, and adding the context's
    number times the vocabulary makes the whole sequence increase.  A query finds
    its context, takes the context's range from the pointers and looks for the
    successor in it.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, words: EliasFano, successors: EliasFano, codes: np.ndarray, weights: np.ndarray):
        self.contexts, self.pointers, self.words, self.successors = contexts, pointers, words, successors
        self.codes, self.weights = codes, weights

    @classmethod
    def of(cls, contexts: np.ndarray, sizes: np.ndarray, words: np.ndarray, codes: np.ndarray, weights: np.ndarray) -> TrieLevel:
        """From increasing contexts, their numbers of successors, the successors in order, and both kinds of codes."""
        vocabulary, number = np.unique(words, return_inverse=True)
        base = np.repeat(np.arange(len(contexts), dtype=np.uint64) * np.uint64(max(1, len(vocabulary))), sizes)
        pointers = np.concatenate([[0], np.cumsum(sizes)])
        successors = EliasFano.of(base + number.astype(np.uint64))
        return cls(EliasFano.of(contexts), EliasFano.of(pointers), EliasFano.of(vocabulary), successors, codes, weights)

    def context(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each context, -1 if unseen."""
        at, seen = self.contexts.find(hashes)
        return np.where(seen, at, -1)

    def _number(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each word and whether it has one; asked for in their order, which keeps the search near where it was."""
        order = np.argsort(word)
        at, seen = self.words.find(word[order])
        number, known = np.empty(len(word), dtype=np.int64), np.empty(len(word), dtype=bool)
        number[order], known[order] = at, seen
        return number, known

    def successor(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Number of each n-gram, -1 if the context is -1 or has no such successor."""
        number, known = self._number(word)
        known &= context >= 0
        own = np.maximum(context, 0)
        at, seen = self.successors.find(own.astype(np.uint64) * np.uint64(max(1, self.words.n)) + np.where(known, number, 0).astype(np.uint64))
        return np.where(known & seen, at, -1)

    def range(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First successor of each context, and the first of the next one."""
        return self.pointers[context].astype(np.int64), self.pointers[context + 1].astype(np.int64)

    def to_bytes(self) -> bytes:
        parts = [p for s in (self.contexts, self.pointers, self.words, self.successors) for p in s.parts()]
        parts += [self.codes, self.weights]
        padded = [p.tobytes() + bytes(-p.nbytes % 8) for p in parts]
        head = np.array([x for p, b in zip(parts, padded) for x in (p.nbytes, len(b))], dtype="<i8")
        return head.tobytes() + b"".join(padded)

    @classmethod
    def from_buffer(cls, data) -> TrieLevel:
        """The level over ``data`` itself (bytes or a memory map): nothing is copied but the select directories."""
        head = np.frombuffer(data, dtype="<i8", count=28).reshape(14, 2)
        views, at = [], 28 * 8
        for size, padded in head.tolist():
            views.append(np.frombuffer(data, dtype=np.uint8, count=size, offset=at))
            at += padded
        sequences = [EliasFano.from_parts(views[k].view("<i8"), views[k + 1], views[k + 2]) for k in range(0, 12, 3)]
        return cls(*sequences, views[12].view("<u2"), views[13].view("<u2"))

    def mapped(self) -> TrieLevel:
        """The same level over an unnamed memory-mapped file, which the system may page out."""
        with tempfile.TemporaryFile() as file:
            file.write(self.to_bytes())
            file.flush()
            return TrieLevel.from_buffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
