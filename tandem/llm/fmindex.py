"""A compressed full-text index over word sequences, in numpy: suffix order by
prefix doubling, Burrows-Wheeler transform in a wavelet matrix of packed bit
vectors with rank counts, and backward search of many patterns at once."""

from __future__ import annotations

import numpy as np

_U = np.uint64


class BitVector:
    """Packed bits with a running count every 64 bits."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        packed = np.concatenate((packed, np.zeros(-len(packed) % 8 + 8, np.uint8)))
        self.words = packed.view(_U)
        self.counts = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words)))).astype(np.int32)
        self.zeros = n - int(bits.sum())

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        w = i >> 6
        below = (_U(1) << (i & 63).astype(_U)) - _U(1)
        return self.counts[w] + np.bitwise_count(self.words[w] & below)


class WaveletMatrix:
    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits = []
        for lvl in range(self.levels - 1, -1, -1):
            b = ((seq >> lvl) & 1).astype(bool)
            self.bits.append(BitVector(b))
            seq = np.concatenate((seq[~b], seq[b]))
        self.begin = self._descend(np.arange(sigma), np.zeros(sigma, np.int64))

    def _descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, v in enumerate(self.bits):
            one = (c >> (self.levels - 1 - k)) & 1
            r = v.rank1(i)
            i = np.where(one == 1, v.zeros + r, i - r)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol c before position i, elementwise."""
        return self._descend(c, i) - self.begin[c]


class FMIndex:
    """Index of a text of symbols 0..sigma-1; 0 separates its parts.  Suffixes
    are ordered by their first ``depth`` symbols at least, which is exact for
    patterns up to that length."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int = 32):
        self.text, self.n = text, len(text)
        rank = text.astype(np.int64)
        h = 1
        while h < depth:
            nxt = np.zeros(self.n, np.int64)
            nxt[:-h or None] = rank[h:] + 1 if h < self.n else 0
            _, rank = np.unique(rank * (self.n + sigma + 2) + nxt, return_inverse=True)
            h *= 2
            if rank.max(initial=0) == self.n - 1:
                break
        order = np.argsort(rank, kind="stable")
        self.bwt = WaveletMatrix(text[order - 1], sigma)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma)))).astype(np.int64)

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol in front."""
        r = self.bwt.rank(np.concatenate((c, c)), np.concatenate((lo, hi)))
        return self.first[c] + r[:len(c)], self.first[c] + r[len(c):]

    def matching_statistics(self, stream: np.ndarray, ends: np.ndarray, threshold: int, least: int = 2):
        """For the positions ``ends`` of a streamed symbol sequence: the length
        (up to ``threshold``) of the longest match that ends there and occurs
        at least ``least`` times in the index, and the interval's first row."""
        c = stream[ends].astype(np.int64)
        lo, hi = self.first[c].copy(), self.first[c + 1].copy()
        length = np.zeros(len(ends), np.int64)
        live = np.flatnonzero((hi - lo >= least) & (c > 0))
        length[live] = 1
        for k in range(1, threshold):
            at = ends[live] - k
            c = np.where(at >= 0, stream[np.maximum(at, 0)], 0).astype(np.int64)
            live, c = live[c > 0], c[c > 0]
            if not len(live):
                break
            a, b = self.extend(c, lo[live], hi[live])
            ok = b - a >= least
            live = live[ok]
            lo[live], hi[live] = a[ok], b[ok]
            length[live] = k + 1
        return length, lo
