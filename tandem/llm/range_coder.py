"""Adaptive context-mixing range coder for token ids, in numpy.

A whole id is one coding step.  Three predictors are mixed: order 0 is a table
of frequencies; order 1 and order 2 (contexts of one and two previous ids, in
hashed slots) each name the id they expect, with a probability.  The mixture of
the three distributions,

    f(s) = W0 * f0(s) + W1 * [s = c1] + W2 * [s = c2],

is coded by a 64-bit range coder.  The weights are trained while coding, for
each pair of probability levels of the two contexts.  Order 0, the contexts and
the weights at the start are a ``Prior``, fitted to many blocks and stored
beside them.  Without one, order 0 is uniform, and the contexts begin empty and
learn within the block.

Every block starts from the same state, so blocks are independent; many blocks
are coded in step with one another, one numpy lane each.  Only integers are
used: any machine decodes the same.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SLOT_BITS = 12
_SLOTS = 1 << SLOT_BITS
_LEVELS = 128  # 8 levels of each context, and whether they expect the same id
_ONE = 1 << 16  # total of order 0
_MIX = 1 << 12  # total of the weights
_SHIFT = np.uint64(28)  # total of the mixture: 2 ** 28
_LEAST = np.uint64(1 << 48)
_WORD, _TOP = np.uint64(16), np.uint64(48)
_WEAK, _NEW = 8, 32  # below the first an expected id is replaced, with the second
_RATE = 6
_PRIOR = struct.Struct("<I")

# change of an 8-bit probability: the first half for a miss, the second for a hit
_P = np.arange(256, dtype=np.int32)
_CHANGE = np.concatenate((-((_P + 15) >> 4), (255 - _P) >> 4))


_HASH1, _HASH2, _KEEP = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(32 - SLOT_BITS)


def _slot2(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Slot of order 2 from the previous id and the one before it (unsigned)."""
    return (one * _HASH1 + two * _HASH2) >> _KEEP


def _expected(slot: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every slot its most frequent id and that id's share (of 255)."""
    best, share = np.zeros(_SLOTS, np.int32), np.full(_SLOTS, _NEW, np.int32)
    key = np.sort((slot << 16) | ids)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    n, key = np.diff(np.append(first, len(slot))), key[first]
    at = key >> 16
    begin = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))  # of the slots that were seen
    most, total, seen = np.maximum.reduceat(n, begin), np.add.reduceat(n, begin), at[begin]
    is_best = np.flatnonzero(n == np.repeat(most, np.diff(np.append(begin, len(n)))))[::-1]
    best[at[is_best]] = key[is_best] & 0xFFFF  # the smallest id of equals stays
    share[seen] = np.maximum(255 * most // total, _WEAK)
    return best, share


class Prior:
    """What the blocks of a frame start from: order 0 (ids by falling frequency,
    with frequencies that add up to 2 ** 16), each slot's expected id and
    probability, and the weights.  Ids are known by their place in order 0."""

    fitted = True

    def __init__(self, ids: np.ndarray, freq: np.ndarray, one: np.ndarray, two: np.ndarray, weights: np.ndarray):
        self.ids, self.freq, self.one, self.two, self.weights = ids, freq, one, two, weights
        self.places = np.zeros(_ONE, np.uint16)
        self.places[ids] = np.arange(len(ids))
        self.sums = np.zeros(_ONE + 1, np.int32)
        np.cumsum(freq, out=self.sums[1:len(ids) + 1])
        self.sums[len(ids) + 1:] = _ONE
        self.found = np.repeat(np.arange(len(ids), dtype=np.int32), freq)

    @staticmethod
    def plain() -> Prior:
        level = (np.arange(_LEVELS) >> np.array([[1], [4]])) & 7
        same = np.arange(_LEVELS) & 1
        two = (level[1] * 2 + 1) * 3800
        one = np.where(same == 1, 0, ((level[0] * 2 + 1) * (61000 - two)) >> 4)
        slots = np.full(_SLOTS, _NEW, np.int32)
        prior = Prior(np.arange(_ONE), np.ones(_ONE, np.int32), slots, slots, np.array([one, two], np.int32))
        prior.fitted = False
        return prior

    @staticmethod
    def fit(ids: np.ndarray) -> Prior:
        counts = np.bincount(ids, minlength=_ONE)
        known = np.flatnonzero(counts)
        known = known[np.argsort(-counts[known], kind="stable")]
        freq = counts[known] * (_ONE - len(known)) // len(ids) + 1
        freq[0] += _ONE - freq.sum()
        places = np.zeros(_ONE, np.int32)
        places[known] = np.arange(len(known))
        now = places[ids]
        prev1 = np.concatenate((np.zeros(1, np.int32), now[:-1]))
        prev2 = np.concatenate((np.zeros(1, np.int32), prev1[:-1]))
        slot1, slot2 = prev1 & (_SLOTS - 1), _slot2(prev1.view(np.uint32), prev2.view(np.uint32)).view(np.int32)
        (c1, p1), (c2, p2) = _expected(slot1, now), _expected(slot2, now)
        one, two = (c1 << 8) | p1, (c2 << 8) | p2
        e1, e2 = one[slot1], two[slot2]
        c1, c2 = e1 >> 8, e2 >> 8
        level = ((e2 >> 1) & 0x70) + ((e1 >> 4) & 0x0E) + (c1 == c2)
        # of each level: how many, how often the one context was right, the other
        right = np.bincount(level * 4 + (now == c1) * 2 + (now == c2), minlength=4 * _LEVELS).reshape(_LEVELS, 4)
        n = right.sum(1)
        weights = Prior.plain().weights
        for row, hits in ((0, right[:, 2]), (1, right[:, 1] + right[:, 3])):
            weights[row] = np.where(n >= 64, hits * 65535 // np.maximum(n, 1), weights[row])
        return Prior(known, freq, one, two, weights)

    def pack(self) -> bytes:
        parts = [np.asarray(self.ids, "<u2"), np.asarray(self.freq - 1, "<u2")]
        for t in (self.one, self.two):
            parts += [np.asarray(t >> 8, "<u2"), np.asarray(t & 255, np.uint8)]
        parts.append(np.asarray(self.weights, "<u2"))
        return zlib.compress(_PRIOR.pack(len(self.ids)) + b"".join(p.tobytes() for p in parts))

    @staticmethod
    def unpack(data: bytes) -> Prior:
        try:
            raw = zlib.decompress(data)
        except zlib.error as e:
            raise ValueError("a frame's prior is broken") from e
        n, at = _PRIOR.unpack_from(raw)[0], _PRIOR.size
        got = []
        for kind, size in (("<u2", n), ("<u2", n), *(("<u2", _SLOTS), (np.uint8, _SLOTS)) * 2, ("<u2", 2 * _LEVELS)):
            got.append(np.frombuffer(raw, kind, size, at).astype(np.int32))
            at += got[-1].size * np.dtype(kind).itemsize
        return Prior(got[0], got[1] + 1, (got[2] << 8) | got[3], (got[4] << 8) | got[5], got[6].reshape(2, _LEVELS))


class _Model:
    """State of the lanes: slots of both contexts, weights, previous ids."""

    def __init__(self, priors: list[Prior], which: np.ndarray):
        n = len(which)
        self.sums = np.concatenate([p.sums for p in priors])
        self.found = np.concatenate([p.found for p in priors])
        self.sums_at, self.found_at = which * (_ONE + 1), which * _ONE
        # lane after lane within a slot or level: the frequent ones stay in the cache
        self.fitted = priors[0].fitted
        self.slots = [np.concatenate([p.one for p in priors]), np.concatenate([p.two for p in priors])]
        if not self.fitted:  # every lane learns its own
            self.slots = [np.tile(t, n) for t in self.slots]
        self.weight = [np.stack([p.weights[r] for p in priors])[which].ravel() for r in (0, 1)]
        self.base, self.weight_at = (which if self.fitted else np.arange(n)) * _SLOTS, np.arange(n) * _LEVELS
        self.at1, self.at2 = self.base.copy(), self.base.copy()
        self.hash2 = np.zeros(n, np.uint32)  # the previous id's part in the next slot of order 2

    def predict(self, k: int) -> None:
        """Expected ids and weights of the first k lanes."""
        self.e1, self.e2 = e1, e2 = self.slots[0][self.at1[:k]], self.slots[1][self.at2[:k]]
        self.c1, self.c2 = e1 >> 8, e2 >> 8
        self.other = self.c1 != self.c2
        self.g = self.weight_at[:k] + (((e2 >> 1) & 0x70) + ((e1 >> 4) & 0x0E) + ~self.other)
        self.q1, self.q2 = self.weight[0][self.g], self.weight[1][self.g]
        w2 = np.minimum(self.q2 >> 4, _MIX - 32)
        w1 = np.minimum(self.q1 >> 4, _MIX - 16 - w2) * self.other
        self.w0 = _MIX - w1 - w2
        self.w1, self.w2 = w1 << 16, w2 << 16

    def interval(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each lane's id lies in the mixture: start and width."""
        at = self.sums_at[:len(s)] + s
        before = self.sums[at]
        self.hit1, self.hit2 = s == self.c1, s == self.c2
        start = self.w0 * before + (s > self.c1) * self.w1 + (s > self.c2) * self.w2
        width = self.w0 * (self.sums[at + 1] - before) + self.hit1 * self.w1 + self.hit2 * self.w2
        return start.astype(np.uint64), width.astype(np.uint64)

    def find(self, v: np.ndarray) -> np.ndarray:
        """The id whose interval holds v: take away what the contexts add below
        v, and look the rest up in order 0.  An expected id's interval begins
        with its part of order 0, whose last place stands for what is added."""
        k = len(v)
        c1, c2, w0, w1, w2 = self.c1, self.c2, self.w0, self.w1, self.w2
        sums_at = self.sums_at[:k] + 1
        past1 = v - (w0 * self.sums[sums_at + c1] + (c1 > c2) * w2 - 1)
        past2 = v - (w0 * self.sums[sums_at + c2] + (c2 > c1) * w1 - 1)
        rest = v - np.minimum(np.maximum(past1, 0), w1) - np.minimum(np.maximum(past2, 0), w2)
        return self.found[self.found_at[:k] + rest // w0]

    def learn(self, s: np.ndarray) -> None:
        k, u = len(s), s.view(np.uint32)
        if not self.fitted:
            new = (s << 8) | _NEW
            for slots, at, e, hit in ((self.slots[0], self.at1, self.e1, self.hit1), (self.slots[1], self.at2, self.e2, self.hit2)):
                e += _CHANGE[(e & 255) + hit * np.int32(256)]
                np.copyto(e, new, where=(e & 255) < _WEAK)
                slots[at[:k]] = e
        for weight, q, hit in ((self.weight[0], self.q1, self.hit1 & self.other), (self.weight[1], self.q2, self.hit2)):
            weight[self.g] = q + ((hit * np.int32(65535) - q) >> _RATE)
        np.add(self.base[:k], s & (_SLOTS - 1), out=self.at1[:k])
        np.add(self.base[:k], (u * _HASH1 + self.hash2[:k]) >> _KEEP, out=self.at2[:k])
        np.multiply(u, _HASH2, out=self.hash2[:k])


def _lanes(lengths: np.ndarray):
    """Lanes in order of falling length, and how many still run at each step."""
    order = np.argsort(-lengths, kind="stable")
    return order, np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0))), "left")


def _with_priors(n: int, order: np.ndarray, priors, which):
    if priors is None:
        priors, which = [Prior.plain()], np.zeros(n, np.int64)
    return priors, np.asarray(which, np.int64)[order]


def encode(blocks: list[np.ndarray], priors: list[Prior] | None = None, which=None) -> list[bytes]:
    """Code of each block; ``which`` names each block's prior."""
    lengths = np.array([len(b) for b in blocks], np.int64)
    order, running = _lanes(lengths)
    n, most = len(blocks), len(running)
    priors, which = _with_priors(n, order, priors, which)
    ids = np.zeros((most, n), np.uint16)
    for lane, i in enumerate(order):
        ids[:len(blocks[i]), lane] = priors[which[lane]].places[blocks[i]]
    model = _Model(priors, which)
    low, width = np.zeros(n, np.uint64), np.full(n, (1 << 64) - 1, np.uint64)
    out, at = np.zeros((n, most + 8), np.uint32), np.zeros(n, np.int64)  # 16-bit words and their carries
    for t in range(most):
        k = int(running[t])
        if not t & 63 and int(at.max()) + 136 > out.shape[1]:  # an id takes two words at most
            out = np.concatenate((out, np.zeros((n, most // 2 + 136), np.uint32)), axis=1)
        s = ids[t, :k].astype(np.int32)
        model.predict(k)
        start, share = model.interval(s)
        a, z = low[:k], width[:k]
        unit = z >> _SHIFT
        moved = a + unit * start
        over = np.flatnonzero(moved < a)
        if len(over):
            out[over, at[over] - 1] += 1
        a[:] = moved
        np.multiply(unit, share, out=z)
        move = np.flatnonzero(z < _LEAST)
        while len(move):
            place, now, left = at[move], a[move], z[move] << _WORD
            out[move, place] = now >> _TOP
            at[move] = place + 1
            a[move], z[move] = now << _WORD, left
            move = move[left < _LEAST]
        model.learn(s)
    if n and int(at.max()) >= out.shape[1]:
        out = np.concatenate((out, np.zeros((n, 1), np.uint32)), axis=1)
    last = (low >> _TOP) + ((low & (_LEAST - np.uint64(1))) != 0)  # within the width left
    out[np.arange(n), at] = last
    while (out >> 16).any():
        carry = out >> 16
        out &= 0xFFFF
        out[:, :-1] += carry[:, 1:]
    words = out.astype("<u2")
    coded: list = [b""] * n
    for lane, i in enumerate(order):
        coded[i] = words[lane, :at[lane] + 1].tobytes()
    return coded


def decode(coded: list[bytes], lengths: np.ndarray, priors: list[Prior] | None = None, which=None) -> list[np.ndarray]:
    lengths = np.asarray(lengths, np.int64)
    order, running = _lanes(lengths)
    n, most = len(coded), len(running)
    priors, which = _with_priors(n, order, priors, which)
    data = np.zeros((n, max((len(c) for c in coded), default=0) // 2 + 8), np.uint64)
    for lane, i in enumerate(order):
        data[lane, :len(coded[i]) // 2] = np.frombuffer(coded[i], "<u2", len(coded[i]) // 2)
    model = _Model(priors, which)
    code, width = np.zeros(n, np.uint64), np.full(n, (1 << 64) - 1, np.uint64)
    for word in range(4):
        code = (code << _WORD) | data[:, word]
    at, out = np.full(n, 4, np.int64), np.zeros((most, n), np.uint16)
    most_v = np.uint64((1 << int(_SHIFT)) - 1)
    for t in range(most):
        k = int(running[t])
        model.predict(k)
        x, z = code[:k], width[:k]
        unit = z >> _SHIFT
        s = model.find(np.minimum(x // unit, most_v).astype(np.int32))
        start, share = model.interval(s)
        x -= unit * start
        np.multiply(unit, share, out=z)
        move = np.flatnonzero(z < _LEAST)
        while len(move):
            place, left = at[move], z[move] << _WORD
            x[move] = (x[move] << _WORD) | data[move, np.minimum(place, data.shape[1] - 1)]
            at[move] = place + 1
            z[move] = left
            move = move[left < _LEAST]
        model.learn(s)
        out[t, :k] = s
    result: list = [None] * n
    for lane, i in enumerate(order):
        result[i] = np.asarray(priors[which[lane]].ids, np.uint32)[out[:lengths[i], lane]]
    return result
