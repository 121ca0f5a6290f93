"""BPE training in exact batches of merges.

The state is a table of distinct words ``(n, syms)`` and a running table of pair
counts ``(key, n)``.  A round does:

1. The ``heavy`` pairs are the first K of all pairs in the trainer's order
   (count descending, then ids).  Only K rows come to the driver.
2. Every word is cut where the pair of neighbours is not heavy.  What is left
   are short segments; distinct ones, with their summed counts, come to the
   driver, ``segments`` rows at most: with more, K is halved.  (A single pair
   has one segment, or runs of one symbol up to the longest word.)
3. The driver merges within the segments, one pair after the other, as long as
   the next pair does not come after the K-th in the trainer's order.  This is
   exact.  A merged pair stands where two symbols met, whose own pair was at
   least as frequent and so is heavy; all of its occurrences lie inside segments,
   and cut-off pairs can only lose occurrences.  (Only a merge whose string
   exists already could add to an old pair: it ends the batch.)
4. One pass applies the batch to the words that hold a merged pair.  Their old
   pairs are subtracted from the running counts and their new ones added; the
   other words are neither rewritten symbol by symbol nor counted again.

Tables go to the shared folder; a round's tables are dropped when the next
round's are written, so a lost executor finds what it needs.
"""

from __future__ import annotations

import heapq
import logging
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.config import SPECIAL_TOKENS, VOCAB_SIZE
from tandem.operators.vocab import char_alphabet
from tandem.session import drop_scratch, scratch_path, ship_package

log = logging.getLogger(__name__)

#: Heavy pairs of the first round and at most, and segments that the driver takes.
HEAVY, MOST_HEAVY, SEGMENTS = 256, 8192, 50_000
#: Words that a task takes at once, and pairs or segments it holds before it passes on their sums.
TAKE, HOLD = 8192, 1 << 19


@dataclass
class BpeModel:
    vocab: list  # index = id, value = token string
    merges: list  # (left_token, right_token) in rank order
    rounds: int = 0

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(t, i) for i, t in enumerate(self.vocab)], "token string, id int")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(r, a, b) for r, (a, b) in enumerate(self.merges)],
                                     "rank int, left string, right string")


# ------------------------------------------------------------------ in tasks

def _slices(batches):
    """The batches in slices of at most TAKE words."""
    for b in batches:
        for s in range(0, len(b), TAKE):
            yield b.slice(s, TAKE)


def _flat(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of all words, their bounds, counts) of a batch."""
    s = batch.column("syms")
    offs = np.asarray(s.offsets)
    return np.asarray(s.values)[offs[0]:offs[-1]], offs - offs[0], batch.column("n").to_numpy()


def _pairs(sym: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key of each symbol with the next one, and whether both are of one word."""
    key = (sym[:-1].astype(np.int64) << 32) | sym[1:]
    inside = np.ones(len(key), bool)
    cut = offs[1:-1]
    inside[cut[(cut > 0) & (cut <= len(key))] - 1] = False
    return key, inside


def _is_in(key: np.ndarray, some: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(some, key), len(some) - 1)
    return some[at] == key


def _count(parts) -> pa.RecordBatch:
    """Summed (key, n) of several (keys, counts)."""
    key = np.concatenate([k for k, _ in parts]) if parts else np.zeros(0, np.int64)
    n = np.concatenate([n for _, n in parts]) if parts else np.zeros(0, np.int64)
    key, of = np.unique(key, return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, of, n)
    return pa.record_batch([pa.array(key), pa.array(total)], ["key", "n"])


def _sums(parts):
    """``_count`` of an iterator, in pieces of about HOLD pairs: a later grouping adds them up."""
    held, n = [], 0
    for p in parts:
        held.append(p)
        n += len(p[0])
        if n >= HOLD:
            yield _count(held)
            held, n = [], 0
    if held:
        yield _count(held)


def _word_pairs(sym, offs, n):
    key, inside = _pairs(sym, offs)
    word = np.repeat(np.arange(len(n)), np.diff(offs))[:-1]
    return key[inside], n[word[inside]]


def _to_symbols(points: np.ndarray, first: int):
    """Words to the ids of their characters."""
    def run(batches):
        for b in _slices(batches):
            text = b.column("word").to_pylist()
            flat = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32)
            ids = (np.searchsorted(points, flat) + first).astype(np.int32)
            offs = np.concatenate(([0], np.cumsum([len(t) for t in text]))).astype(np.int32)
            yield pa.record_batch([b.column("n"), pa.ListArray.from_arrays(pa.array(offs), pa.array(ids))], ["n", "syms"])
    return run


def _count_pairs(batches):
    yield from _sums(_word_pairs(*_flat(b)) for b in _slices(batches))


def _cut(heavy: np.ndarray):
    """Distinct runs of symbols joined by heavy pairs, as bytes."""
    def run(batches):
        total: dict = defaultdict(int)

        def sums():
            return pa.record_batch([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["seg", "n"])

        for b in _slices(batches):
            if len(total) >= HOLD:
                yield sums()
                total.clear()
            sym, offs, n = _flat(b)
            if len(sym) < 2:
                continue
            key, inside = _pairs(sym, offs)
            joined = np.concatenate(([False], inside & _is_in(key, heavy), [False]))
            start = np.flatnonzero(~joined[:-1] & joined[1:])
            end = np.flatnonzero(joined[:-1] & ~joined[1:]) + 1
            word = np.searchsorted(offs, start, "right") - 1
            raw = np.ascontiguousarray(sym.astype("<i4")).tobytes()
            for a, z, c in zip((start * 4).tolist(), (end * 4).tolist(), n[word].tolist(), strict=True):
                total[raw[a:z]] += c
        yield sums()
    return run


def merge_word(syms: list, ranks: dict) -> list:
    """All merges in order of rank, each from left to right.  ``ranks`` has for
    a pair its merges as (rank, new id), ascending."""
    done = -1
    while len(syms) > 1:
        best = None
        for pair in zip(syms, syms[1:], strict=False):
            for rank, new in ranks.get(pair, ()):
                if rank > done:
                    if best is None or rank < best[0]:
                        best = rank, pair, new
                    break
        if best is None:
            return syms
        done, (a, b), new = best
        out, i = [], 0
        while i < len(syms):
            if i + 1 < len(syms) and syms[i] == a and syms[i + 1] == b:
                out.append(new)
                i += 2
            else:
                out.append(syms[i])
                i += 1
        syms = out
    return syms


def _apply(merges: list):
    """Words after a batch of merges; ``old`` has what a changed word was."""
    ranks: dict = defaultdict(list)
    for r, (a, b, new) in enumerate(merges):
        ranks[a, b].append((r, new))
    some = np.array(sorted((a << 32) | b for a, b in ranks), np.int64)

    def run(batches):
        seen = dict(ranks)
        for batch in _slices(batches):
            sym, offs, n = _flat(batch)
            key, inside = _pairs(sym, offs)
            hit = np.flatnonzero(inside & _is_in(key, some)) if len(key) else np.zeros(0, np.int64)
            touched = np.zeros(len(n), bool)
            touched[np.searchsorted(offs, hit, "right") - 1] = True
            old = batch.column("syms").filter(pa.array(touched))
            new = pa.array([merge_word(w, seen) for w in old.to_pylist()], pa.list_(pa.int32()))
            same = batch.filter(pa.array(~touched))
            yield pa.record_batch([pa.concat_arrays([same.column("n"), batch.column("n").filter(pa.array(touched))]),
                                   pa.concat_arrays([same.column("syms").cast(new.type), new]),
                                   pa.concat_arrays([pa.nulls(len(same), new.type), old.cast(new.type)])], ["n", "syms", "old"])
    return run


def _changes(batches):
    """New pairs of changed words, less their old ones."""
    def parts():
        for b in _slices(batches):
            n = b.column("n")
            for name, sign in (("syms", 1), ("old", -1)):
                sym, offs, c = _flat(pa.record_batch([n, b.column(name)], ["n", "syms"]))
                if len(sym) > 1:
                    key, w = _word_pairs(sym, offs, c)
                    yield key, sign * w
    yield from _sums(parts())


# ----------------------------------------------------------------- on the driver

def merge_segments(rows, last: tuple, vocab: list, index: dict, vocab_size: int, most: int | None = None) -> list:
    """The next merges (a, b, new id), ``most`` at most, whose pairs do not come
    after ``last``; ``vocab`` and ``index`` grow with them."""
    segs, weight = [list(np.frombuffer(s, "<i4").tolist()) for s, _ in rows], [n for _, n in rows]
    count: dict = defaultdict(int)
    where: dict = defaultdict(set)
    for i, s in enumerate(segs):
        for p in zip(s, s[1:], strict=False):
            count[p] += weight[i]
            where[p].add(i)
    heap = [(-n, *p) for p, n in count.items()]
    heapq.heapify(heap)
    out: list = []
    while heap and len(vocab) < vocab_size and (most is None or len(out) < most):
        n, a, b = heap[0]
        if (n, a, b) > last:
            break
        heapq.heappop(heap)
        if count.get((a, b), 0) != -n:
            continue  # an earlier count of this pair
        token = vocab[a] + vocab[b]
        known = index.get(token)
        new = len(vocab) if known is None else known
        if known is None:
            vocab.append(token)
            index[token] = new
        out.append((a, b, new))
        if known is not None:
            break
        changed = set()
        for i in where.pop((a, b)):
            s, w = segs[i], weight[i]
            for p in zip(s, s[1:], strict=False):
                count[p] -= w
                changed.add(p)
            segs[i] = s = merge_word(s, {(a, b): [(0, new)]})
            for p in zip(s, s[1:], strict=False):
                count[p] += w
                where[p].add(i)
                changed.add(p)
        for p in changed:
            if count[p] > 0:
                heapq.heappush(heap, (-count[p], *p))
    return out


def bpe_train(spark: SparkSession, words: DataFrame, vocab_size: int = VOCAB_SIZE, specials=tuple(SPECIAL_TOKENS),
              heavy: int = HEAVY, segments: int = SEGMENTS, max_merges: int | None = None) -> BpeModel:
    """Learn BPE merges over ``words(word, n)``: highest count first, ties to
    the smallest (left id, right id), until the vocabulary (special tokens,
    alphabet, merged strings) has ``vocab_size`` tokens, ``max_merges`` are
    learned, or no pair is left.  A merge whose string exists already is
    recorded and does not grow the vocabulary."""
    ship_package(spark)
    alphabet = [r["token"] for r in char_alphabet(words, len(specials)).orderBy("id").collect()]  # characters
    vocab = list(specials) + alphabet
    index = {t: i for i, t in enumerate(vocab)}
    merges: list = []
    points = np.array([ord(c) for c in alphabet], np.uint32)
    rounds = 0

    def table(df, name):
        path = scratch_path(spark, name)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    cur, cur_path = table(words.select(F.col("n").cast("long").alias("n"), "word").where("length(word) > 1")
                          .mapInArrow(_to_symbols(points, len(specials)), "n long, syms array<int>"), "bpe-words")
    counts, counts_path = table(cur.mapInArrow(_count_pairs, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")),
                                "bpe-pairs")
    while len(vocab) < vocab_size and (max_merges is None or len(merges) < max_merges):
        top = counts.orderBy(F.desc("n"), "key").limit(heavy).collect()
        if not top:
            break
        while True:
            keys = np.array(sorted(r["key"] for r in top), np.int64)
            segs = cur.mapInArrow(_cut(keys), "seg binary, n long").groupBy("seg").agg(F.sum("n").alias("n"))
            if len(top) == 1:  # one pair's segments: itself, or runs of one symbol
                rows = segs.collect()
                break
            rows = segs.limit(segments + 1).collect()
            if len(rows) <= segments:
                break
            top = top[:max(1, len(top) // 2)]
        last = top[-1]
        batch = merge_segments([(r["seg"], r["n"]) for r in rows], (-last["n"], last["key"] >> 32, last["key"] & 0xFFFFFFFF),
                               vocab, index, vocab_size, None if max_merges is None else max_merges - len(merges))
        merges += [(vocab[a], vocab[b]) for a, b, _ in batch]
        rounds += 1
        log.debug("bpe round %d: %d heavy pairs, %d segments, %d merges", rounds, len(top), len(rows), len(batch))
        heavy = min(MOST_HEAVY, 2 * len(top)) if len(rows) * 3 < segments else len(top)
        old_paths = cur_path, counts_path
        after, cur_path = table(cur.mapInArrow(_apply(batch), "n long, syms array<int>, old array<int>"), "bpe-words")
        delta = after.where("old is not null").mapInArrow(_changes, "key long, n long")
        counts, counts_path = table(counts.union(delta).groupBy("key").agg(F.sum("n").alias("n")).where("n > 0"), "bpe-pairs")
        cur = after.where("size(syms) > 1").select("n", "syms")
        drop_scratch(spark, *old_paths)
    drop_scratch(spark, cur_path, counts_path)
    return BpeModel(vocab, merges, rounds)
