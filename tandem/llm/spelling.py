"""Spelling variants by a bidirectional FM-index search scheme (operator 13).

Two words are near when one inserted, deleted or replaced code point makes one
of the other.  Then either the first half of the one starts the other, or its
second half ends it.  So a word is matched in two ways against the vocabulary:
its first half exactly and then to the right with one error, or its second half
exactly and then to the left with one error.  Each direction has an FM-index of
the delimited words (the rightward one of the words reversed); a partial match
is an interval of suffix ranks, and a wavelet matrix lists the symbols that can
follow it.

The vocabulary is cut into shards by those halves: a word stands in the shards
of the halves that words one shorter, as long, or one longer may look for, at
most six, and is looked up in two.  The shards' number follows the vocabulary's
size; a half shared by more than HOT words is split over several shards, all of
which its words look through.  No pairs but the near ones are made.

A word's form is its most frequent near word (ties: the smallest in code-point
order), if that is RATIO times as frequent; its root is where following forms
ends.  Forms grow RATIO-fold at each step, so chains are short: they are
followed by joins that double the distance.

Cases: null and empty texts have no words; a null id hashes as the empty
string; texts and words of any length are read whole; repeated rows and tied
ids count each; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import documents, join_small, python_ready, written
from tandem.llm.fmindex import FMIndex

LEAST_LENGTH, LEAST_COUNT, RATIO, MUTED = 7, 2, 10, 31
#: Words of a shard on average, words that may share a half in one shard, and
#: words looked up at a time.
SHARD, HOT, AT_ONCE = 40_000, 20_000, 8192
RUN = r"[A-Za-zÀ-ÿ]+"

# letters a-z, then U+00C0 to U+00FF, as symbols from 1
SYMBOL = np.zeros(256, np.int64)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[192:256] = np.arange(27, 91)
SIGMA = 91


class OneWay(FMIndex):
    """Words (in order of their symbols) between delimiters, searched from the
    right end leftwards."""

    def __init__(self, words: list[str]):
        flat = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("latin-1"), np.uint8)
        super().__init__(SYMBOL[flat], SIGMA, max(map(len, words)) + 2)

    def symbols(self, lo: np.ndarray, hi: np.ndarray):
        """All symbols that stand before the matches of each interval: (index
        of the interval, symbol, new interval)."""
        own, c = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        for v in self.bwt.bits:
            r = v.rank1(np.concatenate((lo, hi)))
            a, b = r[:len(lo)], r[len(lo):]
            own, c = np.concatenate((own, own)), np.concatenate((c * 2, c * 2 + 1))
            lo, hi = np.concatenate((lo - a, v.zeros + a)), np.concatenate((hi - b, v.zeros + b))
            some = hi > lo
            own, c, lo, hi = own[some], c[some], lo[some], hi[some]
        return own, c, self.first[c] + lo - self.bwt.begin[c], self.first[c] + hi - self.bwt.begin[c]

    def one_error(self, x: np.ndarray, start: np.ndarray, length: np.ndarray, exact: np.ndarray):
        """For queries x[start:start + length], given from their right end:
        (query, number of the word) where the first ``exact`` symbols agree and
        the rest differs by exactly one error."""
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), self.first[1])
        live, j, open_ = np.arange(len(start)), 0, []
        while len(live):
            q = live[exact[live] <= j]
            if len(q):
                inside = j < length[q]
                here = np.where(inside, x[np.minimum(start[q] + j, len(x) - 1)], -1)
                # one of several equal neighbours is left out once
                gone = inside & ((exact[q] == j) | (here != x[start[q] + max(j - 1, 0)]))
                open_.append((q[gone], np.full(int(gone.sum()), j + 1), lo[q[gone]], hi[q[gone]]))
                own, c, a, b = self.symbols(lo[q], hi[q])
                ok = (c > 0) & (c != here[own])
                own, a, b = own[ok], a[ok], b[ok]
                open_.append((q[own], np.full(len(own), j), a, b))          # one more
                own, a, b = own[inside[own]], a[inside[own]], b[inside[own]]
                open_.append((q[own], np.full(len(own), j + 1), a, b))      # another one
            live = live[j < length[live]]
            lo[live], hi[live] = self.extend(x[start[live] + j], lo[live], hi[live])
            live = live[hi[live] > lo[live]]
            j += 1
        if not open_:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, at, lo, hi = (np.concatenate(c) for c in zip(*open_, strict=True))
        found = []
        while len(q):
            end = at == length[q]
            c = np.where(end, 0, x[np.minimum(start[q] + at, len(x) - 1)])
            lo, hi = self.extend(c, lo, hi)
            ok = hi > lo
            found.append((q[end & ok], lo[end & ok] - 1))  # row 0 is the last delimiter
            go = ok & ~end
            q, at, lo, hi = q[go], at[go] + 1, lo[go], hi[go]
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _near_in_shard(rows: pa.Table) -> pa.Table:
    """Near pairs of a shard's rows (word, n, side, asks)."""
    out = {"word": [], "near": [], "near_n": []}
    for right in (True, False):
        part = rows.filter(pc.equal(rows.column("side"), "first" if right else "last"))
        held, asked = part.filter(pc.invert(part.column("asks"))), part.filter(part.column("asks"))
        count = dict(zip(held.column("word").to_pylist(), held.column("n").to_pylist(), strict=True))
        asked = sorted(set(asked.column("word").to_pylist()))
        if not count or not asked:
            continue
        words = sorted(w[::-1] for w in count) if right else sorted(count)
        index = OneWay(words)
        for s in range(0, len(asked), AT_ONCE):
            some = asked[s:s + AT_ONCE]
            # symbols in the order in which they are matched
            x = SYMBOL[np.frombuffer("".join(w if right else w[::-1] for w in some).encode("latin-1"), np.uint8)]
            length = np.array([len(w) for w in some])
            exact = length // 2 if right else length - length // 2
            q, t = index.one_error(x, np.cumsum(length) - length, length, exact)
            for i in np.unique(q * len(words) + t).tolist():
                near = words[i % len(words)]
                near = near[::-1] if right else near
                out["word"].append(some[i // len(words)])
                out["near"].append(near)
                out["near_n"].append(count[near])
    return pa.table([pa.array(out["word"], pa.string()), pa.array(out["near"], pa.string()),
                     pa.array(out["near_n"], pa.int64())], ["word", "near", "near_n"])


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, near, near_n) for all near words of a table (word, n) of distinct
    words of two letters or more (those of RUN, a to z in lower case)."""
    python_ready(vocab)
    ways = []
    for d in (-1, 0, 1):
        first = F.expr(f"int(floor((length(word) + {d}) / 2))")
        last = F.expr(f"length(word) + {d} - int(floor((length(word) + {d}) / 2))")
        for side, part in (("first", F.substring("word", 1, first)), ("last", F.right("word", last))):
            ways.append(F.struct(F.lit(side).alias("side"), F.lit(d == 0).alias("asks"),
                                 F.xxhash64(F.lit(side), F.length("word") + d, part).alias("half")))
    rows = vocab.select("word", "n", F.explode(F.array(*ways)).alias("way")).select("word", "n", "way.*")
    many = rows.groupBy("half").count().where(F.col("count") > HOT) \
        .select("half", F.ceil(F.col("count") / HOT).cast("int").alias("parts"))
    rows = join_small(rows, written(many, "halves"), ["half"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    # a word stands in one part of its half, and looks through all of them
    own = F.array(F.struct(F.lit(False).alias("asks"), F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part")))
    all_ = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(F.lit(True).alias("asks"), p.alias("part")))
    rows = rows.select("word", "n", "side", "half", F.explode(F.when(F.col("asks"), F.concat(own, all_)).otherwise(own)).alias("r"))
    shards = max(1, -(-6 * vocab.count() // SHARD))
    shard = F.pmod(F.xxhash64("half", "r.part"), F.lit(shards)).alias("shard")
    pairs = rows.select("word", "n", "side", "r.asks", shard).groupBy("shard").applyInArrow(
        _near_in_shard, "word string, near string, near_n long")
    return pairs.repartition("word").distinct()


def variants(vocab: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of (word, n)."""
    best = near_words(vocab).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    top = F.when(-F.col("best.n") >= ratio * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.n")).alias("form_n")))
    base = vocab.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                   top.alias("top")).select("word", "n", "n_near", "top.*")
    base = written(base, "forms")
    links = base.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        # only links whose end has a form itself go on; joined by shuffle, where AQE splits hot ends
        far = written(links.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                            F.col("next").isNotNull().alias("moved")), "roots")
        links = far.select("word", "root")
        if far.where("moved").isEmpty():
            break
    return base.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of at least LEAST_LENGTH code points and LEAST_COUNT
    occurrences, after one of MUTED runs (by a checksum of id and run) has lost
    a code point."""
    low = F.translate(F.col(f"`{text_col}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("w"))
    runs = runs.where(F.length("w") >= LEAST_LENGTH)  # a shorter run gives no word
    h = F.crc32(F.concat("id", F.lit(":"), "w").cast("binary"))
    at = (h % F.length("w")).cast("int")
    word = F.when(h % MUTED == 0, F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.length("w")))).otherwise(F.col("w"))
    return runs.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH).groupBy("word") \
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


def op13_spelling_variants(spark, sf_dir):
    return variants(written(vocabulary(documents(spark, sf_dir)), "vocabulary"))
