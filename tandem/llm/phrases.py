"""Phrase collocations by Toivonen mining (operator 11).

Words stand in pieces (texts cut at punctuation and line ends); a phrase is 2 to
LONGEST consecutive words of a piece.  All phrases of at least ``least``
occurrences in a language are found, with exact counts:

1. A sample (one document of SAMPLE, by a hash) proposes the n-grams that reach
   a lowered threshold in it.
2. One pass over all documents counts every word, and every n-gram whose first
   and last n-1 words are both proposed: those are the proposals and their
   negative border.  Border n-grams that never occur need no counting.
3. A border n-gram that turns out frequent is a failure of the sample: it joins
   the proposals, and a further pass counts it and the n-grams that it admits.
   The passes end when none failed; every frequent n-gram has then been
   counted, since all its parts are frequent too.  When the failures occur
   seldom (CLOSING), that pass counts all n-grams built on them, to any length,
   and is the last.

Tasks test "proposed" in a broadcast bit table of two bits a proposal, of 16
bits a proposal and 2^MOST_BITS bits (64 MB) at most.  A wrong hit only makes a
pass count an n-gram more, so a table that gets full costs shuffle, not results.
Proposals are counted by their text.  Border n-grams, which are many and mostly
rare, are counted by a 64-bit hash: equal hashes of different n-grams could only
make a failure too many, which the next pass then counts by its text.

A phrase's score is its lowest-scoring cut in two, 1000 * a * n / (l * r) in
decimal arithmetic.  Phrases inside a longer one that is as frequent are dropped
(``share``).  The best ``top`` of a language are ranked in two steps, so that a
language's phrases never meet in one task.

Cases: null text is empty, null language ``und``; empty and blank texts have no
words; texts of any length are read whole (a task works on at least one
document at a time); repeated rows and tied ids count each; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.common import _BASE, LOWER_CODE, _mix, documents, join_small, python_ready, steps, words, written

LEAST, LONGEST, TOP = 100, 5, 2000
SAMPLE, LOWERED = 16, 0.5
#: Share of all words up to which the failures' extensions are counted unasked.
CLOSING = 0.05
LEAST_BITS, MOST_BITS = 20, 29
#: Entries that a task collects before it adds them up and hands them on.
HELD = 1 << 20
_BUCKET = 1 << 15

BREAK = np.zeros(256, bool)
BREAK[list(b".,;:!?\n\v\f\r")] = True
SEPARATOR = BREAK.copy()
SEPARATOR[[32, 9]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


class Bits:
    """A bit table over 64-bit keys, two places a key."""

    def __init__(self, power: int, packed: np.ndarray | None = None):
        self.power = power
        self.packed = np.zeros(1 << power >> 3, np.uint8) if packed is None else packed

    def has(self, key: np.ndarray) -> np.ndarray:
        mask = _U((1 << self.power) - 1)
        out = np.ones(len(key), bool)
        for p in (key & mask, key >> _U(64 - self.power)):
            out &= (self.packed[p >> _U(3)] >> (p & _U(7)).astype(np.uint8)) & 1 > 0
        return out


def bits_of(keys: DataFrame, power: int) -> Bits:
    """The table of a column ``key``, made in Spark: the driver receives bit
    blocks, not keys."""
    place = F.explode(F.array(F.col("key").bitwiseAND(F.lit((1 << power) - 1)), F.shiftrightunsigned("key", 64 - power)))
    blocks = (keys.select(place.alias("p")).groupBy(F.shiftright("p", 15).alias("b"))
              .agg(F.bitmap_construct_agg(F.col("p") % _BUCKET).alias("bits")))
    out = Bits(power)
    for r in blocks.toLocalIterator():
        out.packed[r["b"] * _BUCKET // 8:(r["b"] + 1) * _BUCKET // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _language_codes(part) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct languages, index of each document's, hash of each)."""
    lang = part.column("lang").cast(pa.string()).dictionary_encode()
    name = [str(x).encode() for x in lang.dictionary.to_pylist()]
    code = np.array([int.from_bytes(hashlib.md5(x).digest()[:8], "little") for x in name], np.uint64)
    return lang.dictionary, lang.indices.to_numpy(), code


class Step:
    """The words of some documents, and the keys of their n-grams level by level."""

    def __init__(self, part, data, offs):
        self.langs, self.lang, code = _language_codes(part)
        self.s, self.e, self.doc, self.h = words(data, offs, SEPARATOR, LOWER_CODE)
        self.data = data
        # both parts grow along the text, so the sum differs wherever one does
        self.run = np.cumsum(BREAK[data])[self.s] + self.doc if len(data) else self.doc
        self.salt = code[self.lang[self.doc]] if len(self.doc) else np.zeros(0, np.uint64)

    def levels(self, longest: int = LONGEST):
        """(k, key of the k-gram at each word, whether it stays in one piece)."""
        raw = self.h
        for k in range(1, longest + 1):
            m = len(self.h) - k + 1
            if m < 1:
                return
            with np.errstate(over="ignore"):
                if k > 1:
                    raw = raw[:m] * _U(_BASE) + self.h[k - 1:]
                yield k, _mix(raw ^ self.salt[:m]), self.run[:m] == self.run[k - 1:]

    def texts(self, at: np.ndarray, k: np.ndarray) -> pa.Array:
        """The k words from each place, lower case, joined by one space."""
        size = self.e - self.s + 1
        start = np.cumsum(size) - size
        src = np.repeat(self.s - start, size) + np.arange(int(size.sum()))
        flat = _LOWER[self.data[np.minimum(src, len(self.data) - 1)]]
        flat[start + size - 1] = 32
        last = at + k - 1
        n = start[last] + size[last] - 1 - start[at]
        offs = np.concatenate(([0], np.cumsum(n)))
        buf = flat[np.repeat(start[at] - offs[:-1], n) + np.arange(offs[-1])]
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(buf))


def _sampled(batches):
    """(key, n) of all n-grams of the sample."""
    held, size = [], 0

    def added():
        key, of = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        n = np.bincount(of, np.concatenate([n for _, n in held])).astype(np.int64)
        return pa.record_batch([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    for part, data, offs in steps(batches):
        keys = [key[ok] for _, key, ok in Step(part, data, offs).levels()]
        key, n = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.uint64), np.zeros(0))
        held.append((key, n))
        size += len(key)
        if size > HELD:
            yield added()
            held, size = [], 0
    if held:
        yield added()


_COUNTED = "key long, phrase string, n long"


def _counter(sent):
    """Counts of what the new table admits and the old one did not: proposals
    (in a closing pass all of it) by their text after the language and a tab,
    border n-grams by their key alone; in the first pass also each language
    (with no text) and its words."""
    def run(batches):
        new, old, closing = sent.value
        for part, data, offs in steps(batches):
            st = Step(part, data, offs)
            if not len(st.h):
                continue
            ats, ks, keys, counts, border = [], [], [], [], []
            for k, key, ok in st.levels():
                m = len(key)
                if k == 1:
                    now, before = np.arange(m), np.full(m, old is not None)
                else:
                    now = np.flatnonzero(ok & in_new[:m] & in_new[1:m + 1])
                    before = (in_old[now] & in_old[now + 1]) if old is not None else np.zeros(len(now), bool)
                if not len(now):
                    break
                known, was = new.has(key[now]), np.zeros(len(now), bool)
                if old is not None:
                    was[before] = old.has(key[now[before]])
                if closing:
                    known |= ~before
                in_new, in_old = np.zeros(m, bool), np.zeros(m, bool)
                in_new[now], in_old[now] = known, was
                text = now[known & ~was]
                u, first, n = np.unique(key[text], return_index=True, return_counts=True)
                for to, x in zip((ats, ks, keys, counts), (text[first], np.full(len(u), k), u, n), strict=True):
                    to.append(x)
                border.append(key[now[~known & ~before]])
            at, k, rest = np.concatenate(ats), np.concatenate(ks), np.unique(np.concatenate(border), return_counts=True)
            texts, lang = [st.texts(at, k)], [st.lang[st.doc[at]]]
            if old is None:
                some, total = np.unique(st.lang[st.doc], return_counts=True)
                texts.append(pa.array([""] * len(some), pa.large_string()))
                lang.append(some)
                keys.append(np.zeros(len(some), np.uint64))
                counts.append(total)
            named = pc.binary_join_element_wise(st.langs.cast(pa.large_string()).take(pa.array(np.concatenate(lang))),
                                                pa.concat_arrays(texts), pa.scalar("\t", pa.large_string()))
            yield pa.record_batch([
                pa.array(np.concatenate((*keys, rest[0])).view(np.int64)),
                pa.concat_arrays([named.cast(pa.string()), pa.nulls(len(rest[0]), pa.string())]),
                pa.array(np.concatenate((*counts, rest[1])).astype(np.int64))], ["key", "phrase", "n"])

    return run


def frequent_ngrams(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang",
                    id_col: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """(lang, k, phrase, n) of every n-gram of 1 to LONGEST words with at least
    ``least`` occurrences in its language, and a row k = 0 a language with the
    number of all its words."""
    spark = python_ready(docs).sparkSession
    text, lang = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`").cast("string")
    narrow = docs.select(F.coalesce(text, F.lit("")).alias("text"), F.coalesce(lang, F.lit("und")).alias("lang"),
                         F.xxhash64(F.col(f"`{id_col}`"), text).alias("z"))
    some = narrow.where(F.pmod("z", F.lit(sample)) == 0).select("text", "lang")
    narrow = narrow.select("text", "lang")
    lowered = max(2, int(least / sample * LOWERED))
    proposed = written(some.mapInArrow(_sampled, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
                       .where(F.col("n") >= lowered).select("key"), "proposed")
    power = min(MOST_BITS, max(LEAST_BITS, (16 * proposed.count()).bit_length()))
    new, old, closing, tables = bits_of(proposed, power), None, False, []
    while True:
        sent = spark.sparkContext.broadcast((new, old, closing))
        rows = narrow.mapInArrow(_counter(sent), _COUNTED)
        counted = written(rows.groupBy("key", "phrase").agg(F.sum("n").alias("n"))
                          .where((F.col("n") >= least) | F.col("phrase").endswith("\t")), "ngrams")
        tables.append(counted.where("phrase is not null"))
        failed = counted.where("phrase is null")
        missed = failed.agg(F.sum("n")).first()[0]
        if missed is None:
            break
        total = tables[0].where(F.col("phrase").endswith("\t")).agg(F.sum("n")).first()[0]
        closing = missed <= CLOSING * total
        more = bits_of(failed, power)
        new, old = Bits(power, new.packed | more.packed), new
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    # words hold no tab, so the last one ends the language
    phrase = F.substring_index("phrase", "\t", -1)
    return out.select(F.expr("left(phrase, length(phrase) - length(substring_index(phrase, '\t', -1)) - 1)").alias("lang"),
                      F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " "))).alias("k"),
                      phrase.alias("phrase"), "n")


def _words(lo, hi):
    return F.array_join(F.slice("w", lo, hi - lo + 1), " ")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, text_col: str = "text",
                 lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n,
    score, and cut (the words before the lowest-scoring cut)."""
    found = frequent_ngrams(docs, least, text_col, lang_col, id_col, sample)
    total = found.where("k = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    parts = found.where("k > 0").select("lang", "phrase", F.col("n").alias("f"))
    phrases = found.where("k > 1").select("lang", "k", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    # a longer phrase that is as frequent has parts one word shorter that are, too
    longer = phrases.where("k > 2").select("lang", F.explode(F.array(
        _words(F.lit(1), F.col("k") - 1), _words(F.lit(2), F.col("k")))).alias("phrase"), F.col("a").alias("longer"))
    kept = phrases.join(longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer")), ["lang", "phrase"], "left") \
        .where("longer is null or longer < a")
    cuts = kept.select("lang", "phrase", "a", "k", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _words(F.lit(1), F.col("cut")).alias("first"),
                       _words(F.col("cut") + 1, F.col("k")).alias("rest"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]) \
               .join(parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = join_small(cuts, total, ["lang"])
    score = F.expr("(cast(1000 as decimal(38, 0)) * a * n) div (cast(l as decimal(38, 0)) * r)")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("c"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    out = best.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score", "c.cut")
    part = out.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))) \
        .where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")


def op11_phrase_mining(spark, sf_dir):
    return collocations(documents(spark, sf_dir)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP11_SQL = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS ws
      FROM w, range(1, {LONGEST + 1}) AS r(k)),
f AS (SELECT lang, k, ws, array_to_string(ws, ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {LEAST}),
c AS (SELECT * FROM f WHERE k > 1),
kept AS (SELECT c.* FROM c WHERE NOT EXISTS (
  SELECT 1 FROM c AS x WHERE x.lang = c.lang AND x.k > c.k AND 100 * x.f >= 100 * c.f
    AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))),
s AS (SELECT kept.lang, kept.phrase, kept.f AS a, cut, l.f AS l, r.f AS r, t.n,
        (1000::HUGEINT * kept.f * t.n) // (l.f::HUGEINT * r.f) AS score
      FROM kept, unnest(range(1, kept.k)) AS u(cut), f AS l, f AS r, t
      WHERE l.lang = kept.lang AND l.phrase = array_to_string(kept.ws[1:cut], ' ')
        AND r.lang = kept.lang AND r.phrase = array_to_string(kept.ws[cut + 1:kept.k], ' ') AND t.lang = kept.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM s)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM b WHERE nth = 1
QUALIFY rank <= {TOP}
"""
