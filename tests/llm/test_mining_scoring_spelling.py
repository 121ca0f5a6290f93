"""Phrase mining, language-model scoring and spelling variants against plain
versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_operators import LONG, SCHEMA, SF, cases, clashing, empty, lower, odd_rows, split

from tandem.llm import phrases, scoring, spelling
from tandem.llm.common import documents

# ------------------------------------------------------------------ 11 phrases


def brute_phrases(rows, least, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, counts in f.items():
        cand = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        inside = defaultdict(int)
        for g, a in cand.items():
            for i in range(len(g)):
                for j in range(i + 1, len(g) + 1):
                    if 1 < j - i < len(g):
                        inside[g[i:j]] = max(inside[g[i:j]], a)
        ranked = []
        for g, a in cand.items():
            if 100 * inside[g] >= 100 * a:
                continue
            score, _, l, r = min((1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]])
                                 for k in range(1, len(g)))
            ranked.append((-score, -a, " ".join(g).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top]):
            out.add((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return out


MARKED = [(50 + i, t, "fr", "s", 1) for i, t in enumerate(
    ["Un deux, trois quatre\tcinq  six sept.", "un DEUX trois\nquatre cinq six sept huit neuf dix onze", "a a a a a a a a",
     "é è é è é è!? é è", "x" * 3000 + " y z y z"] * 3)]


@pytest.mark.parametrize("sample,closing", [(1, 0.05), (16, 1.0), (100_000, 0.0)])
def test_phrases(spark, monkeypatch, sample, closing):
    """Whole, partial and empty samples: the passes over the border mend what a sample misses."""
    monkeypatch.setattr(phrases, "CLOSING", closing)
    for df, least in ((documents(spark, SF), 20), (clashing(odd_rows(spark, MARKED)), 2), (empty(spark), 2)):
        got = phrases.collocations(df, least=least, sample=sample).drop("cut")
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == len(set(rows))
        assert set(rows) == brute_phrases([(r.text, r.lang) for r in df.select("text", "lang").collect()], least)


def test_phrases_top_and_full_bit_table(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_BITS", 15)  # nearly every bit set: more is counted, nothing changes
    monkeypatch.setattr(phrases, "LEAST_BITS", 15)
    df = documents(spark, SF)
    rows = {tuple(r) for r in phrases.collocations(df, least=5, top=7).drop("cut").collect()}
    assert rows == brute_phrases([(r.text, r.lang) for r in df.collect()], 5, 7)
    assert max(r[1] for r in rows) == 7


# ------------------------------------------------------------------ 13 spelling

def brute_near_words(words):
    """Near words through single deletions."""
    words, near, holes = set(words), defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            less = w[:i] + w[i + 1:]
            holes[i, less].add(w)
            if less in words:
                near[w].add(less)
                near[less].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    return near


def brute_variants(rows):
    n = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near, form = brute_near_words(n), {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def misspelt(rng, word, edits):
    for _ in range(edits):
        i, c = rng.randrange(len(word)), rng.choice("abceñßÿz")
        word = rng.choice((word[:i] + word[i + 1:], word[:i] + c + word[i:], word[:i] + c + word[i + 1:]))
    return word


def test_spelling(spark):
    rng = random.Random(9)
    base = ["Straßenbahn", "aaaaaaaa", "abababababab", "mississippi", "ÉTÉÉTÉÉTÉ", "nebenwirkung", "x" * 300]
    texts = [" ".join(rng.choice(base) for _ in range(40)) for _ in range(100)]
    texts += [" ".join([misspelt(rng, w, rng.choice((1, 1, 2)))] * rng.choice((2, 3, 30))) for w in base for _ in range(60)]
    extra = [(100 + i, t, "en", "s", 1) for i, t in enumerate(texts)]
    for df in (documents(spark, SF), clashing(odd_rows(spark, extra)), empty(spark)):
        got = spelling.variants(spelling.written(spelling.vocabulary(df), "v"))
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == len({r[0] for r in rows})
        assert set(rows) == brute_variants([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    chained = [r for r in brute_variants([(i, t) for i, t, *_ in extra]) if r[1] and r[2] != r[1]]
    assert chained  # some root is two steps away


def test_near_words_over_split_shards(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SHARD", 50)
    monkeypatch.setattr(spelling, "HOT", 7)
    rng = random.Random(10)
    words = sorted({misspelt(rng, rng.choice(("verzeichnis", "verzeichnet", "aufverzeichnis", "abc", "anna")), 2) for _ in range(900)})
    words = [w for w in words if len(w) > 1]
    df = spark.createDataFrame([(w, 1 + len(w) % 4) for w in words], "word string, n long")
    got = Counter((r.word, r.near) for r in spelling.near_words(df).collect())
    assert set(got.values()) == {1}
    assert set(got) == {(w, x) for w, some in brute_near_words(words).items() for x in some}


# ------------------------------------------------------------------- 12 scoring

def brute_scores(rows, m2=scoring.M2, m3=scoring.M3):
    """The smoothed probabilities by their formulas, token by token."""
    docs = [(i, lower(t)) for i, t in rows]
    docs = [(i, split(t) + [None]) for i, t in docs]  # None: the end
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs]
    c = Counter()
    for (_, w), h in zip(docs, held, strict=True):
        if not h:
            s = ["<start>", *w]
            for k in (1, 2, 3):
                c.update((k, *s[j:j + k]) for j in range(1 if k == 1 else 0, len(s) - k + 1))
            c[1, "<start>"] += 1
    n = sum(v for g, v in c.items() if g[0] == 1 and g[1] != "<start>")
    v = sum(1 for g in c if g[0] == 1 and g[1] != "<start>")
    out = []
    for (i, w), h in zip(docs, held, strict=True):
        s, base, score = ["<start>", *w], 0.0, 0.0
        for j in range(1, len(s)):
            p = (c[1, s[j]] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p)
            p = (c[2, s[j - 1], s[j]] + m2 * p) / (c[1, s[j - 1]] + m2)
            if j > 1:
                p = (c[3, s[j - 2], s[j - 1], s[j]] + m3 * p) / (c[2, s[j - 2], s[j - 1]] + m3)
            score += math.log10(p)
        out.append((i, h, len(w), sum(c[1, x] > 0 for x in w), n, base, score))
    return out


def same_scores(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 3), round(r[6], 3))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6, rel=1e-9) and a[6] == pytest.approx(b[6], abs=1e-6, rel=1e-9)


def test_scoring(spark, monkeypatch):
    monkeypatch.setattr(scoring, "SHARD", 40_000)  # many small shards
    for df in cases(spark):
        same_scores(scoring.scored(df).collect(), brute_scores([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]))
    copies = spark.createDataFrame([(i, t) for i, t in enumerate([LONG, "a b  A b"] * 20)], "doc_id long, text string")
    got = defaultdict(set)
    for r in scoring.scored(copies).collect():
        got[r.n_tokens].add(r.score)
    assert {len(v) for v in got.values()} == {1}


def test_scoring_query_and_held_out_gain(spark):
    got = scoring.op12_lm_scoring(spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = got.where("held_out").collect()
    assert sum(r.score for r in rows) > 0.97 * sum(r.base_score for r in rows)  # both negative
    docs = documents(spark, "/root/testdata/sf0.01")
    same_scores(got.collect(), brute_scores([(r.doc_id, r.text) for r in docs.collect()]))


def test_scoring_without_training_documents_and_unstable_input(spark):
    one = spark.createDataFrame([(i, "a b") for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    assert {(r.train_tokens, r.n_known, r.score, r.base_score) for r in scoring.scored(one).collect()} == {(0, 0, 0.0, 0.0)}
    drawn = F.udf(lambda i: f"{i} {random.random()}").asNondeterministic()
    moving = spark.range(200).select(F.col("id").alias("doc_id"), drawn("id").alias("text"))
    with pytest.raises(Exception, match="another order"):
        scoring.scored(moving).collect()
