"""Each operator against a brute-force version, over the small tables and over
rows with nulls, empty and very long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.llm import (decontaminate, fmindex, language, license_rules, licenses, mixing, partenum, pivots, quality,
                        range_coder, sharding, substrings, token_files)
from tandem.llm.common import connected_components, documents
from tandem.session import read_table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} x{i % 31}" for i in range(30_000))


def odd_rows(spark, extra=()):
    """Nulls in every column, empty, blank and very long texts, repeated rows, tied ids."""
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "té") for b in ("n", "st", "r", "v", "q")]
    body = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(4)]
    rows = [(1, None, None, None, None), (2, "", "en", "s0", 0), (3, " \n\t ", "en", "s0", 4), (4, body[0], "en", "s0", 1),
            (5, body[0], "en", "s1", 1), (6, body[0] + " " + body[1], "de", "s1", 1), (6, body[0] + " " + body[1], "de", "s1", 1),
            (7, body[2], "de", "s0", 1), (7, body[3], "fr", "s2", 1), (None, body[2], None, "s2", 1),
            (8, LONG, "en", "s0", 1), (9, LONG + " tail", "en", "s0", 1), (10, "one", "en", None, 3), (11, "ONE", "en", "s0", 3)]
    return spark.createDataFrame(rows + list(extra), SCHEMA)


def clashing(df):
    """Extra columns with the names that the operators use inside."""
    for c in ("row", "sid", "score", "g", "part", "shard", "n_copies", "tkey", "_tkey", "_src", "rate", "z", "rn", "k"):
        df = df.withColumn(c, F.lit("x"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text, sep="[^\x20\x09-\x0D]+"):
    return re.findall(sep, text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def cases(spark):
    return [documents(spark, SF), clashing(odd_rows(spark)), empty(spark)]


# ------------------------------------------------------------------ 1 licences

def brute_licenses(text):
    w = split(lower(text), "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    joined = " " + " ".join(w) + " "
    found = []
    for i, r in enumerate(license_rules.rules()):
        for m in re.finditer(rf"(?<= )(?:{r.pattern})(?= )", joined):
            start = joined.count(" ", 0, m.start()) - 1
            found.append((start, start + m[0].count(" ") + 1, r.priority, i, r))
    kept = [a for a in found if not any(
        b[0] <= a[0] and a[1] <= b[1] and (b[2], b[1] - b[0], -b[3]) > (a[2], a[1] - a[0], -a[3]) for b in found)]
    base = [a[0] for a in found if a[4].base]
    names = {a[4].label for a in found if a[4].base}
    return (len(w), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(names)),
            ",".join(sorted(names | {a[4].label for a in kept})), max((a[4].weight for a in kept), default=0.0))


LICENSED = ["Licensed under CC BY-NC 4.0.", "MIT License. mit license\nMIT  LICENSE", "GNU General Public License v3 or later",
            "SPDX-License-Identifier: Apache-2.0 license; see the Apache License, Version 2.0", "cc by cc by cc by",
            "released under the terms of the GNU Lesser General Public License version 2.1", "all rights reserved",
            "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0", "gnu affero general public license"]


def test_licenses(spark):
    extra = [(100 + i, t, "en", "s", 1) for i, t in enumerate(LICENSED)] + [(200, " ".join(LICENSED * 40), "en", "s", 1)]
    for df in (documents(spark, SF), clashing(odd_rows(spark, extra)), empty(spark)):
        got = Counter(tuple(r) for r in licenses.scan(df).select(
            "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect())
        want = Counter((r.doc_id, *brute_licenses(r.text)) for r in df.select("doc_id", "text").collect())
        assert got == want


def test_license_rules_pass_their_gates():
    rules = license_rules.rules()
    assert len(rules) > 200
    for t in LICENSED:
        joined = " " + " ".join(split(lower(t), "[a-z0-9]+")) + " "
        for r in rules:
            if re.search(rf"(?<= )(?:{r.pattern})(?= )", joined):
                assert r.keyword in joined and any(g in joined for g in license_rules.GATES)


def generated(parsed, rng):
    """A random text that the parsed pattern matches."""
    out = ""
    for op, av in parsed:
        op = str(op)
        if op == "LITERAL":
            out += chr(av)
        elif op == "IN":
            kind, x = rng.choice(av)
            out += chr(x if str(kind) == "LITERAL" else rng.randint(*x))
        elif op == "BRANCH":
            out += generated(rng.choice(av[1]), rng)
        elif op == "SUBPATTERN":
            out += generated(av[3], rng)
        else:
            assert op in ("MAX_REPEAT", "MIN_REPEAT"), op
            out += "".join(generated(av[2], rng) for _ in range(rng.randint(av[0], min(av[1], av[0] + 2))))
    return out


def test_every_branch_of_every_rule_passes_gate_and_keyword():
    from re import _parser
    rng = random.Random(3)
    for r in license_rules.rules():
        parsed = _parser.parse(r.pattern)
        for _ in range(300):
            text = generated(parsed, rng)
            assert re.fullmatch(r.pattern, text)
            assert r.keyword in text and any(g in text for g in license_rules.GATES), (r.label, text)


def test_licenses_without_the_word(spark):
    texts = {"see copying file": "see-license", "new BSD": "bsd-3-clause", "FreeBSD": "bsd-2-clause", "original bsd": "bsd-4-clause",
             "All advertising materials mentioning features or use of this software": "bsd-4-clause",
             "Neither the name of X nor the names of its contributors may be used to endorse": "bsd-3-clause"}
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.labels for r in licenses.scan(df).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts.values())


def test_licenses_stay_in_the_jvm(spark):
    plan = licenses.op1_license_scan(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -------------------------------------------------------------- 2 substrings

def brute_repeats(rows, span=20):
    """rows: (document key, text) in order; repeated keys are one document."""
    seen, out = {}, {}
    for key, text in rows:
        if key in out:
            continue
        w, gone = split(text), set()
        for i in range(len(w) - span + 1):
            if seen.setdefault(tuple(w[i:i + span]), (key, i)) != (key, i):
                gone.update(range(i, i + span))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[key] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substrings_on_tables(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        docs = documents(spark, sf)
        got = {r[0]: tuple(r)[1:] for r in substrings.op2_substring_dedup(spark, sf).collect()}
        assert got == brute_repeats((r.doc_id, r.text) for r in docs.orderBy("doc_id").select("doc_id", "text").collect())


def test_substrings_odd_rows(spark):
    df = clashing(odd_rows(spark))
    order = df.select("doc_id", "text", F.pmod(F.xxhash64("text"), F.lit(1 << 31)).alias("t")).collect()
    order.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.t))
    want = brute_repeats(((r.doc_id, r.t), r.text) for r in order)
    got = Counter((r[0], *tuple(r)[1:4]) for r in substrings.remove_repeats(df).collect())
    assert got == Counter((r.doc_id, *want[r.doc_id, r.t]) for r in order)
    assert substrings.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [1000, 0])
def test_hot_anchor_windows(spark, monkeypatch, hot):
    """One passage in many different contexts; with a limit of 0 every segment
    is dealt as single windows."""
    monkeypatch.setattr(substrings, "HOT_ANCHOR", hot)
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(5000)}"
    passage = " ".join(word() for _ in range(45))
    rows = [(i, " ".join([*(word() for _ in range(15)), passage, *(word() for _ in range(15))]), "en", "s", 1) for i in range(120)]
    got = {r[0]: tuple(r)[1:4] for r in substrings.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute_repeats((r[0], r[1]) for r in rows)


def test_matching_statistics():
    rng = np.random.default_rng(3)
    text = np.concatenate([np.append(rng.integers(1, 5, 40), 0) for _ in range(8)])
    index = fmindex.FMIndex(text, 5)
    stream = rng.integers(1, 6, 60) % 5
    length, _ = index.matching_statistics(stream, np.arange(60), 12)
    parts = "".join(map(str, text.tolist()))
    s = "".join(map(str, stream.tolist()))
    for e in range(60):
        best = 0
        for k in range(1, 13):
            p = s[e - k + 1:e + 1] if e - k + 1 >= 0 else None
            if p is None or "0" in p or sum(parts.startswith(p, i) for i in range(len(parts))) < 2:
                break
            best = k
        assert length[e] == best


# ---------------------------------------------------------- 3 n-gram Jaccard

def brute_near(rows, k, num, den):
    """rows: (id, text) -> id: (set size, component), by an inverted list of shingles."""
    sets = {}
    for i, t in rows:
        w = split(lower(t))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    lists = defaultdict(list)
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in lists[x]).items():
            if den * n >= num * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for x in s:
            lists[x].append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 4, 5)])
def test_near_duplicates_on_tables(spark, k, num, den):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = {r[0]: tuple(r)[1:] for r in partenum.near_duplicates(docs, k, num, den).collect()}
    assert got == brute_near(((r.doc_id, r.text) for r in docs.collect()), k, num, den)


def test_near_copies_at_the_threshold(spark):
    """Chains of copies with a few changed words, around the threshold."""
    rng = random.Random(9)
    rows, doc = [], [f"a{rng.randrange(900)}" for _ in range(200)]
    for i in range(150):
        base = doc if i % 3 else rows[-1][1].split(" ") if rows else doc
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"b{rng.randrange(900)}"
        if rng.random() < 0.3:
            w = w[:len(w) - rng.randrange(15)]
        rows.append((i, " ".join(w), "en", "s", 1))
    for n2, k2 in ((2, 1), (3, 1), (4, 2), (1, 0)):
        got = {r[0]: tuple(r)[1:] for r in partenum.near_duplicates(
            spark.createDataFrame(rows, SCHEMA), 3, 90, 100, n2=n2, k2=k2).collect()}
        assert got == brute_near(((r[0], r[1]) for r in rows), 3, 90, 100)


def test_large_signature_groups_are_tiled(spark):
    """Groups over several tiles give the same components as all their pairs,
    and no task holds more than two tiles of a group."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 3, (40, partenum.CELLS))
    rows, member = [], []
    for i in range(900):
        x = base[rng.integers(40)].copy()
        x[rng.integers(0, partenum.CELLS, rng.integers(0, 40))] += 1
        rows.append((i, int(x.sum()), bytes(x.astype(np.uint8))))
        member.append((i % 3 if i < 200 else 3, i))
    reps = spark.createDataFrame(rows, "sid long, n_shingles long, cells binary").repartition(4)
    held = spark.createDataFrame(member, "sig long, sid long").repartition(3)
    edges = set()
    cells = np.array([list(r[2]) for r in rows], np.int64)
    size = cells.sum(axis=1)
    for sig in range(4):
        ids = np.array([i for s, i in member if s == sig])
        for i in ids:
            apart = np.abs(cells[ids] - cells[i]).sum(axis=1)
            edges |= {(int(i), int(j)) for j in ids[9 * apart <= size[ids] + size[i]] if j > i}
    want = partenum._components(900, *np.array(sorted(edges)).T)
    for tile in (60, 10_000):
        df = partenum.possible_links(held, reps, 4, 5, tile)
        got = np.array([(r.a, r.b) for r in df.collect()])
        assert (partenum._components(900, *got.T) == want).all()
    assert len(set(want.tolist())) < 900


def test_near_duplicates_odd_rows(spark):
    df = clashing(odd_rows(spark))
    got = Counter((r.doc_id, r.component_id) for r in partenum.near_duplicates(df, 3, 90, 100).collect())
    assert got[(1, 1)] == got[(2, 2)] == got[(3, 3)] == 1  # wordless: alone
    assert got[(4, 4)] == got[(5, 4)] == 1 and got[(6, 6)] == 2
    assert got[(8, 8)] == got[(9, 8)] == 1 and got[(10, 10)] == got[(11, 10)] == 1
    assert got[(None, 7)] == 1 and got[(7, 7)] == 2
    kept = partenum.keep_one(df, k=3, num=90, den=100)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 6, 7, 7, 8, 10, None])
    assert partenum.near_duplicates(empty(spark)).count() == 0 == partenum.keep_one(empty(spark)).count()


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(80), 100 + rng.randrange(80)) for _ in range(60)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    real = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root[x] for x in real}


# ------------------------------------------------------------------ 4 vectors

def brute_vectors(rows, threshold=0.95):
    ok = {i: np.array(v, float) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)}
    ids = sorted(ok)
    x = np.array([ok[i] / np.linalg.norm(ok[i]) for i in ids])
    s = x @ x.T >= threshold
    np.fill_diagonal(s, False)
    lab = np.arange(len(ids))
    for _ in ids:
        lab = np.array([min([lab[i], *lab[s[i]]]) for i in range(len(ids))])
    out = {i: (0, i, True) for i, _ in rows}
    return out | {i: (int(s[k].sum()), ids[lab[k]], ids[lab[k]] == i) for k, i in enumerate(ids)}


def test_vectors(spark):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal((30, 16))
    v = [centre[i % 30] + rng.standard_normal(16) * 0.09 for i in range(400)]
    rows = [(i, x.astype("f4").tolist()) for i, x in enumerate(v)] + [(500 + i, v[0].astype("f4").tolist()) for i in range(30)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15), (904, [1e-30] * 16),
             (905, [float("inf")] * 16)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pivots.near_vectors(
        df.withColumn("cls", F.lit(1)), pivots=64, tile=64).collect()}
    want = brute_vectors(rows)
    assert got.keys() == want.keys()
    links = sum(n for n, _, _ in want.values())
    assert sum(n for n, _, _ in got.values()) >= 0.9 * links
    assert all(got[i][0] <= want[i][0] for i in got)
    assert all(got[i] == want[i] for i in range(900, 906)) and got[529][0] >= 29
    # most vectors in one dense group, from which most of the sample comes
    dense = [(i, (centre[0] + rng.standard_normal(16) * 0.09).astype("f4").tolist(), 1) for i in range(300)]
    both = spark.createDataFrame(dense + [(1000 + r[0], r[1], 1) for r in rows[:100]], df.schema)
    want = brute_vectors([(r.vec_id, r.embedding) for r in both.collect()])
    got = {r.vec_id: r.n_links for r in pivots.near_vectors(both, pivots=32, tile=64).collect()}
    assert sum(got.values()) >= 0.95 * sum(n for n, _, _ in want.values())
    assert pivots.near_vectors(df.limit(0)).count() == 0
    assert pivots.near_vectors(df.where("vec_id > 900 and vec_id < 904")).count() == 3


# ----------------------------------------------------------------- 5 language

def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = language.op5_language_id(spark, sf)
    rows = got.join(documents(spark, sf).select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    crc = {r.doc_id: r.held_out for r in got.collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in crc.items())


def test_kneser_ney_probabilities(spark):
    """Against a direct computation; each context's probabilities sum to one."""
    text = "abab cab abba"
    df = spark.createDataFrame([("x", text), ("x", "bab")], "lang string, text string")
    counts = {r.g: r.n for r in language.gram_counts(df, 3).collect()}
    brute = Counter()
    for t in (text, "bab"):
        t = f" {t} "
        for i in range(len(t) - 2):
            brute[sum(ord(c) << (16 * (2 - j)) for j, c in enumerate(t[i:i + 3]))] += 1
    assert counts == brute
    tables = [{r.g: r.p for r in p.collect()} for p, _ in language.probabilities(language.gram_counts(df, 3), 3)]
    bows = [{r.ctx: r.bow for r in b.collect()} for _, b in language.probabilities(language.gram_counts(df, 3), 3)]
    low = lambda g, k: tables[k - 1].get(g) if g in tables[k - 1] else (
        bows[k - 1].get(g >> 16 if k > 1 else 0, 1.0) * (low(g & ((1 << 16 * (k - 1)) - 1), k - 1) if k > 1 else 2.0 ** -16))
    for ctx in {g >> 16 for g in counts}:
        known = {g & 0xFFFF for t in tables for g in t}
        total = sum(low(ctx << 16 | c, 3) for c in known) + (65536 - len(known)) * low(ctx << 16 | 0xFFFF, 3)
        assert abs(total - 1) < 1e-9


def test_language_odd_rows(spark):
    df = clashing(odd_rows(spark, [(20, "12 34 !!", "en", "s", 1), (21, "é", "fr", "s", 1), (22, "a\U0001D4D0", "de", "s", 1)]))
    got = {r.doc_id: r for r in language.identify(df, language.train(df)).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 20))
    assert got[21].lang_pred in ("en", "de", "fr") and got[8].lang_pred == "en"
    none = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(none, language.train(none)).collect()} == {"und"}
    assert language.identify(empty(spark), language.train(empty(spark))).count() == 0


def test_language_keeps_rare_grams(spark):
    """A 4-gram seen once in more than 2**22 characters stays in counts and arrays."""
    rows = [(i, LONG, "en", "s", 1) for i in range(40)] + [(50, "zqxj", "en", "s", 1), (51, "zqxj", "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = language.train(df)
    known = df.where(~language.held_out(F.col("doc_id"))).select("lang", "text")
    counts = {r.g: r.n for r in language.gram_counts(known).collect()}
    rare = sum(ord(c) << (16 * (3 - j)) for j, c in enumerate("zqxj"))
    assert 0 < counts[rare] * (1 << 22) < sum(counts.values())
    assert set(counts) == {r.g for r in model.tables[3][0].collect()}
    arrays = model.model()
    assert len(arrays.grams[3][0]) == len(counts)
    assert not np.isnan(arrays.look(arrays.grams[3], np.array([rare], np.uint64))).any()


def test_language_in_slices(spark, monkeypatch):
    """Many passes over slices of the model give what one pass over all of it gives."""
    extra = [(20, "12 34 !!", "en", "s", 1), (21, "é", "fr", "s", 1), (22, "a\U0001D4D0", "de", "s", 1)]
    df = odd_rows(spark, extra).union(documents(spark, SF))
    rows = lambda m: sorted(((r.doc_id, r.lang_pred, r.rejected, r.n_letters, round(r.score, 6), round(r.cross_entropy, 6))
                             for r in language.identify(df, m).collect()), key=str)
    one = language.train(df)
    monkeypatch.setattr(language, "SLICE_BYTES", 1 << 16)
    many = language.train(df)
    assert one.n_slices == 1 and many.n_slices > 2
    whole, parts = one.model(), [many.model(s) for s in range(many.n_slices)]
    assert sum(len(m.grams[3][0]) for m in parts) == len(whole.grams[3][0])
    assert max(len(m.grams[3][0]) for m in parts) < len(whole.grams[3][0])
    assert rows(many) == rows(one)


# -------------------------------------------------------------- 6 token files

def test_range_coder_round_trip():
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 50257, n).astype(np.int32) for n in (1, 2, 3000, 517)] + [
        np.full(900, 65535, np.int32), np.zeros(4096, np.int32), (np.arange(2000) % 7).astype(np.int32)]
    coded = range_coder.encode(blocks)
    for a, b in zip(blocks, range_coder.decode(coded, [len(b) for b in blocks]), strict=True):
        assert (a == b).all()
    assert len(coded[5]) < 60 and len(coded[6]) < 1200
    alone = range_coder.decode(coded[3:4], [517])[0]  # blocks are independent
    assert (alone == blocks[3]).all()


def test_frames_check_their_blocks():
    frame = token_files.pack_frames([([5, None], [np.arange(10, dtype=np.int32), np.array([7, 0], np.int32)])])[0]
    ids, size, flat = next(token_files.unpack_frames([frame]))
    assert ids == [5, None] and size.tolist() == [10, 2] and flat.tolist() == [*range(10), 7, 0]
    with pytest.raises(ValueError):
        list(token_files.unpack_frames([frame[:-6] + bytes([frame[-6] ^ 1]) + frame[-5:]]))


def test_frames_take_less_than_order_0(spark, monkeypatch):
    texts = [r.text or "" for r in documents(spark, "/root/testdata/sf0.01").select("text").limit(300).collect()]
    docs = token_files.Encoder()(texts)
    steps = []
    predict = range_coder._Model.predict
    monkeypatch.setattr(range_coder._Model, "predict", lambda self, *a: (steps.append(1), predict(self, *a))[1])
    frame = token_files.pack_frames([(list(range(len(docs))), docs)])[0]
    assert len(steps) <= token_files.BLOCK_IDS  # one an id, not one a bit
    flat = np.concatenate(docs)
    n = np.bincount(flat)
    entropy = -(n[n > 0] * np.log2(n[n > 0] / len(flat))).sum() / 8
    index = 13 * len(docs) + 12 * -(-len(flat) // token_files.BLOCK_IDS)
    assert len(frame) - index < entropy
    assert (next(token_files.unpack_frames([frame]))[2] == flat).all()


def test_broken_prior_is_an_error():
    prior = range_coder.Prior.fit(np.arange(500, dtype=np.int32) % 11).pack()
    with pytest.raises(ValueError):
        range_coder.Prior.unpack(prior[:20] + bytes([prior[20] ^ 255]) + prior[21:])


def test_priors_of_any_number_of_ids():
    rng = np.random.default_rng(1)
    every = rng.permutation(1 << 16).astype(np.int32)  # each id once: no frequency to spare
    skewed = np.minimum(rng.geometric(0.3, 70_000), 65_535).astype(np.int32)
    for ids in (every, skewed, np.full(1, 65_535, np.int32), np.zeros(50_000, np.int32)):
        prior = range_coder.Prior.unpack(range_coder.Prior.fit(ids).pack())
        cut = [ids[s:s + 1000] for s in range(0, len(ids), 1000)]
        coded = range_coder.encode(cut, [prior], [0] * len(cut))
        back = range_coder.decode(coded, [len(c) for c in cut], [prior], [0] * len(cut))
        assert (np.concatenate(back) == ids).all()


def test_cut_equals_the_pattern():
    import public_tokenizers
    import regex
    pattern, kinds, rng = regex.compile(public_tokenizers.PATTERN), token_files._kinds(), random.Random(2)
    for chars in ("ab '\n\t\u00a0\u3000\u200b\x85\x1cé1²½_-.,!?sS'tll'ré中😀\x00\r\uffff\U0010ffff", " ''stremvld\nx1"):
        texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(30))) for _ in range(4000)]
        pieces, ends = token_files._cut(texts, kinds)
        pieces, begin = pieces.to_pylist(), 0
        for text, end in zip(texts, ends.tolist(), strict=True):
            assert pieces[begin:end] == pattern.findall(text)
            begin = end + 1


def test_piecewise_encoding_equals_the_library():
    rng = random.Random(1)
    chars = "ab '\n\t\u00a0\u3000\u200b\x85\x1cé1²½_-.,!?sS'tll'ré中😀\x00\r"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["", "a<|endoftext|>b", "<|endoftext|>", LONG]
    plain = token_files.tokenizer().encode_batch(texts, add_special_tokens=False)
    enc = token_files.Encoder(kept=50)
    for s in range(0, len(texts), 97):
        for a, b in zip(plain[s:s + 97], enc(texts[s:s + 97]), strict=True):
            assert a.ids == b.tolist()


def test_token_files(spark, tmp_path):
    tok = token_files.tokenizer()
    for name, df in (("a", documents(spark, SF)), ("b", clashing(odd_rows(spark)))):
        token_files.write_token_files(df, str(tmp_path / name))
        got = [tuple(r) for r in token_files.read_token_files(spark, str(tmp_path / name)).collect()]
        rows = sorted(((r.doc_id, r.text) for r in df.collect()),
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
        want, at = [], 0
        for i, t in rows:
            ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
            want.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
            at += len(ids)
        assert sorted(got, key=lambda r: r[1]) == want
    token_files.write_token_files(empty(spark), str(tmp_path / "c"))
    assert token_files.read_token_files(spark, str(tmp_path / "c")).count() == 0


# ------------------------------------------------------------------ 7 quality

def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = quality.op7_quality_cnn(spark, sf).join(read_table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    good = [r.score for r in got if r.quality == 1]
    bad = [r.score for r in got if r.quality == 0]
    auc = np.mean(np.array(good)[:, None] > np.array(bad)[None])
    assert auc > 0.98 and np.mean([r.predicted == r.quality for r in got]) > 0.97


def plain_quality(p, text):
    """The score of one text, position by position."""
    raw = (text or "").encode()
    feats = []
    for s in range(0, max(1, len(raw) - (quality.CHUNK - quality.STRIDE)), quality.STRIDE):
        chunk = raw[s:s + quality.CHUNK].ljust(quality.CHUNK, b"\0")
        e = p["emb"][list(chunk)].astype(float)
        best = np.max([e[i:i + quality.WIDTH].reshape(-1) @ p["conv"] for i in range(quality.CHUNK - quality.WIDTH + 1)], axis=0)
        feats.append(np.maximum(np.maximum(best + p["bias"], 0) @ p["dense"] + p["dbias"], 0))
    z = np.mean(feats, axis=0) @ p["mean"] + np.max(feats, axis=0) @ p["max"] + p["out"][0]
    return 1 / (1 + np.exp(-(z * p["scale"] + p["shift"])))


def test_quality_equals_the_plain_network_and_equal_texts_get_equal_scores(spark):
    docs, labels = documents(spark, SF), read_table(spark, SF, "labels")
    w = quality.train(docs, labels)
    rows = [r for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r.score for r in quality.op7_quality_cnn(spark, SF).collect()}
    assert all(abs(got[r.doc_id] - plain_quality(w, r.text)) < 1e-4 for r in rows[:40])
    # the same texts among others, in other steps and at other places of a step
    mixed_up = spark.createDataFrame([(i, t) for i, t in enumerate([r.text for r in rows[:60]] * 3 + ["#", "", None])],
                                     "doc_id long, text string").repartition(5)
    by_text = defaultdict(set)
    for r in quality.scored(mixed_up, w).collect():
        by_text[r.row.text or ""].add(r.score)
    for r in rows[:60]:
        by_text[r.text or ""].add(got[r.doc_id])
    assert all(len(v) == 1 for v in by_text.values())


def test_quality_covers_whole_texts_and_odd_rows(spark):
    rng = random.Random(5)
    fine = lambda n: " ".join(rng.choice(["the", "river", "ran", "under", "old", "stone", "bridges"]) for _ in range(n))
    junk = lambda n: " ".join("####" for _ in range(n))
    rows = [(i, fine(60) if i % 2 else junk(60), "en", "s", 1) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)] + [(None, 1, 0), (1, None, 0)],
                                   "doc_id long, quality int, toxic int")
    w = quality.train(spark.createDataFrame(rows, SCHEMA), labels)
    x, owner = quality.chunks_of(np.frombuffer((fine(2000) + junk(300)).encode(), np.uint8),
                                 np.array([0, len(fine(0)) + 0, 5000]))
    assert owner.tolist().count(1) == len(quality.chunk_starts(5000)) and x.shape[1] == quality.CHUNK
    df = clashing(odd_rows(spark))
    got = quality.scored(df, w)
    assert got.select("row.*").columns == df.columns and got.count() == 14
    s = {r.row.doc_id: r.score for r in got.collect()}
    assert all(0 <= v <= 1 for v in s.values()) and s[1] == s[2]
    assert quality.keep_good(empty(spark), w).count() == 0
    assert quality.train(df, labels.where("quality = 1"))["prior"] == 1.0
    assert quality.scored(df, quality.train(df, labels.limit(0))).where("score = 1").count() == 14


# ------------------------------------------------------------------- 8 mixing

def test_mixing(spark):
    n = 4000
    rows = [(i, f"t{i}", "en", "big" if i % 3 else f"s{i % 9}", 1) for i in range(n)]
    df = clashing(spark.createDataFrame(rows, SCHEMA))
    out = mixing.replicate(df, weights={"big": 1.0, "s0": 1.0, "s3": 2.0}, rows=8000)
    got = Counter(r.row.source for r in out.collect())
    assert set(got) == {"big", "s0", "s3"}
    for s, w in (("big", 0.25), ("s0", 0.25), ("s3", 0.5)):
        assert abs(got[s] - 8000 * w) < 5 * (8000 * w) ** 0.5
    flat = mixing.mixed(df, weights={"s3": 1.0}, rows=300_000)  # a rate of several hundred
    k = flat.groupBy("doc_id").count().agg(F.avg("count"), F.var_samp("count")).first()
    assert abs(k[0] - 675) < 10 and 0.7 < k[1] / 675 < 1.35
    assert flat.columns == df.columns
    again = mixing.replicate(df, weights={"big": 1.0, "s0": 1.0, "s3": 2.0}, rows=8000)
    assert Counter((r.row.doc_id, r.copy, r.place) for r in again.collect()) == Counter(
        (r.row.doc_id, r.copy, r.place) for r in out.collect())
    assert mixing.replicate(odd_rows(spark), rows=2000).where("row.source is null").count() > 0
    assert mixing.replicate(empty(spark)).count() == 0


def test_mixing_query_carries_whole_documents(spark):
    docs = documents(spark, SF)
    got = mixing.op8_poisson_mixing(spark, SF)
    assert got.columns == docs.columns + ["n_copies", "copy", "place"]
    rows = {r.doc_id: tuple(r) for r in docs.collect()}
    got = got.collect()
    assert got and all(tuple(r)[:len(docs.columns)] == rows[r.doc_id] for r in got)
    assert [r.place for r in got] == sorted(r.place for r in got)


# ----------------------------------------------------------- 9 decontamination

def test_decontamination(spark):
    rng = random.Random(6)
    word = lambda p: f"{p}{rng.randrange(400)}"
    items = [(i, " ".join(word("q") for _ in range(20)) + ". " + " ".join(word("q") for _ in range(10)) + ".") for i in range(12)]
    items += [(12, "only four words here"), (13, ""), (14, None), (0, items[0][1])]
    fill = lambda n: " ".join(word("q") if rng.random() < 0.3 else word("z") for _ in range(n))
    rows, want = [], set()
    for d in range(60):
        t = fill(rng.randrange(5, 400))
        if d % 4 == 0:
            i = d % 12
            w = items[i][1].split()
            if d % 8 == 0:  # a paraphrase: a few words changed, the answer kept
                for _ in range(6):
                    w[rng.randrange(20)] = word("z")
            t += " " + " ".join(w) + " " + fill(30)
            want.add((d, i))
        rows.append((d, t, "en", "s", 1))
    rows.append((70, "see ONLY four, words here!", "en", "s", 1))
    rows.append((71, "only four other words here", "en", "s", 1))
    want |= {(70, 12)}
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = clashing(spark.createDataFrame(rows, SCHEMA).union(odd_rows(spark)))
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    assert got == want
    blocks = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench, block=5).collect()}
    assert blocks == want
    left = decontaminate.remove(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - len({d for d, _ in want})
    assert decontaminate.matches(empty(spark), bench).count() == 0 == decontaminate.matches(docs, bench.limit(0)).count()


def test_decontamination_pages_past_null_ids(spark):
    """More items without an id than a block holds: those after them are searched too."""
    text = lambda i: " ".join(f"n{i}x{j}" for j in range(20))
    items = [(None, text(i)) for i in range(5)] + [(i, text(i)) for i in range(5, 9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, f"before {text(i)} after", "en", "s", 1) for i in range(9)], SCHEMA)
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench, block=3).collect()}
    assert got == {(i, None if i < 5 else i) for i in range(9)}


def test_decontamination_finds_all_exact_passages(spark):
    sf = "/root/testdata/sf0.01"
    flat = lambda t: " " + " ".join(split(lower(t), "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")) + " "
    texts = {r.doc_id: flat(r.text) for r in documents(spark, sf).collect()}
    items = {r.item_id: flat(r.text) for r in read_table(spark, sf, "benchmark").collect()}
    want = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id) for r in decontaminate.op9_benchmark_decontamination(spark, sf).collect()}
    assert want <= got and len(got) <= 1.1 * len(want)


def test_latent_space_is_the_leading_subspace(spark):
    """The projection keeps the cosines of the exact truncated SVD."""
    rng = np.random.default_rng(1)
    topic = rng.random((5, 60)) ** 6
    docs = []
    for i in range(80):
        p = topic[i % 5] / topic[i % 5].sum()
        docs.append((i, " ".join(f"w{t}" for t in rng.choice(60, 64, p=p)), "en", "s", 1))
    items = decontaminate.Items([0], [" ".join(f"w{t}" for t in range(60))])
    sc = spark.sparkContext
    hits = spark.createDataFrame(docs, SCHEMA).select("doc_id", F.md5("text").alias("tkey"), "text").mapInArrow(
        decontaminate._find_hits(sc.broadcast(items.vocab)),
        "doc_id long, tkey string, n_words long, pos array<int>, term array<int>").checkpoint()
    idf = np.linspace(1, 3, 60)
    v = decontaminate.latent_space(hits, items, idf, rank=5)
    a = np.zeros((81, 60))
    a[80] = idf
    for i, t, *_ in docs:
        for w, n in Counter(t.split()).items():
            k = items.seq[0][int(w[1:])]
            a[i, k] = n * idf[k]
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    a[80] *= 80 ** 0.5
    exact = np.linalg.svd(a)[2][:5]
    overlap = np.linalg.svd(exact @ v)[1]
    assert overlap.min() > 0.98


# ---------------------------------------------------------------- 10 sharding

def brute_capacity(sizes, n):
    lo, hi = -(-sum(sizes) // n), sum(sizes)
    while lo < hi:
        mid, used, at = (lo + hi) // 2, 1, 0
        for s in sizes:
            if at + s > mid:
                used, at = used + 1, 0
            at += s
        if used <= n and max(sizes) <= mid:
            hi = mid
        else:
            lo = mid + 1
    return lo


def test_sharding(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BLOCKS", 64)  # several rounds of refining
    extra = [(1000 + i, "copy " * 30, "en", "s", 1) for i in range(500)] + [(3000 + i, f"d{i} " * (i % 50), "en", "s", 1) for i in range(700)]
    for df in (documents(spark, SF), clashing(odd_rows(spark, extra)), empty(spark)):
        got = sharding.assign_shards(df, 40).collect()
        rows = df.select("doc_id", "text").collect()
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
            (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(0 <= s < 40 for s in slots)
        assert {r.law for r in got} <= {"bytes"} and {r.grown_shard for r in got} <= {None}
        if rows:
            groups = defaultdict(int)
            for d, t in rows:
                key = hashlib.md5(t.encode()).digest() if t is not None else hashlib.md5(str(d or "").encode()).digest() + b"\0"
                groups[key] += len((t or "").encode()) + 16
            loads = defaultdict(int)
            for r in got:
                loads[r.shard] += r.size
            assert max(loads.values()) == brute_capacity([groups[k] for k in sorted(groups)], 40)
            where = defaultdict(set)
            for r in got:
                where[r.text_crc32, r.size].add(r.shard)
            assert all(len(s) == 1 for (c, n), s in where.items() if n > 16)


@pytest.mark.parametrize("hot", ["a", "b", "c"])
def test_sharding_spreads_beside_a_hot_group(spark, monkeypatch, hot):
    """A third of the bytes in one group: the other shards are near equal, wherever it stands."""
    monkeypatch.setattr(sharding, "FIRST_BLOCKS", 64)
    rng = random.Random(hot)
    rows = [(i, f"{i} " + "x" * rng.randrange(400), "en", "s", 1) for i in range(4000)]
    rows += [(10_000 + i, hot * 200, "en", "s", 1) for i in range(2000)]
    loads = Counter()
    for r in sharding.assign_shards(spark.createDataFrame(rows, SCHEMA), 40).collect():
        loads[r.shard] += r.size
    hot_load = 2000 * 216
    assert max(loads.values()) == hot_load and set(loads) == set(range(40))
    share = (sum(loads.values()) - hot_load) / 39
    others = sorted(x for x in loads.values() if x != hot_load)
    assert all(abs(x - share) < 0.3 * share for x in others[1:])  # one is what is left before the hot group


def test_sharding_stays_in_the_jvm(spark):
    plan = sharding.op10_sharding(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
