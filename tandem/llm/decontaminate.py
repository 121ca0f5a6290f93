"""Benchmark decontamination by latent semantic retrieval (operator 9).

Documents are reduced, in one scan of the texts, to the positions of words
that occur in the benchmark (no other word can count towards a match), which
are written to the shared folder.  Passages of PASSAGE words then get TF-IDF
vectors over the benchmark's words, with document frequencies counted over all
passages; words in more than COMMON of them are left out of the vectors (not of
the later comparison).  A distributed randomised SVD of the documents' and the
items' passages, both given the same total weight, gives a latent space: each
of two rounds multiplies a thin matrix by A^T A, tasks returning partial
products that Spark sums.  Overlapping passages covering every document are
projected, and items of cosine COSINE or more are candidates.  A candidate is confirmed by the
longest common subsequence of item and surrounding words: nearly the whole item
(VERBATIM), or a smaller share (PARAPHRASE) if the item's answer, its last
sentence, is found as well (ANSWER).  Items of fewer than SHORT words are looked
up as word sequences instead, all their words in a row.

Benchmark items are taken in blocks of BLOCK, each against all documents; a
block's words, its latent space and its items are what is broadcast.

Cases: null and empty texts match nothing; items without words are left out;
repeated items match separately; equal texts are flagged alike, whatever their
ids (null or tied ids too); an empty benchmark or table gives no rows; other
columns are ignored by `matches` and kept by `remove`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import LOWER_CODE, NOT_WORD, documents, join_small, python_ready, steps, words, written
from tandem.session import read_table

#: Words of a passage, and of the blocks of which two neighbours make one.
PASSAGE, HOP = 64, 32
RANK, OVERSAMPLE, SEED = 256, 16, 5
COSINE, COMMON = 0.4, 0.05
VERBATIM, PARAPHRASE, ANSWER = 0.7, 0.5, 0.6
SHORT, LEAST_TERMS = 8, 3
BLOCK = 200
ROWS = 64
_STEP_HITS = 1 << 14


class Items:
    """A block of benchmark items as sequences of term numbers."""

    def __init__(self, ids: list, texts: list[str]):
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        offs = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
        start, _, doc, h = words(data, offs, NOT_WORD, LOWER_CODE)
        self.vocab, term = np.unique(h, return_inverse=True)
        bound = np.searchsorted(doc, np.arange(len(raw) + 1))
        self.ids, self.seq, self.answer = [], [], []
        for i, r in enumerate(raw):
            s = term[bound[i]:bound[i + 1]]
            if not len(s):
                continue
            at = start[bound[i]:bound[i + 1]] - offs[i]
            end = max(r.rfind(c, 0, int(at[-1])) for c in (b".", b"?", b"!", b"\n"))
            last = int(np.searchsorted(at, end)) if end >= 0 else 0
            if len(s) - last < 3 or last == 0:
                last = len(s) - max(3, len(s) // 4)
            self.ids.append(ids[i])
            self.seq.append(s)
            self.answer.append(s[max(0, last):])
        self.masks = [(term_masks(s), term_masks(a)) for s, a in zip(self.seq, self.answer, strict=True)]
        self.long = np.array([len(s) >= SHORT for s in self.seq], bool)
        self.short: dict = {}
        for i in np.flatnonzero(~self.long):
            self.short.setdefault(len(self.seq[i]), []).append(int(i))

    def __len__(self):
        return len(self.ids)

    def vectors(self, idf: np.ndarray):
        """Entries (item, term, weight) of the items' TF-IDF rows, zero weights left out."""
        row = np.repeat(np.arange(len(self)), [len(s) for s in self.seq])
        e, tf = np.unique(row * len(self.vocab) + np.concatenate(self.seq), return_counts=True)
        row, t = e // len(self.vocab), e % len(self.vocab)
        used = idf[t] > 0
        row, t = row[used], t[used]
        return row, t, _weights(row, t, tf[used], idf)


def term_masks(a: np.ndarray) -> tuple[int, dict]:
    """Length of a sequence and, for each term, the bits of its places."""
    where: dict = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | (1 << i)
    return len(a), where


def lcs(masks: tuple[int, dict], b: list) -> int:
    """Length of the longest common subsequence (bit-parallel over the masked sequence)."""
    n, where = masks
    full = (1 << n) - 1
    v = full
    for x in b:
        m = where.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _find_hits(vocab):
    def run(batches):
        v = vocab.value
        for part, data, offs in steps(batches):
            _, _, doc, h = words(data, offs, NOT_WORD, LOWER_CODE)
            n = np.bincount(doc, minlength=len(offs) - 1)
            at = np.minimum(np.searchsorted(v, h), len(v) - 1)
            hit = v[at] == h
            place = np.arange(len(h)) - np.searchsorted(doc, doc)
            bound = np.searchsorted(doc[hit], np.arange(len(offs)))
            lists = [pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(x.astype(np.int32)))
                     for x in (place[hit], at[hit])]
            yield pa.record_batch([part.column("doc_id"), part.column("tkey"), pa.array(n, pa.int64()), *lists],
                                  ["doc_id", "tkey", "n_words", "pos", "term"])
    return run


def _hits(batches):
    """Steps of (batch slice, document index, position, term) of the hits."""
    for b in batches:
        pos, term = b.column("pos"), b.column("term")
        off = np.asarray(pos.offsets)
        at = 0
        while at < len(b):
            to = max(at + 1, int(np.searchsorted(off, off[at] + _STEP_HITS, "right")) - 1)
            to = min(to, len(b))
            cut = slice(off[at], off[to])
            # offsets index the child arrays as they are, before any slicing
            yield (b.slice(at, to - at), np.repeat(np.arange(to - at), np.diff(off[at:to + 1])),
                   np.asarray(pos.values)[cut], np.asarray(term.values)[cut])
            at = to


def _counted(doc, pos, term, width: int):
    """Distinct (block, term) entries in order of block, for blocks of ``width``
    words: row of each entry, term, count, and the rows' keys (document, number)."""
    key = (doc.astype(np.int64) << 31) | (pos // width)
    rows, row = np.unique(key, return_inverse=True)
    terms = int(term.max(initial=0)) + 1
    e, tf = np.unique(row.astype(np.int64) * terms + term, return_counts=True)
    return e // terms, e % terms, tf, rows


def _weights(row, term, tf, idf):
    """TF-IDF weights of entries in order of row, each row of length one."""
    w = tf * idf[term]
    norm = np.sqrt(np.bincount(row, w * w))
    return (w / norm[row]).astype(np.float32)


def _sums(group, weight, at, m):
    """The groups (given in order) and, for each, the sum of weight * m[at]:
    the groups' first entries together, then their second ones, and so on."""
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.append(first, len(group)))
    order = np.argsort(-size, kind="stable")
    start, left = first[order], np.searchsorted(-size[order], -np.arange(size.max()), "left")
    out = np.zeros((len(first), m.shape[1]), m.dtype)
    for k, n in enumerate(left.tolist()):
        e = start[:n] + k
        part = m[at[e]]
        part *= weight[e, None]
        out[:n] += part
    back = np.empty_like(out)
    back[order] = out
    return group[first], back


def _document_frequency(batches):
    total: dict = {}
    df = np.zeros(0, np.int64)
    for b, doc, pos, term in _hits(batches):
        total["n"] = total.get("n", 0) + int(np.sum(np.maximum(1, -(-b.column("n_words").to_numpy() // PASSAGE))))
        if len(term):
            _, t, _, _ = _counted(doc, pos, term, PASSAGE)
            one = np.bincount(t, minlength=len(df))
            one[:len(df)] += df
            df = one
    t = np.flatnonzero(df)
    yield pa.record_batch([pa.array(np.r_[-1, t].astype(np.int32)), pa.array(np.r_[total.get("n", 0), df[t]])],
                          ["term", "df"])


def _useful(doc, pos, term, idf):
    used = idf[term] > 0
    return doc[used], pos[used], term[used]


def _gram_product(sent):
    """Partial A^T A Q of a task, in blocks of ROWS terms; block -1 has the
    number of passages."""
    def run(batches):
        idf, q = sent.value
        z, rows = np.zeros(q.shape, np.float64), 0
        for _, doc, pos, term in _hits(batches):
            doc, pos, term = _useful(doc, pos, term, idf)
            if not len(term):
                continue
            row, t, tf, keys = _counted(doc, pos, term, PASSAGE)
            w = _weights(row, t, tf, idf)
            rows += len(keys)
            _, y = _sums(row, w, t, q)
            order = np.argsort(t, kind="stable")
            some, part = _sums(t[order], w[order], row[order], y)
            z[some] += part
        some = [s for s in range(0, len(z), ROWS) if z[s:s + ROWS].any()]
        yield pa.record_batch([pa.array([-1, *some], pa.int32()), pa.array(
            [np.float64(rows).tobytes(), *(z[s:s + ROWS].tobytes() for s in some)], pa.binary())], ["block", "z"])
    return run


def _sum_blocks(parts: pd.DataFrame) -> pd.DataFrame:
    z = sum(np.frombuffer(x) for x in parts.sort_values("z")["z"])
    return pd.DataFrame({"block": [parts["block"].iloc[0]], "z": [z.tobytes()]})


def term_weights(hits: DataFrame, items: Items) -> np.ndarray:
    """Inverse document frequencies over all passages, zero for common words
    (but for those of an item that would keep fewer than LEAST_TERMS)."""
    df = np.zeros(len(items.vocab) + 1)
    for r in hits.mapInArrow(_document_frequency, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]  # -1: the number of passages
    n, df = df[-1], df[:-1]
    rare = df <= COMMON * n
    for s in items.seq:
        if rare[np.unique(s)].sum() < LEAST_TERMS:
            rare[s] = True
    return np.where(rare, np.log((n + 1) / (df + 1)) + 1, 0.0)


def latent_space(hits: DataFrame, items: Items, idf: np.ndarray, rank: int = RANK, seed: int = SEED) -> np.ndarray:
    """Leading right singular vectors of the passages of documents and items,
    by a randomised range finder with one power round and a Rayleigh-Ritz step."""
    sc = hits.sparkSession.sparkContext
    row, t, w = items.vectors(idf)

    def product(q):
        sent = sc.broadcast((idf, q.astype(np.float32)))
        parts = hits.mapInArrow(_gram_product(sent), "block int, z binary")
        z, rows = np.zeros(q.shape), 0.0
        for r in parts.groupBy("block").applyInPandas(_sum_blocks, "block int, z binary").collect():
            x = np.frombuffer(r["z"])
            if r["block"] < 0:
                rows = float(x[0])
            else:
                x = x.reshape(-1, q.shape[1])
                z[r["block"]:r["block"] + len(x)] = x
        y = np.zeros((len(items), q.shape[1]))
        np.add.at(y, row, w[:, None] * q[t])
        own = np.zeros(q.shape)
        np.add.at(own, t, w[:, None] * y[row])
        return z / max(rows, 1.0) + own / len(items)

    width = min(len(idf), rank + OVERSAMPLE)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(idf), width)))
    q, _ = np.linalg.qr(product(q))
    z = product(q)
    value, vec = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
    return q @ vec[:, np.argsort(-value)[:rank]]


def _project(row_count, row, t, w, v):
    x = np.zeros((row_count, v.shape[1]), np.float32)
    if len(row):
        some, sums = _sums(row, w, t, v)
        x[some] = sums
    return x


def _unit(x):
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n > 0, n, 1)


def _overlapping(doc, pos, term, idf, v):
    """Latent unit vectors of the overlapping passages: each is the sum of two
    neighbouring blocks of HOP words, projected once; (vectors, document,
    number of the first block)."""
    row, t, tf, keys = _counted(doc, pos, term, HOP)
    x = _project(len(keys) + 1, row, t, (tf * idf[t]).astype(np.float32), v)  # the last row stays zero
    own = np.unique(np.r_[keys, keys[keys & ((1 << 31) - 1) > 0] - 1])

    def block(k):
        at = np.minimum(np.searchsorted(keys, k), max(0, len(keys) - 1))
        return np.where(keys[at] == k, at, len(keys)) if len(keys) else np.zeros(0, np.int64)

    return _unit(x[block(own)] + x[block(own + 1)]), own >> 31, own & ((1 << 31) - 1)


def _sequences(items: Items, doc, pos, term):
    """(document, item, first word) of short items whose words stand in a row."""
    for n, some in items.short.items():
        m = len(term) - n + 1
        if m < 1:
            continue
        row = (doc[:m] == doc[n - 1:]) & (pos[n - 1:] - pos[:m] == n - 1)
        for i in some:
            ok = row & (term[:m] == items.seq[i][0])
            for j in range(1, n):
                ok &= term[j:j + m] == items.seq[i][j]
            for at in np.flatnonzero(ok):
                yield int(doc[at]), i, int(pos[at])


def _search(sent):
    def run(batches):
        items, idf, v, latent = sent.value
        for b, doc, pos, term in _hits(batches):
            best: dict = {}
            for d, i, at in _sequences(items, doc, pos, term):
                new = (1.0, 1.0, -at)
                best[d, i] = max(best.get((d, i), new), new)
            bound = np.searchsorted(doc, np.arange(len(b) + 1))
            x, row_doc, row_q = _overlapping(*_useful(doc, pos, term, idf), idf, v)
            cos = (x @ latent.T) * items.long
            for p, i in zip(*np.nonzero(cos >= COSINE), strict=True):
                d, n = int(row_doc[p]), len(items.seq[i])
                lo, hi = int(row_q[p]) * HOP - n, int(row_q[p]) * HOP + PASSAGE + n
                a, z = bound[d] + np.searchsorted(pos[bound[d]:bound[d + 1]], (lo, hi))
                if z - a < n * PARAPHRASE:
                    continue
                near = term[a:z].tolist()
                share = lcs(items.masks[i][0], near) / n
                if share >= VERBATIM or (share >= PARAPHRASE
                                         and lcs(items.masks[i][1], near) >= ANSWER * len(items.answer[i])):
                    new = (share, float(cos[p, i]), -int(row_q[p]) * HOP)
                    best[d, i] = max(best.get((d, i), new), new)
            out: dict = {c: [] for c in ("doc", "item_id", "cosine", "lcs", "first_word")}
            for (d, i), (share, c, at) in sorted(best.items()):
                for name, x in zip(out, (d, items.ids[i], c, share, -at), strict=True):
                    out[name].append(x)
            at = pa.array(out["doc"], pa.int64())
            yield pa.record_batch([b.column("doc_id").take(at), b.column("tkey").take(at),
                                   pa.array(out["item_id"], pa.int64()), pa.array(out["cosine"], pa.float64()),
                                   pa.array(out["lcs"], pa.float64()), pa.array(out["first_word"], pa.int64())],
                                  ["doc_id", "tkey", "item_id", "cosine", "lcs", "first_word"])
    return run


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            block: int = BLOCK) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, tkey (MD5
    of the text), item_id, cosine, lcs (share of the item), first_word (of the
    best passage)."""
    spark = python_ready(docs).sparkSession
    kind = dict(docs.dtypes)[id_col]
    schema = f"doc_id {kind}, tkey string, item_id long, cosine double, lcs double, first_word long"
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("tkey"),
                         F.col(text_col).alias("text"))
    held = benchmark.where("text is not null").select("item_id", "text")
    held = written(held.repartitionByRange("item_id", "text").sortWithinPartitions("item_id", "text"), "items")
    out, rest, last = spark.createDataFrame([], schema), held, None
    while True:
        rows = rest.orderBy("item_id", "text").limit(block).collect()
        items = Items([r["item_id"] for r in rows], [r["text"] for r in rows])
        if len(items):
            vocab = spark.sparkContext.broadcast(items.vocab)
            hits = narrow.mapInArrow(_find_hits(vocab), f"doc_id {kind}, tkey string, n_words long, pos array<int>, term array<int>")
            hits = written(hits, "hits")
            idf = term_weights(hits, items)
            v = latent_space(hits, items, idf).astype(np.float32)
            latent = _unit(_project(len(items), *items.vectors(idf), v))
            sent = spark.sparkContext.broadcast((items, idf, v, latent))
            out = out.union(hits.where(F.size("term") > 0).mapInArrow(_search(sent), schema))
        if len(rows) < block:
            return out
        last = rows[-1]
        # items without an id stand first
        after = F.col("item_id").isNotNull() if last["item_id"] is None else F.col("item_id") > last["item_id"]
        rest = held.where(after | (F.col("item_id").eqNullSafe(F.lit(last["item_id"])) & (F.col("text") > last["text"])))


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item."""
    bad = written(matches(docs, benchmark, text_col=text_col, **kw).select(F.col("tkey").alias("_tkey")).distinct(), "leaks")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("_tkey"))
    return join_small(keyed, bad, ["_tkey"], "left_anti").select("row.*")


def op9_benchmark_decontamination(spark, sf_dir):
    found = matches(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "lcs", "cosine", "first_word")
