"""Quality classifier: a byte-level convolutional network in numpy (operator 7).

A document is covered by chunks of CHUNK bytes overlapping by CHUNK - STRIDE.
Each byte is embedded, learned filters of WIDTH bytes slide over a chunk byte by
byte, and each filter's largest response in the chunk is kept (max-pooling).  A dense
layer turns these into chunk features, whose mean and maximum over all chunks
of the document give one probability.

Fitting uses a bounded sample: at most PER_CLASS labelled documents of either
class, chosen by a hash of the id, and of each at most TRAIN_CHUNKS chunks
spread evenly over its whole text; these chunks are what the driver receives.
The class sizes, counted over all labels, correct the sample's balance.
Scoring runs in Arrow batches over whole texts with the broadcast weights
(about 80 kB), without a shuffle.

Cases: null and empty texts are scored as one chunk of zero bytes; texts of
any length are read whole; repeated rows get equal scores; null ids are scored
and never used for fitting; labels without a document, null labels and rows of
the held-out fold are not used; without labels of both classes every score is
the share of label 1 (1.0 without labels); an empty table gives no rows; other
columns are carried along untouched by `scored`, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tandem.llm.common import documents, python_ready, steps
from tandem.session import read_table

CHUNK, STRIDE, WIDTH = 512, 448, 8
EMBED, FILTERS, HIDDEN = 8, 48, 24
PER_CLASS, TRAIN_CHUNKS = 1500, 16
EPOCHS, BATCH_CHUNKS, RATE, SEED = 12, 128, 0.004, 11
_POSITIONS = CHUNK - WIDTH + 1


def chunk_starts(n: int) -> np.ndarray:
    return np.arange(0, max(1, n - (CHUNK - STRIDE)), STRIDE)


def chunks_of(data: np.ndarray, offs: np.ndarray, most: int | None = None):
    """All chunks of a step's documents as (bytes [n, CHUNK], document index)."""
    rows, owner = [], []
    for i in range(len(offs) - 1):
        at = chunk_starts(int(offs[i + 1] - offs[i]))
        if most and len(at) > most:
            at = at[np.linspace(0, len(at) - 1, most).astype(int)]
        rows.append(at + offs[i])
        owner.append(np.full(len(at), i))
    start, owner = np.concatenate(rows), np.concatenate(owner)
    at = start[:, None] + np.arange(CHUNK)
    inside = at < offs[owner + 1][:, None]
    return np.where(inside, np.append(data, np.uint8(0))[np.minimum(at, len(data))], 0).astype(np.uint8), owner


def _responses(p: dict, x: np.ndarray):
    """Filter responses [n, positions, FILTERS] of a fitting step."""
    e = p["emb"][x].reshape(len(x), CHUNK * EMBED)
    win = np.lib.stride_tricks.sliding_window_view(e, WIDTH * EMBED, axis=1)[:, ::EMBED]
    return (win.reshape(-1, WIDTH * EMBED) @ p["conv"]).reshape(len(x), _POSITIONS, FILTERS)


def chunk_features(p: dict, x: np.ndarray) -> np.ndarray:
    """Features of each chunk [n, HIDDEN], one by one: a filter's response is a
    sum of per-byte table entries, added in a fixed order.  (A matrix product's
    rounding depends on the other rows, so equal texts would get scores that
    differ in the last digits.)"""
    table = [p["emb"] @ p["conv"][w * EMBED:(w + 1) * EMBED] for w in range(WIDTH)]
    out = np.empty((len(x), FILTERS), np.float32)
    for s in range(0, len(x), 4):
        at = x[s:s + 4].astype(np.intp)
        r = table[0][at[:, :_POSITIONS]]
        for w in range(1, WIDTH):
            r += np.take(table[w], at[:, w:w + _POSITIONS], axis=0)
        out[s:s + 4] = r.max(axis=1)
    a = np.maximum(out + p["bias"], 0)
    h = np.tile(p["dbias"], (len(x), 1))
    for k in range(FILTERS):
        h += a[:, k:k + 1] * p["dense"][k]
    return np.maximum(h, 0)


def document_logits(p: dict, h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    n = np.diff(np.append(first, len(owner)))[:, None]
    mean, top = np.add.reduceat(h.astype(np.float64), first) / n, np.maximum.reduceat(h, first)
    return (mean * p["mean"]).sum(axis=1) + (top * p["max"]).sum(axis=1) + p["out"]


def fit(x: np.ndarray, owner: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> dict:
    """Adam on the logistic loss, classes weighted equally.  ``x`` holds the
    chunks, ``owner`` the index of their document, ``label`` one per document."""
    rng = np.random.default_rng(seed)
    draw = lambda *s, by: (rng.standard_normal(s) * by).astype(np.float32)
    p = {"emb": draw(256, EMBED, by=0.5), "conv": draw(WIDTH * EMBED, FILTERS, by=0.2),
         "bias": np.zeros(FILTERS, np.float32), "dense": draw(FILTERS, HIDDEN, by=0.2),
         "dbias": np.full(HIDDEN, 0.1, np.float32), "mean": draw(HIDDEN, by=0.3), "max": draw(HIDDEN, by=0.3),
         "out": np.zeros(1, np.float32)}
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    weight = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum())) * len(label)
    bound = np.searchsorted(owner, np.arange(len(label) + 1))
    t = 0
    for epoch in range(epochs):
        order = rng.permutation(len(label))
        at = 0
        while at < len(order):
            to, size = at, 0
            while to < len(order) and (size < BATCH_CHUNKS or to == at):
                size += bound[order[to] + 1] - bound[order[to]]
                to += 1
            docs, at = order[at:to], to
            rows = np.concatenate([np.arange(bound[d], bound[d + 1]) for d in docs])
            own = np.repeat(np.arange(len(docs)), bound[docs + 1] - bound[docs])
            xb = x[rows]
            parts, where = [], []
            for s in range(0, len(xb), 32):
                r = _responses(p, xb[s:s + 32])
                w = r.argmax(axis=1)
                where.append(w)
                parts.append(np.take_along_axis(r, w[:, None, :], 1)[:, 0])
            where, pool = np.concatenate(where), np.concatenate(parts) + p["bias"]
            a = np.maximum(pool, 0)
            pre = a @ p["dense"] + p["dbias"]
            h = np.maximum(pre, 0)
            first = np.searchsorted(own, np.arange(len(docs)))
            n = np.bincount(own)[:, None].astype(np.float32)
            hm, hx = np.add.reduceat(h, first) / n, np.maximum.reduceat(h, first)
            z = hm @ p["mean"] + hx @ p["max"] + p["out"]
            g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[docs]) * weight[docs] / len(docs)).astype(np.float32)
            d = {"mean": hm.T @ g, "max": hx.T @ g, "out": g.sum(keepdims=True)}
            top = (h == hx[own]) & (h > 0)
            share = top / np.maximum(np.add.reduceat(top.astype(np.float32), first), 1)[own]
            dh = (g / n[:, 0])[own, None] * p["mean"] + g[own, None] * p["max"] * share
            dpre = dh * (pre > 0)
            d["dense"], d["dbias"] = a.T @ dpre, dpre.sum(0)
            da = (dpre @ p["dense"].T) * (pool > 0)
            d["bias"] = da.sum(0)
            # only the window that gave the maximum passes a gradient back
            idx = np.arange(len(xb))[:, None, None], where[:, :, None] + np.arange(WIDTH)
            bytes_ = xb[idx]                                     # [n, FILTERS, WIDTH]
            e = p["emb"][bytes_].reshape(len(xb), FILTERS, WIDTH * EMBED)
            d["conv"] = np.einsum("nf,nfk->kf", da, e)
            de = (da[:, :, None] * p["conv"].T[None]).reshape(-1, EMBED)
            code = bytes_.reshape(-1)
            d["emb"] = np.stack([np.bincount(code, de[:, c], 256) for c in range(EMBED)], 1).astype(np.float32)
            t += 1
            rate = RATE * (1 - epoch / epochs * 0.8)
            for k in p:
                m1[k] += 0.1 * (d[k] - m1[k])
                m2[k] += 0.002 * (d[k] ** 2 - m2[k])
                p[k] -= (rate * (m1[k] / (1 - 0.9 ** t)) / (np.sqrt(m2[k] / (1 - 0.998 ** t)) + 1e-7)).astype(np.float32)
    return p


def calibrate(z: np.ndarray, label: np.ndarray, weight: np.ndarray, decay: float = 1e-4) -> tuple[float, float]:
    """(scale, shift) of the logits that fit the labels best when every sampled
    document stands for as many as its class has in the whole table (Newton
    steps on the penalised logistic loss)."""
    mid, spread = z.mean(), z.std() + 1e-9
    a = np.stack(((z - mid) / spread, np.ones_like(z)), 1)
    weight = weight / weight.sum()
    ridge = np.diag([decay, 0.0])
    b = np.array([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a @ b, -40, 40)))
        hess = (a * (weight * q * (1 - q))[:, None]).T @ a + ridge + 1e-9 * np.eye(2)
        step = np.linalg.solve(hess, a.T @ (weight * (label - q)) - ridge @ b)
        b = b + step / max(1.0, np.abs(step).max() / 2)
    return b[0] / spread, b[1] - b[0] * mid / spread


def _train_chunks(batches):
    for part, data, offs in steps(batches):
        x, owner = chunks_of(data, offs, TRAIN_CHUNKS)
        bound = np.searchsorted(owner, np.arange(len(offs)))
        out = [x[bound[i]:bound[i + 1]].tobytes() for i in range(len(offs) - 1)]
        yield pa.record_batch([part.column("doc_id"), part.column("quality"), pa.array(out, pa.binary())],
                              ["doc_id", "quality", "chunks"])


def held_out(id_col):
    """The fold that labels are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_class: int = PER_CLASS) -> dict | None:
    """Weights, or None without labels of both classes (``prior`` is then all there is)."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("quality")) \
        .where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id"))).distinct()
    sizes = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return {"prior": np.float64(n1 / (n0 + n1) if n0 + n1 else 1.0)}
    picked = None
    for q in (0, 1):
        one = known.where(F.col("quality") == q).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(per_class)
        picked = one if picked is None else picked.union(one)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(picked), "doc_id")  # 2 * per_class short rows
    rows = sample.mapInArrow(_train_chunks, "doc_id long, quality int, chunks binary").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["quality"], bytes(r["chunks"])))
    x = [np.frombuffer(r["chunks"], np.uint8).reshape(-1, CHUNK) for r in rows]
    label = np.array([r["quality"] for r in rows])
    if len(set(label.tolist())) < 2:
        return {"prior": np.float64(n1 / (n0 + n1))}
    owner = np.repeat(np.arange(len(x)), [len(c) for c in x])
    x = np.concatenate(x)
    p = fit(x, owner, label)
    z = document_logits(p, chunk_features(p, x), owner).astype(np.float64)
    p["scale"], p["shift"] = calibrate(z, label, np.where(label == 1, n1 / (label == 1).sum(), n0 / (label == 0).sum()))
    return p


def scored(docs: DataFrame, weights: dict, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in the new column ``name``."""
    spark = python_ready(docs).sparkSession
    sent = spark.sparkContext.broadcast(weights)
    fields = StructType([StructField("row", docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).schema[0].dataType),
                         StructField(name, DoubleType())])

    def run(batches):
        p = sent.value
        for part, data, offs in steps(batches):
            if "prior" in p:
                score = np.full(len(offs) - 1, float(p["prior"]))
            else:
                x, owner = chunks_of(data, offs)
                z = document_logits(p, chunk_features(p, x), owner).astype(np.float64) * p["scale"] + p["shift"]
                score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.record_batch([part.column("row"), pa.array(score)], ["row", name])

    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    return held.mapInArrow(run, fields)


def keep_good(docs: DataFrame, weights: dict, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows that the classifier does not reject, with the columns of ``docs``."""
    return scored(docs, weights, text_col).where(F.col("score") >= least).select("row.*")


def op7_quality_cnn(spark, sf_dir):
    docs = documents(spark, sf_dir)
    weights = train(docs, read_table(spark, sf_dir, "labels"))
    out = scored(docs.select("doc_id", "text"), weights)
    return out.select("row.doc_id", "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
