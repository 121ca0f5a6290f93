"""Language identification by interpolated Kneser-Ney character models (operator 5).

Training counts every character ORDER-gram of every training text, per
language, in vectorised tasks (partial counts per task step, then a shuffle by
n-gram).  The lower orders' continuation counts, the context totals and the
interpolated probabilities follow from that table by grouping and joining.
Probabilities of all n-grams of all languages are looked up in sorted hash
arrays, one for each order, with one column for each language, so that a
character of text costs one binary search.  No n-gram is left out: a model of
more than SLICE_BYTES is cut into slices by a hash of the two characters before
the last, which an n-gram, its context and the n-grams it backs off to have in
common.  The texts are read once a slice, each time scoring the n-grams that
belong to it, and the sums are added up; so driver and tasks hold one slice at
a time.  The tables of single characters and pairs go with every slice.  Unseen
n-grams back off with the context's weight.

A text's language is that of the lowest cross-entropy per character.  The
rejection threshold of a language is calibrated on all its training documents
(mean plus CALIBRATE standard deviations of their cross-entropy): a document
above it has ``rejected`` true; ``score`` is the posterior of the languages at
a fixed temperature times the margin to the threshold.

Characters are lower-cased; runs of anything but letters are one space.

Cases: null texts and texts without a letter are ``und`` with score 0; rows
with null lang, null id or null text are not trained on; repeated rows count
as often as they occur; without any training row all are ``und``; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import documents, join_small, python_ready, written

ORDER = 4
#: Bytes of the arrays that one pass over the texts looks up (orders 1 and 2 come on top).
SLICE_BYTES = 96 << 20
CALIBRATE = 4.0
DISCOUNT = 0.75
#: Characters (per language model) over which the posterior's evidence counts at most.
EVIDENCE = 40
STEP_CHARS = 1 << 18
_U = np.uint64
_PRIME = (1 << 31) - 1
_HASH = _U(0x9E3779B97F4A7C15)
_letters: list = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        table = np.zeros(0x110000, bool)
        table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        _letters.append(table)
    return _letters[0]


def characters(texts: list[str]):
    """(codes, document index) of the normalised characters of some texts: 16
    bits each, each document between spaces.  Code points above 16 bits fold
    into the private area."""
    low = [("" if t is None else t).lower() for t in texts]
    n = np.array([len(t) + 2 for t in low])
    cp = np.frombuffer((" " + "  ".join(low) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), n)
    letter = letters()[cp]
    cp = np.where(letter, cp, 32)
    cp = np.where(cp > 0xFFFF, 0xE000 + cp % 0x1900, cp)
    keep = letter.copy()
    keep[1:] |= letter[:-1] | (doc[1:] != doc[:-1])
    keep[0] = True
    return cp[keep].astype(_U), doc[keep], np.bincount(doc, letter, len(texts)).astype(np.int64)


def grams(codes, doc, order: int):
    """Packed n-grams (the last character lowest) and the document of each."""
    m = max(0, len(codes) - order + 1)
    g = np.zeros(m, _U)
    for j in range(order):
        g = (g << _U(16)) | codes[j:j + m]
    ok = doc[:m] == doc[order - 1:order - 1 + m]
    return g[ok], doc[:m][ok]


def _slices(texts: list):
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (size < STEP_CHARS or to == at):
            size += len(texts[to] or "")
            to += 1
        yield at, to
        at = to


def _count(order: int):
    def run(batches):
        held: dict = {}

        def flush():
            for lang, parts in held.items():
                g, n = (np.concatenate(x) for x in zip(*parts, strict=True))
                g, inv = np.unique(g, return_inverse=True)
                yield pa.record_batch([pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)),
                                       pa.array(np.bincount(inv, n).astype(np.int64))], ["lang", "g", "n"])
            held.clear()

        size = 0
        for b in batches:
            texts, langs = b.column("text").to_pylist(), np.array(b.column("lang").to_pylist(), object)
            for at, to in _slices(texts):
                codes, doc, _ = characters(texts[at:to])
                g, d = grams(codes, doc, order)
                own = langs[at:to][d]
                for lang in set(langs[at:to]):
                    u, n = np.unique(g[own == lang], return_counts=True)
                    held.setdefault(lang, []).append((u, n))
                    size += len(u)
                if size > 1 << 21:
                    yield from flush()
                    size = 0
        yield from flush()
    return run


def held_out(id_col):
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, g, n): counts of the character n-grams of docs (lang, text)."""
    part = python_ready(docs).mapInArrow(_count(order), "lang string, g long, n long")
    n = part.groupBy("lang", "g").agg(F.sum("n").alias("n"))
    return n


def probabilities(counts: DataFrame, order: int = ORDER, discount: float = DISCOUNT) -> list[DataFrame]:
    """For each order 1..N: (lang, g, p) and the contexts' back-off weights
    (lang, ctx, bow) that serve the order, from the top order's counts."""
    tables = {order: counts.withColumnRenamed("n", "c")}
    for k in range(order - 1, 0, -1):
        # continuation count: in how many different contexts the (k)-gram was seen
        mask = (1 << (16 * k)) - 1
        nxt = tables[k + 1].select("lang", F.col("g").bitwiseAND(F.lit(mask)).alias("g"))
        tables[k] = nxt.groupBy("lang", "g").agg(F.count(F.lit(1)).alias("c"))
    out, lower = [], None
    for k in range(1, order + 1):
        t = tables[k].withColumn("ctx", F.shiftrightunsigned("g", 16) if k > 1 else F.lit(0).cast("long"))
        ctx = t.groupBy("lang", "ctx").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
        t = t.join(ctx, ["lang", "ctx"])
        bow = ctx.select("lang", "ctx", (F.lit(discount) * F.col("kinds") / F.col("total")).alias("bow"))
        own = F.greatest(F.col("c") - discount, F.lit(0.0)) / F.col("total")
        share = F.lit(discount) * F.col("kinds") / F.col("total")
        if k == 1:
            # the rest goes to 2**16 characters alike
            t = t.select("lang", "g", (own + share / 65536).alias("p"))
        else:
            t = t.withColumn("tail", F.col("g").bitwiseAND(F.lit((1 << (16 * (k - 1))) - 1)))
            t = t.join(lower.select("lang", F.col("g").alias("tail"), F.col("p").alias("q")), ["lang", "tail"])
            t = t.select("lang", "g", (own + share * F.col("q")).alias("p"))
        lower = written(t, f"kn{k}")
        out.append((lower, written(bow, f"bow{k}")))
    return out


class Model:
    """Sorted hash arrays: for each order the n-grams with their log2
    probabilities, and the contexts with their back-off weights, per language."""

    def __init__(self, langs: list[str], grams_: list, contexts: list):
        self.langs, self.grams, self.contexts = langs, grams_, contexts

    @staticmethod
    def table(keys: np.ndarray, lang: np.ndarray, value: np.ndarray, n: int):
        h = keys.view(_U) * _HASH
        u, inv = np.unique(h, return_inverse=True)
        m = np.full((len(u), n), np.nan, np.float32)
        m[inv, lang] = value
        return u, m

    @staticmethod
    def look(table, keys: np.ndarray) -> np.ndarray:
        u, m = table
        h = keys * _HASH
        at = np.minimum(np.searchsorted(u, h), max(0, len(u) - 1))
        if not len(u):
            return np.full((len(keys), m.shape[1]), np.nan, np.float32)
        out = m[at]
        out[u[at] != h] = np.nan
        return out

    def log2p(self, g: np.ndarray, k: int) -> np.ndarray:
        """log2 probabilities [n, languages] of k-grams, with back-off."""
        p = self.look(self.grams[k - 1], g)
        miss = np.flatnonzero(np.isnan(p).any(axis=1))
        if len(miss):
            ctx = g[miss] >> _U(16) if k > 1 else np.zeros(len(miss), _U)
            bow = np.nan_to_num(self.look(self.contexts[k - 1], ctx), nan=0.0)
            low = self.log2p(g[miss] & _U((1 << (16 * (k - 1))) - 1), k - 1) if k > 1 else np.float32(-16.0)
            p[miss] = np.where(np.isnan(p[miss]), bow + low, p[miss])
        return p

    def complete(self) -> Model:
        """Fill each language's gaps among the n-grams that another one has, so
        that a look-up that hits needs no back-off."""
        for k in range(1, len(self.grams) + 1):
            u, m = self.grams[k - 1]
            if len(u):
                inverse = _U(pow(int(_HASH), -1, 1 << 64))
                for s in range(0, len(u), 1 << 16):
                    m[s:s + (1 << 16)] = self.log2p(u[s:s + (1 << 16)] * inverse, k)
        return self

    def bits(self, texts: list, n_slices: int = 1, nth: int = 0):
        """(log2 probability of the n-grams in the slice [n, languages], number
        of all n-grams, number of letters) of each text."""
        order = len(self.grams)
        codes, doc, n = characters(texts)
        g, d = grams(codes, doc, order)
        # texts shorter than the order are padded with leading spaces
        short = np.flatnonzero((n > 0) & (np.bincount(d, minlength=len(texts)) == 0))
        for i in short:
            c = codes[doc == i]
            c = np.concatenate((np.full(order, 32, _U), c))
            gi, _ = grams(c, np.zeros(len(c), np.int64), order)
            g, d = np.concatenate((g, gi)), np.concatenate((d, np.full(len(gi), i)))
        count = np.bincount(d, minlength=len(texts))
        if n_slices > 1:
            pair = (g >> _U(16)) & _U(0xFFFFFFFF)
            own = (pair % _U(_PRIME) * _U(48271) % _U(_PRIME) >> _U(8)) % _U(n_slices) == _U(nth)
            g, d = g[own], d[own]
        p = self.log2p(g, order)
        return np.stack([np.bincount(d, p[:, j], len(texts)).astype(float) for j in range(p.shape[1])], 1), count, n


def _slice_of(pair, n_slices: int):
    """Slice of two characters (a long of 32 bits), as Model.bits has it."""
    return F.shiftright(pair % _PRIME * 48271 % _PRIME, 8) % n_slices


class Tables:
    """The whole model as written tables: for each order the probabilities
    (lang, g, p) and the contexts' back-off weights (lang, ctx, bow)."""

    def __init__(self, langs: list[str], tables: list):
        self.langs, self.tables = langs, tables
        rows = sum(df.count() for pair in tables[2:] for df in pair)
        self.n_slices = max(1, -(-rows * (8 + 4 * len(langs)) // SLICE_BYTES))

    def model(self, nth: int = 0) -> Model:
        """The arrays of one slice."""
        index = {x: i for i, x in enumerate(self.langs)}
        out = ([], [])
        for k, pair in enumerate(self.tables, 1):
            for df, key, col, to in zip(pair, ("g", "ctx"), ("p", "bow"), out, strict=True):
                if k > 2 and self.n_slices > 1:
                    two = (F.shiftrightunsigned(key, 16) if key == "g" else F.col(key)).bitwiseAND(F.lit(0xFFFFFFFF))
                    df = df.where(_slice_of(two, self.n_slices) == nth)
                arrow = df.select(F.col(key).alias("k"), "lang", F.log2(col).cast("float").alias("v")).toArrow()
                lang = arrow["lang"].combine_chunks().dictionary_encode()
                number = np.array([index[x] for x in lang.dictionary.to_pylist()], np.int64)
                to.append(Model.table(arrow["k"].to_numpy(), number[lang.indices.to_numpy()], arrow["v"].to_numpy(),
                                      len(self.langs)))
        return Model(self.langs, *out).complete()


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Tables | None:
    """The model of all rows outside the held-out fold that have a language."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()
                       & ~held_out(F.col(id_col))).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = written(gram_counts(known), "grams")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    return Tables(langs, probabilities(counts)) if langs else None


def _scored(docs: DataFrame, model: Model | None, n_slices: int, nth: int) -> DataFrame:
    """Each row's sums for one slice, and md5 of its text in place of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for b in batches:
            texts = b.column("text").to_pylist()
            for at, to in _slices(texts):
                if m is None:
                    n = characters(texts[at:to])[2]
                    bits, count = np.zeros((to - at, 0)), np.zeros(to - at, np.int64)
                else:
                    bits, count, n = m.bits(texts[at:to], n_slices, nth)
                sums = pa.ListArray.from_arrays(np.arange(to - at + 1, dtype=np.int32) * bits.shape[1], bits.ravel())
                part = b.slice(at, to - at)
                yield pa.record_batch([part.column(c) for c in ("doc_id", "held_out", "known", "tkey")]
                                      + [pa.array(n), pa.array(count), sums],
                                      ["doc_id", "held_out", "known", "tkey", "n_letters", "n_grams", "bits"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(run, f"doc_id {kind}, held_out boolean, known boolean, tkey string, n_letters long, "
                                "n_grams long, bits array<double>")


def identify(docs: DataFrame, model: Tables | None, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, n_letters, rejected."""
    known = F.coalesce(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)), F.lit(False))
    n_slices, langs = (model.n_slices, model.langs) if model else (1, [])
    rows = python_ready(docs).select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), known.alias("known"),
        (F.md5(text_col) if n_slices > 1 else F.lit(None).cast("string")).alias("tkey"), F.col(text_col).alias("text"))
    if n_slices == 1:
        out = _scored(rows, model.model() if model else None, 1, 0)
    else:
        passes = [written(_scored(rows, model.model(s), n_slices, s).withColumn("nth", F.lit(s)), "language-sums")
                  for s in range(n_slices)]
        out = passes[0]
        for p in passes[1:]:
            out = out.union(p)
        # equal rows have equal sums: one row stands for all, and is repeated after
        key = ["doc_id", "held_out", "known", "tkey"]
        out = out.groupBy(*key).agg(
            F.count_if(F.col("nth") == 0).alias("rows"), F.max("n_letters").alias("n_letters"),
            F.max("n_grams").alias("n_grams"),
            F.array(*[F.sum(F.col("bits")[i]) for i in range(len(langs))]).alias("bits"))
        out = out.select(*key, "n_letters", "n_grams", F.transform("bits", lambda x: x / F.col("rows")).alias("bits"),
                         F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    # one-row generators keep the arrays from being computed anew in every use
    ce = F.transform("bits", lambda x: F.lit(0.0) - x / F.greatest(F.col("n_grams"), F.lit(1)))
    out = out.select("doc_id", "held_out", "known", "n_letters", F.inline(F.array(F.struct(ce.alias("ce")))))
    out = out.select("*", F.inline(F.array(F.struct(F.array_min("ce").alias("low")))))
    some = F.col("n_letters") > 0
    odds = F.aggregate("ce", F.lit(0.0), lambda acc, x: acc + F.pow(
        F.lit(2.0), (F.col("low") - x) * F.least(F.col("n_letters"), F.lit(EVIDENCE))))
    pred = F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("ce", F.col("low")).cast("int")) \
        if langs else F.lit("und")
    out = out.select("doc_id", "held_out", "known", F.when(some, pred).otherwise("und").alias("lang_pred"),
                     F.when(some & F.lit(bool(langs)), 1 / odds).otherwise(0.0).alias("score"),
                     F.coalesce("low", F.lit(0.0)).alias("cross_entropy"), "n_letters")
    out = written(out, "languages")
    limit = out.where("known and n_letters > 0").groupBy("lang_pred").agg(
        (F.avg("cross_entropy") + CALIBRATE * F.coalesce(F.stddev_pop("cross_entropy"), F.lit(0.0))).alias("limit"))
    out = join_small(out, limit, ["lang_pred"], "left")
    return out.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "n_letters",
                      F.coalesce(F.col("cross_entropy") > F.col("limit"), F.col("n_letters") == 0).alias("rejected"))


def op5_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return identify(docs, train(docs))
