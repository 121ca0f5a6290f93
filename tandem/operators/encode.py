"""Encoding: direction selection, BPE / word-level encoding, truncation,
SOS/EOS framing, id→token lookup, detokenising and the round-tripped
reference (P12, F4-F6, F11-F13, J4).

Texts are split on the special tokens, normalised and pre-tokenised.  BPE encodes
each row in one Arrow pass; a word-level vocabulary is looked up by
``lookup.map_arrays`` for the words that ``text_reader`` finds in the same pass.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.config import EOS_ID, MAX_SEQ_LEN, SOS_ID, SPECIAL_TOKENS, UNK_ID
from tandem.functions.text import _nfkc_lower, cutter, detokenize, normalize_frame, pretoken_classes, pretokenize
from tandem.operators.lookup import MOST_BYTES, map_arrays

#: Encoded words a task keeps at most, and characters of all of them.
WORDS_KEPT, CHARS_KEPT = 100_000, 2_000_000
PRETOKEN = re.compile(r"\w+|[^\w\s]+")
_SPECIAL_ALT = "|".join(re.escape(t) for t in SPECIAL_TOKENS)
SEGMENT_PATTERN = f"(?s){_SPECIAL_ALT}|(?:(?!{_SPECIAL_ALT}).)+"


def direction_select(df: DataFrame, src_lang: str = "en", tgt_lang: str = "vi",
                     col: str = "translation") -> DataFrame:
    """Pick source and target sides from the translation struct."""
    return df.withColumn("src", F.col(col).getField(src_lang)) \
             .withColumn("tgt", F.col(col).getField(tgt_lang))


def text_words(df: DataFrame, key: str, col: str) -> DataFrame:
    """``(key, pos, word)``: special-token segments are words of their own
    (their ids are in every vocabulary), other segments are normalised and
    pre-tokenised.  A row without words gives one row with NULL.  The input is
    evaluated once."""
    seg = df.select(F.col(key).alias("_k"), F.posexplode_outer(
        F.regexp_extract_all(F.coalesce(F.col(col), F.lit("")), F.lit(SEGMENT_PATTERN), 0))
        .alias("sp", "seg"))
    special = F.col("seg").isin(*SPECIAL_TOKENS)
    txt = normalize_frame(seg.withColumn("plain", F.when(~special, F.col("seg"))), "plain", "norm")
    # no word holds a bracket and a letter, so a special token is told apart
    words = F.when(special, F.array("seg")).otherwise(pretokenize("norm"))
    w = txt.select("_k", "sp", F.posexplode_outer(words).alias("wp", "word"))
    return w.select("_k", F.struct("sp", "wp").alias("pos"), "word")


def assemble_ids(tokens: DataFrame, key: str, out: str) -> DataFrame:
    """Group ``tokens(_k, pos, ids)`` back to one id array per key; NULL ids
    (rows without words) leave an empty array."""
    g = tokens.groupBy("_k").agg(F.sort_array(F.collect_list(
        F.when(F.col("ids").isNotNull(), F.struct("pos", "ids")))).alias("t"))
    return g.select(F.col("_k").alias(key), F.flatten(F.transform("t", lambda x: x["ids"])).alias(out))


# ---------------------------------------------------------------- BPE

def _bpe_word(word: str, ranks: dict, vocab: dict, unk: int) -> list:
    """Merge the lowest-rank adjacent pair (leftmost first) until none applies.
    Characters outside the vocabulary become one [UNK] each."""
    syms = list(word)
    while len(syms) > 1:
        best = None
        for i in range(len(syms) - 1):
            r = ranks.get((syms[i], syms[i + 1]))
            if r is not None and (best is None or r < best[0]):
                best = (r, i)
        if best is None:
            break
        i = best[1]
        syms[i:i + 2] = [syms[i] + syms[i + 1]]
    return [vocab.get(s, unk) for s in syms]


def bpe_word_ids(spark: SparkSession, words: DataFrame, vocab: list, merges: list,
                 unk_id: int = UNK_ID) -> DataFrame:
    """``(word, ids)`` for distinct words: an Arrow UDF over a broadcast of
    the (bounded) merge ranks and vocabulary."""
    bc = spark.sparkContext.broadcast(({(a, b): r for r, (a, b) in enumerate(merges)},
                                       {t: i for i, t in enumerate(vocab)}))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def enc(s: pd.Series) -> pd.Series:
        ranks, vmap = bc.value
        return s.map(lambda w: _bpe_word(w, ranks, vmap, unk_id))

    return words.select("word", enc("word").alias("ids"))


def encode_column(spark: SparkSession, df: DataFrame, key: str, col: str, out: str,
                  word_table_fn) -> DataFrame:
    """Encode ``col`` to ``out ARRAY<INT>`` keyed by ``key``.

    ``word_table_fn(distinct_words_df) -> (word, ids)``."""
    tw = text_words(df, key, col)
    distinct_words = tw.filter(F.col("word").isNotNull()).select("word").distinct()
    tokens = tw.join(word_table_fn(distinct_words), "word", "left")
    return assemble_ids(tokens, key, out)


def bpe_encode(spark: SparkSession, df: DataFrame, key: str, col: str, out: str,
               vocab: list, merges: list) -> DataFrame:
    """BPE-encode a text column (F4): row-local, no shuffle.

    Rows are normalised and pre-tokenised in the JVM; one Arrow pass applies
    the broadcast merges (bounded by the vocabulary size), each task keeping
    the words it has encoded."""
    seg = F.regexp_extract_all(F.coalesce(F.col(col), F.lit("")), F.lit(SEGMENT_PATTERN), 0)
    # normalisation works on whole texts: cutting at special tokens first keeps them as they are
    marked = df.select(F.col(key), F.transform(seg, lambda s: F.when(
        s.isin(*SPECIAL_TOKENS), F.concat(F.lit("\u0001"), s)).otherwise(s)).alias("_segs"))
    bc = spark.sparkContext.broadcast(({(a, b): r for r, (a, b) in enumerate(merges)},
                                       {t: i for i, t in enumerate(vocab)}))

    def run(batches):
        ranks, vmap = bc.value
        seen: dict = {}
        chars = 0
        for pdf in batches:
            ids = []
            for segs in pdf["_segs"]:
                row: list = []
                for s in segs:
                    if s[:1] == "\u0001" and s[1:] in SPECIAL_TOKENS:
                        row.append(vmap[s[1:]])
                        continue
                    for w in PRETOKEN.findall(_nfkc_lower(s)):
                        if w not in seen:
                            if len(seen) >= WORDS_KEPT or chars >= CHARS_KEPT:
                                seen.clear()
                                chars = 0
                            chars += len(w)
                            seen[w] = _bpe_word(w, ranks, vmap, UNK_ID)
                        row += seen[w]
                ids.append(row)
            yield pd.DataFrame({key: pdf[key], out: ids})

    kind = dict(df.dtypes)[key]
    return marked.mapInPandas(run, f"{key} {kind}, {out} array<int>")


# ------------------------------------------------- word-level vocabulary

def word_vocab(word_counts: DataFrame, specials=tuple(SPECIAL_TOKENS)) -> DataFrame:
    """Word-level vocabulary ``token, id``: the special tokens (ids 0..3),
    then words with id = specials−1 + rank by (count desc, token) —
    restatable in SQL, used for oracle checks.

    The rank is a global order over distinct words: a range-partitioned sort
    plus per-partition offsets (``ordered_index``), no single-task window."""
    from tandem.operators.batching import ordered_index
    idx = ordered_index(word_counts.select("word", "n"), [F.desc("n"), F.col("word")], "r")
    words = idx.select(F.col("word").alias("token"),
                       (F.col("r") + len(specials)).cast("int").alias("id"))
    sp = word_counts.sparkSession.createDataFrame([(t, i) for i, t in enumerate(specials)],
                                                  "token string, id int")
    return sp.unionByName(words)


def text_reader(spark: SparkSession, limits: list):
    """The ``read`` of ``lookup.map_arrays`` for arrays of as many texts as ``limits``: the
    words of ``text_words``, of each text as many as its limit (None: all), and how many the
    first text has."""
    patterns, tools = pretoken_classes(spark), []

    def read(lists):
        if not tools:
            tools.append(cutter(patterns))
        pieces, owner, special = [], [], []  # a text without special tokens is one piece, of one letter where it is one
        for i, x in enumerate(lists.flatten()):
            text = x.as_py()
            if not text or "[" not in text or not any(t in text for t in SPECIAL_TOKENS):
                pieces.append(text)
                owner.append(i)
                continue
            for s in _SEGMENTS.findall(text):
                if s in SPECIAL_TOKENS:
                    special.append((len(pieces), s))
                pieces.append("s" if s in SPECIAL_TOKENS else s)
                owner.append(i)
        flat, size = tools[0](pieces)
        if special:
            at = np.zeros(len(flat), bool)
            at[(np.cumsum(size) - size)[[i for i, _ in special]]] = True
            flat = pc.replace_with_mask(flat, pa.array(at), pa.array([s for _, s in special], pa.string()))
        n = len(lists.flatten())
        size = np.bincount(np.array(owner, np.int64), weights=size, minlength=n).astype(np.int64)
        most = np.resize(np.array([np.iinfo(np.int64).max if m is None else m for m in limits]), n)
        if (size > most).any():
            place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            flat, size = flat.filter(pa.array(place < np.repeat(most, size))), np.minimum(size, most)
        bounds = np.concatenate(([0], np.cumsum(size)))[::len(limits)]
        return flat, bounds, size[::len(limits)]
    return read


_SEGMENTS = re.compile(SEGMENT_PATTERN)


def word_vocab_encode_pairs(pairs: DataFrame, vocab: DataFrame, max_len: int = MAX_SEQ_LEN,
                            carry: tuple = ("split",), most: int = MOST_BYTES) -> DataFrame:
    """``id, src_ids, tgt_ids`` and the ``carry`` columns of ``pairs(id, src,
    tgt, ...)`` with a word-level vocabulary: the words of both sides are looked up
    in one array, of which only the words outside the commonest are shuffled."""
    both = pairs.select("id", *carry, F.array("src", "tgt").alias("_w"))
    m = map_arrays(both, "_w", "_i", vocab, "token", "id", UNK_ID, "id", most,
                   text_reader(pairs.sparkSession, [max_len, max_len - 2]), "_n")
    return m.select("id", *carry, F.slice("_i", F.lit(1), F.col("_n")).alias("src_ids"),
                    frame_target(F.slice("_i", F.col("_n") + 1, F.size("_i") - F.col("_n")), max_len).alias("tgt_ids"))


def word_vocab_encode(spark: SparkSession, df: DataFrame, key: str, col: str, out: str,
                      vocab: DataFrame, most: int = MOST_BYTES) -> DataFrame:
    """Encode with a word-level vocabulary (unknown word → [UNK])."""
    texts = df.select(key, F.array(col).alias("_w"))
    return map_arrays(texts, "_w", out, vocab, "token", "id", UNK_ID, "id", most, text_reader(spark, [None])).select(key, out)


# ------------------------------------------------- framing

def truncate_ids(col, max_len: int) -> "F.Column":
    """First ``max_len`` ids."""
    return F.slice(F.col(col) if isinstance(col, str) else col, 1, max_len)


def frame_target(col, max_len: int = MAX_SEQ_LEN, sos: int = SOS_ID, eos: int = EOS_ID):
    """``[SOS] + ids[:max_len-2] + [EOS]`` (F5 + F6)."""
    return F.concat(F.array(F.lit(sos)), truncate_ids(col, max_len - 2), F.array(F.lit(eos)))


# ---------------------------------------------------- decode side

def ids_to_tokens(df: DataFrame, col: str, vocab: DataFrame, out: str = "tokens",
                  key: str = "id", carry: tuple = (), most: int = MOST_BYTES) -> DataFrame:
    """Map id arrays to token arrays, order kept (J4); the ``carry`` columns
    go along.  Unknown and NULL ids give [UNK], a NULL array an empty one.

    The vocabulary's first ``most`` bytes go to every task; of a larger one only
    the ids that are not among them are shuffled."""
    cols = dict.fromkeys([key, *carry, col])
    return map_arrays(df.select(*cols), col, out, vocab, "id", "token", "[UNK]", "id", most).select(key, *carry, out)


def bpe_join_decode(tokens) -> "F.Column":
    """Default decoder: plain concatenation."""
    return F.array_join(F.col(tokens) if isinstance(tokens, str) else tokens, "")


def round_trip_reference(df: DataFrame, vocab: DataFrame, tgt_col: str = "tgt_ids",
                         key: str = "id") -> DataFrame:
    """Reference string = labels → tokens → detokenise."""
    lab = df.select(key, F.slice(tgt_col, 2, F.greatest(F.size(tgt_col) - 1, F.lit(0))).alias("labels"))
    toks = ids_to_tokens(lab, "labels", vocab, "tokens", key)
    return toks.select(key, detokenize("tokens").alias("ref"))
