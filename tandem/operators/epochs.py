"""Batches of a saved dataset, epoch by epoch, without a sort and without
moving tokens (X8, O5, W3, F4-F7).

A row's position is the number of rows in the files before its own plus its
index in the file, which Parquet readers know: numbering costs one count per
file.  An epoch's order is a keyed permutation of the positions, computed for
each row by itself.  A row's batch follows from that, and one exchange of the
raw texts brings a batch together.  A single Arrow pass then encodes, frames,
shifts and pads its rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.config import (EOS_ID, EVAL_BATCH_SIZE, MAX_SEQ_LEN, PAD_ID, SEED, SOS_ID, SPECIAL_TOKENS, TRAIN_BATCH_SIZE,
                           UNK_ID)
from tandem.functions.text import _nfkc_lower, detokenize
from tandem.operators.batching import batch_size_col, md5_key
from tandem.operators.bpe import BpeModel
from tandem.operators.clean import nonempty_pred
from tandem.operators.encode import PRETOKEN, SEGMENT_PATTERN, WORDS_KEPT, _bpe_word
from tandem.session import join_measured, ship_package

ROUNDS, WALKS = 4, 24


def save_dataset(pairs: DataFrame, root: str) -> None:
    """Non-blank pairs ``id, split, en, vi`` as Parquet by split, in order of id."""
    (pairs.filter(nonempty_pred()).select("id", "split", "en", "vi").orderBy("split", "id")
     .write.mode("overwrite").partitionBy("split").parquet(root))


def load_dataset(spark: SparkSession, root: str, split: str | None = None) -> DataFrame:
    """``id, en, vi, split`` of a saved dataset, with each row's 0-based ``pos``
    in its split and the split's ``n_rows``; ``split`` reads that folder alone."""
    df = spark.read.schema("id long, en string, vi string, split string").parquet(root)
    if split:
        df = df.filter(F.col("split") == split)
    df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # one row a file
    files = df.groupBy("split", "_file").agg((F.max("_row") + 1).alias("_n"))
    here = Window.partitionBy("split")
    before = here.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("split", "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                         F.sum("_n").over(here).alias("n_rows"))
    return join_measured(df, files, ["split", "_file"]).select(
        "id", "split", "en", "vi", (F.col("_before") + F.col("_row")).alias("pos"), "n_rows")


def permuted(pos: Column, n: Column, seed: int = SEED, epoch: int = 0) -> Column:
    """A keyed bijection of 0..n-1: a Feistel network over the smallest a x b
    grid that holds them, walked until it lands below n.  (Fewer than a places
    of the grid lie above n, so nearly every walk has one step.)"""
    a = F.ceil(F.sqrt(n)).cast("long")
    b = F.ceil(n / a).cast("long")

    def step(x):
        first = F.struct((x % a).alias("l"), F.floor(x / a).cast("long").alias("r"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, lambda s, j: F.struct(
            s["r"].alias("l"), F.pmod(s["l"] + md5_key(seed, F.lit(epoch), j, s["r"]), F.when(j % 2 == 1, a).otherwise(b)).alias("r")),
            lambda s: s["l"] + s["r"] * a)

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), step(pos), lambda x, _: F.when(x < n, x).otherwise(step(x)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("permutation walk did not end")).cast("long"))


def epoch_batches(dataset: DataFrame, epoch: int = 0, seed: int = SEED, shuffle_train: bool = True,
                  train_batch: int = TRAIN_BATCH_SIZE, eval_batch: int = EVAL_BATCH_SIZE) -> DataFrame:
    """Adds ``slot`` (the row's place in its split's epoch order; only the train
    split is shuffled) and ``batch_id``."""
    slot = F.col("pos")
    if shuffle_train:
        slot = F.when(F.col("split") == "train", permuted(F.col("pos"), F.col("n_rows"), seed, epoch)).otherwise(slot)
    size = batch_size_col(F.col("split"), train_batch, eval_batch)
    return dataset.withColumn("slot", slot).withColumn("batch_id", F.floor(F.col("slot") / size).cast("long"))


# ------------------------------------------------------------------ in tasks

class Encoder:
    """Text to ids with a model's merges; remembers the words it has encoded."""

    def __init__(self, model: BpeModel):
        self.ranks = {p: r for r, p in enumerate(model.merges)}
        self.ids = {t: i for i, t in enumerate(model.vocab)}
        self.seen: dict = {}

    def __call__(self, segments: list, most: int) -> list:
        """The first ``most`` ids of a text cut at special tokens."""
        out: list = []
        for s in segments or ():
            if s in SPECIAL_TOKENS:
                out.append(self.ids[s])
            else:
                for w in PRETOKEN.findall(_nfkc_lower(s)):
                    ids = self.seen.get(w)
                    if ids is None:
                        if len(self.seen) >= WORDS_KEPT:
                            self.seen.clear()
                        ids = self.seen[w] = _bpe_word(w, self.ranks, self.ids, UNK_ID)
                    out += ids
                    if len(out) >= most:
                        return out[:most]
            if len(out) >= most:
                break
        return out[:most]


def _lists(rows: list) -> pa.ListArray:
    offs = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(np.array([x for r in rows for x in r], np.int32)))


def _segments(col: str) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(col), F.lit("")), F.lit(SEGMENT_PATTERN), F.lit(0))


def _pad(rows: list) -> pa.ListArray:
    most = max(map(len, rows))
    return _lists([r + [PAD_ID] * (most - len(r)) for r in rows])


def _collator(model, max_len: int):
    """Encodes the rows of one batch after another and pads them to its longest."""
    names = ["split", "batch_id", "slot", "id", "src_padded", "tgt_input_padded", "labels_padded"]

    def run(batches):
        encode = Encoder(model.value)

        def padded(key, rows):
            src = [encode(s, max_len) for _, _, s, _ in rows]
            tgt = [encode(t, max_len - 2) for _, _, _, t in rows]
            return pa.record_batch([
                pa.array([key[0]] * len(rows), pa.string()), pa.array([key[1]] * len(rows), pa.int64()),
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), _pad(src),
                _pad([[SOS_ID, *t] for t in tgt]), _pad([[*t, EOS_ID] for t in tgt])], names)

        key, held = None, []
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("split", "batch_id", "slot", "id", "src", "tgt")]
            for split, batch, *row in zip(*cols, strict=True):
                if key != (split, batch) and held:
                    yield padded(key, held)
                    held = []
                key = split, batch
                held.append(row)
        if held:
            yield padded(key, held)

    return run


def collate_texts(batched: DataFrame, model: BpeModel, src: str = "en", tgt: str = "vi",
                  max_len: int = MAX_SEQ_LEN) -> DataFrame:
    """Padded batches of BPE ids from ``id, split, slot, batch_id`` and two text
    columns: one exchange of the texts by batch, then one Arrow pass."""
    spark = batched.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)  # bounded by the vocabulary size
    rows = batched.select("split", "batch_id", "slot", "id", _segments(src).alias("src"), _segments(tgt).alias("tgt"))
    rows = rows.repartition("split", "batch_id").sortWithinPartitions("split", "batch_id", "slot")
    return rows.mapInArrow(_collator(sent, max_len), """split string, batch_id long, slot long, id long,
        src_padded array<int>, tgt_input_padded array<int>, labels_padded array<int>""")


def prepare_batches(spark: SparkSession, root: str, model: BpeModel, epoch: int = 0, seed: int = SEED, **kw) -> DataFrame:
    """A saved dataset's padded batches of one epoch."""
    return collate_texts(epoch_batches(load_dataset(spark, root), epoch, seed, **kw), model)


# ------------------------------------------------------------------ decoding

def lexical_ids(train: DataFrame, model: BpeModel, src: str = "en", tgt: str = "vi",
                max_len: int = MAX_SEQ_LEN) -> np.ndarray:
    """For every token id the target id that most often stands at its position
    in the training pairs (ties: the smallest), [UNK] where it never occurs.
    Tasks count pairs of ids; the result has one entry a vocabulary token."""
    spark = train.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        encode = Encoder(sent.value)
        for b in batches:
            a, c = [], []
            for s, t in zip(b.column("src").to_pylist(), b.column("tgt").to_pylist(), strict=True):
                x, y = encode(s, max_len), encode(t, max_len - 2)
                n = min(len(x), len(y))
                a += x[:n]
                c += y[:n]
            key, n = np.unique(np.array(a, np.int64) << 32 | np.array(c, np.int64), return_counts=True)
            yield pa.record_batch([pa.array(key >> 32), pa.array(key & 0xFFFFFFFF), pa.array(n.astype(np.int64))], ["src", "next", "n"])

    pairs = train.select(_segments(src).alias("src"), _segments(tgt).alias("tgt")).mapInArrow(run, "src long, next long, n long")
    best = pairs.groupBy("src", "next").agg(F.sum("n").alias("n")).groupBy("src").agg(
        F.max_by("next", F.struct("n", -F.col("next"))).alias("next"))
    out = np.full(len(model.vocab), UNK_ID, np.int32)
    for r in best.collect():  # at most one row a vocabulary token
        out[r["src"]] = r["next"]
    return out


class LexicalScorer:
    """The next id of every live row of a batch: the table's id for the source
    token at the position being written, [EOS] past its end."""

    def __init__(self, table: np.ndarray):
        self.table = table

    def start(self, sources: list) -> dict:
        n = np.array([len(s) for s in sources])
        flat = self.table[np.array([i for s in sources for i in s], np.int64)] if n.sum() else np.zeros(0, np.int32)
        return {"n": n, "first": np.cumsum(n) - n, "flat": np.append(flat, np.int32(EOS_ID))}

    def next(self, state: dict, live: np.ndarray, step: int) -> np.ndarray:
        inside = step < state["n"][live]
        return np.where(inside, state["flat"][np.where(inside, state["first"][live] + step, 0)], EOS_ID)


def decode_together(sources: list, scorer, max_len: int = MAX_SEQ_LEN) -> list:
    """Greedy decoding of many rows in lock step (D1): each step appends one id
    to every live row; a row leaves after [EOS] or at ``max_len``.

    ``scorer.start(sources)`` makes a state for the rows, ``scorer.next(state,
    live, step)`` gives the next id of each row number in ``live``."""
    state = scorer.start(sources)
    out = np.full((len(sources), max_len), PAD_ID, np.int32)
    out[:, 0] = SOS_ID
    size = np.full(len(sources), 1)
    live = np.arange(len(sources))
    for step in range(max_len - 1):
        if not len(live):
            break
        ids = np.asarray(scorer.next(state, live, step))
        out[live, step + 1] = ids
        size[live] += 1
        live = live[ids != EOS_ID]
    return [row[:n].tolist() for row, n in zip(out, size.tolist(), strict=True)]


def decode_captured(sources: list, scorer, max_len: int = MAX_SEQ_LEN) -> tuple[list, list]:
    """(ids, error) of each row: where a batch fails, its halves are decoded by
    themselves, so that only the failing rows are left out (P14)."""
    try:
        return decode_together(sources, scorer, max_len), [None] * len(sources)
    except Exception as e:  # noqa: BLE001 - reported per row
        if len(sources) == 1:
            return [[]], [f"{type(e).__name__}: {e}"]
        half = len(sources) // 2
        parts = [decode_captured(x, scorer, max_len) for x in (sources[:half], sources[half:])]
        return parts[0][0] + parts[1][0], parts[0][1] + parts[1][1]


def translate(texts: DataFrame, model: BpeModel, scorer, key: str = "id", src: str = "en",
              max_len: int = MAX_SEQ_LEN) -> DataFrame:
    """``key, pred_ids, translation, error`` of every text (D2): encoding,
    decoding and the way back to text in one Arrow pass, no exchange."""
    spark = texts.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast((model, scorer))
    kind = dict(texts.dtypes)[key]

    def run(batches):
        m, score = sent.value
        encode, vocab = Encoder(m), np.array(m.vocab, object)
        for b in batches:
            ids, errors = decode_captured([encode(s, max_len) for s in b.column("src").to_pylist()], score, max_len)
            tokens = [vocab[r].tolist() if r else [] for r in ids]
            yield pa.record_batch([b.column(key), _lists(ids), pa.array(tokens, pa.list_(pa.string())),
                                   pa.array(errors, pa.string())], [key, "pred_ids", "tokens", "error"])

    out = texts.select(key, _segments(src).alias("src")).mapInArrow(
        run, f"{key} {kind}, pred_ids array<int>, tokens array<string>, error string")
    return out.select(key, "pred_ids", detokenize("tokens").alias("translation"), "error")
