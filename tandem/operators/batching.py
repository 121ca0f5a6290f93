"""Batching: ordered row index, batch assignment, seeded shuffle, teacher
forcing shift, per-batch padding and attention masks (W1, W3, O5, A18, A20,
F7-F10).

No single-partition window is used: a global order is a range-partitioned
sort, checkpointed (reliably) so its partitions are stable, plus a prefix sum
over per-partition counts (one row per partition).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tandem.config import EVAL_BATCH_SIZE, PAD_ID, SEED, TRAIN_BATCH_SIZE


def ordered_index(df: DataFrame, order_cols: list, name: str = "row_idx", stored: bool = False) -> DataFrame:
    """Contiguous 0-based index in ``order_cols`` order (distributed).  With ``stored``
    the sorted rows are a compressed Parquet table, of which later steps read only the
    columns they need, instead of a checkpoint of whole rows."""
    from tandem.session import checkpoint_root, written
    checkpoint_root(df.sparkSession)
    pid = F.spark_partition_id()
    part = [pid.alias("_part"), (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("_in")]
    srt = df.orderBy(*order_cols)
    here = written(srt.select("*", *part), "ordered") if stored else srt.checkpoint(eager=True).select("*", *part)
    # one row per partition: its prefix sum is the only unpartitioned window
    counts = here.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_off"))
    return (here.join(F.broadcast(offsets), "_part")
            .select(*df.columns, (F.col("_off") + F.col("_in")).alias(name)))


def md5_key(seed, *parts) -> Column:
    """A seeded pseudo-random 60-bit number of the given columns: the first 15
    hex digits of the MD5 of "seed:part:part..."."""
    text = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def index_within(df: DataFrame, part: str, order: list, name: str = "row_idx", stored: bool = False) -> DataFrame:
    """Index restarting at 0 for every value of ``part`` (``stored``: see ``ordered_index``)."""
    from tandem.session import join_measured
    g = ordered_index(df, [F.col(part)] + order, "_gidx", stored)
    starts = g.groupBy(part).agg(F.min("_gidx").alias("_start"))  # one row per part value
    return (join_measured(g, starts, part)
            .withColumn(name, F.col("_gidx") - F.col("_start")).drop("_gidx", "_start"))


def batch_size_col(split: Column, train_batch: int = TRAIN_BATCH_SIZE,
                   eval_batch: int = EVAL_BATCH_SIZE) -> Column:
    return F.when(split == "train", F.lit(train_batch)).otherwise(F.lit(eval_batch))


def batch_assign(df: DataFrame, train_batch: int = TRAIN_BATCH_SIZE,
                 eval_batch: int = EVAL_BATCH_SIZE, shuffle_train: bool = False,
                 seed: int = SEED, epoch: int = 0) -> DataFrame:
    """Consecutive rows in groups of the split's batch size, last partial
    batch kept (W3).  ``shuffle_train`` orders train rows by a seeded hash
    of (seed, epoch, id) first (O5); validation / test stay in id order."""
    if shuffle_train:
        key = F.when(F.col("split") == "train", md5_key(seed, F.lit(epoch), F.col("id"))) \
               .otherwise(F.lit(0).cast("long"))
        df = df.withColumn("_order", key)
        idx = index_within(df, "split", [F.col("_order"), F.col("id")], "pos", True).drop("_order")
    else:
        idx = index_within(df, "split", [F.col("id")], "pos", True)
    bs = batch_size_col(F.col("split"), train_batch, eval_batch)
    return idx.withColumn("batch_id", F.floor(F.col("pos") / bs).cast("long"))


def seeded_shuffle(df: DataFrame, seed: int = SEED, epoch: int = 0) -> DataFrame:
    """The rows in a deterministic random order, numbered by ``pos``."""
    held = df.withColumn("_order", md5_key(seed, F.lit(epoch), F.col("id")))
    return ordered_index(held, [F.col("_order"), F.col("id")], "pos").drop("_order")


def shifted_targets(tgt: str = "tgt_ids"):
    """Teacher forcing: decoder input = tgt[:-1], labels = tgt[1:]."""
    n = F.greatest(F.size(tgt) - 1, F.lit(0))
    return F.slice(tgt, 1, n).alias("dec_input_ids"), F.slice(tgt, 2, n).alias("labels")


def pad_to(col: str, length: Column, pad: int = PAD_ID) -> Column:
    """Right-pad an id array with ``pad`` up to ``length``."""
    return F.concat(F.col(col), F.array_repeat(F.lit(pad), F.greatest(length - F.size(col), F.lit(0))))


def padding_mask(col) -> Column:
    """True where the id is not padding (F8)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.transform(c, lambda x: x != PAD_ID)


def look_ahead_mask(t: Column) -> Column:
    """T×T lower-triangular mask incl. the diagonal."""
    rng = F.sequence(F.lit(0), t - 1)
    return F.when(t > 0, F.transform(rng, lambda q: F.transform(rng, lambda k: k <= q))) \
            .otherwise(F.array().cast("array<array<boolean>>"))


def target_mask(col, packed: bool = False) -> Column:
    """Padding mask AND look-ahead: m[q][k] = pm[k] ∧ k ≤ q (F10).  The padding mask
    is made once a row (bound by the outer transform) and each row of the result is a
    slice of it and a run of False.

    With ``packed`` a row of the mask is a binary with a byte 0 or 1 (as text) for each
    cell, copied as a block, where an array has an object for each cell; a cell that is
    NULL is 0."""
    def rows(pm):
        return F.transform(F.sequence(F.lit(1), F.size(pm)), lambda q: F.concat(
            F.slice(pm, F.lit(1), q), F.array_repeat(F.lit(False), F.size(pm) - q)))

    if packed:
        return _packed_target_mask(F.col(col) if isinstance(col, str) else col)
    return F.get(F.transform(F.array(padding_mask(col)), lambda pm: F.when(F.size(pm) > 0, rows(pm)).otherwise(
        F.array().cast("array<array<boolean>>"))), F.lit(0))


def _packed_target_mask(ids: Column) -> Column:
    """Row q is the padding mask up to q, then zeros; the rows from the last True on are
    the padding mask itself and share its bytes."""
    bits = F.array_join(padding_mask(ids).cast("array<int>").cast("array<string>"), "", "0").cast("binary")
    zeros = F.repeat(F.lit("0"), F.size(ids) - 1).cast("binary")  # from place q on: those of row q
    rest = F.lit(2**31 - 1)

    def rows(b, z):
        n, last = F.length(b), F.greatest(F.length(F.rtrim(b.cast("string"), F.lit("0"))), F.lit(1))
        unlike = F.transform(F.sequence(F.lit(1), last), lambda q: F.concat(F.substring(b, F.lit(1), q), F.substring(z, q, rest)))
        return F.when(n > 0, F.concat(unlike, F.array_repeat(b, n - last))).otherwise(F.array().cast("array<binary>"))

    return F.get(F.transform(F.array(bits), lambda b: F.get(F.transform(F.array(zeros), lambda z: rows(b, z)), F.lit(0))), F.lit(0))


def mask_strings(df: DataFrame, col: str, rows: int = 128) -> DataFrame:
    """``df`` with the masks of ``col`` as text: their rows as 0 and 1, joined by
    slashes; ``rows`` masks are in memory at once.  Packed rows are text already and
    are joined where they are."""
    if dict(df.dtypes)[col] == "array<binary>":
        return df.withColumn(col, F.array_join(F.col(col).cast("array<string>"), "/"))
    kinds = ", ".join(f"`{c}` {'string' if c == col else t}" for c, t in df.dtypes)

    def run(batches):
        for b in batches:
            at = b.schema.get_field_index(col)
            for s in range(0, len(b), rows):
                part = b.slice(s, rows)
                yield part.set_column(at, col, _as_text(part.column(at)))
    return df.mapInArrow(run, kinds)


def _as_text(masks: pa.ListArray) -> pa.Array:
    n, k = len(masks), masks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    inner = masks.flatten()
    length = inner.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    bits = inner.flatten().fill_null(False).to_numpy(zero_copy_only=False)
    width = length + 1  # with its slash, but for a mask's last row
    width[(np.cumsum(k) - 1)[k > 0]] -= 1
    starts = np.cumsum(width) - width
    out = np.full(int(width.sum()), ord("/"), np.uint8)
    out[np.arange(len(bits)) + np.repeat(starts - (np.cumsum(length) - length), length)] = bits + np.uint8(ord("0"))
    ends = np.concatenate(([0], np.cumsum(np.bincount(np.repeat(np.arange(n), k), weights=width, minlength=n))))
    text = pa.StringArray.from_buffers(n, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out))
    return pc.if_else(masks.is_valid(), text, None) if masks.null_count else text


def collate(batched: DataFrame, masks: bool = False, packed: bool = False) -> DataFrame:
    """Per-batch dynamic padding (A18, F7) and masks (F8-F10; ``packed``: see
    ``target_mask``).

    ``batched`` has ``split, batch_id, src_ids, tgt_ids``.  Batch maxima come
    from a window partitioned by (split, batch_id): small groups spread over
    all tasks (one shuffle)."""
    dec, lab = shifted_targets("tgt_ids")
    b = batched.select("*", dec, lab)
    w = Window.partitionBy("split", "batch_id")
    b = (b.withColumn("T_src", F.max(F.size("src_ids")).over(w))
          .withColumn("T_tgt", F.max(F.size("dec_input_ids")).over(w)))
    out = b.select("*",
                   pad_to("src_ids", F.col("T_src")).alias("src_padded"),
                   pad_to("dec_input_ids", F.col("T_tgt")).alias("tgt_input_padded"),
                   pad_to("labels", F.col("T_tgt")).alias("labels_padded"))
    out = out.withColumn("src_mask", padding_mask("src_padded"))
    if masks:
        out = out.withColumn("tgt_mask", target_mask("tgt_input_padded", packed))
    return out


def prepare_batches(encoded: DataFrame, masks: bool = False, **kw) -> DataFrame:
    """Encoded pairs ``id, split, src_ids, tgt_ids`` → padded batches (X8):
    batch assignment, then padding to each batch's longest row."""
    return collate(batch_assign(encoded, **kw), masks)


def split_sizes(df: DataFrame, train_batch: int = TRAIN_BATCH_SIZE,
                eval_batch: int = EVAL_BATCH_SIZE) -> DataFrame:
    """Rows per split and batches = ceil(rows / batch size)."""
    bs = F.when(F.col("split") == "train", F.lit(float(train_batch))).otherwise(F.lit(float(eval_batch)))
    return (df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
            .select("split", "n_rows", F.ceil(F.col("n_rows") / bs).cast("long").alias("n_batches")))


def head_n(df: DataFrame, n: int, order: str = "id") -> DataFrame:
    """First ``n`` rows by storage order (O1).  With a contiguous line index
    this is a pushed-down filter; otherwise a bounded top-n."""
    if order == "line_id":
        return df.filter(F.col("line_id") < n)
    from tandem.operators.profile import bounded_top_n
    return bounded_top_n(df, order, n)


def context_windows(df: DataFrame, key: str, text: str, c: int = 3) -> DataFrame:
    """Every language-model window: X = words[i:i+c], Y = words[i+1:i+1+c]
    for i in [0, n−c), words split on single spaces (W2).  Rows with n ≤ c
    give none."""
    w = F.split(F.col(text), " ")
    base = df.select(key, w.alias("w"))
    starts = F.when(F.size("w") > c, F.sequence(F.lit(0), F.size("w") - c - 1))
    ex = base.select(key, "w", F.explode(starts).alias("i"))
    return ex.select(key, "i", F.slice("w", F.col("i") + 1, c).alias("x"),
                     F.slice("w", F.col("i") + 2, c).alias("y"))


def sample_windows(df: DataFrame, key: str, text: str, c: int = 3, batch: int = 2,
                   seed: int = 0) -> DataFrame:
    """Language-model batch per text (W2, sampled form): ``batch`` window
    starts drawn uniformly *with replacement* from [0, n−c), seeded by
    ``md5_key(seed, key, j)`` — row-local, no shuffle, reproducible on any
    cluster.  Texts with n ≤ c give none."""
    w = F.split(F.col(text), " ")
    base = df.select(key, w.alias("w")).filter(F.size("w") > c)
    span = (F.size("w") - c).cast("long")
    starts = F.transform(F.sequence(F.lit(0), F.lit(batch - 1)),
                         lambda j: F.struct(j.alias("j"), F.pmod(md5_key(seed, F.col(key), j), span)
                                            .cast("int").alias("i")))
    ex = base.select(key, "w", F.explode(starts).alias("d"))
    return ex.select(key, F.col("d.j").alias("draw"), F.col("d.i").alias("i"),
                     F.slice("w", F.col("d.i") + 1, c).alias("x"),
                     F.slice("w", F.col("d.i") + 2, c).alias("y"))
