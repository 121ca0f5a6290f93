"""Training-run analytics: epoch mean loss, learning-rate schedule,
step sampling, early stopping, checkpoint epochs, label-smoothed cross
entropy and argmax over logits (A16, A17, F16, F17, F21, O6, P15, W4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.config import LABEL_SMOOTHING, LEARNING_RATE, LOG_EVERY, MIN_DELTA, PAD_ID, PATIENCE, WARMUP_FRACTION
from tandem.operators.fold import fold_slices
from tandem.session import join_measured


def epoch_mean_loss(batches: DataFrame) -> DataFrame:
    """Mean of batch losses per (run, epoch), unweighted."""
    return batches.groupBy("run", "epoch").agg(F.avg("loss").alias("mean_loss"))


def lr_at(step: Column, total: Column, lr: float = LEARNING_RATE,
          warmup_fraction: float = WARMUP_FRACTION) -> Column:
    """Linear warm-up then linear decay (F16); ``total`` = batches × epochs,
    warm-up = int(fraction × total)."""
    w = F.floor(total * F.lit(warmup_fraction)).cast("long")
    warm = step.cast("double") / F.greatest(F.lit(1), w).cast("double")
    decay = F.greatest(F.lit(0.0), (total - step).cast("double") / F.greatest(F.lit(1), total - w).cast("double"))
    return F.lit(lr) * F.when(step < w, warm).otherwise(decay)


def with_lr(batches: DataFrame, lr: float = LEARNING_RATE) -> DataFrame:
    """Add ``total_steps`` per run (one row per run, broadcast by its counted
    size, as a run can hold most rows) and the learning rate at ``step``."""
    return with_total_steps(batches).withColumn("lr", lr_at(F.col("step"), F.col("total_steps"), lr))


def with_total_steps(batches: DataFrame) -> DataFrame:
    """Adds ``total_steps``, the number of batches of the run."""
    totals = batches.groupBy("run").agg(F.count(F.lit(1)).alias("total_steps"))
    return join_measured(batches, totals, "run")


def sample_every_n_steps(batches: DataFrame, every: int = LOG_EVERY,
                         lr: float = LEARNING_RATE) -> DataFrame:
    """Rows whose 1-based batch index is a multiple of ``every``; the logged
    rate is the one after the scheduler step, i.e. at ``step + 1`` (P15)."""
    totals = batches.groupBy("run").agg(F.count(F.lit(1)).alias("total_steps"))
    b = batches.filter((F.col("step") + 1) % every == 0)
    return (join_measured(b, totals, "run")
            .withColumn("lr", lr_at(F.col("step") + 1, F.col("total_steps"), lr)))


def early_stop_state(epochs: DataFrame, patience: int = PATIENCE,
                     min_delta: float = MIN_DELTA, key: str = "run",
                     epoch: str = "epoch", val: str = "val_loss") -> DataFrame:
    """Early-stopping fold per run over epochs in order.

    improvement ⇔ val < best − min_delta (best starts at +inf, NaN never
    improves); counter resets on improvement, else +1; stop at the first
    epoch with counter ≥ patience (latched).  A checkpoint is written
    at every epoch, up to and including the stop, whose loss equals the best
    loss after the update, so ties with the best write one too.

    The epochs stream through a state of constant size (``operators.fold``); the
    only list made is the result's, of the epochs that write a checkpoint
    (``best_checkpoints`` gives them as rows, without a list)."""
    slices = fold_slices(epochs, patience, min_delta, key, epoch, val)
    kept = F.array_sort(F.flatten(F.collect_list("checkpoints")))
    return slices.groupBy(key).agg(F.sum("n").alias("n_epochs"), F.max("stop_epoch").alias("stop_epoch"),
                                   F.max_by("best", "place").alias("best_loss"), kept.alias("checkpoint_epochs"))


def best_checkpoints(epochs: DataFrame, **kw) -> DataFrame:
    """One row per (run, epoch) at which a checkpoint is written."""
    key = kw.get("key", "run")
    return fold_slices(epochs, **kw).select(key, F.explode("checkpoints").alias("epoch"))


def smoothed_cross_entropy(logits: DataFrame, eps: float = LABEL_SMOOTHING,
                           ignore: int = PAD_ID, col: str = "logits",
                           label: str = "label") -> DataFrame:
    """Mean label-smoothed cross entropy over rows whose label is not the
    padding id (F17): (1−ε)(−log p_y) + ε/C Σ_c (−log p_c)."""
    x = F.col(col)
    m = F.array_max(x)
    lse = m + F.log(F.aggregate(F.transform(x, lambda v: F.exp(v - m)), F.lit(0.0), lambda a, b: a + b))
    c = F.size(x).cast("double")
    nll_y = lse - F.element_at(x, F.col(label) + 1)
    smooth = (lse * c - F.aggregate(x, F.lit(0.0), lambda a, b: a + b)) / c
    row = (1 - eps) * nll_y + eps * smooth
    kept = logits.filter(F.col(label) != ignore)
    return kept.agg(F.count(F.lit(1)).alias("n_rows"), F.avg(row).alias("loss"))


def argmax_token(col) -> Column:
    """0-based index of the largest value, ties → lowest index."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")
