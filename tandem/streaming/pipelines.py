"""Structured Streaming forms of the cleaner, the funnel, translation and
early stopping (ST1-ST4).

Sources are file streams (Parquet) with explicit schemas; sinks are Parquet
with checkpoint locations in the shared checkpoint folder, so a restarted
query resumes where it stopped; batch functions replace their own output.  ``trigger(availableNow=True)`` processes what
has arrived and stops, which makes batch ≡ stream testable.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tandem.config import CleanConfig, MIN_DELTA, PATIENCE
from tandem.operators import clean as C


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def stream_clean_pairs(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                       schema, cfg: CleanConfig = C.DEFAULT, files_per_trigger: int | None = None) -> None:
    """Incremental cleaning of arriving pair files (ST1): stateless filter,
    append mode."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    src = reader.parquet(source_dir)
    out = C.clean_pairs(src, cfg)
    q = (out.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    _run(q)


def stream_funnel(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                  schema, cfg: CleanConfig = C.DEFAULT, files_per_trigger: int | None = None) -> None:
    """Running funnel counters (ST2): a streaming global aggregation in
    complete mode; every micro-batch overwrites the one-row result table."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    src = C.with_lengths(reader.parquet(source_dir))
    L, R, S = C.length_pred(cfg), C.ratio_pred(cfg), C.score_pred(cfg)
    agg = src.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if(F.coalesce(L, F.lit(False))).alias("n_length"),
        F.count_if(F.coalesce(L & R, F.lit(False))).alias("n_length_ratio"),
        F.count_if(F.coalesce(L & R & S, F.lit(False))).alias("n_all"))

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(sink_dir)

    q = (agg.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _run(q)


def stream_translate(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                     schema, encode_fn, decode_fn, files_per_trigger: int | None = None) -> None:
    """Continuous translation of arriving requests (ST3): blank / control
    dropped, each micro-batch encoded and decoded.  A batch is written to its
    own folder ``batch=<id>``, replacing it, so a replay after a failure leaves
    no duplicates; the elapsed seconds of each batch go to ``<sink>.times``."""
    from tandem.operators.decode import requests_from_text
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    src = requests_from_text(reader.parquet(source_dir), "text")

    def handle(batch: DataFrame, epoch: int) -> None:
        import time
        t0 = time.time()
        decode_fn(encode_fn(batch)).write.mode("overwrite").parquet(f"{sink_dir}/batch={epoch}")
        batch.sparkSession.createDataFrame([(epoch, time.time() - t0)], "batch long, seconds double") \
             .coalesce(1).write.mode("overwrite").parquet(f"{sink_dir}.times/batch={epoch}")

    q = (src.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    _run(q)


EARLY_STOP_OUT = ("run string, epoch int, val_loss double, best double, counter int, "
                  "improved boolean, checkpoint boolean, should_stop boolean")
EARLY_STOP_STATE = "best double, counter int, stopped boolean, last_epoch int"


def _early_stop_fn(patience: int, min_delta: float):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (run,) = key
        if state.exists:
            best, counter, stopped, last = state.get
        else:
            best, counter, stopped, last = float("inf"), 0, False, -1
        frames = [p for p in pdfs if len(p)]
        rows = pd.concat(frames).sort_values("epoch") if frames else pd.DataFrame(columns=["epoch", "val_loss"])
        out = []
        for ep, v in zip(rows["epoch"], rows["val_loss"]):
            ep = int(ep)
            if stopped or ep <= last:
                continue  # latched after the stop; replayed / late epochs ignored
            improved = bool(v < best - min_delta)
            if improved:
                best, counter = float(v), 0
            else:
                counter += 1
            stopped = counter >= patience
            last = ep
            out.append((run, ep, float(v), best, counter, improved, bool(v == best), stopped))
        state.update((best, counter, stopped, last))
        cols = ["run", "epoch", "val_loss", "best", "counter", "improved", "checkpoint", "should_stop"]
        yield pd.DataFrame(out, columns=cols)
    return fn


def stream_early_stop(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                      schema, patience: int = PATIENCE, min_delta: float = MIN_DELTA,
                      files_per_trigger: int | None = None, state_partitions: int | None = None) -> None:
    """Early stopping as per-run state over an arriving metrics stream
    (ST4): ``applyInPandasWithState`` keyed by run; every processed epoch
    is appended with the state after it.

    ``state_partitions`` sizes the state store (the session's shuffle
    partitions by default); it is fixed in the query checkpoint at the first
    start (Spark takes it from ``spark.sql.shuffle.partitions``, set only while
    the query starts)."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    src = reader.parquet(source_dir)
    out = src.groupBy("run").applyInPandasWithState(
        _early_stop_fn(patience, min_delta), EARLY_STOP_OUT, EARLY_STOP_STATE, "append",
        GroupStateTimeout.NoTimeout)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions or old))
    try:
        q = (out.writeStream.format("parquet").option("path", sink_dir)
             .option("checkpointLocation", checkpoint).outputMode("append")
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    _run(q)


def early_stop_summary(log: DataFrame) -> DataFrame:
    """Per run: stop epoch, best loss at the stop, checkpoint epochs."""
    return log.groupBy("run").agg(
        F.min(F.when(F.col("should_stop"), F.col("epoch"))).alias("stop_epoch"),
        F.max_by("best", "epoch").alias("best_loss"),
        F.array_sort(F.collect_list(F.when(F.col("checkpoint"), F.col("epoch")))).alias("checkpoint_epochs"))
