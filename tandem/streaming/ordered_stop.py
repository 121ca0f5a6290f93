"""Early stopping over epochs that arrive in any order (ST4), on the state store.

Each run keeps its fold (a value state) and the epochs that came before their
turn (a map state, epoch -> loss).  An epoch is processed when all before it have
been, so the result does not depend on the order of files or micro-batches.
Replayed epochs and those after the stop are ignored; the first loss of an epoch
counts.  A run that sends nothing for ``silent_ms`` is ended by a timer: epochs that
still wait are processed in order, past the missing ones.  The fold stays, so that
late epochs of an ended or stopped run are ignored; its waiting epochs go.

The waiting epochs of a run are bounded by how far its epochs arrive apart, not
by its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor

from tandem.config import MIN_DELTA, PATIENCE
from tandem.session import ship_package
from tandem.streaming.pipelines import _run

OUT = ("run string, epoch int, val_loss double, best double, counter int, improved boolean, checkpoint boolean, "
       "should_stop boolean, by_timer boolean")
COLUMNS = [c.split()[0] for c in OUT.split(", ")]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE = "spark.sql.streaming.stateStore.providerClass"


class EarlyStop(StatefulProcessor):
    """``silent_ms`` of None sets no timer: a run with a gap waits for ever."""

    def __init__(self, patience: int, min_delta: float, silent_ms: int | None, first_epoch: int = 0):
        self.patience, self.min_delta, self.silent_ms, self.first_epoch = patience, min_delta, silent_ms, first_epoch

    def init(self, handle) -> None:
        self.handle = handle
        self.fold = handle.getValueState("fold", "best double, counter int, next_epoch int, stopped boolean, ended boolean")
        self.waiting = handle.getMapState("waiting", "epoch int", "val_loss double")

    def _get(self) -> list:
        return list(self.fold.get()) if self.fold.exists() else [float("inf"), 0, self.first_epoch, False, False]

    def _take(self, run, state: list, epoch: int, loss, by_timer: bool) -> tuple:
        loss = float("nan") if loss is None else float(loss)
        improved = loss < state[0] - self.min_delta
        state[0], state[1] = (loss, 0) if improved else (state[0], state[1] + 1)
        state[2], state[3] = epoch + 1, state[1] >= self.patience
        return run, epoch, loss, state[0], state[1], improved, loss == state[0], state[3], by_timer

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        (run,), state, out = key, self._get(), []
        for frame in rows:
            for epoch, loss in zip(frame["epoch"], frame["val_loss"]):
                if pd.isna(epoch) or state[3] or state[4] or epoch < state[2]:
                    continue
                epoch = int(epoch)
                if epoch > state[2]:
                    if not self.waiting.containsKey((epoch,)):
                        self.waiting.updateValue((epoch,), (float(loss),))
                    continue
                out.append(self._take(run, state, epoch, loss, False))
                while not state[3] and self.waiting.containsKey((state[2],)):
                    after = state[2]
                    out.append(self._take(run, state, after, self.waiting.getValue((after,))[0], False))
                    self.waiting.removeKey((after,))
        if state[3]:
            self.waiting.clear()
        self.fold.update(tuple(state))
        if self.silent_ms is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
            if not (state[3] or state[4]):
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silent_ms)
        yield pd.DataFrame(out, columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (run,), state, out = key, self._get(), []
        left = sorted((k[0], v[0]) for k, v in self.waiting.iterator()) if self.waiting.exists() else []
        for epoch, loss in left:
            if state[3]:
                break
            out.append(self._take(run, state, epoch, loss, True))
        self.waiting.clear()
        state[4] = True
        self.fold.update(tuple(state))
        yield pd.DataFrame(out, columns=COLUMNS)


def ordered_stops(metrics: DataFrame, patience: int = PATIENCE, min_delta: float = MIN_DELTA,
                  silent_ms: int | None = None, first_epoch: int = 0) -> DataFrame:
    """Adds the state after each epoch to a stream ``run, epoch, val_loss``."""
    return metrics.groupBy("run").transformWithStateInPandas(
        EarlyStop(patience, min_delta, silent_ms, first_epoch), OUT, "append",
        "none" if silent_ms is None else "processingTime")


def start_ordered_stop(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str, schema,
                       files_per_trigger: int | None = None, trigger: dict | None = None,
                       **kw):
    """Start the stopper over arriving metric files and return the query.  Its
    state store must be RocksDB: the session's setting is changed only while the
    query starts, and Spark keeps it in the query's checkpoint."""
    ship_package(spark)
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    out = ordered_stops(reader.parquet(source_dir).select("run", "epoch", "val_loss"), **kw)
    old = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        return (out.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint)
                .outputMode("append").trigger(**(trigger or {"availableNow": True})).start())
    finally:
        spark.conf.unset(STORE) if old is None else spark.conf.set(STORE, old)


def stream_ordered_stop(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str, schema,
                        files_per_trigger: int | None = None, **kw) -> None:
    """Process what has arrived and return."""
    _run(start_ordered_stop(spark, source_dir, sink_dir, checkpoint, schema, files_per_trigger, **kw))
