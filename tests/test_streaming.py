"""Structured Streaming: stream output over all files equals the batch
result; the stateful early stopper ignores replayed / late epochs."""

import os
import tempfile

from pyspark.sql import functions as F

from tandem.operators import clean as C
from tandem.sources import fixtures as FX
from tandem.streaming import pipelines as SP

SF = "/root/testdata/sf0.001"


def _dirs():
    root = tempfile.mkdtemp(prefix="tandem-stream-")
    return [os.path.join(root, n) for n in ("src", "sink", "ck")]


def test_stream_clean_equals_batch(spark):
    src, sink, ck = _dirs()
    p = FX.pairs(spark, SF)
    p.repartitionByRange(3, "id").write.parquet(src)
    SP.stream_clean_pairs(spark, src, sink, ck, p.schema, files_per_trigger=1)
    got = {r.id for r in spark.read.parquet(sink).collect()}
    want = {r.id for r in C.clean_pairs(p).collect()}
    assert got == want and len(got) == 97


def test_stream_early_stop_ignores_late_epochs(spark):
    src, sink, ck = _dirs()
    schema = "run string, epoch int, val_loss double"
    vals = [5, 4, 4, 4, 4, 4, 4, 3]
    first = [("r", e, float(v)) for e, v in enumerate(vals[:4])]
    # second file: a replayed epoch 2 with a better loss (must be ignored) and the rest
    second = [("r", 2, 0.5)] + [("r", e, float(v)) for e, v in enumerate(vals) if e >= 4]
    spark.createDataFrame(first, schema).coalesce(1).write.mode("append").parquet(src)
    spark.createDataFrame(second, schema).coalesce(1).write.mode("append").parquet(src)
    SP.stream_early_stop(spark, src, sink, ck, spark.createDataFrame([], schema).schema, files_per_trigger=1)
    log = spark.read.parquet(sink)
    s = SP.early_stop_summary(log).first()
    assert s.stop_epoch == 6 and s.best_loss == 4.0 and s.checkpoint_epochs == [0, 1, 2, 3, 4, 5, 6]
    # latched: epoch 7 (after the stop) is not processed
    assert log.filter(F.col("epoch") == 7).count() == 0


def test_stream_translate_replaces_a_replayed_batch(spark):
    src, sink, ck = _dirs()
    spark.createDataFrame([(1, "hello"), (2, "  "), (3, "exit")], "id long, text string").coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    for k in ("a", "b"):  # the second run has lost its checkpoint and sees batch 0 again
        SP.stream_translate(spark, src, sink, ck + k, schema, lambda b: b, lambda e: e.select("id", "request"))
    assert [(r.id, r.request) for r in spark.read.parquet(sink).collect()] == [(1, "hello")]
    assert spark.read.parquet(sink + ".times").filter("seconds >= 0").count() == 1


def test_stream_translate_takes_files_in_several_batches(spark):
    src, sink, ck = _dirs()
    for i in range(3):
        spark.createDataFrame([(i, f"hello {i}")], "id long, text string").coalesce(1).write.mode("append").parquet(src)
    SP.stream_translate(spark, src, sink, ck, spark.read.parquet(src).schema, lambda b: b,
                        lambda e: e.select("id", "request"), files_per_trigger=1)
    assert sorted(n for n in os.listdir(sink) if n.startswith("batch=")) == ["batch=0", "batch=1", "batch=2"]
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [0, 1, 2]


EPOCHS = "run string, epoch int, val_loss double"


def _file(spark, src, rows):
    spark.createDataFrame(rows, EPOCHS).coalesce(1).write.mode("append").parquet(src)


def test_ordered_stop_takes_epochs_in_any_order(spark):
    from tandem.streaming import ordered_stop as OS
    src, sink, ck = _dirs()
    vals = [5.0, 4.0, 4.0, 4.0, 4.0, 4.0, 4.0, 3.0]
    _file(spark, src, [("r", e, vals[e]) for e in (3, 1)] + [("s", 0, 1.0), ("s", None, 0.1)])
    _file(spark, src, [("r", e, vals[e]) for e in (7, 0, 5)] + [("s", 1, None), (None, 0, 2.0)])
    # a replayed epoch with a better loss, one that waits already, and the rest
    _file(spark, src, [("r", 1, 0.5), ("r", 5, 0.5), ("r", 2, vals[2]), ("r", 4, vals[4]), ("r", 6, vals[6])])
    schema = spark.createDataFrame([], EPOCHS).schema
    OS.stream_ordered_stop(spark, src, sink, ck, schema, files_per_trigger=1)
    log = spark.read.parquet(sink)
    s = SP.early_stop_summary(log.filter("run = 'r'")).first()
    assert s.stop_epoch == 6 and s.best_loss == 4.0 and s.checkpoint_epochs == [0, 1, 2, 3, 4, 5, 6]
    assert [(r.epoch, r.val_loss) for r in log.filter("run = 'r'").orderBy("epoch").collect()] == list(enumerate(vals[:7]))
    assert sorted(r.epoch for r in log.filter("run = 's'").collect()) == [0, 1]
    assert log.filter("run is null").count() == 1
    # a restart resumes from the state: the stop is latched
    _file(spark, src, [("r", 7, 0.1), ("s", 2, 0.5)])
    OS.stream_ordered_stop(spark, src, sink, ck, schema, files_per_trigger=1)
    log = spark.read.parquet(sink)
    assert log.filter("run = 'r'").count() == 7 and log.filter("run = 's' and epoch = 2").first().best == 0.5


def test_ordered_stop_ends_silent_runs(spark):
    import time
    from tandem.streaming import ordered_stop as OS
    src, sink, ck = _dirs()
    _file(spark, src, [("gap", 0, 3.0), ("gap", 2, 2.0), ("gap", 4, 2.5), ("whole", 0, 1.0)])
    q = OS.start_ordered_stop(spark, src, sink, ck, spark.createDataFrame([], EPOCHS).schema, silent_ms=2000,
                              trigger={"processingTime": "500 milliseconds"})
    try:
        for _ in range(120):
            time.sleep(0.5)
            if q.exception() is not None:
                raise RuntimeError(str(q.exception()))
            if q.lastProgress and spark.read.schema(OS.OUT).parquet(sink).filter("by_timer").count() == 2:
                break
    finally:
        q.stop()
    got = sorted(spark.read.parquet(sink).select("run", "epoch", "best", "counter", "by_timer").collect())
    assert [tuple(r) for r in got] == [("gap", 0, 3.0, 0, False), ("gap", 2, 2.0, 0, True), ("gap", 4, 2.0, 1, True),
                                       ("whole", 0, 1.0, 0, False)]
