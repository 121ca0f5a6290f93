"""The run log keeps one copy of what is logged twice; scratch tables go with
their scope."""

import os

import pytest
from pyspark.sql import functions as F

from tandem.operators import runs as R
from tandem.operators.runlog import RunLog
from tandem.session import checkpoint_root, scratch_path, scratch_scope

SF = "/root/testdata/sf0.001"


def test_run_log_replaces_only_its_epoch(spark):
    log = RunLog(spark, scratch_path(spark, "log"))
    assert log.read("batches").count() == 0 and log.read("samples").columns == ["run", "epoch", "id", "ref", "pred"]
    steps = spark.range(400).select(F.lit("a").alias("run"), F.floor(F.col("id") / 100).cast("int").alias("epoch"),
                                    F.col("id").alias("step"), F.col("id").cast("double").alias("loss"), F.lit(0).alias("lr"))
    for e in (0, 1, 1, 2):
        log.batches(steps.filter(F.col("epoch") == e), F.lit(400), every=30)
        log.epochs(steps.filter(F.col("epoch") == e))
    log.batches(steps.filter("epoch = 1").withColumn("run", F.lit("b")), F.lit(400), every=30)
    got = sorted((r.run, r.step) for r in log.read("batches").collect())
    assert got == [("a", s) for s in range(29, 300, 30)] + [("b", s) for s in range(119, 200, 30)]
    want = R.sample_every_n_steps(steps.drop("lr"), every=30).filter("epoch < 3")
    assert {(r.step, r.lr) for r in log.read("batches").filter("run = 'a'").collect()} == {(r.step, r.lr) for r in want.collect()}
    assert sorted((r.epoch, r.mean_loss) for r in log.read("epochs").collect()) == [(0, 49.5), (1, 149.5), (2, 249.5)]
    # a repeated epoch with other rows leaves none of the old
    log.batches(steps.filter("step >= 100 and step < 130"), F.lit(400), every=30)
    assert [r.step for r in log.read("batches").filter("run = 'a' and epoch = 1").collect()] == [119]


def test_samples_are_the_first_by_id(spark):
    log = RunLog(spark, scratch_path(spark, "log"))
    t = spark.createDataFrame([(i, f"r{i}", None if i == 3 else f"p{i}", "x") for i in (9, 3, 7, 5, 1, 8)],
                              "id long, ref string, pred string, run string")
    log.samples(t, "m", 4)
    log.samples(t, "m", 4)
    assert [tuple(r) for r in log.read("samples").orderBy("id").collect()] == [
        ("m", 4, i, f"r{i}", None if i == 3 else f"p{i}") for i in (1, 3, 5, 7, 8)]


def _scratch(spark):
    root = checkpoint_root(spark).replace("file:", "")
    return {n for n in os.listdir(root) if n.startswith("tandem-")}


@pytest.mark.parametrize("name", ["scan_pairs", "row_at", "aligned_reader", "stream_clean_pairs"])
def test_scratch_tables_go_with_their_scope(spark, tmp_path, name):
    import __spark_entry__ as E
    before = _scratch(spark)
    with scratch_scope(spark):
        E.queries()[name](spark, SF).write.parquet(str(tmp_path / "out"))
        assert _scratch(spark) > before
    assert _scratch(spark) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0 or name == "row_at"  # fewer rows than 1000 here
    with pytest.raises(RuntimeError):
        with scratch_scope(spark):
            spark.range(3).write.parquet(scratch_path(spark, "broken"))
            raise RuntimeError
    assert _scratch(spark) == before


def test_files_do_not_grow_with_epochs(spark, tmp_path):
    """Many epochs in a job: a few files; a job that broke off is not read; the log can be compacted."""
    log = RunLog(spark, str(tmp_path / "log"))
    steps = spark.range(0, 3000, 1, 3).select(F.lit("r").alias("run"), F.floor(F.col("id") / 10).cast("int").alias("epoch"),
                                              F.col("id").alias("step"), F.lit(0.5).alias("loss"))
    log.batches(steps, F.lit(3000), every=5)
    log.batches(steps.filter("epoch >= 100 and step % 10 < 5"), F.lit(3000), every=5)
    files = [f for _, _, fs in os.walk(tmp_path) for f in fs if f.endswith(".parquet")]
    assert len(files) <= 6
    want = sorted([s for s in range(4, 1000, 5)] + [s for s in range(1004, 3000, 10)])
    assert sorted(r.step for r in log.read("batches").collect()) == want
    broken = tmp_path / "log" / "batches" / "9999999999-x"
    steps.limit(1).write.parquet(str(broken))
    os.remove(broken / "_SUCCESS")
    assert sorted(r.step for r in log.read("batches").collect()) == want
    log.compact("batches")
    assert sorted(r.step for r in log.read("batches").collect()) == want and len(log._folders("batches")) == 1
