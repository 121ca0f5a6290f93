"""The log of training runs as Parquet tables: batch rows, epoch means and
translation samples (S11, P15, O8).

What is logged for an epoch of a run replaces what was logged for it before: a job
that is repeated after a failure leaves no rows twice, and other runs and epochs
stay untouched.  Each job writes a folder of its own, numbered in order, with a few
files however many epochs it logs; a reader takes of each run and epoch the rows of
the last whole folder that has it.  ``compact`` rewrites the folders as one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.config import LEARNING_RATE, LOG_EVERY
from tandem.operators.runs import epoch_mean_loss, lr_at
from tandem.session import drop_scratch
from tandem.sources.aligned import path_exists

TABLES = {
    "batches": "run string, epoch int, step long, loss double, lr double",
    "epochs": "run string, epoch int, mean_loss double",
    "samples": "run string, epoch int, id long, ref string, pred string",
}


class RunLog:
    """A log at ``root``; tables that nothing was logged to read as empty."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folders(self, table: str) -> list:
        """Names of the whole folders of a table, in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = sorted(x.getPath().getName() for x in fs.listStatus(path))
        return [n for n in names if path_exists(self.spark, f"{self.root}/{table}/{n}/_SUCCESS")]

    def read(self, table: str) -> DataFrame:
        cols = [c.strip().split()[0] for c in TABLES[table].split(",")]
        folders = self._folders(table)
        if not folders:
            return self.spark.createDataFrame([], TABLES[table])
        rows = self.spark.read.schema(TABLES[table]).parquet(*[f"{self.root}/{table}/{n}" for n in folders])
        if len(folders) == 1:
            return rows.select(*cols)
        rows = rows.withColumn("_job", F.element_at(F.split("_metadata.file_path", "/"), -2))
        last = rows.groupBy("run", "epoch").agg(F.max("_job").alias("_last"))
        same = rows["run"].eqNullSafe(last["run"]) & rows["epoch"].eqNullSafe(last["epoch"]) & (rows["_job"] == last["_last"])
        return rows.join(last, same, "left_semi").select(*cols)

    def _write(self, rows: DataFrame, table: str) -> None:
        names = [c.strip().split() for c in TABLES[table].split(",")]
        before = self._folders(table)
        nth = 1 + int(before[-1].split("-")[0]) if before else 0
        (rows.select(*[F.col(n).cast(t).alias(n) for n, t in names])
         .write.mode("errorifexists").parquet(f"{self.root}/{table}/{nth:010d}-{uuid.uuid4().hex[:12]}"))

    def compact(self, table: str) -> None:
        """Rewrite a table's folders as one; not while another job logs to it."""
        old = self._folders(table)
        if len(old) > 1:
            self._write(self.read(table), table)
            drop_scratch(self.spark, *[f"{self.root}/{table}/{n}" for n in old])

    def batches(self, batches: DataFrame, total_steps: Column, every: int = LOG_EVERY, lr: float = LEARNING_RATE) -> None:
        """Log ``run, epoch, step, loss``: the rows whose 1-based batch index is a
        multiple of ``every``, with the rate after the scheduler's step.
        ``total_steps`` is the planned length of the run, so an epoch can be logged
        before the next one is there."""
        kept = batches.filter((F.col("step") + 1) % every == 0)
        self._write(kept.withColumn("lr", lr_at(F.col("step") + 1, total_steps, lr)), "batches")

    def epochs(self, batches: DataFrame) -> None:
        """Log the mean loss of every whole epoch in ``batches``."""
        self._write(epoch_mean_loss(batches), "epochs")

    def samples(self, translated: DataFrame, run: str, epoch: int, n: int = 5) -> None:
        """Log the first ``n`` rows by id of ``id, ref, pred``."""
        first = translated.select("id", "ref", "pred").orderBy("id").limit(n)
        self._write(first.select(F.lit(run).alias("run"), F.lit(epoch).alias("epoch"), "*"), "samples")
