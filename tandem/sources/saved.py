"""Saved tables with a row-offset index: rows by position without a scan of the
table (O2, O3, S2).

``save_rows`` writes a table in order and beside it one row per data file: its
name, the position of its first row and its number of rows.  A position names
one file and a row index in it (``_metadata.row_index``), so a lookup of k
positions reads at most k files, sorts nothing and makes no checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.operators.batching import md5_key
from tandem.sources.aligned import path_exists

FILES = "file string, first long, n long"


def save_rows(df: DataFrame, path: str, order: list) -> None:
    """Write ``df`` in ``order`` to ``path/rows`` and its index to ``path/files``.
    Rows equal in all of ``order`` stand in any order among themselves."""
    spark = df.sparkSession
    df.orderBy(*order).write.mode("errorifexists").parquet(f"{path}/rows")
    saved = spark.read.schema(df.schema).parquet(f"{path}/rows")
    # task numbers pass 99999 and file numbers of a task pass c999: compare them as numbers
    name = F.element_at(F.split("file", "/"), -1)
    place = [F.regexp_extract(name, r"^part-(\d+)", 1).cast("long"), F.regexp_extract(name, r"-c(\d+)\.", 1).try_cast("long")]
    files = (saved.groupBy(F.col("_metadata.file_path").alias("file"))
             .agg((F.max("_metadata.row_index") + 1).alias("n")))
    # one row a file
    before = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    files.select(name.alias("file"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), "n") \
         .write.mode("errorifexists").parquet(f"{path}/files")


class SavedRows:
    """A table written by ``save_rows``; ``schema`` is that of its rows."""

    def __init__(self, spark: SparkSession, path: str, schema):
        if not path_exists(spark, f"{path}/files/_SUCCESS"):
            raise FileNotFoundError(f"no complete saved table at {path}")
        self.spark, self.path, self.schema = spark, path, schema
        self.files = spark.read.schema(FILES).parquet(f"{path}/files")

    def count(self) -> int:
        return self.files.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def rows(self, positions: list, name: str = "row_idx") -> DataFrame:
        """The rows at the given 0-based positions with their position as
        ``name``: one row each however often a position is given, none for
        positions outside the table.  Meant for a driver's handful of positions."""
        wanted = sorted({int(p) for p in positions if p >= 0})
        at = self.spark.createDataFrame([(p,) for p in wanted], "_pos long")
        hits = at.join(self.files, (F.col("_pos") >= F.col("first")) & (F.col("_pos") < F.col("first") + F.col("n"))) \
            .select("_pos", "file", "first").collect()  # at most one a position
        if not hits:
            return self.spark.createDataFrame([], self.schema).withColumn(name, F.lit(None).cast("long"))
        some = sorted({h.file for h in hits})
        data = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/rows/{f}" for f in some])
        data = data.select(*[F.col(f"`{c}`") for c in data.columns],
                           F.element_at(F.split("_metadata.file_path", "/"), -1).alias("_file"),
                           F.col("_metadata.row_index").alias("_row"))
        keep = self.spark.createDataFrame([(h.file, h._pos - h.first, h._pos) for h in hits],
                                          f"_file string, _row long, `{name}` long")
        return data.join(F.broadcast(keep), ["_file", "_row"]).drop("_file", "_row")  # one row a position

    def row_at(self, i: int) -> DataFrame:
        """The row at position ``i``, none outside the table (O2)."""
        return self.rows([i]).drop("row_idx")

    def head(self, n: int) -> DataFrame:
        return self.rows(list(range(min(n, self.count()))))

    def tail(self, n: int) -> DataFrame:
        """The last ``n`` rows (O2)."""
        total = self.count()
        return self.rows(list(range(max(0, total - n), total)))

    def sample(self, k: int, seed: int = 0) -> DataFrame:
        """``k`` seeded positions with replacement, one row a ``draw`` (O3)."""
        total = self.count()
        draws = self.spark.range(k).select(F.col("id").alias("draw"),
                                           F.pmod(md5_key(seed, F.col("id")), F.lit(max(total, 1))).alias("row_idx"))
        picks = [r.row_idx for r in draws.collect()] if total else []  # k numbers
        return self.rows(picks).join(F.broadcast(draws), "row_idx")
