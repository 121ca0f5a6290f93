"""Line-aligned text sources and Parquet sinks.

Line order is recovered without a global sort or a single-partition window:
every input split (file, block start) is one group whose rows are contiguous
inside one task, so a row's position is ``offset(block) + (row id − first
row id of block)``.  Only the per-block table (one row per split) is ordered
and prefix-summed; it is joined back by broadcast when its size is checked
to be small at run time (AQE), by a shuffled join otherwise.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

PAIR_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("translation", T.StructType([
        T.StructField("en", T.StringType(), True),
        T.StructField("vi", T.StringType(), True),
    ]), True),
])


def file_number(path):
    """The first number in a file's name (part-100000 comes after part-10001);
    NULL, and so before all others, when there is none."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_extract(name, "([0-9]+)", 1).try_cast("decimal(38,0)")


def with_line_index(df: DataFrame, name: str = "line_id") -> DataFrame:
    """Add a contiguous 0-based index in file order.

    ``df`` must come straight from a file scan (``spark.read.text`` /
    ``parquet``) so the split of a row is known from ``_metadata``.  Files
    stand in order of the first number in their name, then of the name.  A
    file that cannot be split (``.gz``) is one block.
    """
    base = df.select("*",
                     F.col("_metadata.file_path").alias("_f"),
                     F.col("_metadata.file_block_start").alias("_b"),
                     F.monotonically_increasing_id().alias("_m"))
    blocks = (base.groupBy("_f", "_b")
              .agg(F.min("_m").alias("_m0"), F.count(F.lit(1)).alias("_n")))
    # one row per input split: the ordered window runs over the block table
    # only, never over the data rows
    w = Window.orderBy(file_number(F.col("_f")), "_f", "_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_f", "_b", "_m0",
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    # The block table is an aggregate, so AQE knows its exact size after
    # its stage runs and broadcasts it only below the broadcast threshold.
    out = (base.join(offsets, ["_f", "_b"], "inner")
           .withColumn(name, (F.col("_off") + F.col("_m") - F.col("_m0")).cast("long")))
    return out.drop("_f", "_b", "_m", "_m0", "_off")


def read_lines(spark: SparkSession, path: str, name: str = "line_id") -> DataFrame:
    """Lines of a text file or directory (files in path order) with index."""
    return with_line_index(spark.read.text(path), name)


def ingest_aligned_text(spark: SparkSession, en_path: str, vi_path: str,
                        strip: bool = True) -> DataFrame:
    """Pair line i of one file with line i of the other (S1 + J1).

    Inner equi-join on ``line_id`` (both sides are large: sort-merge), so the
    result stops at the shorter file; empty lines keep their id.
    """
    from tandem.functions.text import strip_text
    en = read_lines(spark, en_path).select(F.col("line_id").alias("id"), F.col("value").alias("en"))
    vi = read_lines(spark, vi_path).select(F.col("line_id").alias("id"), F.col("value").alias("vi"))
    j = en.join(vi, "id", "inner")
    if strip:
        j = j.select("id", strip_text("en").alias("en"), strip_text("vi").alias("vi"))
    return j


def to_translation(df: DataFrame) -> DataFrame:
    """Enforce the explicit pair schema (S3)."""
    return df.select(F.col("id").cast("long").alias("id"),
                     F.struct(F.col("en").cast("string").alias("en"),
                              F.col("vi").cast("string").alias("vi")).alias("translation"))


def scan_scores(spark: SparkSession, path: str) -> DataFrame:
    """One float per line → ``id, score FLOAT, parse_ok``.

    Blank lines and ``#`` comment lines are skipped before indexing; other
    unparsable lines become NULL scores (counted by ``score_parse_report``)
    instead of failing the job.
    """
    raw = spark.read.text(path)
    from tandem.functions.text import is_blank, strip_text
    kept = raw.filter(~is_blank("value") & ~strip_text("value").startswith("#"))
    number = strip_text("value").try_cast("float")
    return with_line_index(kept).select(F.col("line_id").alias("id"), number.alias("score"),
                                        number.isNotNull().alias("parse_ok"))


def score_parse_report(scores: DataFrame) -> DataFrame:
    return scores.agg(F.count(F.lit(1)).alias("n_scores"),
                      F.count_if(~F.col("parse_ok")).alias("n_unparsable"))


def _hadoop(spark: SparkSession, path: str):
    """The path's file system and its Hadoop path."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop(spark, path)
    return fs.exists(jpath)


def write_if_absent(df: DataFrame, path: str) -> bool:
    """Save unless a complete output exists; the plan is not executed when it
    does (S4, S5).  A folder without ``_SUCCESS`` is a broken write and is
    written anew.  Returns True when written."""
    if path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        log.info("output exists at %s, skipping", path)
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_cleaned(df: DataFrame, path: str) -> bool:
    """Project ``id, translation`` and save if absent."""
    return write_if_absent(to_translation(df) if "translation" not in df.columns
                           else df.select("id", "translation"), path)


def restore(spark: SparkSession, path: str) -> None:
    """Finish a swap of ``write_final`` that was broken off: the old table comes
    back if ``path`` is missing, and goes if the new one stands."""
    fs, target = _hadoop(spark, path)
    old = _hadoop(spark, f"{path.rstrip('/')}.old")[1]
    if fs.exists(old):
        if fs.exists(target):
            fs.delete(old, True)
        else:
            fs.rename(old, target)


def write_final(df: DataFrame, path: str) -> None:
    """Project ``translation`` and replace what is at ``path`` (S6).  The rows
    are written beside it first, so ``path`` may be an input of ``df`` and a
    failed job leaves the old table.  The old table is moved to ``<path>.old`` and
    deleted only when the new one stands: at every moment one complete table is
    there, and ``restore`` (called first) brings it back after a crash."""
    spark = df.sparkSession
    restore(spark, path)
    log.warning("overwriting %s", path)
    cols = ["translation"] if "translation" in df.columns else None
    out = df.select(*cols) if cols else to_translation(df).select("translation")
    base = path.rstrip("/")
    new = f"{base}.new-{uuid.uuid4().hex[:8]}"
    out.write.parquet(new)
    fs, target = _hadoop(spark, path)
    old = _hadoop(spark, f"{base}.old")[1]
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(_hadoop(spark, new)[1], target):
        raise OSError(f"could not move {new} to {path}")
    fs.delete(old, True)


def scan_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Load a saved pair table with the explicit schema (S7); a missing
    path raises a clear error (deliberate: the reference only logs)."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"pair table not found: {path}")
    return spark.read.schema(PAIR_SCHEMA).parquet(path)


def scan_splits(spark: SparkSession, root: str, for_tokenizer: bool = False) -> DataFrame:
    """Read ``root/split=train|validation|test`` (partition column ``split``),
    drop blank pairs; ``for_tokenizer`` keeps train only (partition pruning)
    (S9, U4)."""
    from tandem.operators.clean import nonempty_pred
    df = spark.read.parquet(root)
    df = (df.select("*", F.col("translation.en").alias("en"), F.col("translation.vi").alias("vi"))
          .filter(nonempty_pred()).drop("en", "vi"))
    if for_tokenizer:
        df = df.filter(F.col("split") == "train")
    return df


def write_splits(df: DataFrame, root: str) -> None:
    """Write a tagged pair table partitioned by ``split``."""
    df.write.mode("overwrite").partitionBy("split").parquet(root)


def metrics_append(df: DataFrame, path: str) -> None:
    """Append metric / sample rows to a Parquet log."""
    df.write.mode("append").parquet(path)


def save_vocab(vocab: DataFrame, merges: DataFrame | None, root: str) -> None:
    """Persist a tokenizer as two Parquet tables ``vocab(token, id)`` and
    ``merges(rank, left, right)`` (S10)."""
    vocab.select("token", F.col("id").cast("int").alias("id")).write.mode("overwrite").parquet(f"{root}/vocab")
    if merges is not None:
        merges.select(F.col("rank").cast("int").alias("rank"), "left", "right") \
              .write.mode("overwrite").parquet(f"{root}/merges")


def load_vocab(spark: SparkSession, root: str, specials=None) -> DataFrame:
    """Reload a saved vocabulary and check that the special tokens carry
    their fixed ids (S10).  The check is one small filtered aggregate."""
    from tandem.config import SPECIAL_TOKENS
    specials = list(specials or SPECIAL_TOKENS)
    v = spark.read.schema("token string, id int").parquet(f"{root}/vocab")
    want = {t: i for i, t in enumerate(specials)}
    got = {r["token"]: r["id"] for r in v.filter(F.col("token").isin(*specials)).collect()}
    if got != want:
        raise ValueError(f"special token ids {got} differ from {want}")
    return v


def load_merges(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("rank int, left string, right string").parquet(f"{root}/merges")
