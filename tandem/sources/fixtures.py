"""Bitext inputs derived by Spark from the shared tables.

The engine's native inputs are aligned text files (see ``aligned``); these
builders derive the same schemas from the driver's parquet tables so every
operator runs over whole tables and grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.session import read_table

# Scores: pair k of document d reads event ``(d * SCORE_STEP + k)`` modulo the
# number of events, so every pair has one.
SCORE_STEP = 10


def pairs(spark: SparkSession, sf_dir: str, with_score: bool = True) -> DataFrame:
    """Pair table ``id, en, vi[, score]`` over every line of every document
    (FIXTURES B1); after an odd number of lines the last one is paired with an
    empty line.

    Pair k of a document has the id ``doc_id * stride + k``, where ``stride``
    is the largest number of pairs of any document (one aggregate, a scalar
    subquery), so ids never collide.  The score comes from ``events`` by a left
    join; the events side is projected to two columns and AQE broadcasts it
    only when its runtime size is below the threshold, otherwise both sides
    shuffle.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.split(F.col("text"), "\n")
    n_pairs = F.ceil(F.size(lines) / 2).cast("int")
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n")))
    stride = docs.agg(F.max(F.floor(breaks / 2) + 1).cast("long").alias("stride")).scalar()
    events = read_table(spark, sf_dir, "events")
    p = (docs
         .select("doc_id", lines.alias("a"), n_pairs.alias("n"))
         .select("doc_id", "a", F.explode(
             F.when(F.col("n") >= 1, F.sequence(F.lit(0), F.col("n") - 1))).alias("k"))
         .select((F.col("doc_id") * stride + F.col("k")).cast("long").alias("id"),
                 F.get(F.col("a"), 2 * F.col("k")).alias("en"),
                 F.coalesce(F.get(F.col("a"), 2 * F.col("k") + 1), F.lit("")).alias("vi"),
                 (F.col("doc_id") * SCORE_STEP + F.col("k")).alias("score_key")))
    if not with_score:
        return p.drop("score_key")
    n_events = events.agg(F.nullif(F.count(F.lit(1)), F.lit(0)).alias("n")).scalar()
    p = p.withColumn("score_key", F.pmod("score_key", n_events))
    ev = events.select(F.col("event_id").alias("score_key"),
                       (F.col("value") / 50).cast("float").alias("score"))
    return p.join(ev, "score_key", "left").drop("score_key")


def sentences(pairs_: DataFrame) -> DataFrame:
    """Both sides of every pair as rows ``sent_id, lang, sentence``
    (``sent_id`` = 2 * id for en, one more for vi)."""
    return pairs_.select(F.explode(F.array(
        F.struct((F.col("id") * 2).alias("sent_id"), F.lit("en").alias("lang"), F.col("en").alias("sentence")),
        F.struct((F.col("id") * 2 + 1).alias("sent_id"), F.lit("vi").alias("lang"), F.col("vi").alias("sentence")),
    )).alias("s")).select("s.*")


def as_translation(df: DataFrame, keep=("id",)) -> DataFrame:
    """Typed pair table: ``id BIGINT, translation STRUCT<en, vi>`` (S3)."""
    return df.select(*[F.col(k) for k in keep],
                     F.struct(F.col("en").cast("string").alias("en"),
                              F.col("vi").cast("string").alias("vi")).alias("translation"))


def splits(df: DataFrame) -> DataFrame:
    """Tag rows with ``split``: train (id%10<8), validation (=8), test (=9)."""
    r = F.col("id") % 10
    return df.withColumn("split", F.when(r < 8, "train")
                         .when(r == 8, "validation").otherwise("test"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch training log ``run, step, epoch, loss`` (FIXTURES B4).

    One run per event type; ``step`` is the 0-based position in (ts,
    event_id) order within the run.  A run can hold a large share of all
    rows, so the numbering is a range-partitioned sort plus per-partition
    offsets (``index_within``), not a window partitioned by run."""
    from tandem.operators.batching import index_within
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), "ts", "event_id", F.col("value").alias("loss"))
    idx = index_within(ev, "run", [F.col("ts"), F.col("event_id")], "step")
    return (idx.select("run", F.col("step").cast("long").alias("step"), "loss")
            .withColumn("epoch", F.floor(F.col("step") / 100).cast("int")))


def epoch_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-epoch validation loss ``run, epoch, val_loss`` (mean batch loss)."""
    return (runs(spark, sf_dir).groupBy("run", "epoch")
            .agg(F.avg("loss").alias("val_loss")))


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logit rows ``vec_id, logits ARRAY<DOUBLE>, label`` (FIXTURES B5)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("logits"), "label")
