"""Source / sink queries over real files.

The aligned-text fixture (FIXTURES B6) is written by Spark from the pair
table into the shared checkpoint folder: ``en``, ``vi`` and ``score`` text
files ordered by id (a range-partitioned global sort, part files in order).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tandem.plans.registry import query
from tandem.plans.sql import with_pairs
from tandem.session import scratch_path, written
from tandem.sources import aligned as A
from tandem.sources import aligned_reader as AR
from tandem.sources import fixtures as FX

def aligned_files(spark, sf_dir: str, drop_last_vi: bool = False) -> dict:
    """Write the pair fixture as three line-aligned text files."""
    root = scratch_path(spark, "aligned")
    p = written(FX.pairs(spark, sf_dir), "pairs")  # each file sorts it anew
    ordered = p.orderBy("id")
    ordered.select(F.coalesce("en", F.lit("")).alias("value")).write.text(f"{root}/en")
    vi = ordered
    if drop_last_vi:
        last = p.agg(F.max("id").alias("m"))
        vi = p.join(last, p.id == last.m, "left_anti").orderBy("id")
    vi.select(F.coalesce("vi", F.lit("")).alias("value")).write.text(f"{root}/vi")
    (ordered.select(F.coalesce(F.col("score").cast("string"), F.lit("nan")).alias("value"))
     .write.text(f"{root}/score"))
    return {"en": f"{root}/en", "vi": f"{root}/vi", "score": f"{root}/score"}


STRIP_SQL = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


@query("ingest_aligned_text", with_pairs(f"""
SELECT row_number() OVER (ORDER BY id) - 1 AS id,
       {STRIP_SQL.format(c='en')} AS en, {STRIP_SQL.format(c='vi')} AS vi FROM p
"""))
def q_ingest_aligned_text(spark, sf_dir):
    f = aligned_files(spark, sf_dir)
    return A.ingest_aligned_text(spark, f["en"], f["vi"])


@query("line_index", with_pairs("""
SELECT row_number() OVER (ORDER BY id) - 1 AS line_id, en AS value FROM p
"""))
def q_line_index(spark, sf_dir):
    f = aligned_files(spark, sf_dir)
    return A.read_lines(spark, f["en"]).select("line_id", "value")


@query("zip_join", with_pairs("""
SELECT id, en, vi FROM (
  SELECT row_number() OVER (ORDER BY id) - 1 AS id, en,
         lead(vi) OVER (ORDER BY id) AS nxt, vi FROM p)
WHERE nxt IS NOT NULL
"""))
def q_zip_join(spark, sf_dir):
    """The vi file is one line shorter: the zip stops at the shorter file."""
    f = aligned_files(spark, sf_dir, drop_last_vi=True)
    return A.ingest_aligned_text(spark, f["en"], f["vi"], strip=False)


_ZIP_SQL = with_pairs("""
SELECT row_number() OVER (ORDER BY id) - 1 AS id, en, vi FROM p
QUALIFY lead(id) OVER (ORDER BY id) IS NOT NULL
""")


@query("aligned_reader", _ZIP_SQL)
def q_aligned_reader(spark, sf_dir):
    """The zip of ``zip_join`` by the data source: no join, blocks of 64 KB here
    so that the lines of a block lie across files and blocks of the other side."""
    f = aligned_files(spark, sf_dir, drop_last_vi=True)
    return AR.read_aligned(spark, {"en": f["en"], "vi": f["vi"]}, block=1 << 16)


@query("aligned_stream", _ZIP_SQL)
def q_aligned_stream(spark, sf_dir):
    """The same lines arriving as a stream and appended to a table."""
    f = aligned_files(spark, sf_dir, drop_last_vi=True)
    marks, sink, ck = (scratch_path(spark, n) for n in ("line-marks", "aligned-out", "aligned-ck"))
    AR.mark_lines(spark, {"en": f["en"], "vi": f["vi"]}, marks, block=1 << 16)
    (AR.stream_aligned(spark, ["en", "vi"], marks).writeStream.format("parquet").option("path", sink)
     .option("checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema("id long, en string, vi string").parquet(sink)


@query("scan_scores", with_pairs("""
SELECT row_number() OVER (ORDER BY id) - 1 AS id,
       round(CAST(coalesce(score, 'nan'::FLOAT) AS DOUBLE), 6) AS score FROM ps
"""))
def q_scan_scores(spark, sf_dir):
    f = aligned_files(spark, sf_dir)
    s = A.scan_scores(spark, f["score"])
    return s.select("id", F.round(F.col("score").cast("double"), 6).alias("score"))


@query("scan_pairs", with_pairs("""
SELECT id, en, vi FROM pl
WHERE len_en BETWEEN 3 AND 150 AND len_vi BETWEEN 3 AND 150
  AND len_en > 0 AND len_vi > 0 AND len_en*2.0 >= len_vi AND len_vi*2.0 >= len_en
  AND NOT isnan(score) AND score > CAST(1.0872 AS FLOAT)
"""))
def q_scan_pairs(spark, sf_dir):
    """clean → write_cleaned (skip-if-exists) → write_final → both read back
    and joined on their text, so either file's rows would be missed."""
    from tandem.operators.clean import clean_pairs
    cleaned = clean_pairs(FX.pairs(spark, sf_dir))
    path = scratch_path(spark, "cleaned")
    A.write_cleaned(cleaned, path)
    assert not A.write_cleaned(cleaned, path)  # second call is skipped
    final = scratch_path(spark, "final")
    A.write_final(A.scan_pairs(spark, path), final)  # translation only
    A.write_final(spark.read.parquet(final), final)  # a second time over its own input
    t = A.scan_pairs(spark, path)
    t = t.join(spark.read.parquet(final).distinct(), "translation", "left_semi")
    return t.select("id", F.col("translation.en").alias("en"), F.col("translation.vi").alias("vi"))


@query("scan_splits", with_pairs("""
SELECT id, CASE WHEN id % 10 < 8 THEN 'train' WHEN id % 10 = 8 THEN 'validation'
                ELSE 'test' END AS split
FROM p WHERE length(trim(coalesce(en, ''))) > 0 AND length(trim(coalesce(vi, ''))) > 0
"""))
def q_scan_splits(spark, sf_dir):
    root = scratch_path(spark, "splits")
    A.write_splits(FX.splits(A.to_translation(FX.pairs(spark, sf_dir, with_score=False))), root)
    return A.scan_splits(spark, root).select("id", "split")


@query("split_sizes", with_pairs("""
SELECT split, count(*) AS n_rows,
       CAST(ceil(count(*) / CASE WHEN split = 'train' THEN 32.0 ELSE 64.0 END) AS BIGINT) AS n_batches
FROM (SELECT CASE WHEN id % 10 < 8 THEN 'train' WHEN id % 10 = 8 THEN 'validation'
                  ELSE 'test' END AS split FROM p)
GROUP BY split
"""))
def q_split_sizes(spark, sf_dir):
    from tandem.operators.batching import split_sizes
    return split_sizes(FX.splits(FX.pairs(spark, sf_dir, with_score=False)))


@query("metrics_append", """
WITH ev AS (SELECT event_type AS run,
            row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS step,
            value AS loss FROM events)
SELECT run, CAST(floor(step / 100) AS BIGINT) AS epoch, round(avg(loss), 6) AS mean_loss
FROM ev GROUP BY ALL
""")
def q_metrics_append(spark, sf_dir):
    """Epoch metrics appended to a Parquet log in two sessions (first half
    of the epochs, then the rest) and read back whole (S11)."""
    from tandem.operators.runs import epoch_mean_loss
    m = epoch_mean_loss(FX.runs(spark, sf_dir)).select(
        "run", F.col("epoch").cast("long").alias("epoch"), F.round("mean_loss", 6).alias("mean_loss"))
    log = scratch_path(spark, "metrics")
    A.metrics_append(m.filter(F.col("epoch") < 10), log)
    A.metrics_append(m.filter(F.col("epoch") >= 10), log)
    return spark.read.parquet(log).select("run", "epoch", "mean_loss")
