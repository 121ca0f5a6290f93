"""Streaming queries (ST1-ST4).  Each writes its source files from the
shared tables into the checkpoint folder (several files, consumed over
several micro-batches), runs the stream to completion and returns the sink
read back; the oracles restate the equivalent batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from tandem.config import MAX_SEQ_LEN
from tandem.operators import decode as D
from tandem.operators import encode as E
from tandem.plans.decode import TRANSLATED, _model
from tandem.plans.evaluate import RUNS_CTE
from tandem.plans.registry import ORACLES, query
from tandem.plans.sql import with_pairs
from tandem.plans.text import DETOK_SQL, DROP_SPECIALS_SQL, PRE, wq
from tandem.session import cut_lineage, read_table, scratch_path
from tandem.sources import fixtures as FX
from tandem.streaming import ordered_stop as OS
from tandem.streaming import pipelines as SP

#: Micro-batches that a stream's source files are consumed in.
BATCHES = 4


def _write_source(df, path, key="id"):
    """Source files by key range, as many as the session's shuffle partitions;
    returns the schema and the files to take per micro-batch."""
    df.repartitionByRange(key).write.parquet(path)
    files = len(df.sparkSession.read.parquet(path).inputFiles())
    return df.schema, max(1, -(-files // BATCHES))


def _write_in_order(df, path, key, n=BATCHES):
    """Append ``n`` key ranges one after another, one file each, so that they
    arrive (and are consumed) in key order: the arrival order is the feature,
    and the table has one row per hundred log rows."""
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    step = max(1, -(-(hi - lo + 1) // n))
    for start in range(lo, hi + 1, step):
        df.filter((F.col(key) >= start) & (F.col(key) < start + step)).coalesce(1) \
          .write.mode("append").parquet(path)
    return df.schema


@query("stream_clean_pairs")
def q_stream_clean_pairs(spark, sf_dir):
    src, sink, ck = (scratch_path(spark, n) for n in ("st1-src", "st1-sink", "st1-ck"))
    schema, per = _write_source(FX.pairs(spark, sf_dir), src)
    SP.stream_clean_pairs(spark, src, sink, ck, schema, files_per_trigger=per)
    return spark.read.parquet(sink).select("id", "en", "vi")


ORACLES["stream_clean_pairs"] = ORACLES["clean_pairs"]


@query("stream_funnel")
def q_stream_funnel(spark, sf_dir):
    src, sink, ck = (scratch_path(spark, n) for n in ("st2-src", "st2-sink", "st2-ck"))
    schema, per = _write_source(FX.pairs(spark, sf_dir), src)
    SP.stream_funnel(spark, src, sink, ck, schema, files_per_trigger=per)
    return spark.read.parquet(sink).select("n_pairs", "n_length", "n_length_ratio", "n_all")


ORACLES["stream_funnel"] = with_pairs("""
SELECT count(*) AS n_pairs,
       count(*) FILTER (WHERE len_en BETWEEN 3 AND 150 AND len_vi BETWEEN 3 AND 150) AS n_length,
       count(*) FILTER (WHERE len_en BETWEEN 3 AND 150 AND len_vi BETWEEN 3 AND 150
                          AND len_en > 0 AND len_vi > 0 AND len_en*2.0 >= len_vi AND len_vi*2.0 >= len_en)
         AS n_length_ratio,
       count(*) FILTER (WHERE len_en BETWEEN 3 AND 150 AND len_vi BETWEEN 3 AND 150
                          AND len_en > 0 AND len_vi > 0 AND len_en*2.0 >= len_vi AND len_vi*2.0 >= len_en
                          AND NOT isnan(score) AND score > CAST(1.0872 AS FLOAT)) AS n_all
FROM pl
""")


@query("stream_early_stop", RUNS_CTE + """
SELECT run, CAST(stop_epoch AS BIGINT) AS stop_epoch, round(best, 6) AS best_loss,
       array_to_string(cks, ',') AS checkpoint_epochs FROM fin
""")
def q_stream_early_stop(spark, sf_dir):
    src, sink, ck = (scratch_path(spark, n) for n in ("st4-src", "st4-sink", "st4-ck"))
    ep = FX.epoch_losses(spark, sf_dir).select("run", F.col("epoch").cast("int").alias("epoch"), "val_loss")
    schema = _write_in_order(ep, src, key="epoch")
    SP.stream_early_stop(spark, src, sink, ck, schema, files_per_trigger=1)
    s = SP.early_stop_summary(spark.read.parquet(sink))
    return s.select("run", F.col("stop_epoch").cast("long").alias("stop_epoch"),
                    F.round("best_loss", 6).alias("best_loss"),
                    F.array_join(F.col("checkpoint_epochs").cast("array<string>"), ",").alias("checkpoint_epochs"))


@query("stream_ordered_stop", ORACLES["stream_early_stop"])
def q_stream_ordered_stop(spark, sf_dir):
    """The same runs with their epochs dealt to files by hash, so that they arrive
    out of order, several files a micro-batch."""
    src, sink, ck = (scratch_path(spark, n) for n in ("st5-src", "st5-sink", "st5-ck"))
    ep = FX.epoch_losses(spark, sf_dir).select("run", F.col("epoch").cast("int").alias("epoch"), "val_loss")
    ep.repartition(2 * BATCHES, "epoch").write.parquet(src)
    files = len(spark.read.parquet(src).inputFiles())
    OS.stream_ordered_stop(spark, src, sink, ck, ep.schema, files_per_trigger=max(1, -(-files // BATCHES)))
    s = SP.early_stop_summary(spark.read.parquet(sink))
    return s.select("run", F.col("stop_epoch").cast("long").alias("stop_epoch"),
                    F.round("best_loss", 6).alias("best_loss"),
                    F.array_join(F.col("checkpoint_epochs").cast("array<string>"), ",").alias("checkpoint_epochs"))


_TURNS = TRANSLATED + f"""
, rq AS (SELECT conv_id * 1000 + turn AS id, text FROM conversations WHERE role = 'user'
         AND length(trim(coalesce(text, ''))) > 0 AND lower(trim(text)) NOT IN ('exit', 'quit')),
rs AS (SELECT id, coalesce(wid, 1) AS sid, pos FROM (
         SELECT id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos
         FROM (SELECT id, regexp_extract_all(lower(text), '{PRE}') AS ws FROM rq)) LEFT JOIN wv USING (word)
       WHERE pos <= 150),
rc AS (SELECT rs.id, list(coalesce(lt.t, 1) ORDER BY pos) AS c FROM rs LEFT JOIN lt ON lt.s = rs.sid GROUP BY rs.id),
rt AS (SELECT id, unnest(c[1:149]) AS tok, unnest(range(1, len(c[1:149]) + 1)) AS pos FROM rc),
rw AS (SELECT id, list(coalesce(wv.word, '[UNK]') ORDER BY pos) AS tl FROM rt LEFT JOIN wv ON wv.wid = rt.tok GROUP BY id)
SELECT rq.id, coalesce({DETOK_SQL.format(t=DROP_SPECIALS_SQL.format(t='tl'))}, '') AS translation,
       CAST(NULL AS VARCHAR) AS error FROM rq LEFT JOIN rw USING (id)
"""


@query("stream_translate", wq("", _TURNS))
def q_stream_translate(spark, sf_dir):
    """Arriving user turns (the requests) are filtered, encoded with the word
    vocabulary and decoded with the lexical table, micro-batch by micro-batch."""
    src, sink, ck = (scratch_path(spark, n) for n in ("st3-src", "st3-sink", "st3-ck"))
    conv = read_table(spark, sf_dir, "conversations").filter(F.col("role") == "user") \
        .select((F.col("conv_id") * 1000 + F.col("turn")).cast("long").alias("id"), "text")
    schema, per = _write_source(conv, src)
    vocab, _, table = _model(spark, sf_dir)
    vocab = cut_lineage(vocab)  # every micro-batch reads it

    def enc(batch):
        e = E.word_vocab_encode(spark, batch, "id", "request", "ids", vocab)
        return e.select("id", E.truncate_ids("ids", MAX_SEQ_LEN).alias("src_ids"))

    def dec(encoded):
        return D.translate_table(spark, encoded, vocab, table).select("id", "translation", "error")

    SP.stream_translate(spark, src, sink, ck, schema, enc, dec, files_per_trigger=per)
    return spark.read.parquet(sink).select("id", "translation", "error")
