"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tandem.operators import clean as C
from tandem.plans.registry import query
from tandem.plans.sql import LEN_OK, RATIO_OK, SCORE_OK, with_pairs
from tandem.sources import fixtures as FX
from tandem.functions.text import strip_text, is_blank


def _scored(spark, sf_dir):
    return FX.pairs(spark, sf_dir)


@query("clean_pairs", with_pairs(f"""
SELECT id, en, vi FROM pl WHERE {LEN_OK} AND {RATIO_OK} AND {SCORE_OK}
"""))
def q_clean_pairs(spark, sf_dir):
    return C.clean_pairs(_scored(spark, sf_dir))


@query("clean_pairs_sequential", with_pairs(f"""
SELECT id, en, vi FROM pl WHERE {LEN_OK} AND {RATIO_OK}
  AND id IN (SELECT id FROM ps WHERE {SCORE_OK})
"""))
def q_clean_pairs_sequential(spark, sf_dir):
    p = FX.pairs(spark, sf_dir, with_score=False)
    scores = _scored(spark, sf_dir).select("id", "score")
    return C.clean_pairs_sequential(p, scores)


@query("filter_by_mask", with_pairs(f"""
SELECT id, en, vi FROM pl WHERE coalesce({LEN_OK} AND {RATIO_OK} AND {SCORE_OK}, false)
"""))
def q_filter_by_mask(spark, sf_dir):
    return C.clean_pairs_masked(_scored(spark, sf_dir))


@query("typed_pairs", with_pairs("""
SELECT id, en, vi FROM p
"""))
def q_typed_pairs(spark, sf_dir):
    t = FX.as_translation(FX.pairs(spark, sf_dir, with_score=False))
    return t.select("id", F.col("translation.en").alias("en"), F.col("translation.vi").alias("vi"))


@query("strip_text", with_pairs("""
SELECT id, regexp_replace(en, '^\\s+|\\s+$', '', 'g') AS en_strip,
       regexp_replace(vi, '^\\s+|\\s+$', '', 'g') AS vi_strip FROM p
"""))
def q_strip_text(spark, sf_dir):
    p = FX.pairs(spark, sf_dir, with_score=False)
    return p.select("id", strip_text("en").alias("en_strip"), strip_text("vi").alias("vi_strip"))


@query("pair_lengths", with_pairs("""
SELECT id, len_en, len_vi FROM pl
"""))
def q_pair_lengths(spark, sf_dir):
    return (C.with_lengths(FX.pairs(spark, sf_dir, with_score=False))
            .select("id", F.col("len_en").cast("long").alias("len_en"),
                    F.col("len_vi").cast("long").alias("len_vi")))


@query("filter_nonempty", with_pairs("""
SELECT id, en, vi FROM p
WHERE length(trim(coalesce(en, ''))) > 0 AND length(trim(coalesce(vi, ''))) > 0
"""))
def q_filter_nonempty(spark, sf_dir):
    p = FX.pairs(spark, sf_dir, with_score=False)
    return p.filter(C.nonempty_pred()).select("id", "en", "vi")


@query("nonempty_report", with_pairs("""
SELECT count(*) AS n_in,
       count(*) FILTER (WHERE length(trim(coalesce(en, ''))) > 0
                          AND length(trim(coalesce(vi, ''))) > 0) AS n_kept,
       count(*) - count(*) FILTER (WHERE length(trim(coalesce(en, ''))) > 0
                          AND length(trim(coalesce(vi, ''))) > 0) AS n_dropped
FROM p
"""))
def q_nonempty_report(spark, sf_dir):
    return C.nonempty_report(FX.pairs(spark, sf_dir, with_score=False))


@query("filter_length", with_pairs(f"""
SELECT id FROM pl WHERE {LEN_OK}
"""))
def q_filter_length(spark, sf_dir):
    p = C.with_lengths(FX.pairs(spark, sf_dir, with_score=False))
    return p.filter(C.length_pred()).select("id")


@query("filter_ratio", with_pairs(f"""
SELECT id FROM pl WHERE {RATIO_OK}
"""))
def q_filter_ratio(spark, sf_dir):
    p = C.with_lengths(FX.pairs(spark, sf_dir, with_score=False))
    return p.filter(C.ratio_pred()).select("id")


@query("filter_score", with_pairs(f"""
SELECT id FROM ps WHERE {SCORE_OK}
"""))
def q_filter_score(spark, sf_dir):
    return _scored(spark, sf_dir).filter(C.score_pred()).select("id")


@query("semi_good_ids", with_pairs(f"""
SELECT id, en, vi FROM p WHERE id IN (SELECT id FROM ps WHERE {SCORE_OK})
"""))
def q_semi_good_ids(spark, sf_dir):
    p = FX.pairs(spark, sf_dir, with_score=False)
    good = _scored(spark, sf_dir).filter(C.score_pred()).select("id")
    return C.semi_by_ids(p, good).select("id", "en", "vi")


@query("filter_by_id_set", with_pairs(f"""
SELECT id FROM pl WHERE {LEN_OK} AND id IN (SELECT id FROM ps WHERE {SCORE_OK})
"""))
def q_filter_by_id_set(spark, sf_dir):
    p = C.with_lengths(FX.pairs(spark, sf_dir, with_score=False)).filter(C.length_pred())
    good = _scored(spark, sf_dir).filter(C.score_pred()).select("id")
    return C.semi_by_ids(p, good).select("id")


@query("keep_mask", with_pairs(f"""
SELECT id, coalesce({LEN_OK} AND {RATIO_OK} AND {SCORE_OK}, false) AS keep_mask FROM pl
"""))
def q_keep_mask(spark, sf_dir):
    return C.with_keep_mask(_scored(spark, sf_dir)).select("id", "keep_mask")


@query("attach_scores", with_pairs("""
SELECT id, round(CAST(score AS DOUBLE), 6) AS score FROM ps
"""))
def q_attach_scores(spark, sf_dir):
    p = FX.pairs(spark, sf_dir, with_score=False)
    scores = _scored(spark, sf_dir).select("id", "score").filter(F.col("score").isNotNull())
    return (C.attach_scores(p, scores)
            .select("id", F.round(F.col("score").cast("double"), 6).alias("score")))


@query("pair_count", with_pairs("""
SELECT count(*) AS n_pairs FROM p
"""))
def q_pair_count(spark, sf_dir):
    return FX.pairs(spark, sf_dir, with_score=False).agg(F.count(F.lit(1)).alias("n_pairs"))


@query("filter_funnel", with_pairs(f"""
SELECT n_pairs, n_length, n_length_ratio, n_all,
       n_pairs - n_length AS removed_length,
       n_length - n_length_ratio AS removed_ratio,
       n_length_ratio - n_all AS removed_score,
       round((n_pairs - n_all) * 100.0 / n_pairs, 6) AS removed_pct,
       round(n_all * 100.0 / n_pairs, 6) AS retained_pct
FROM (SELECT count(*) AS n_pairs,
             count(*) FILTER (WHERE {LEN_OK}) AS n_length,
             count(*) FILTER (WHERE {LEN_OK} AND {RATIO_OK}) AS n_length_ratio,
             count(*) FILTER (WHERE {LEN_OK} AND {RATIO_OK} AND {SCORE_OK}) AS n_all
      FROM pl)
"""))
def q_filter_funnel(spark, sf_dir):
    f = C.filter_funnel(_scored(spark, sf_dir))
    return f.withColumn("removed_pct", F.round("removed_pct", 6)) \
            .withColumn("retained_pct", F.round("retained_pct", 6))


@query("mask_counts", with_pairs(f"""
SELECT count(*) AS n_pairs,
       count(*) FILTER (WHERE {LEN_OK}) AS n_length_mask,
       count(*) FILTER (WHERE len_en*2.0 >= len_vi AND len_vi*2.0 >= len_en) AS n_ratio_mask,
       count(*) FILTER (WHERE len_en > 0 AND len_vi > 0) AS n_nonzero_mask,
       count(*) FILTER (WHERE {SCORE_OK}) AS n_score_mask,
       count(*) FILTER (WHERE {LEN_OK} AND {RATIO_OK} AND {SCORE_OK}) AS n_keep
FROM pl
"""))
def q_mask_counts(spark, sf_dir):
    return C.mask_counts(_scored(spark, sf_dir))


@query("score_alignment", with_pairs("""
SELECT (SELECT count(*) FROM p) AS n_pairs,
       (SELECT count(*) FROM events) AS n_scores,
       (SELECT count(*) FROM p) <> (SELECT count(*) FROM events) AS mismatch
"""))
def q_score_alignment(spark, sf_dir):
    from tandem.session import read_table
    p = FX.pairs(spark, sf_dir, with_score=False)
    scores = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return C.score_alignment(p, scores)


@query("project_columns", with_pairs("""
SELECT id, en FROM p
"""))
def q_project_columns(spark, sf_dir):
    return FX.pairs(spark, sf_dir, with_score=False).select("id", "en")


@query("direction_select", with_pairs("""
SELECT id, vi AS src, en AS tgt FROM p
"""))
def q_direction_select(spark, sf_dir):
    from tandem.operators.encode import direction_select
    t = FX.as_translation(FX.pairs(spark, sf_dir, with_score=False))
    return direction_select(t, src_lang="vi", tgt_lang="en").select("id", "src", "tgt")


@query("filter_blank_requests", """
SELECT conv_id, turn, trim(text) AS request FROM conversations
WHERE role = 'user' AND length(trim(coalesce(text, ''))) > 0
  AND lower(trim(text)) NOT IN ('exit', 'quit')
""")
def q_filter_blank_requests(spark, sf_dir):
    from tandem.operators.decode import requests_from_text
    from tandem.session import read_table
    c = read_table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return requests_from_text(c, "text").select("conv_id", "turn", "request")
