"""Profiling and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tandem.operators import batching as B
from tandem.operators import clean as C
from tandem.operators import profile as PR
from tandem.plans.registry import query
from tandem.plans.sql import md5_sql, with_pairs
from tandem.session import scratch_path
from tandem.sources import fixtures as FX
from tandem.sources.saved import SavedRows, save_rows


def _lens(spark, sf_dir):
    return C.with_lengths(FX.pairs(spark, sf_dir))


def _r6(df, cols):
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c).cast("double"), 6))
    return df


def _saved_pairs(spark, sf_dir):
    """The pair table saved in order of id, with its row-offset index."""
    p = FX.pairs(spark, sf_dir, with_score=False)
    path = scratch_path(spark, "saved-pairs")
    save_rows(p, path, ["id"])
    return SavedRows(spark, path, p.schema)


LONG = """
,lg AS (SELECT 'en' AS lang, len_en AS len FROM pl UNION ALL SELECT 'vi', len_vi FROM pl)
"""


@query("length_describe", with_pairs(LONG.strip() + """
SELECT lang, count(len) AS count, round(avg(len), 6) AS mean, round(stddev_samp(len), 6) AS std,
       round(CAST(min(len) AS DOUBLE), 6) AS min,
       round(quantile_cont(len, 0.25), 6) AS q25, round(quantile_cont(len, 0.5), 6) AS q50,
       round(quantile_cont(len, 0.75), 6) AS q75, round(CAST(max(len) AS DOUBLE), 6) AS max
FROM lg GROUP BY lang
"""))
def q_length_describe(spark, sf_dir):
    d = PR.length_describe(_lens(spark, sf_dir))
    return _r6(d, ["mean", "std", "min", "q25", "q50", "q75", "max"])


@query("score_stats", with_pairs("""
SELECT count(s) AS n, count(*) FILTER (WHERE isnan(score)) AS nan_count, round(avg(s), 6) AS mean,
       round(quantile_cont(s, 0.5), 6) AS median, round(min(s), 6) AS min,
       round(quantile_cont(s, 0.25), 6) AS q1, round(quantile_cont(s, 0.5), 6) AS q2,
       round(quantile_cont(s, 0.75), 6) AS q3, round(max(s), 6) AS max
FROM (SELECT score, CASE WHEN NOT isnan(score) THEN CAST(score AS DOUBLE) END AS s FROM ps)
"""))
def q_score_stats(spark, sf_dir):
    s = PR.score_stats(FX.pairs(spark, sf_dir))
    return _r6(s, ["mean", "median", "min", "q1", "q2", "q3", "max"])


@query("quantile_cutoff", with_pairs("""
SELECT round(greatest(quantile_cont(len_en, 0.999), quantile_cont(len_vi, 0.999)), 6) AS cutoff FROM pl
"""))
def q_quantile_cutoff(spark, sf_dir):
    """On the 50 000-row seeded sample (all rows below that size)."""
    s = PR.sample_n(_lens(spark, sf_dir), 50_000)
    return _r6(PR.quantile_cutoff(s), ["cutoff"])


HIST_SQL = """
,mm AS (SELECT {g} min(v) AS lo, max(v) AS hi FROM hv {gb}),
bins AS (SELECT {g2} lo, hi, unnest(range(0, 100)) AS bin FROM mm),
cnt AS (SELECT {g3} CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) * 100 / (hi - lo)), 99) END AS INTEGER) AS bin,
               count(*) AS c
        FROM hv JOIN mm {on} GROUP BY ALL)
SELECT {g4} CAST(bins.bin AS BIGINT) AS bin, round(lo + bins.bin * (hi - lo) / 100, 6) AS bin_lo,
       round(lo + (bins.bin + 1) * (hi - lo) / 100, 6) AS bin_hi, coalesce(c, 0) AS count
FROM bins LEFT JOIN cnt {on2}
"""


@query("length_histogram", with_pairs(""",hv AS (SELECT 'en' AS lang, CAST(len_en AS DOUBLE) AS v FROM pl
       UNION ALL SELECT 'vi', CAST(len_vi AS DOUBLE) FROM pl)""" + HIST_SQL.format(
    g="lang,", gb="GROUP BY lang", g2="lang,", g3="hv.lang,", on="USING (lang)", g4="bins.lang,",
    on2="ON cnt.lang = bins.lang AND cnt.bin = bins.bin")))
def q_length_histogram(spark, sf_dir):
    long = PR.lengths_long(_lens(spark, sf_dir))
    h = PR.histogram(long, "len", 100, group="lang")
    return _r6(h.withColumn("bin", F.col("bin").cast("long")), ["bin_lo", "bin_hi"])


@query("score_histogram", with_pairs(""",hv AS (SELECT CAST(score AS DOUBLE) AS v FROM ps
        WHERE score IS NOT NULL AND NOT isnan(score))""" + HIST_SQL.format(
    g="", gb="", g2="", g3="", on="ON true", g4="", on2="ON cnt.bin = bins.bin")))
def q_score_histogram(spark, sf_dir):
    h = PR.histogram(FX.pairs(spark, sf_dir), "score", 100)
    return _r6(h.withColumn("bin", F.col("bin").cast("long")), ["bin_lo", "bin_hi"])


@query("score_kde", with_pairs(""",sv AS (SELECT CAST(score AS DOUBLE) AS v FROM ps
        WHERE score IS NOT NULL AND NOT isnan(score)),
st AS (SELECT count(*) AS n, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi FROM sv),
bw AS (SELECT n, sd * pow(n, -0.2) AS h, lo, hi, (hi - lo) / 199 AS step FROM st),
gr AS (SELECT unnest(range(0, 200)) AS g, n, h, lo, step FROM bw)
SELECT CAST(g AS BIGINT) AS g, round(lo + g * step, 6) AS x,
       round(sum(exp(-0.5 * pow((lo + g * step - v) / h, 2))) / (n * h * sqrt(2 * pi())), 6) AS density
FROM gr, sv GROUP BY g, lo, step, n, h
"""))
def q_score_kde(spark, sf_dir):
    k = PR.kde(FX.pairs(spark, sf_dir), "score", 200)
    return _r6(k.withColumn("g", F.col("g").cast("long")), ["x", "density"])


@query("head_n", with_pairs("SELECT id, en, vi FROM p ORDER BY id LIMIT 1000"))
def q_head_n(spark, sf_dir):
    return B.head_n(FX.pairs(spark, sf_dir, with_score=False), 1000).select("id", "en", "vi")


@query("saved_tail", with_pairs("""
SELECT row_number() OVER (ORDER BY id) - 1 AS row_idx, id, en, vi FROM p ORDER BY id DESC LIMIT 10
"""))
def q_saved_tail(spark, sf_dir):
    """The last ten rows of the saved table, read from its last files."""
    return _saved_pairs(spark, sf_dir).tail(10).select("row_idx", "id", "en", "vi")


@query("tail_n", with_pairs("SELECT id, en, vi FROM p ORDER BY id DESC LIMIT 10"))
def q_tail_n(spark, sf_dir):
    return PR.tail_n(FX.pairs(spark, sf_dir, with_score=False), 10).select("id", "en", "vi")


@query("row_at", with_pairs("SELECT id, en, vi FROM p ORDER BY id LIMIT 1 OFFSET 1000"))
def q_row_at(spark, sf_dir):
    return _saved_pairs(spark, sf_dir).row_at(1000).select("id", "en", "vi")


SAMPLE_ROWS = 500


@query("sample_n", with_pairs(f"""
SELECT id, len_en, len_vi FROM pl ORDER BY {md5_sql("42", "id")}, id LIMIT {SAMPLE_ROWS}
"""))
def q_sample_n(spark, sf_dir):
    """A seeded sample without replacement, smaller than the table."""
    s = PR.sample_n(_lens(spark, sf_dir), SAMPLE_ROWS)
    return s.select("id", F.col("len_en").cast("long").alias("len_en"), F.col("len_vi").cast("long").alias("len_vi"))


@query("sample_inspect", with_pairs(f"""
, ix AS (SELECT id, en, vi, row_number() OVER (ORDER BY id) - 1 AS row_idx FROM p)
SELECT draw, row_idx, id, en, vi
FROM (SELECT draw, {md5_sql("7", "draw")} % (SELECT count(*) FROM p) AS row_idx FROM range(0, 5) d(draw))
JOIN ix USING (row_idx)
""".strip()))
def q_sample_inspect(spark, sf_dir):
    """5 seeded positions with replacement of the pair table saved in order of id."""
    return _saved_pairs(spark, sf_dir).sample(5, seed=7).select("draw", "row_idx", "id", "en", "vi")


@query("seeded_shuffle", with_pairs(f"""
SELECT id, row_number() OVER (ORDER BY {md5_sql("42", "0", "id")}, id) - 1 AS pos FROM p
"""))
def q_seeded_shuffle(spark, sf_dir):
    """Every row once, with its place in a seeded order."""
    return B.seeded_shuffle(FX.pairs(spark, sf_dir, with_score=False), seed=42, epoch=0).select("id", "pos")
