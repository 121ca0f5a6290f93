"""Decoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tandem.operators import decode as D
from tandem.plans.evaluate import INTL_SQL, _bleu_sql
from tandem.plans.registry import query
from tandem.plans.text import DETOK_SQL, DROP_SPECIALS_SQL, ENCODED, _encoded, _ids_str, _word_vocab, wq
from tandem.session import cut_lineage, written


def _model(spark, sf_dir):
    """(vocabulary, encoded pairs, lexical table of the training pairs)."""
    vocab = _word_vocab(spark, sf_dir)
    enc = written(_encoded(spark, sf_dir, vocab), "encoded")
    return vocab, enc, cut_lineage(D.lexical_table(enc.filter(F.col("split") == "train")))


@query("bigram_table", wq("""
, bg AS (SELECT tgt[i] AS prev, tgt[i + 1] AS nxt
         FROM (SELECT tgt, unnest(range(1, len(tgt))) AS i FROM enc WHERE split = 'train')),
bc AS (SELECT prev, nxt, count(*) AS n FROM bg GROUP BY ALL)
SELECT CAST(prev AS BIGINT) AS prev, CAST(nxt AS BIGINT) AS next FROM bc
QUALIFY row_number() OVER (PARTITION BY prev ORDER BY n DESC, nxt) = 1
""", ENCODED))
def q_bigram_table(spark, sf_dir):
    """Most frequent successor per id over the training targets (ties →
    smallest id)."""
    enc = _encoded(spark, sf_dir)
    t = D.bigram_table(enc.filter(F.col("split") == "train"))
    return t.select(F.col("prev").cast("long").alias("prev"), F.col("next").cast("long").alias("next"))


LEXICAL = ENCODED + """
, lx AS (SELECT src[i] AS s, tgt[i + 1] AS t
         FROM (SELECT src, tgt, unnest(range(1, least(len(src), len(tgt) - 2) + 1)) AS i FROM enc WHERE split = 'train')),
lt AS (SELECT s, t FROM (SELECT s, t, count(*) AS n FROM lx GROUP BY ALL)
       QUALIFY row_number() OVER (PARTITION BY s ORDER BY n DESC, t) = 1),
cand AS (SELECT id, list(coalesce(lt.t, 1) ORDER BY i) AS c
         FROM (SELECT id, src, unnest(range(1, len(src) + 1)) AS i FROM enc) e LEFT JOIN lt ON lt.s = e.src[e.i] GROUP BY id),
dec AS (SELECT enc.id, split, list_concat([2], coalesce(c[1:149], []), CASE WHEN coalesce(len(c), 0) < 149 THEN [3] ELSE [] END)
          AS pred FROM enc LEFT JOIN cand USING (id))
"""


@query("lexical_table", wq("SELECT CAST(s AS BIGINT) AS src, CAST(t AS BIGINT) AS next FROM lt", LEXICAL))
def q_lexical_table(spark, sf_dir):
    """For every source id the target id most often at its position in the
    training pairs: the default decoding scorer."""
    t = _model(spark, sf_dir)[2]
    return t.select(F.col("src").cast("long").alias("src"), F.col("next").cast("long").alias("next"))


@query("greedy_decode", wq("""
SELECT id, array_to_string(pred, ' ') AS pred_ids, CAST(len(pred) AS BIGINT) AS n_ids,
       CAST(NULL AS VARCHAR) AS error FROM dec
""", LEXICAL))
def q_greedy_decode(spark, sf_dir):
    """Greedy decoding of every source."""
    _, enc, table = _model(spark, sf_dir)
    dec = D.lexical_decode(spark, enc, table)
    return dec.select("id", _ids_str("pred_ids").alias("pred_ids"),
                      F.size("pred_ids").cast("long").alias("n_ids"), "error")


TRANSLATED = LEXICAL + f"""
, tk2 AS (SELECT id, split, pos, coalesce(w.word, CASE tok WHEN 0 THEN '[PAD]' WHEN 1 THEN '[UNK]' WHEN 2 THEN '[SOS]'
                                      WHEN 3 THEN '[EOS]' END) AS t
          FROM (SELECT id, split, unnest(pred) AS tok, unnest(range(1, len(pred) + 1)) AS pos FROM dec) d
          LEFT JOIN wv w ON w.wid = d.tok),
tr AS (SELECT id, split, list(t ORDER BY pos) AS tl FROM tk2 GROUP BY ALL),
translated AS (SELECT id, split, {DETOK_SQL.format(t=DROP_SPECIALS_SQL.format(t='tl'))} AS translation FROM tr)
"""


@query("translate_table", wq("""
SELECT id, translation, CAST(NULL AS VARCHAR) AS error FROM translated
""", TRANSLATED))
def q_translate_table(spark, sf_dir):
    """Encode → decode → tokens → detokenised text for every row."""
    vocab, enc, table = _model(spark, sf_dir)
    return D.translate_table(spark, enc, vocab, table).select("id", "translation", "error")


EVALUATED = TRANSLATED + f"""
, ev AS (SELECT id, translation AS pred, {DETOK_SQL.format(t=DROP_SPECIALS_SQL.format(t='tgt_tokens[2:len(tgt_tokens)]'))}
           AS ref FROM translated JOIN (SELECT id, tgt_tokens FROM enc) USING (id) WHERE split = 'test')
"""


def _scores(p: str, r: str) -> str:
    body = _bleu_sql(p, r).strip().removeprefix(",").replace("FROM pr)", "FROM ev)", 1).replace("FROM pr", "FROM ev", 1)
    return "(WITH " + body + ")"


_WORDS = "regexp_extract_all({c}, '\\S+')"


@query("evaluate_table", wq(f"""
SELECT round(a.bleu, 6) AS bleu, round(b.bleu, 6) AS sacrebleu, a.pred_len AS n_tokens
FROM {_scores(_WORDS.format(c="pred"), _WORDS.format(c="ref"))} a,
     {_scores(INTL_SQL.format(c="pred"), INTL_SQL.format(c="ref"))} b
""", EVALUATED))
def q_evaluate_table(spark, sf_dir):
    """Corpus BLEU and SacreBLEU of the test-split translations (D3)."""
    vocab, enc, table = _model(spark, sf_dir)
    scores, _ = D.evaluate_table(spark, enc.filter(F.col("split") == "test"), vocab, table)
    return scores.select(F.round("bleu", 6).alias("bleu"), F.round("sacrebleu", 6).alias("sacrebleu"), "n_tokens")


@query("evaluation_samples", wq("SELECT id, pred, ref FROM ev ORDER BY id LIMIT 5", EVALUATED))
def q_evaluation_samples(spark, sf_dir):
    """The first five test translations beside their references (D3)."""
    vocab, enc, table = _model(spark, sf_dir)
    return D.evaluate_table(spark, enc.filter(F.col("split") == "test"), vocab, table)[1].select("id", "pred", "ref")
