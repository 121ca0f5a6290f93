"""Queries over a saved dataset with BPE ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from tandem.config import EVAL_BATCH_SIZE, MAX_SEQ_LEN, TRAIN_BATCH_SIZE
from tandem.operators import epochs as EP
from tandem.operators import vocab as V
from tandem.operators.bpe import bpe_train
from tandem.operators.evaluate import corpus_scores
from tandem.plans.registry import query
from tandem.plans.sql import md5_sql
from tandem.plans.text import PRE, _ids_str, _pairs, merge_chain_sql, wq
from tandem.session import cut_lineage, scratch_path
from tandem.sources import fixtures as FX

#: Merges of the queries that SQL restates.
FEW_MERGES = 60


def _saved(spark, sf_dir):
    root = scratch_path(spark, "dataset")
    EP.save_dataset(FX.splits(_pairs(spark, sf_dir)), root)
    return root


def _model(spark, root, **kw):
    """A BPE model of the train split alone."""
    train = EP.load_dataset(spark, root, "train")
    return bpe_train(spark, cut_lineage(V.word_counts(V.stack_languages(train))), **kw)


DATASET = f"""
, ds AS MATERIALIZED (
  SELECT id, en, vi, CASE WHEN id % 10 < 8 THEN 'train' WHEN id % 10 = 8 THEN 'validation' ELSE 'test' END AS split
  FROM p WHERE length(trim(coalesce(en, ''))) > 0 AND length(trim(coalesce(vi, ''))) > 0),
pos AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY split ORDER BY id) - 1 AS pos,
                            count(*) OVER (PARTITION BY split) AS n FROM ds)
"""


def _step_sql(x: str) -> str:
    """One turn of the permutation's network, from [left, right] over the rounds."""
    turn = (f"[s[2], (s[1] + {md5_sql('42', '0', 'j[1]', 's[2]')}) % (CASE WHEN j[1] % 2 = 1 THEN a ELSE b END)]")
    rounds = ", ".join(f"[{j}::BIGINT]" for j in range(1, EP.ROUNDS + 1))
    done = f"list_reduce([[({x}) % a, ({x}) // a], {rounds}], lambda s, j: {turn})"
    return f"list_sum(list_transform([{done}], lambda z: z[1] + z[2] * a))::BIGINT"


EPOCH = DATASET + f"""
, grid AS (SELECT *, ceil(sqrt(n))::BIGINT AS a, ceil(n / ceil(sqrt(n)))::BIGINT AS b FROM pos),
x0 AS MATERIALIZED (SELECT *, CASE WHEN split = 'train' THEN {_step_sql('pos')} ELSE pos END AS x FROM grid)
""" + "".join(f""", x{i + 1} AS MATERIALIZED (
  SELECT * REPLACE (CASE WHEN x >= n THEN {_step_sql('x')} ELSE x END AS x) FROM x{i})""" for i in range(3)) + f"""
, ep AS (SELECT id, split, en, vi, pos, x AS slot,
                x // CASE WHEN split = 'train' THEN {TRAIN_BATCH_SIZE} ELSE {EVAL_BATCH_SIZE} END AS batch_id FROM x3)
"""


@query("epoch_batches", wq("SELECT id, split, pos, slot, batch_id FROM ep", EPOCH))
def q_epoch_batches(spark, sf_dir):
    """Position, shuffled place and batch of every row of a saved dataset: no
    sort, a keyed permutation of the positions (O5, W3)."""
    return EP.epoch_batches(EP.load_dataset(spark, _saved(spark, sf_dir))).select("id", "split", "pos", "slot", "batch_id")


WORDS = EPOCH + f"""
, dw AS (SELECT id, split, side, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS spot
         FROM (SELECT id, split, 's' AS side, regexp_extract_all(lower(en), '{PRE}') AS ws FROM ds
               UNION ALL SELECT id, split, 't', regexp_extract_all(lower(vi), '{PRE}') FROM ds)),
cw AS MATERIALIZED (SELECT word, count(*) FILTER (WHERE split = 'train') AS n, regexp_extract_all(word, '.') AS c FROM dw GROUP BY ALL)
""" + merge_chain_sql("cw", FEW_MERGES) + f"""
, wt AS (SELECT word, unnest(t) AS token, unnest(range(1, len(t) + 1)) AS k
         FROM (SELECT word, regexp_extract_all(s, '\\x01[^\\x02]*\\x02') AS t FROM w{FEW_MERGES})),
wi AS MATERIALIZED (SELECT word, list(coalesce(v.id + 3, 1) ORDER BY k) AS ids FROM wt LEFT JOIN v{FEW_MERGES} v USING (token) GROUP BY word),
sid AS MATERIALIZED (SELECT id, side, flatten(list(ids ORDER BY spot)) AS ids FROM dw JOIN wi USING (word) GROUP BY ALL),
enc AS MATERIALIZED (
  SELECT ep.*, coalesce(s.ids[1:{MAX_SEQ_LEN}], []) AS src, coalesce(t.ids[1:{MAX_SEQ_LEN - 2}], []) AS tgt
  FROM ep LEFT JOIN sid s ON s.id = ep.id AND s.side = 's' LEFT JOIN sid t ON t.id = ep.id AND t.side = 't')
"""


def _id_strings(df):
    return df.select("split", "batch_id", "slot", "id", *[_ids_str(c).alias(c) for c in (
        "src_padded", "tgt_input_padded", "labels_padded")])


@query("bpe_batches_few_merges", wq("""
, m AS (SELECT split, batch_id, max(len(src)) AS ms, max(len(tgt)) + 1 AS mt FROM enc GROUP BY ALL)
SELECT split, batch_id, slot, id,
  array_to_string(list_concat(src, list_resize([0], ms - len(src), 0)), ' ') AS src_padded,
  array_to_string(list_concat([2], tgt, list_resize([0], mt - 1 - len(tgt), 0)), ' ') AS tgt_input_padded,
  array_to_string(list_concat(tgt, [3], list_resize([0], mt - 1 - len(tgt), 0)), ' ') AS labels_padded
FROM enc JOIN m USING (split, batch_id)
""", WORDS))
def q_bpe_batches_few_merges(spark, sf_dir):
    """Padded batches of BPE ids with a vocabulary of 60 merges of the train
    split, restated in SQL from the counting of words on (X8, F4-F7)."""
    root = _saved(spark, sf_dir)
    return _id_strings(EP.prepare_batches(spark, root, _model(spark, root, max_merges=FEW_MERGES)))


@query("bpe_batches")
def q_bpe_batches(spark, sf_dir):
    """Padded batches of BPE ids with the full vocabulary size, learned on the
    train split (X8); tests compare with the public ``tokenizers`` encoder."""
    root = _saved(spark, sf_dir)
    return _id_strings(EP.prepare_batches(spark, root, _model(spark, root)))


def _translated(spark, sf_dir, split=None, **kw):
    root = _saved(spark, sf_dir)
    model = _model(spark, root, **kw)
    scorer = EP.LexicalScorer(EP.lexical_ids(EP.load_dataset(spark, root, "train"), model))
    data = EP.load_dataset(spark, root, split)
    return EP.translate(data, model, scorer), data


TRANSLATE = WORDS + f"""
, lx AS (SELECT s, t, count(*) AS c FROM (
    SELECT src[i] AS s, tgt[i] AS t FROM (SELECT src, tgt, unnest(range(1, least(len(src), len(tgt)) + 1)) AS i
                                          FROM enc WHERE split = 'train')) GROUP BY ALL),
lt AS MATERIALIZED (SELECT s, t FROM lx QUALIFY row_number() OVER (PARTITION BY s ORDER BY c DESC, t) = 1),
cd AS MATERIALIZED (SELECT id, list(coalesce(lt.t, 1) ORDER BY i) AS c
       FROM (SELECT id, src, unnest(range(1, len(src) + 1)) AS i FROM enc) e LEFT JOIN lt ON lt.s = e.src[e.i] GROUP BY id),
de AS (SELECT enc.id, enc.split, coalesce(c[1:{MAX_SEQ_LEN - 1}], []) AS c FROM enc LEFT JOIN cd USING (id)),
pr AS (SELECT id, split, list_concat([2], c, CASE WHEN len(c) < {MAX_SEQ_LEN - 1} THEN [3] ELSE [] END) AS pred FROM de)
"""


@query("bpe_decode_few_merges", wq("""
SELECT id, array_to_string(pred, ' ') AS pred_ids, NULL::VARCHAR AS error FROM pr
""", TRANSLATE))
def q_bpe_decode_few_merges(spark, sf_dir):
    """Greedy decoding in lock step over BPE ids (60 merges), restated in SQL."""
    out, _ = _translated(spark, sf_dir, max_merges=FEW_MERGES)
    return out.select("id", _ids_str("pred_ids").alias("pred_ids"), "error")


@query("bpe_evaluate")
def q_bpe_evaluate(spark, sf_dir):
    """Corpus BLEU and SacreBLEU of the test split's translations with the full
    BPE vocabulary learned on the train split (D3)."""
    out, data = _translated(spark, sf_dir, "test")
    pr = out.join(data.select("id", F.col("vi").alias("ref")), "id").select("id", F.col("translation").alias("pred"), "ref")
    s = corpus_scores(pr)
    return s.select(F.round("bleu", 6).alias("bleu"), F.round("sacrebleu", 6).alias("sacrebleu"), "n_tokens")
