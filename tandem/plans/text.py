"""Vocabulary, encoding and batching queries (A10-A13, A18, A19, O7, U1-U3,
F4-F12, W1-W3, J4)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.config import EVAL_BATCH_SIZE, MAX_SEQ_LEN, TRAIN_BATCH_SIZE
from tandem.functions.text import detokenize, drop_special_tokens
from tandem.operators import batching as B
from tandem.operators import encode as E
from tandem.operators import vocab as V
from tandem.operators.bpe import bpe_train
from tandem.plans.registry import query
from tandem.plans.sql import md5_sql, with_pairs
from tandem.session import cut_lineage, join_measured, read_table
from tandem.sources import fixtures as FX

# DuckDB restatement of the Unicode pre-tokeniser for Latin text.
PRE = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]+"

CORPUS = f"""
,t AS (SELECT en AS t FROM p UNION ALL SELECT vi FROM p),
wc AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(t), '{PRE}')) AS word FROM t)
       GROUP BY word),
wv AS (SELECT word, 3 + row_number() OVER (ORDER BY n DESC, word) AS wid FROM wc)
"""

ENCODED = CORPUS + f"""
,tok AS (SELECT id, side, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos
         FROM (SELECT id, 'src' AS side, regexp_extract_all(lower(coalesce(en, '')), '{PRE}') AS ws FROM p
               UNION ALL
               SELECT id, 'tgt' AS side, regexp_extract_all(lower(coalesce(vi, '')), '{PRE}') AS ws FROM p)),
ids AS (SELECT id, side, list(wid ORDER BY pos) AS l, list(word ORDER BY pos) AS w
        FROM tok JOIN wv USING (word) GROUP BY id, side),
enc AS (SELECT p.id,
               coalesce(list_slice(s.l, 1, {MAX_SEQ_LEN}), []) AS src,
               list_concat([2], coalesce(list_slice(t.l, 1, {MAX_SEQ_LEN - 2}), []), [3]) AS tgt,
               list_concat(['[SOS]'], coalesce(list_slice(t.w, 1, {MAX_SEQ_LEN - 2}), []), ['[EOS]']) AS tgt_tokens,
               CASE WHEN p.id % 10 < 8 THEN 'train' WHEN p.id % 10 = 8 THEN 'validation'
                    ELSE 'test' END AS split
        FROM p LEFT JOIN ids s ON s.id = p.id AND s.side = 'src'
               LEFT JOIN ids t ON t.id = p.id AND t.side = 'tgt'),
bat AS (SELECT enc.*, row_number() OVER (PARTITION BY split ORDER BY id) - 1 AS pos,
               CAST(floor((row_number() OVER (PARTITION BY split ORDER BY id) - 1)
                    / CASE WHEN split = 'train' THEN {TRAIN_BATCH_SIZE} ELSE {EVAL_BATCH_SIZE} END) AS BIGINT)
                 AS batch_id
        FROM enc),
bm AS (SELECT split, batch_id, max(len(src)) AS t_src, max(len(tgt) - 1) AS t_tgt FROM bat GROUP BY ALL)
"""

def _pairs(spark, sf_dir):
    return FX.pairs(spark, sf_dir, with_score=False)


def _word_counts(spark, sf_dir):
    return V.word_counts(V.stack_languages(_pairs(spark, sf_dir)))


def _word_vocab(spark, sf_dir):
    return cut_lineage(E.word_vocab(_word_counts(spark, sf_dir)))


def _encoded(spark, sf_dir, vocab=None):
    """``id, split, src_ids, tgt_ids`` with the word-level vocabulary."""
    p = FX.splits(_pairs(spark, sf_dir)).withColumnRenamed("en", "src").withColumnRenamed("vi", "tgt")
    return E.word_vocab_encode_pairs(p, vocab if vocab is not None else _word_vocab(spark, sf_dir))


def _batched(spark, sf_dir):
    return B.batch_assign(_encoded(spark, sf_dir))


def _bpe(spark, sf_dir, **kw):
    """The BPE model of all sentences, with ``config.VOCAB_SIZE`` tokens at most."""
    return bpe_train(spark, cut_lineage(_word_counts(spark, sf_dir)), **kw)


def wq(body: str, ctes: str = CORPUS) -> str:
    """Oracle SQL: pair CTEs, then ``ctes``, then ``body``."""
    return with_pairs(ctes.strip() + "\n" + body.strip()) if ctes else with_pairs(body)


def _ids_str(col):
    return F.array_join(F.col(col).cast("array<string>"), " ")


# ------------------------------------------------------------ vocabulary

@query("stack_languages", with_pairs("""
SELECT en AS text FROM p UNION ALL SELECT vi AS text FROM p
"""))
def q_stack_languages(spark, sf_dir):
    return V.stack_languages(_pairs(spark, sf_dir))


@query("word_counts", wq("SELECT word, n FROM wc"))
def q_word_counts(spark, sf_dir):
    return _word_counts(spark, sf_dir).select("word", F.col("n").cast("long").alias("n"))


@query("char_alphabet", wq("""
SELECT token, CAST(3 + row_number() OVER (ORDER BY token) AS BIGINT) AS id
FROM (SELECT DISTINCT unnest(regexp_extract_all(word, '.')) AS token FROM wc)
"""))
def q_char_alphabet(spark, sf_dir):
    a = V.char_alphabet(_word_counts(spark, sf_dir))
    return a.select("token", F.col("id").cast("long").alias("id"))


PAIR_SQL = """
,cw AS (SELECT n, regexp_extract_all(word, '.') AS c FROM wc),
pr AS (SELECT c[i] AS "left", c[i + 1] AS "right", n
       FROM (SELECT n, c, unnest(range(1, len(c))) AS i FROM cw)),
pc AS (SELECT "left", "right", CAST(sum(n) AS BIGINT) AS n FROM pr GROUP BY ALL)
"""


def _initial_pairs(spark, sf_dir):
    wc = cut_lineage(_word_counts(spark, sf_dir))
    alpha = V.char_alphabet(wc)
    syms = V.words_to_symbols(wc, alpha)
    st = V.pair_stats(syms)
    names = alpha.select(F.col("id").alias("a"), F.col("token").alias("left"))
    names_r = alpha.select(F.col("id").alias("b"), F.col("token").alias("right"))
    return (join_measured(join_measured(st, names, "a"), names_r, "b")
            .select("a", "b", "left", "right", F.col("n").cast("long").alias("n")))


@query("pair_counts", wq('SELECT "left", "right", n FROM pc', CORPUS + PAIR_SQL))
def q_pair_counts(spark, sf_dir):
    return _initial_pairs(spark, sf_dir).select("left", "right", "n")


@query("best_pair", wq('SELECT "left", "right", n FROM pc ORDER BY n DESC, "left", "right" LIMIT 1',
                       CORPUS + PAIR_SQL))
def q_best_pair(spark, sf_dir):
    return V.best_pair(_initial_pairs(spark, sf_dir)).select("left", "right", "n")


@query("bpe_train")
def q_bpe_train(spark, sf_dir):
    """All merges up to the full vocabulary size (checked against the public
    ``tokenizers`` trainer in tests)."""
    return _bpe(spark, sf_dir).merges_df(spark)


def merge_chain_sql(words: str, rounds: int) -> str:
    """The trainer's definition over a table ``(word, n, c)`` of words, counts
    and characters (words of count 0 are merged along): materialised tables of
    words w0, w1, ..., tokens v0, v1, ... and merges b0, b1, ....  Symbols stand
    between chr(1) and chr(2), so a replacement merges from left to right."""
    sql = f"""
, w0 AS MATERIALIZED (SELECT word, n, list_transform(c, lambda x: chr(1) || x || chr(2)) AS c, array_to_string(
    list_transform(c, lambda x: chr(1) || x || chr(2)), '') AS s FROM {words}),
v0 AS MATERIALIZED (SELECT token, row_number() OVER (ORDER BY token) AS id
                    FROM (SELECT DISTINCT unnest(c) AS token FROM w0 WHERE n > 0))"""
    for r in range(rounds):
        sql += f"""
, b{r} AS MATERIALIZED (
  SELECT l.token AS a, r.token AS b, chr(1) || l.token[2:-2] || r.token[2:-2] || chr(2) AS ab
  FROM (SELECT c[i] AS a, c[i + 1] AS b, sum(n) AS n
        FROM (SELECT n, c, unnest(range(1, len(c))) AS i FROM (
          SELECT n, regexp_extract_all(s, '\\x01[^\\x02]*\\x02') AS c FROM w{r} WHERE n > 0)) GROUP BY ALL) p
  JOIN v{r} l ON l.token = p.a JOIN v{r} r ON r.token = p.b ORDER BY p.n DESC, l.id, r.id LIMIT 1)
, w{r + 1} AS MATERIALIZED (SELECT word, n, replace(s, (SELECT a || b FROM b{r}), (SELECT ab FROM b{r})) AS s FROM w{r})
, v{r + 1} AS MATERIALIZED (SELECT * FROM v{r} UNION ALL SELECT ab, 1 + (SELECT max(id) FROM v{r}) FROM b{r}
    WHERE ab NOT IN (SELECT token FROM v{r}))"""
    return sql


def _first_merges_sql(rounds: int) -> str:
    chain = ", cw AS (SELECT word, n, regexp_extract_all(word, '.') AS c FROM wc)" + merge_chain_sql("cw", rounds)
    return wq(chain + " " + " UNION ALL ".join(
        f'SELECT {r}::BIGINT AS rank, a[2:-2] AS "left", b[2:-2] AS "right" FROM b{r}' for r in range(rounds)), CORPUS)


FIRST_MERGES = 100


@query("bpe_first_merges", _first_merges_sql(FIRST_MERGES))
def q_bpe_first_merges(spark, sf_dir):
    """The first 100 merges, restated in SQL one merge after the other."""
    m = _bpe(spark, sf_dir, max_merges=FIRST_MERGES).merges_df(spark)
    return m.select(F.col("rank").cast("long").alias("rank"), "left", "right")


@query("vocab_union")
def q_vocab_union(spark, sf_dir):
    """Specials, alphabet, then each merge result unless it already exists."""
    return _bpe(spark, sf_dir).vocab_df(spark)


@query("vocab_size")
def q_vocab_size(spark, sf_dir):
    return _bpe(spark, sf_dir).vocab_df(spark).agg(F.count(F.lit(1)).alias("vocab_size"))


@query("bpe_encode")
def q_bpe_encode(spark, sf_dir):
    """BPE ids of every sentence of both sides with the learned merges."""
    m = _bpe(spark, sf_dir)
    enc = E.bpe_encode(spark, FX.sentences(_pairs(spark, sf_dir)), "sent_id", "sentence", "ids", m.vocab, m.merges)
    return enc.select("sent_id", _ids_str("ids").alias("ids"), F.size("ids").cast("long").alias("n_ids"))


@query("word_vocab", wq("""
SELECT word AS token, CAST(wid AS BIGINT) AS id FROM wv
UNION ALL SELECT * FROM (VALUES ('[PAD]', 0::BIGINT), ('[UNK]', 1), ('[SOS]', 2), ('[EOS]', 3)) v(token, id)
"""))
def q_word_vocab(spark, sf_dir):
    return _word_vocab(spark, sf_dir).select("token", F.col("id").cast("long").alias("id"))


@query("encode_words", wq("""
SELECT id, array_to_string(src, ' ') AS src_ids, array_to_string(tgt, ' ') AS tgt_ids FROM enc
""", ENCODED))
def q_encode_words(spark, sf_dir):
    e = _encoded(spark, sf_dir)
    return e.select("id", _ids_str("src_ids").alias("src_ids"), _ids_str("tgt_ids").alias("tgt_ids"))


@query("truncate_ids", wq("""
SELECT id, CAST(len(src) AS BIGINT) AS src_len, CAST(len(tgt) - 2 AS BIGINT) AS tgt_body_len FROM enc
""", ENCODED))
def q_truncate_ids(spark, sf_dir):
    e = _encoded(spark, sf_dir)
    return e.select("id", F.size("src_ids").cast("long").alias("src_len"),
                    (F.size("tgt_ids") - 2).cast("long").alias("tgt_body_len"))


@query("add_sos_eos", wq("""
SELECT id, CAST(tgt[1] AS BIGINT) AS first_id, CAST(tgt[len(tgt)] AS BIGINT) AS last_id,
       CAST(len(tgt) AS BIGINT) AS tgt_len FROM enc
""", ENCODED))
def q_add_sos_eos(spark, sf_dir):
    e = _encoded(spark, sf_dir)
    return e.select("id", F.col("tgt_ids")[0].cast("long").alias("first_id"),
                    F.element_at("tgt_ids", -1).cast("long").alias("last_id"),
                    F.size("tgt_ids").cast("long").alias("tgt_len"))


@query("shifted_targets", wq("""
SELECT id, array_to_string(tgt[1:len(tgt) - 1], ' ') AS dec_input_ids,
       array_to_string(tgt[2:len(tgt)], ' ') AS labels FROM enc
""", ENCODED))
def q_shifted_targets(spark, sf_dir):
    e = _encoded(spark, sf_dir)
    dec, lab = B.shifted_targets("tgt_ids")
    s = e.select("id", dec, lab)
    return s.select("id", _ids_str("dec_input_ids").alias("dec_input_ids"), _ids_str("labels").alias("labels"))


@query("shuffled_batches", wq(f"""
, sh AS (SELECT enc.*, row_number() OVER (PARTITION BY split ORDER BY
           CASE WHEN split = 'train' THEN {md5_sql("42", "0", "id")} ELSE 0 END, id) - 1 AS sp FROM enc)
SELECT id, split, CAST(sp AS BIGINT) AS pos,
       CAST(floor(sp / CASE WHEN split = 'train' THEN {TRAIN_BATCH_SIZE} ELSE {EVAL_BATCH_SIZE} END) AS BIGINT) AS batch_id
FROM sh
""", ENCODED))
def q_shuffled_batches(spark, sf_dir):
    """Batches of the seeded order of the train split, the others by id."""
    b = B.batch_assign(_encoded(spark, sf_dir), shuffle_train=True, seed=42, epoch=0)
    return b.select("id", "split", F.col("pos").cast("long").alias("pos"), F.col("batch_id").cast("long").alias("batch_id"))


@query("prepare_batches", wq("""
SELECT id, split, batch_id,
  array_to_string(list_concat(src, list_resize([0], t_src - len(src), 0)), ' ') AS src_padded,
  array_to_string(list_concat(tgt[1:len(tgt) - 1], list_resize([0], t_tgt - (len(tgt) - 1), 0)), ' ')
    AS tgt_input_padded,
  array_to_string(list_concat(tgt[2:len(tgt)], list_resize([0], t_tgt - (len(tgt) - 1), 0)), ' ')
    AS labels_padded
FROM bat JOIN bm USING (split, batch_id)
""", ENCODED))
def q_prepare_batches(spark, sf_dir):
    """Pairs → word-level ids → padded batches."""
    c = B.prepare_batches(_encoded(spark, sf_dir))
    return c.select("id", "split", F.col("batch_id").cast("long").alias("batch_id"),
                    _ids_str("src_padded").alias("src_padded"), _ids_str("tgt_input_padded").alias("tgt_input_padded"),
                    _ids_str("labels_padded").alias("labels_padded"))


@query("batch_assign", wq("SELECT id, split, CAST(pos AS BIGINT) AS pos, batch_id FROM bat", ENCODED))
def q_batch_assign(spark, sf_dir):
    return _batched(spark, sf_dir).select("id", "split", F.col("pos").cast("long").alias("pos"),
                                          F.col("batch_id").cast("long").alias("batch_id"))


@query("batch_max_len", wq("""
SELECT split, batch_id, CAST(t_src AS BIGINT) AS t_src, CAST(t_tgt AS BIGINT) AS t_tgt FROM bm
""", ENCODED))
def q_batch_max_len(spark, sf_dir):
    c = B.collate(_batched(spark, sf_dir))
    return c.groupBy("split", "batch_id").agg(F.max("T_src").cast("long").alias("t_src"),
                                              F.max("T_tgt").cast("long").alias("t_tgt"))


@query("pad_batch", wq("""
SELECT id,
  array_to_string(list_concat(src, list_resize([0], t_src - len(src), 0)), ' ') AS src_padded,
  array_to_string(list_concat(tgt[1:len(tgt) - 1], list_resize([0], t_tgt - (len(tgt) - 1), 0)), ' ')
    AS tgt_input_padded,
  array_to_string(list_concat(tgt[2:len(tgt)], list_resize([0], t_tgt - (len(tgt) - 1), 0)), ' ')
    AS labels_padded
FROM bat JOIN bm USING (split, batch_id)
""", ENCODED))
def q_pad_batch(spark, sf_dir):
    c = B.collate(_batched(spark, sf_dir))
    return c.select("id", _ids_str("src_padded").alias("src_padded"),
                    _ids_str("tgt_input_padded").alias("tgt_input_padded"),
                    _ids_str("labels_padded").alias("labels_padded"))


@query("padding_mask", wq("""
SELECT id, array_to_string(list_transform(list_concat(src, list_resize([0], t_src - len(src), 0)),
                                          lambda x: CASE WHEN x <> 0 THEN '1' ELSE '0' END), '') AS src_mask
FROM bat JOIN bm USING (split, batch_id)
""", ENCODED))
def q_padding_mask(spark, sf_dir):
    c = B.collate(_batched(spark, sf_dir))
    return c.select("id", F.array_join(F.transform("src_mask", lambda b: F.when(b, "1").otherwise("0")), "")
                    .alias("src_mask"))


@query("look_ahead_mask", wq("""
SELECT split, batch_id, CAST(t_tgt AS BIGINT) AS t,
       array_to_string(list_transform(range(0, t_tgt), lambda q: repeat('1', q + 1) || repeat('0', t_tgt - q - 1)), '/')
         AS mask FROM bm
""", ENCODED))
def q_look_ahead_mask(spark, sf_dir):
    c = B.collate(_batched(spark, sf_dir))
    per_batch = c.groupBy("split", "batch_id").agg(F.max("T_tgt").alias("t"))
    m = per_batch.withColumn("mask", B.look_ahead_mask(F.col("t")))
    return B.mask_strings(m.select("split", "batch_id", F.col("t").cast("long").alias("t"), "mask"), "mask")


@query("target_mask", wq("""
SELECT id, CAST(t_tgt AS BIGINT) AS t,
       array_to_string(list_transform(range(0, t_tgt), lambda q: repeat('1', least(q + 1, len(tgt) - 1))
                                      || repeat('0', t_tgt - least(q + 1, len(tgt) - 1))), '/') AS mask
FROM bat JOIN bm USING (split, batch_id)
""", ENCODED))
def q_target_mask(spark, sf_dir):
    c = B.collate(_batched(spark, sf_dir), masks=True, packed=True)
    return B.mask_strings(c.select("id", F.col("T_tgt").cast("long").alias("t"), F.col("tgt_mask").alias("mask")), "mask")


def _tgt_tokens(spark, sf_dir):
    vocab = _word_vocab(spark, sf_dir)
    return E.ids_to_tokens(_encoded(spark, sf_dir, vocab), "tgt_ids", vocab, "tokens")


@query("ids_to_tokens", wq("SELECT id, array_to_string(tgt_tokens, ' ') AS tokens FROM enc", ENCODED))
def q_ids_to_tokens(spark, sf_dir):
    return _tgt_tokens(spark, sf_dir).select("id", F.array_join("tokens", " ").alias("tokens"))


@query("drop_special_tokens", wq("""
SELECT id, array_to_string(tgt_tokens[2:len(tgt_tokens) - 1], ' ') AS tokens FROM enc
""", ENCODED))
def q_drop_special_tokens(spark, sf_dir):
    t = _tgt_tokens(spark, sf_dir)
    return t.select("id", F.array_join(drop_special_tokens("tokens"), " ").alias("tokens"))


DETOK_SQL = """regexp_replace(regexp_replace(array_to_string({t}, ' '),
       '\\s([.,!?''":;])', '\\1', 'g'), '(\\w)\\s(''\\w)', '\\1\\2', 'g')"""


DROP_SPECIALS_SQL = "list_filter({t}, lambda x: x NOT IN ('[PAD]', '[UNK]', '[SOS]', '[EOS]'))"


@query("detokenize", wq(f"""
SELECT id, {DETOK_SQL.format(t='tgt_tokens[2:len(tgt_tokens) - 1]')} AS text FROM enc
""", ENCODED))
def q_detokenize(spark, sf_dir):
    t = _tgt_tokens(spark, sf_dir)
    return t.select("id", detokenize("tokens").alias("text"))


@query("bpe_join_decode", wq("SELECT id, array_to_string(tgt_tokens, '') AS text FROM enc", ENCODED))
def q_bpe_join_decode(spark, sf_dir):
    t = _tgt_tokens(spark, sf_dir)
    return t.select("id", E.bpe_join_decode("tokens").alias("text"))


@query("round_trip_reference", wq(f"""
SELECT id, {DETOK_SQL.format(t=DROP_SPECIALS_SQL.format(t='tgt_tokens[2:len(tgt_tokens)]'))} AS ref FROM enc
""", ENCODED))
def q_round_trip_reference(spark, sf_dir):
    vocab = _word_vocab(spark, sf_dir)
    return E.round_trip_reference(_encoded(spark, sf_dir, vocab), vocab)


@query("context_windows", """
WITH d AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(0, len(w) - 3)) AS i FROM d)
SELECT doc_id, CAST(i AS BIGINT) AS i, array_to_string(w[i + 1:i + 3], ' ') AS x,
       array_to_string(w[i + 2:i + 4], ' ') AS y FROM s
""")
def q_context_windows(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return B.context_windows(d, "doc_id", "text", 3).select(
        "doc_id", F.col("i").cast("long").alias("i"),
        F.array_join("x", " ").alias("x"), F.array_join("y", " ").alias("y"))


@query("save_load_vocab", wq("""
SELECT word AS token, CAST(wid AS BIGINT) AS id FROM wv
UNION ALL SELECT * FROM (VALUES ('[PAD]', 0::BIGINT), ('[UNK]', 1), ('[SOS]', 2), ('[EOS]', 3)) v(token, id)
"""))
def q_save_load_vocab(spark, sf_dir):
    """Word vocabulary saved as Parquet and reloaded with the special-id
    check (S10)."""
    from tandem.session import scratch_path
    from tandem.sources import aligned as A
    root = scratch_path(spark, "tokenizer")
    A.save_vocab(_word_vocab(spark, sf_dir), None, root)
    v = A.load_vocab(spark, root)
    return v.select("token", F.col("id").cast("long").alias("id"))


@query("normalize_text", with_pairs("""
SELECT sent_id, lang, lower(t) AS norm FROM sent
"""))
def q_normalize_text(spark, sf_dir):
    """NFKC + per-character lowercase of every sentence of both sides (F1, F2);
    ASCII rows stay in the JVM, the rest go through one Arrow UDF."""
    from tandem.functions.text import normalize_frame
    return normalize_frame(FX.sentences(_pairs(spark, sf_dir)), "sentence", "norm").select("sent_id", "lang", "norm")


@query("pretokenize", with_pairs(f"""
SELECT sent_id, lang, array_to_string(regexp_extract_all(t, '{PRE}'), ' ') AS tokens FROM sent
"""))
def q_pretokenize(spark, sf_dir):
    """Word runs and punctuation runs of every sentence of both sides."""
    from tandem.functions.text import pretokenize
    s = FX.sentences(_pairs(spark, sf_dir))
    return s.select("sent_id", "lang", F.array_join(pretokenize("sentence"), " ").alias("tokens"))


@query("sample_context_windows", f"""
WITH d AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents),
s AS (SELECT doc_id, w, unnest([0, 1]) AS draw FROM d WHERE len(w) > 3),
i AS (SELECT doc_id, w, draw, {md5_sql("0", "doc_id", "draw")} % (len(w) - 3) AS i FROM s)
SELECT doc_id, CAST(draw AS BIGINT) AS draw, CAST(i AS BIGINT) AS i, array_to_string(w[i + 1:i + 3], ' ') AS x,
       array_to_string(w[i + 2:i + 4], ' ') AS y FROM i
""")
def q_sample_context_windows(spark, sf_dir):
    """Two seeded windows (context 3) per document (W2, sampled form)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    s = B.sample_windows(d, "doc_id", "text", 3, 2, seed=0)
    return s.select("doc_id", F.col("draw").cast("long").alias("draw"), F.col("i").cast("long").alias("i"),
                    F.array_join("x", " ").alias("x"), F.array_join("y", " ").alias("y"))
