"""Sources (line index, zip, scores), BPE against the public tokenizers
package, batching masks, BLEU against a plain-Python restatement and
early stopping."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tandem.operators import batching as B
from tandem.operators import runs as R
from tandem.operators import vocab as V
from tandem.operators.bpe import BpeModel
from tandem.sources import aligned as A


def _write(path, data: bytes):
    with open(path, "wb") as f:
        f.write(data)


def test_line_ends_and_index(spark):
    d = tempfile.mkdtemp(prefix="tandem-lines-")
    p = os.path.join(d, "a.txt")
    _write(p, "l0\r\nl1\rl2\n\nl4\x0bx y\n".encode())
    rows = A.read_lines(spark, p).orderBy("line_id").collect()
    assert [r.line_id for r in rows] == [0, 1, 2, 3, 4]
    assert rows[3].value == ""


def test_line_index_multi_block(spark):
    d = tempfile.mkdtemp(prefix="tandem-blocks-")
    p = os.path.join(d, "big.txt")
    lines = [f"line {i}" for i in range(5000)]
    _write(p, ("\n".join(lines) + "\n").encode())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = A.read_lines(spark, p).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted((r.line_id, r.value) for r in rows)
    assert got == list(enumerate(lines))


def test_zip_stops_at_shorter(spark):
    d = tempfile.mkdtemp(prefix="tandem-zip-")
    _write(os.path.join(d, "en.txt"), b" a \nb\nc\n")
    _write(os.path.join(d, "vi.txt"), b"x\ny \n")
    rows = A.ingest_aligned_text(spark, os.path.join(d, "en.txt"), os.path.join(d, "vi.txt")).orderBy("id").collect()
    assert [(r.id, r.en, r.vi) for r in rows] == [(0, "a", "x"), (1, "b", "y")]


def test_score_file_junk(spark):
    d = tempfile.mkdtemp(prefix="tandem-score-")
    p = os.path.join(d, "s.txt")
    _write(p, b"1.5\n\n# c\nabc\n2.0\n")
    rows = A.scan_scores(spark, p).orderBy("id").collect()
    assert [r.id for r in rows] == [0, 1, 2]
    assert rows[1].score is None and rows[2].score == 2.0
    assert A.score_parse_report(A.scan_scores(spark, p)).first().n_unparsable == 1


def test_bpe_matches_tokenizers_package(spark):
    pytest.importorskip("tokenizers")
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers, trainers
    import json
    from tandem.operators.bpe import bpe_train
    from tandem.sources import fixtures as FX
    p = FX.pairs(spark, "/root/testdata/sf0.01", with_score=False)
    wc = V.word_counts(V.stack_languages(p)).checkpoint()
    m = bpe_train(spark, wc, 2000)
    tok = Tokenizer(models.BPE(unk_token="[UNK]"))
    tok.normalizer = normalizers.Sequence([normalizers.NFKC(), normalizers.Lowercase()])
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tr = trainers.BpeTrainer(vocab_size=2000, special_tokens=["[PAD]", "[UNK]", "[SOS]", "[EOS]"],
                             show_progress=False)
    rows = p.select("en", "vi").toPandas()
    tok.train_from_iterator(list(rows.en) + list(rows.vi), tr)
    j = json.loads(tok.to_str())
    hm = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in j["model"]["merges"]]
    assert hm == [tuple(x) for x in m.merges] and len(hm) > 1900
    assert m.rounds < 20
    assert j["model"]["vocab"] == {t: i for i, t in enumerate(m.vocab)}
    # encoding with the learned merges equals the library's
    from tandem.operators.encode import bpe_encode
    df = spark.createDataFrame([(1, "Eauouon. zz [SOS] [sos]"), (2, "")], "id long, t string")
    got = {r.id: r.ids for r in bpe_encode(spark, df, "id", "t", "ids", m.vocab, m.merges).collect()}
    assert got[1] == tok.encode("Eauouon. zz [SOS] [sos]", add_special_tokens=False).ids
    assert got[2] == []


def plain_bpe(words, vocab_size, specials=("[PAD]", "[UNK]", "[SOS]", "[EOS]")):
    """One merge at a time over all words."""
    vocab = [*specials, *sorted({c for w in words for c in w})]
    index = {t: i for i, t in enumerate(vocab)}
    state, merges = [([index[c] for c in w], n) for w, n in words.items()], []
    while len(vocab) < vocab_size:
        count = {}
        for s, n in state:
            for p in zip(s, s[1:]):
                count[p] = count.get(p, 0) + n
        if not count:
            break
        a, b = min(count, key=lambda p: (-count[p], p))
        token = vocab[a] + vocab[b]
        merges.append((vocab[a], vocab[b]))
        if token not in index:
            index[token] = len(vocab)
            vocab.append(token)
        for s, _ in state:
            i = 0
            while i + 1 < len(s):
                if (s[i], s[i + 1]) == (a, b):
                    s[i:i + 2] = [index[token]]
                i += 1
    return merges, vocab


@pytest.mark.parametrize("heavy,segments,letters", [(1, 50_000, "ab"), (3, 4, "ab"), (256, 50_000, "abc"), (5, 12, "abé𝄞")])
def test_bpe_batches_equal_single_merges(spark, heavy, segments, letters):
    """Runs of equal letters, ties and strings made in two ways, in batches of any size."""
    import random
    from tandem.operators.bpe import bpe_train
    rng = random.Random(heavy)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))): rng.randrange(1, 9) for _ in range(60)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    size = 40 if heavy < 256 else 10_000
    m = bpe_train(spark, df, size, heavy=heavy, segments=segments)
    assert (m.merges, m.vocab) == plain_bpe(words, size)


def test_bpe_without_words_and_scratch_dropped(spark):
    from tandem.operators.bpe import bpe_train
    from tandem.session import checkpoint_root
    from pathlib import Path
    root = Path(checkpoint_root(spark).removeprefix("file:"))
    before = set(root.glob("tandem-bpe-*"))
    assert bpe_train(spark, spark.createDataFrame([], "word string, n long")).merges == []
    assert bpe_train(spark, spark.createDataFrame([("a", 3)], "word string, n long")).vocab[-1] == "a"
    m = bpe_train(spark, spark.createDataFrame([("abab", 3), ("ba", 9)], "word string, n long"), max_merges=1)
    assert m.merges == [("b", "a")]
    assert set(root.glob("tandem-bpe-*")) == before


def test_pair_tie_break(spark):
    w = spark.createDataFrame([("ab", 1, " 4 5 "), ("cd", 1, " 6 7 ")], "word string, n long, syms string")
    best = V.best_pair(V.pair_stats(w)).first()
    assert (best.a, best.b) == (4, 5)


def test_padding_and_masks(spark):
    df = spark.createDataFrame([(1, "train", 0, [5, 6, 7], [2, 5, 6, 7, 3]), (2, "train", 0, [8], [2, 8, 3])],
                               "id long, split string, batch_id long, src_ids array<int>, tgt_ids array<int>")
    c = {r.id: r for r in B.collate(df, masks=True).collect()}
    assert c[2].src_padded == [8, 0, 0] and c[1].src_padded == [5, 6, 7]
    assert c[2].tgt_input_padded == [2, 8, 0, 0] and c[2].labels_padded == [8, 3, 0, 0]
    assert c[2].src_mask == [True, False, False]
    assert c[2].tgt_mask == [[True, False, False, False], [True, True, False, False],
                             [True, True, False, False], [True, True, False, False]]


def test_histogram_max_in_last_bin(spark):
    from tandem.operators.profile import histogram
    df = spark.createDataFrame([(float(v),) for v in range(101)], "v double")
    h = {r.bin: r["count"] for r in histogram(df, "v", 100).collect()}
    assert h[99] == 2 and sum(h.values()) == 101 and len(h) == 100


def test_bleu_matches_python(spark):
    from tandem.operators.evaluate import bleu_python, corpus_bleu
    preds = ["the cat sat on the mat today", "a b c d e", "x y"]
    refs = ["the cat sat on a mat today ok", "a b c d e", "x y z w"]
    df = spark.createDataFrame(list(zip(range(3), preds, refs)), "id long, pred string, ref string")
    got = corpus_bleu(df).first().bleu
    assert abs(got - bleu_python(preds, refs)) < 1e-9
    same = spark.createDataFrame([(0, "a b c d e", "a b c d e")], "id long, pred string, ref string")
    assert abs(corpus_bleu(same).first().bleu - 100.0) < 1e-9


def test_early_stop_latches(spark):
    vals = [5, 4, 4, 4, 4, 4, 4, 3]
    df = spark.createDataFrame([("r", i, float(v)) for i, v in enumerate(vals)], "run string, epoch int, val_loss double")
    s = R.early_stop_state(df).first()
    assert s.stop_epoch == 6 and s.best_loss == 4.0 and s.checkpoint_epochs == [0, 1, 2, 3, 4, 5, 6]


def test_checkpoints_at_ties_only(spark):
    vals = [5.0, 4.0, 4.0, 4.0, 4.5]
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(vals)], "run string, epoch int, val_loss double")
    assert R.early_stop_state(df).first().checkpoint_epochs == [0, 1, 2, 3]


def test_greedy_decode_never_eos():
    from tandem.operators.decode import greedy_decode_ids
    out = greedy_decode_ids([5], lambda s, p: 7, max_len=150)
    assert len(out) == 150 and out[0] == 2


def test_lr_schedule(spark):
    df = spark.createDataFrame([("r", s) for s in range(160)], "run string, step int")
    rows = {r.step: r.lr for r in R.with_lr(df).collect()}
    assert rows[0] == 0.0 and abs(rows[8] - 5e-4 * 8 / 16) < 1e-15 and abs(rows[16] - 5e-4) < 1e-15


def test_sample_windows_are_valid_windows(spark):
    texts = {1: "rain fell on the long grey road all day", 2: "two words", 3: "one two three four", 4: None}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = B.sample_windows(df, "doc_id", "text", 3, 2, seed=0).collect()
    assert sorted(r.doc_id for r in rows) == [1, 1, 3, 3]
    for r in rows:
        words = texts[r.doc_id].split(" ")
        assert 0 <= r.i < len(words) - 3
        assert r.x == words[r.i:r.i + 3] and r.y == words[r.i + 1:r.i + 4]


def test_row_at_past_the_end_and_null_order(spark):
    from tandem.operators.profile import bounded_top_n, row_at
    df = spark.range(10)
    assert [r.id for r in row_at(df, 3).collect()] == [3] and row_at(df, 50).count() == 0
    v = spark.range(1000).select(F.when(F.col("id") % 100 == 0, None).otherwise(F.col("id")).alias("v"), "id")
    for n in (5, 20, 400):  # the sketch and the plain branch treat NULL alike
        top = [r.v for r in bounded_top_n(v, "v", n, "id").collect()]
        assert top.count(None) == min(n, 10)


def test_sampling_does_not_depend_on_partitions(spark):
    from tandem.operators.profile import sample_inspect, sample_n
    df = spark.range(500).select("id", F.col("id").alias("row_idx"))
    picks = [sorted((r.draw, r.row_idx) for r in sample_inspect(df.repartition(n), 5, 7).collect()) for n in (1, 4, 5)]
    assert picks[0] == picks[1] == picks[2] and len(picks[0]) == 5
    some = [sorted(r.id for r in sample_n(df.repartition(n), 20).collect()) for n in (1, 6)]
    assert some[0] == some[1] and len(some[0]) == 20


def test_files_in_numeric_order(spark):
    d = tempfile.mkdtemp(prefix="tandem-order-")
    for n in ("part-100000.txt", "part-10001.txt", "part-9.txt"):
        _write(os.path.join(d, n), f"{n}\n".encode())
    rows = A.read_lines(spark, d).orderBy("line_id").collect()
    assert [r.value for r in rows] == ["part-9.txt", "part-10001.txt", "part-100000.txt"]


def test_merges_round_trip_and_broken_folder(spark):
    root = tempfile.mkdtemp(prefix="tandem-tok-")
    m = BpeModel(vocab=["[PAD]", "[UNK]", "[SOS]", "[EOS]", "a", "b", "ab"], merges=[("a", "b")])
    A.save_vocab(m.vocab_df(spark), m.merges_df(spark), root)
    assert A.load_vocab(spark, root).count() == 7
    assert [(r.rank, r.left, r.right) for r in A.load_merges(spark, root).collect()] == [(0, "a", "b")]
    half = os.path.join(root, "half")
    os.makedirs(half)  # a folder without _SUCCESS is written anew
    p = spark.createDataFrame([(1, "x", "y")], "id long, en string, vi string")
    assert A.write_cleaned(p, half) and not A.write_cleaned(p, half)


def test_decoding_reads_the_source_and_reports_errors(spark):
    from tandem.operators import decode as D
    pairs = spark.createDataFrame([(1, [7, 8], [2, 17, 18, 3]), (2, [7, 9], [2, 17, 19, 3]), (3, [], [2, 3])],
                                  "id long, src_ids array<int>, tgt_ids array<int>")
    table = D.lexical_table(pairs)
    assert {(r.src, r.next) for r in table.collect()} == {(7, 17), (8, 18), (9, 19)}
    new = spark.createDataFrame([(1, [8, 7, 99]), (2, []), (3, [7] * 150)], "id long, src_ids array<int>")
    got = {r.id: r.pred_ids for r in D.lexical_decode(spark, new, table).collect()}
    assert got[1] == [2, 18, 17, 1, 3] and got[2] == [2, 3] and got[3] == [2] + [17] * 149

    def raising(src, prefix):
        if 99 in list(src):
            raise ValueError("no such id")
        return 3

    rows = {r.id: (r.pred_ids, r.error) for r in D.greedy_decode(spark, new, lambda: raising).collect()}
    assert rows[1] == ([], "ValueError: no such id") and rows[2] == ([2, 3], None)


def test_pair_encoding_keeps_specials_and_empty_sides(spark):
    from tandem.operators import encode as E
    vocab = spark.createDataFrame([("[PAD]", 0), ("[UNK]", 1), ("[SOS]", 2), ("[EOS]", 3), ("a", 4), (".", 5)],
                                  "token string, id int")
    p = spark.createDataFrame([(1, "train", "A. zz [SOS] [sos]", None), (2, "test", "", "a")],
                              "id long, split string, src string, tgt string")
    got = {r.id: r for r in E.word_vocab_encode_pairs(p, vocab).collect()}
    assert got[1].src_ids == [4, 5, 1, 2, 1, 1, 1] and got[1].tgt_ids == [2, 3] and got[1].split == "train"
    assert got[2].src_ids == [] and got[2].tgt_ids == [2, 4, 3]
