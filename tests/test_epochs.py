"""Saved datasets, epoch orders, padded BPE batches and lock-step decoding."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.operators import epochs as EP
from tandem.operators.bpe import BpeModel, bpe_train
from tandem.operators.vocab import stack_languages, word_counts
from tandem.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("dataset") / "pairs")
    EP.save_dataset(FX.splits(FX.pairs(spark, SF, with_score=False)).repartition(5), root)
    return root


@pytest.fixture(scope="module")
def model(spark, saved):
    train = EP.load_dataset(spark, saved, "train")
    return bpe_train(spark, word_counts(stack_languages(train)).checkpoint(), 600)


def test_positions_follow_storage_order(spark, saved):
    rows = EP.load_dataset(spark, saved).collect()
    by = {}
    for r in rows:
        by.setdefault(r.split, []).append(r)
    for some in by.values():
        some.sort(key=lambda r: r.pos)
        assert [r.pos for r in some] == list(range(len(some))) and {r.n_rows for r in some} == {len(some)}
        assert [r.id for r in some] == sorted(r.id for r in some)
    assert all(r.en.strip() and r.vi.strip() for r in rows)


def test_permutation_is_a_bijection(spark):
    sizes = [1, 2, 3, 5, 26, 101, 577, 1000, 4099]
    df = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("pos"))
    seen = {}
    for epoch in (0, 1):
        out = df.select("n", "pos", EP.permuted(F.col("pos"), F.col("n"), 7, epoch).alias("to")).collect()
        for n in sizes:
            got = {r.pos: r.to for r in out if r.n == n}
            assert sorted(got.values()) == list(range(n))
            seen[n, epoch] = [got[i] for i in range(n)]
    big = seen[4099, 0]
    assert big != seen[4099, 1]
    # looks random: few fixed points, little correlation with the old order
    assert sum(i == x for i, x in enumerate(big)) < 10 and abs(np.corrcoef(range(4099), big)[0, 1]) < 0.06


def test_batches_equal_library_encoding(spark, saved, model):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers
    tok = Tokenizer(models.BPE(vocab={t: i for i, t in enumerate(model.vocab)}, merges=model.merges, unk_token="[UNK]"))
    tok.normalizer = normalizers.Sequence([normalizers.NFKC(), normalizers.Lowercase()])
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    json.loads(tok.to_str())
    data = {(r.split, r.slot): r for r in EP.epoch_batches(EP.load_dataset(spark, saved), epoch=3).collect()}
    got = EP.prepare_batches(spark, saved, model, epoch=3).collect()
    assert {(r.split, r.slot) for r in got} == set(data) and len(got) == len(data)
    batches = {}
    for r in got:
        x = data[r.split, r.slot]
        assert (x.id, x.batch_id) == (r.id, r.batch_id) and r.batch_id == r.slot // (32 if r.split == "train" else 64)
        src = tok.encode(x.en, add_special_tokens=False).ids[:150]
        tgt = tok.encode(x.vi, add_special_tokens=False).ids[:148]
        batches.setdefault((r.split, r.batch_id), []).append((r, src, [2, *tgt], [*tgt, 3]))
    for some in batches.values():
        for col in (0, 1, 2):
            most = max(len(b[col + 1]) for b in some)
            for b in some:
                have = (b[0].src_padded, b[0].tgt_input_padded, b[0].labels_padded)[col]
                assert have == b[col + 1] + [0] * (most - len(b[col + 1]))


def test_one_exchange_of_texts(spark, saved, model):
    plan = EP.prepare_batches(spark, saved, model)._jdf.queryExecution().executedPlan().toString()
    moves = [x for x in plan.splitlines() if "Exchange" in x and "BroadcastExchange" not in x and "_file" not in x]
    # the only moves besides the one row a file: raw texts by batch, once
    assert len([x for x in moves if "batch_id" in x]) == 1 and "rangepartitioning" not in plan
    assert "Generate" not in plan and plan.count("MapInArrow") == 1
    order = EP.epoch_batches(EP.load_dataset(spark, saved))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in order and "batch_id" not in "".join(x for x in order.splitlines() if "Exchange" in x)


def test_lock_step_decoding(spark, model):
    scorer = EP.LexicalScorer(np.arange(1000, dtype=np.int32) + 4)
    assert EP.decode_together([[5, 6], [], [7] * 9], scorer, 6) == [[2, 9, 10, 3], [2, 3], [2, 11, 11, 11, 11, 11]]
    assert EP.decode_together([], scorer) == []

    class Failing(EP.LexicalScorer):
        def next(self, state, live, step):
            if (state["n"][live] == 3).any():
                raise ValueError("three")
            return super().next(state, live, step)

    ids, errors = EP.decode_captured([[5], [1, 2, 3], [6], [7, 7]], Failing(scorer.table))
    assert ids == [[2, 9, 3], [], [2, 10, 3], [2, 11, 11, 3]] and errors == [None, "ValueError: three", None, None]
    texts = spark.createDataFrame([(1, "the river"), (2, None), (3, "[SOS] x")], "id long, en string")
    out = {r.id: r for r in EP.translate(texts, model, EP.LexicalScorer(np.arange(len(model.vocab), dtype=np.int32))).collect()}
    assert out[2].pred_ids == [2, 3] and out[2].translation == "" and out[1].error is None
    assert out[1].pred_ids[1:-1] == EP.Encoder(model)(["the river"], 150)


def test_lexical_ids(spark):
    m = BpeModel(["[PAD]", "[UNK]", "[SOS]", "[EOS]", "a", "b", "c"], [])
    df = spark.createDataFrame([("a b", "b b c"), ("a", "b"), ("ab", "cc"), ("c", "")], "en string, vi string")
    assert EP.lexical_ids(df, m).tolist() == [1, 1, 1, 1, 5, 5, 1]  # c never has a partner; b: b and c once each
