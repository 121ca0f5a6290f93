"""A BPE task holds a bounded number of words, pairs and segments, whatever its partition's size."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tandem.operators import bpe


def word_batches(taken, n=40, size=50):
    rng = np.random.default_rng(1)
    for _ in range(n):
        words = [rng.integers(0, 5, rng.integers(0, 9)).astype(np.int32).tolist() for _ in range(size)]
        taken.append(words)
        yield pa.record_batch([pa.array(range(1, size + 1), pa.int64()), pa.array(words, pa.list_(pa.int32())),
                               pa.array([w[::-1] if i % 2 else None for i, w in enumerate(words)], pa.list_(pa.int32()))],
                              ["n", "syms", "old"])


def total(pieces, key):
    out = Counter()
    for p in pieces:
        for k, n in zip(p[key].to_pylist(), p["n"].to_pylist(), strict=True):
            out[k] += n
    return {k: n for k, n in out.items() if n}


@pytest.mark.parametrize("run,key", [(bpe._count_pairs, "key"), (bpe._cut(np.array([0, 1, (1 << 32) | 2, (2 << 32) | 2], np.int64)), "seg"),
                                     (bpe._changes, "key")])
def test_sums_are_passed_on_before_all_words_are_read(run, key, monkeypatch):
    def batches(taken):
        for b in word_batches(taken):
            yield b.filter(b["old"].is_valid()) if run is bpe._changes else b
    whole = total(run(batches([])), key)
    monkeypatch.setattr(bpe, "HOLD", 10 if key == "seg" else 400)
    monkeypatch.setattr(bpe, "TAKE", 16)
    taken: list = []
    pieces = run(batches(taken))
    first = next(pieces)
    assert len(taken) < 20 and len(first)
    assert total([first, *pieces], key) == whole


def test_encoded_words_kept_are_bounded_by_characters(spark, monkeypatch):
    from tandem.operators import encode as E
    df = spark.createDataFrame([(i, f"{'ab' * 40}{i} ab") for i in range(50)], "id long, t string")
    args = spark, df, "id", "t", "ids", ["[PAD]", "[UNK]", "[SOS]", "[EOS]", "a", "b", "ab"], [("a", "b")]
    want = sorted((r.id, r.ids) for r in E.bpe_encode(*args).collect())
    monkeypatch.setattr(E, "CHARS_KEPT", 100)
    assert sorted((r.id, r.ids) for r in E.bpe_encode(*args).collect()) == want and E.WORDS_KEPT <= 100_000
