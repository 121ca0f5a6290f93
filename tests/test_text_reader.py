"""Words and ids of texts, read in one Arrow pass: the same as the JVM's pre-tokeniser gives, and no text is split in the JVM."""

import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from tandem.functions.text import pretokenize
from tandem.operators import encode as E
from tandem.operators import vocab as V

TEXTS = ["", " ", None, "  The  cat's  3rd_try... ", "a\tb\n\x1cc\x85d e ", "x²¼ ½ ﬁn Ａ１", "[SOS] [sos]a[PAD]É ［SOS］", "é ́e",
         "mèo‍ăn İstanbul ΣΑΣ", "ࡰ՘ \U0001f600\U0001f600!", "é.é " * 90, "　一二、三 ไทย नमस्ते"]


def jvm_words(spark, texts):
    """Each text's words by ``text_words``, which normalises and pre-tokenises segment by segment in Spark."""
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    rows = E.text_words(df, "id", "t").filter("word is not null").collect()
    return [[r.word for r in sorted((r for r in rows if r._k == i), key=lambda r: r.pos)] for i in range(len(texts))]


def test_words_equal_the_jvms(spark):
    read = E.text_reader(spark, [None, 3])
    pairs = pa.array([[a, b] for a, b in zip(TEXTS, TEXTS[::-1])], pa.list_(pa.string()))
    want = jvm_words(spark, TEXTS)
    for n in (1, 200):  # more rows than are read at once
        flat, bounds, first = read(pa.concat_arrays([pairs] * n))
        words = flat.to_pylist()
        got = [words[a:z] for a, z in zip(bounds, bounds[1:])]
        assert got == [a + b[:3] for a, b in zip(want, want[::-1])] * n and first.tolist() == [len(a) for a in want] * n
    flat, bounds, first = read(pairs.slice(0, 0))
    assert len(flat) == len(first) == 0 and bounds.tolist() == [0]


def test_classes_are_the_jvms_for_every_character(spark):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join("a" + chr(c) for c in points[i::40] if not unicodedata.normalize("NFKC", chr(c)).isspace()) for i in range(40)]
    read = E.text_reader(spark, [None])
    flat, bounds, _ = read(pa.array([[t] for t in texts], pa.list_(pa.string())))
    words = flat.to_pylist()
    df = spark.createDataFrame([(i, E._nfkc_lower(t)) for i, t in enumerate(texts)], "i long, t string").repartition(8)
    want = {r.i: r.w for r in df.select("i", pretokenize("t").alias("w")).collect()}
    assert [words[a:z] for a, z in zip(bounds, bounds[1:])] == [want[i] for i in range(40)]


def test_no_text_is_split_in_the_jvm(spark):
    vocab = spark.createDataFrame([("[PAD]", 0), ("[UNK]", 1), ("[SOS]", 2), ("[EOS]", 3), ("a", 4)], "token string, id int").checkpoint()
    df = spark.range(3).select("id", F.lit("train").alias("split"), F.lit("a b").alias("src"), F.lit("b a").alias("tgt"))
    enc = E.word_vocab_encode_pairs(df, vocab)
    plan = enc._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan.lower() and plan.count("ArrowEvalPython") == 1
    assert {(tuple(r.src_ids), tuple(r.tgt_ids)) for r in enc.collect()} == {((4, 1), (2, 1, 4, 3))}


def test_words_are_counted_in_one_pass(spark):
    """Only words are exchanged, once; their counts equal those of the JVM's pre-tokeniser."""
    df = spark.createDataFrame([(t,) for t in TEXTS for _ in range(3)], "text string")
    wc = V.word_counts(df)
    plan = wc._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "MapInArrow" in plan and "Generate" not in plan
    norm = spark.createDataFrame([(E._nfkc_lower(t),) for t in TEXTS], "t string").select(F.explode(pretokenize("t")).alias("w"))
    assert {r.word: r.n for r in wc.collect()} == {w: 3 * n for w, n in Counter(r.w for r in norm.collect()).items()}


def test_words_are_cut_in_arrow(spark, monkeypatch):
    """Texts are cut together, as many as a number of characters, and each keeps its own words."""
    from tandem.functions import text as X
    cut = X.cutter(X.pretoken_classes(spark))
    want = [X.re.findall(X.pretoken_classes(spark)[1], E._nfkc_lower(t or "")) for t in TEXTS]
    for most in (1, 40, 1 << 19):
        monkeypatch.setattr(X, "READ_CHARS", most)
        words, size = cut(TEXTS * 3)
        assert isinstance(words, pa.StringArray) and words.to_pylist() == [w for t in want * 3 for w in t]
        assert size.tolist() == [len(t) for t in want * 3]
    words, size = cut([])
    assert len(words) == len(size) == 0
    read = E.text_reader(spark, [2])
    flat, bounds, _ = read(pa.array([["[PAD][SOS]a b"], ["x"], ["a[EOS]b"], ["[sos]"]], pa.list_(pa.string())))
    assert flat.to_pylist() == ["[PAD]", "[SOS]", "x", "a", "[EOS]", "[", "sos"] and bounds.tolist() == [0, 2, 3, 5, 7]
