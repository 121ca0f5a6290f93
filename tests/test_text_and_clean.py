"""Golden semantics cases (tiny inline tables) for text functions and the
cleaning predicates."""

import numpy as np
from pyspark.sql import functions as F

from tandem.functions.text import detokenize, drop_special_tokens, is_blank, strip_text, word_count
from tandem.operators import clean as C


def _one(spark, rows, schema, col):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_word_count_matches_python_split(spark):
    texts = [" a　b c d\x1ce\x85f​g \t", "", "  ", "　", "one", "x  y\n z"]
    got = _one(spark, [(t,) for t in texts], "t string", word_count("t"))
    assert got == [len(t.split()) for t in texts]
    assert got[0] == 6  # U+200B does not split


def test_word_count_null_is_zero(spark):
    assert _one(spark, [(None,)], "t string", word_count("t")) == [0]


def test_strip_matches_python(spark):
    texts = ["　 ab c \t", "x", "   ", "\x1c y \x85"]
    got = _one(spark, [(t,) for t in texts], "t string", strip_text("t"))
    assert got == [t.strip() for t in texts]


def test_blank(spark):
    got = _one(spark, [("",), ("  ",), ("　",), (None,), ("a",)], "t string", is_blank("t"))
    assert got == [True, True, True, True, False]


def _lens_df(spark, rows):
    return spark.createDataFrame(rows, "id long, len_en int, len_vi int, score float")


def test_length_bounds_inclusive(spark):
    df = _lens_df(spark, [(1, 2, 5, 2.0), (2, 3, 5, 2.0), (3, 150, 150, 2.0), (4, 151, 150, 2.0)])
    ids = [r.id for r in df.filter(C.length_pred()).collect()]
    assert sorted(ids) == [2, 3]


def test_ratio(spark):
    df = _lens_df(spark, [(1, 10, 20, 2.0), (2, 10, 21, 2.0), (3, 0, 0, 2.0), (4, 0, 5, 2.0)])
    assert sorted(r.id for r in df.filter(C.ratio_pred()).collect()) == [1]
    # the ratio mask alone (no >0 guard) keeps (0, 0)
    assert sorted(r.id for r in df.filter(C.ratio_only_pred()).collect()) == [1, 3]


def test_score_float32_threshold(spark):
    f32 = float(np.float32(1.0872))
    df = _lens_df(spark, [(1, 5, 5, f32), (2, 5, 5, 1.0873), (3, 5, 5, float("nan")), (4, 5, 5, None)])
    assert sorted(r.id for r in df.filter(C.score_pred()).collect()) == [2]


def test_keep_mask_null_is_false(spark):
    df = _lens_df(spark, [(1, 5, 5, None), (2, 5, 5, 2.0)])
    got = {r.id: r.keep_mask for r in df.withColumn("keep_mask", C.keep_mask()).collect()}
    assert got == {1: False, 2: True}


def test_funnel_empty_input_gives_null_pct(spark):
    df = spark.createDataFrame([], "id long, en string, vi string, score float")
    r = C.filter_funnel(df).first()
    assert r.n_pairs == 0 and r.removed_pct is None


def test_detokenize(spark):
    toks = ["[SOS]", "don", "'", "t", "stop", ".", "[PAD]"]
    got = _one(spark, [(toks,)], "t array<string>", detokenize("t"))
    assert got == ["don' t stop."]


def test_drop_special_keeps_duplicates(spark):
    got = _one(spark, [(["a", "[UNK]", "a", "[EOS]"],)], "t array<string>", drop_special_tokens("t"))
    assert got == [["a", "a"]]


def test_variants_agree_sf001(spark):
    from tandem.sources import fixtures as FX
    p = FX.pairs(spark, "/root/testdata/sf0.001")
    a = {r.id for r in C.clean_pairs(p).collect()}
    b = {r.id for r in C.clean_pairs_masked(p).collect()}
    c = {r.id for r in C.clean_pairs_sequential(FX.pairs(spark, "/root/testdata/sf0.001", with_score=False),
                                                p.select("id", "score")).collect()}
    assert a == b == c and len(a) == 97


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() == 97
    assert df.columns == ["id", "en", "vi"]


def test_no_per_document_cap(spark):
    """Pairs beyond the tenth of a document have a score and can be kept, ids
    never collide, and an odd last line is paired with an empty one."""
    from tandem.sources import fixtures as FX
    from tandem.session import read_table
    sf = "/root/testdata/sf0.001"
    p = FX.pairs(spark, sf)
    docs = read_table(spark, sf, "documents").toPandas()
    lines = [t.split("\n") for t in docs.text]
    assert p.count() == sum((len(a) + 1) // 2 for a in lines) == p.select("id").distinct().count()
    assert p.filter("score is null").count() == 0
    stride = max((len(a) + 1) // 2 for a in lines)
    kept = [r.id % stride for r in C.clean_pairs(p).collect()]
    assert sum(k >= 10 for k in kept) == 15
    got = [r.sentence for r in FX.sentences(p).select("sentence").collect()]
    assert sorted(x for x in got if x) == sorted(x for a in lines for x in a if x)


def test_short_score_file_drops_unscored(spark):
    """Pairs without a score (a short score file) are kept out, not raised."""
    p = spark.createDataFrame([(0, "a b c", "a b c"), (1, "a b c", "a b c")], "id long, en string, vi string")
    s = spark.createDataFrame([(0, 2.0)], "id long, score float")
    assert [r.id for r in C.clean_pairs(C.attach_scores(p, s)).collect()] == [0]
