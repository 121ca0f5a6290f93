"""Scoring and decoding hold a bounded number of rows, however many an Arrow batch has."""

import pandas as pd
from pyspark.sql import functions as F

from tandem.operators import decode as D
from tandem.operators import evaluate as EV


def test_scores_are_summed_over_few_rows_at_a_time(monkeypatch):
    rows = [("a b c d e"[:1 + i % 9], "a b  c x d e f"[i % 5:]) for i in range(2 * EV.STAT_ROWS + 3)]
    seen, keep = [], EV.batch_sums_codes

    def counted(codes, lp, lr):
        seen.append(len(lp))
        return keep(codes, lp, lr)
    monkeypatch.setattr(EV, "batch_sums_codes", counted)
    parts = list(EV._batch_stats([""])(iter([pd.DataFrame(rows, columns=["p", "r"]), pd.DataFrame({"p": [], "r": []}, dtype=str)])))
    assert seen == [EV.STAT_ROWS, EV.STAT_ROWS, 3]
    want = [sum(x) for x in zip(*[EV._row_stats(p.split(), r.split()) for p, r in rows])]
    assert pd.concat(parts).sum().tolist() == want


def test_rows_are_decoded_few_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(D, "DECODE_ROWS", 2)
    df = spark.range(0, 7, 1, 1).select("id", F.transform(F.sequence(F.lit(0), F.col("id")), lambda x: (x + 5).cast("int")).alias("src_ids"))
    out = D.greedy_decode(spark, df, lambda: D.aligned_scorer).collect()
    assert {r.id: r.pred_ids for r in out} == {i: [2, *range(5, 6 + i), 3] for i in range(7)} and not any(r.error for r in out)
