"""Exact ranks without a sort, binned density, early stopping in constant
memory: each against a plain version."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.operators import fold
from tandem.operators import profile as PR
from tandem.operators import ranks
from tandem.operators import runs as R

NAN, INF = float("nan"), float("inf")


def doubles(spark, values):
    return spark.createDataFrame([(v,) for v in values], "score double").repartition(4)


@pytest.mark.parametrize("kind", ["spread", "ties", "one", "infinite"])
def test_ranks_are_exact_on_narrowing_passes(spark, kind):
    rng = np.random.default_rng(5)
    values = {"spread": rng.normal(size=3000), "ties": rng.integers(0, 6, 3000).astype(float),
              "one": np.full(500, 2.5), "infinite": np.r_[rng.normal(size=500), [INF] * 40, [-INF] * 40]}[kind]
    df = doubles(spark, [float(v) for v in values] + [NAN, None, NAN])
    want = np.sort(values)
    spots = [0, 1, len(want) // 3, len(want) // 2, len(want) - 2, len(want) - 1, len(want), -1]
    # a coarse sketch, no margin and few fetched values: ranks are missed and the interval narrows many times
    got = ranks.values_at_ranks(df, "score", spots, fetched=7, k=8, margin=0.0)
    assert got == {r: want[r] for r in spots if 0 <= r < len(want)}


def test_score_stats_are_exact_and_sort_free(spark, capsys):
    rng = np.random.default_rng(6)
    values = [float(x) for x in rng.normal(size=1001).round(2)]
    df = doubles(spark, values + [NAN] * 3 + [None])
    g = PR.score_stats(df, fetched=20, k=16).first()
    assert (g.n, g.nan_count, g.min, g.max) == (1001, 3, min(values), max(values))
    assert [g.q1, g.q2, g.q3] == pytest.approx(np.quantile(values, [.25, .5, .75]).tolist(), abs=1e-12)
    one = doubles(spark, [3.0])
    assert PR.score_stats(one).first().median == 3.0
    assert PR.score_stats(one.limit(0)).first().asDict() == dict(n=0, nan_count=0, mean=None, median=None, min=None,
                                                                q1=None, q2=None, q3=None, max=None)


def test_no_rank_query_sorts(spark, monkeypatch):
    from pyspark.sql import DataFrame
    sorts = []
    for name in ("orderBy", "sort", "checkpoint", "localCheckpoint"):
        monkeypatch.setattr(DataFrame, name, lambda *a, n=name, **k: sorts.append(n))
    PR.score_stats(spark.range(500).select(F.col("id").cast("double").alias("score")), fetched=10).collect()
    assert sorts == []


def test_binned_density_within_its_bound(spark):
    rng = np.random.default_rng(7)
    values = np.r_[rng.normal(size=700), rng.normal(4, .2, 300), [4.0] * 50, [-30.0]]
    df = doubles(spark, [float(v) for v in values] + [NAN, None])
    got = {r.g: r for r in PR.kde(df, "score", grid=50, cut=1.0).collect()}
    n, h = len(values), values.std(ddof=1) * len(values) ** -0.2
    x = np.linspace(values.min() - h, values.max() + h, 50)
    want = np.exp(-0.5 * ((x[:, None] - values[None, :]) / h) ** 2).sum(1) / (n * h * math.sqrt(2 * math.pi))
    bound = PR.kde_error() / (h * math.sqrt(2 * math.pi))
    assert bound < 1e-10 and len(got) == 50
    assert max(abs(got[g].density - want[g]) for g in range(50)) <= bound + 1e-13
    assert max(abs(got[g].x - x[g]) for g in range(50)) < 1e-9
    assert PR.kde(df.limit(0), "score").count() == 0 and PR.kde(doubles(spark, [1.0, 1.0]), "score").count() == 0


def plain_fold(losses, patience, min_delta):
    """(stop epoch, best, checkpoints) of one run, epoch by epoch."""
    best, counter, kept = INF, 0, []
    for e, v in enumerate(losses):
        v = NAN if v is None else v
        if v < best - min_delta:
            best, counter = v, 0
        else:
            counter += 1
        if v == best:
            kept.append(e)
        if counter >= patience:
            return e, best, kept
    return None, best, kept


def made_runs(rng):
    runs = {"falling": [3 - i * 0.01 for i in range(150)], "flat": [1.0] * 60, "nan": [NAN] * 12 + [None, 2.0, 1.0],
            None: [0.5, 0.4, INF, 0.4, 0.2], "inf": [INF] * 30, "low": [-INF, 1.0, -INF]}
    for i in range(8):
        steps = rng.normal(-0.02, 0.1, int(rng.integers(1, 200)))
        runs[f"walk{i}"] = [float(x) for x in np.cumsum(steps).round(2)]
    return runs


@pytest.mark.parametrize("patience,min_delta,cases", [(5, 1e-4, 64), (9, 0.3, 1), (40, 0.25, 2), (30, 0.0, 1), (1, 0.1, 64)])
def test_early_stopping_cut_at_every_border(spark, monkeypatch, patience, min_delta, cases):
    runs = made_runs(np.random.default_rng(11))
    df = spark.createDataFrame([(r, e, v) for r, vs in runs.items() for e, v in enumerate(vs)],
                               "run string, epoch int, val_loss double")
    want = {r: plain_fold(vs, patience, min_delta) for r, vs in runs.items()}
    for parts in (1, 17, 90):
        def cut(epochs, key, epoch, val):
            s = (epochs.select(F.col(key).alias("run"), F.col(epoch).alias("e"), F.col(val).alias("v"))
                 .toPandas())
            s = sorted(zip(s.run, s.e, s.v), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
            rows = spark.sparkContext.parallelize(s, parts)
            return spark.createDataFrame(rows, "run string, e int, v double").withColumn("part", F.spark_partition_id())
        monkeypatch.setattr(fold, "_sorted", cut)
        slices = fold.fold_slices(df, patience, min_delta, cases=cases)
        got = {}
        for r in sorted(slices.collect(), key=lambda r: r.place):
            n, stop, best, kept = got.get(r.run, (0, None, None, []))
            got[r.run] = n + r.n, stop if r.stop_epoch is None else r.stop_epoch, r.best, kept + r.checkpoints
        assert {r: g[0] for r, g in got.items()} == {r: len(vs) for r, vs in runs.items()}
        assert {r: g[1:] for r, g in got.items()} == want


def test_early_stopping_odd_rows(spark):
    schema = "grp int, t int, loss double, run string"
    rows = [(1, 1, 0.5, "x"), (1, 1, 0.5, "x"), (1, None, 0.9, "x"), (None, 3, None, "y")]
    df = spark.createDataFrame(rows, schema)
    got = {r.grp: r for r in R.early_stop_state(df, key="grp", epoch="t", val="loss").collect()}
    assert got[1].n_epochs == 3 and got[1].best_loss == 0.5 and got[None].best_loss == INF
    assert [x for x in got[1].checkpoint_epochs if x is not None] == [1, 1]
    assert R.early_stop_state(df.limit(0), key="grp", epoch="t", val="loss").count() == 0
    assert sorted(r.epoch for r in R.best_checkpoints(df.filter("t is not null"), key="grp", epoch="t", val="loss").collect()) == [1, 1]
    with pytest.raises(ValueError):
        R.early_stop_state(df, min_delta=-1.0, key="grp", epoch="t", val="loss")
