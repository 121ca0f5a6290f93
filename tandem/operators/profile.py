"""Profiling: length / score statistics, quantile cut-off, histograms, KDE,
samples and positional access (A2-A7, O1-O4).

Exact percentiles use Spark's ``percentile`` whose partial aggregation keeps
a value→count map per task: its size is the number of *distinct* values
(bounded for word lengths).  For high-cardinality columns at scale pass
``exact=False`` to use the mergeable ``percentile_approx`` sketch.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.operators.batching import md5_key
from tandem.operators.ranks import SKETCH_K, quantiles
from tandem.session import join_measured, scratch_path

QUARTILES = [0.25, 0.5, 0.75]


def _pct(col: str, qs, exact: bool = True, accuracy: int = 100_000) -> Column:
    arr = F.array(*[F.lit(q) for q in qs])
    if exact:
        return F.percentile(F.col(col), arr)
    return F.percentile_approx(F.col(col), arr, accuracy)


def lengths_long(df: DataFrame) -> DataFrame:
    """``lang, len`` — both length columns stacked (no join)."""
    return df.select(F.explode(F.array(
        F.struct(F.lit("en").alias("lang"), F.col("len_en").alias("len")),
        F.struct(F.lit("vi").alias("lang"), F.col("len_vi").alias("len")))).alias("x")).select("x.*")


def length_describe(df: DataFrame, exact: bool = True) -> DataFrame:
    """count, mean, std (ddof=1), min, quartiles, max per language (A2)."""
    L = lengths_long(df)
    g = L.groupBy("lang").agg(
        F.count("len").alias("count"), F.avg("len").alias("mean"), F.stddev_samp("len").alias("std"),
        F.min("len").alias("min"), _pct("len", QUARTILES, exact).alias("q"), F.max("len").alias("max"))
    return g.select("lang", "count", "mean", "std", "min", F.col("q")[0].alias("q25"),
                    F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max")


def score_stats(df: DataFrame, col: str = "score", **kw) -> DataFrame:
    """mean, median, min, quartiles, max over all scores; NaN is excluded
    and counted (A3).

    Quartiles are exact and interpolated, found by counting between the bounds a
    sketch proposes (``operators.ranks``): nothing is sorted, and the first
    pass gives the other figures too."""
    valid = F.col(col).isNotNull() & ~F.isnan(col)
    v = df.select(F.when(valid, F.col(col).cast("double")).alias("s"),
                  (F.col(col).isNotNull() & F.isnan(col)).alias("is_nan"))
    k = kw.get("k", SKETCH_K)
    g = v.agg(F.count("s").alias("n"), F.count_if("is_nan").alias("nan_count"), F.avg("s").alias("mean"),
              F.min("s").alias("min"), F.max("s").alias("max"), F.kll_sketch_agg_double("s", F.lit(k)).alias("k")).first()
    q1, q2, q3 = quantiles(v, "s", QUARTILES, g.n, g.k, **kw)
    return df.sparkSession.createDataFrame(
        [(g.n, g.nan_count, g["mean"], q2, g["min"], q1, q2, q3, g["max"])],
        "n long, nan_count long, mean double, median double, min double, q1 double, q2 double, q3 double, max double")


def quantile_cutoff(sample: DataFrame, q: float = 0.999, exact: bool = True) -> DataFrame:
    """max(q-quantile of len_en, of len_vi) (A4)."""
    return sample.agg(F.greatest(_pct("len_en", [q], exact)[0], _pct("len_vi", [q], exact)[0]).alias("cutoff"))


def histogram(df: DataFrame, value: str, bins: int = 100, group: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max] per group, right edge closed, empty
    bins included (A5, A6).  min/max come from a one-row-per-group
    aggregate that is broadcast back (bounded by the number of groups); the
    bin grid is generated from it, never cross joined."""
    if group is None:
        df = df.withColumn("_g", F.lit(0))
        group = "_g"
    keys = [group]
    v = df.select(*keys, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    mm = v.groupBy(*keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = F.col("hi") - F.col("lo")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) * bins / width), F.lit(bins - 1))).cast("int")
    joined = join_measured(v, mm, keys)
    counts = joined.select(*keys, b.alias("bin")).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = mm.select(*keys, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, keys + ["bin"], "left").fillna(0, subset=["count"])
    step = (F.col("hi") - F.col("lo")) / bins
    out = out.select(*keys, "bin", (F.col("lo") + F.col("bin") * step).alias("bin_lo"),
                     (F.col("lo") + (F.col("bin") + 1) * step).alias("bin_hi"), "count")
    return out.drop("_g")


KDE_TERMS = 14    # terms of the series of a bin
KDE_BINS = 2      # bins a bandwidth


def kde_error(terms: int = KDE_TERMS, bins: int = KDE_BINS) -> float:
    """Bound of the density's error by binning, in units of the highest density
    one value can have (1 / (n h sqrt(2 pi)) for each of n values, so the whole
    is at most this bound / (h sqrt(2 pi))): the tail of
    sum |He_k(u)| exp(-u*u/2) t**k / k! with |He_k(u)| exp(-u*u/4) <= 1.09 sqrt(k!),
    where t = 1 / (2 bins) is the largest distance from a bin's middle."""
    t = 1 / (2 * bins)
    return sum(1.09 * t ** k / math.sqrt(math.factorial(k)) for k in range(terms, terms + 40))


def kde(df: DataFrame, value: str, grid: int = 200, cut: float = 0.0) -> DataFrame:
    """Gaussian KDE with Scott's bandwidth h = std · n^(−1/5) on a grid of
    ``grid`` points over [min − cut·h, max + cut·h] (A7).

    Values are summed into bins of half a bandwidth: each keeps the power sums
    of its values' distances from its middle, which the map side already adds up, so
    what is shuffled grows with the range in bandwidths and not with the rows.
    A grid point then adds, for each bin, the Hermite series of the kernel around
    the bin's middle: a value's share is exact but for ``kde_error``."""
    v = df.select(F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    st = v.agg(F.count("v").alias("n"), F.stddev_samp("v").alias("sd"),
               F.min("v").alias("lo"), F.max("v").alias("hi")).first()  # one row
    n, sd, lo, hi = st["n"], st["sd"], st["lo"], st["hi"]
    if not n or sd is None or sd == 0:
        return v.sparkSession.createDataFrame([], "g int, x double, density double")
    h = sd * n ** (-1.0 / 5.0)
    a, b = lo - cut * h, hi + cut * h
    step = (b - a) / (grid - 1)
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    scaled = (F.col("v") - F.lit(lo)) / F.lit(h) * KDE_BINS
    bins = (v.select(F.floor(scaled).alias("bin"), scaled.alias("z"))
            .select("bin", ((F.col("z") - F.col("bin") - 0.5) / KDE_BINS).alias("d"))
            .groupBy("bin").agg(*[F.sum(F.pow("d", F.lit(k)) if k else F.lit(1.0)).alias(f"m{k}")
                                  for k in range(KDE_TERMS)]))
    at = (a - lo) / h + np.arange(grid) * (step / h)

    def add(batches):
        total = np.zeros(grid)
        for t in batches:
            middle = (t.column("bin").to_numpy() + 0.5) / KDE_BINS
            for i in range(0, t.num_rows, 1024):
                u = at[None, :] - middle[i:i + 1024, None]
                he, last, near = np.ones_like(u), np.zeros_like(u), np.zeros_like(u)
                for k in range(KDE_TERMS):
                    near += he * (t.column(f"m{k}").to_numpy()[i:i + 1024, None] / math.factorial(k))
                    he, last = u * he - k * last, he
                total += (near * np.exp(-0.5 * u * u)).sum(0)
        yield pa.RecordBatch.from_pydict({"g": np.arange(grid, dtype=np.int32), "s": total})

    return (bins.mapInArrow(add, "g int, s double").groupBy("g").agg(F.sum("s").alias("s"))
            .select("g", (F.lit(a) + F.col("g") * F.lit(step)).alias("x"), (F.col("s") * norm).alias("density")))


def bounded_top_n(df: DataFrame, order_col: str, n: int, tie_col: str | None = None,
                  accuracy: int = 10_000) -> DataFrame:
    """The ``n`` rows with the smallest ``order_col`` (ties by ``tie_col``),
    exact, without sending n rows per partition into one task.

    A mergeable quantile sketch (``percentile_approx``) gives a cut-off that
    keeps roughly 2n rows; the kept set is counted, and because it holds every
    row below the cut-off it contains the true top n whenever it has at
    least n rows.  Otherwise (or for small inputs) the plain top-n is used."""
    order = [F.col(order_col)] + ([F.col(tie_col)] if tie_col else [])
    total = df.count()
    if total <= 4 * n:
        return df.orderBy(*order).limit(n)
    q = min(1.0, 2.0 * n / total + 2.0 / accuracy)
    cut = df.agg(F.percentile_approx(order_col, F.lit(q), accuracy)).first()[0]
    # NULL sorts first, whatever the size
    kept = df.filter(F.col(order_col).isNull() | (F.col(order_col) <= F.lit(cut)))
    if kept.count() < n:
        return df.orderBy(*order).limit(n)
    return kept.orderBy(*order).limit(n)


def sample_n(df: DataFrame, n: int = 50_000, seed: int = 42, key: str = "id") -> DataFrame:
    """``min(n, rows)`` rows without replacement, deterministic on any
    cluster: the n smallest seeded hashes (a bounded top-n) (O4)."""
    h = df.withColumn("_h", md5_key(seed, F.col(key)))
    return bounded_top_n(h, "_h", n, key).drop("_h")


def sample_inspect(indexed: DataFrame, k: int = 5, seed: int = 0, index: str = "row_idx") -> DataFrame:
    """``k`` uniform positions with replacement (seeded), joined back on the
    contiguous index; duplicates allowed (O3)."""
    spark = indexed.sparkSession
    n = indexed.agg(F.max(index)).first()[0]
    if n is None:
        return indexed.limit(0).withColumn("draw", F.lit(0).cast("long"))
    picks = spark.range(k).select(F.col("id").alias("draw"),
                                  F.pmod(md5_key(seed, F.col("id")), F.lit(n + 1)).alias(index))
    return indexed.join(F.broadcast(picks), index, "inner")  # k rows


def tail_n(df: DataFrame, n: int = 10, order: str = "id") -> DataFrame:
    """Last ``n`` rows by ``order`` (bounded top-n), ascending (O2)."""
    return df.orderBy(F.desc(order)).limit(n).orderBy(order)


def row_at(df: DataFrame, i: int, order: str = "id") -> DataFrame:
    """The row at 0-based position ``i`` by ``order``, none past the end (O2).
    The table is saved in that order first; for more than one lookup, save it once
    with ``sources.saved.save_rows`` and ask ``SavedRows``."""
    from tandem.sources.saved import SavedRows, save_rows
    path = scratch_path(df.sparkSession, "ordered-rows")
    save_rows(df, path, [order])
    return SavedRows(df.sparkSession, path, df.schema).row_at(i)
