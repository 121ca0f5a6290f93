"""Exact values at given ranks without a sort (A3).

A KLL sketch brackets each wanted rank between two values of the table; one
counting pass says on which side of them, or between them, the rank lies, and
sketches what lies between.  This repeats until few values are left around
every rank; those are fetched with their counts.  A sketch decides only where to
look, the counts decide the answer, so it is exact whatever the sketch's error.
The interval around a rank shrinks to about 1 % a pass: four passes reach 10 000
values out of 10**12.  No task and no fetch holds more than that a rank.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SKETCH_K = 4096      # about 0.13 % of rank error
MARGIN = 0.004       # three times that
FETCHED = 10_000     # values fetched around one rank


@dataclass
class _Open:
    """A wanted rank: ``at`` counts from the first of the ``n`` values that lie
    strictly between ``lo`` and ``hi`` (None: no bound)."""
    at: int
    n: int
    lo: float | None = None
    hi: float | None = None
    sketch: bytearray | None = None
    value: float | None = None

    def inside(self, x: Column) -> Column:
        c = F.lit(True)
        if self.lo is not None:
            c = c & (x > F.lit(self.lo))
        return c & (x < F.lit(self.hi)) if self.hi is not None else c


def _sketch(x: Column, k: int) -> Column:
    return F.kll_sketch_agg_double(x, F.lit(k))


def _bracket(spark: SparkSession, o: _Open, margin: float) -> tuple[float, float]:
    """Two values of the sketch that should lie around the rank."""
    spots = [max(0.0, o.at / o.n - margin), min(1.0, (o.at + 1) / o.n + margin)]
    s = F.lit(bytes(o.sketch))
    lo, hi = spark.range(1).select(*[F.kll_sketch_get_quantile_double(s, F.lit(q)) for q in spots]).first()
    return min(lo, hi), max(lo, hi)


def values_at_ranks(values: DataFrame, col: str, ranks: list, n: int | None = None, sketch=None,
                    fetched: int = FETCHED, k: int = SKETCH_K, margin: float = MARGIN) -> dict:
    """``{rank: value}`` for 0-based ranks in ascending order of the double column
    ``col``; NULL and NaN rows don't count, ranks outside the table are left
    out.  ``n`` and ``sketch`` (of all counted values) save the first pass."""
    spark = values.sparkSession
    x = F.col(col)
    v = values.select(x.cast("double").alias(col)).filter(x.isNotNull() & ~F.isnan(x))
    if n is None:
        n, sketch = v.agg(F.count(col), _sketch(x, k)).first()
    wanted = {r: _Open(r, n, sketch=sketch) for r in ranks if 0 <= r < n}
    while True:
        wide = [o for o in wanted.values() if o.value is None and o.n > fetched]
        if not wide:
            break
        missed = [o for o in wide if o.sketch is None]
        if missed:  # the sketch pointed beside these ranks
            row = v.agg(*[_sketch(F.when(o.inside(x), x), k) for o in missed]).first()
            for o, s in zip(missed, row):
                o.sketch = s
        cuts = [_bracket(spark, o, margin) for o in wide]
        aggs = []
        for o, (p, q) in zip(wide, cuts):
            between = (x > F.lit(p)) & (x < F.lit(q))
            aggs += [F.count_if(o.inside(x) & (x < F.lit(p))), F.count_if(x == F.lit(p)), F.count_if(between),
                     F.count_if(x == F.lit(q)), _sketch(F.when(between, x), k)]
        row = v.agg(*aggs).first()
        for i, (o, (p, q)) in enumerate(zip(wide, cuts)):
            below, at_p, between, at_q, inner = row[5 * i:5 * i + 5]
            if p == q:
                at_q = between = 0
            _narrow(o, p, q, below, at_p, between, at_q, inner)
    left = [o for o in wanted.values() if o.value is None]
    if left:
        keep = left[0].inside(x)
        for o in left[1:]:
            keep = keep | o.inside(x)
        few = sorted((r[col], r["count"]) for r in v.filter(keep).groupBy(col).count().collect())
        for o in left:
            at = o.at
            for value, c in few:
                if (o.lo is None or value > o.lo) and (o.hi is None or value < o.hi):
                    if at < c:
                        o.value = value
                        break
                    at -= c
    return {r: o.value for r, o in wanted.items()}


def _narrow(o: _Open, p, q, below, at_p, between, at_q, inner) -> None:
    """Move ``o`` into the part of its interval that holds its rank."""
    o.sketch, at = None, o.at
    if at < below:
        o.hi, o.n = p, below
    elif at < below + at_p:
        o.value = p
    elif at < below + at_p + between:
        o.at, o.lo, o.hi, o.n, o.sketch = at - below - at_p, p, q, between, inner
    elif at < below + at_p + between + at_q:
        o.value = q
    else:
        past = below + at_p + between + at_q
        o.at, o.lo, o.n = at - past, q, o.n - past


def quantiles(values: DataFrame, col: str, fractions: list, n: int | None = None, sketch=None, **kw) -> list:
    """Interpolated quantiles of ``col`` (NULL and NaN left out), exact; all None
    in an empty table."""
    if n is None:
        x = F.col(col).cast("double")
        n, sketch = values.agg(F.count(F.nanvl(x, F.lit(None))),
                               _sketch(F.nanvl(x, F.lit(None)), kw.get("k", SKETCH_K))).first()
    if not n:
        return [None] * len(fractions)
    spots = [(n - 1) * f for f in fractions]
    found = values_at_ranks(values, col, sorted({r for s in spots for r in (math.floor(s), math.ceil(s))}),
                            n, sketch, **kw)

    def at(s):
        a, b = found[math.floor(s)], found[math.ceil(s)]
        return a if a == b else a + (b - a) * (s - math.floor(s))
    return [at(s) for s in spots]
