"""Embedding near-dedup by a pivot-permutation index (operator 4).

A vector is described by the order of its nearest reference points (pivots).
The pivots are a seeded hash sample of the table (CANDIDATES rows for each of
the PIVOTS kept), the only bounded part, and they are broadcast; one that is
within DISTINCT of an earlier one is passed over, as the order among pivots of
one dense group would be chance.  The inverted pivot lists are keyed by
unordered sets of SHARED of a vector's first NEAREST pivots, so that two
vectors meet in a list exactly when they share at least that many of those
pivots (the shared-pivot count); every vector is indexed.  Whatever meets is verified by
cosine in double precision inside the list.

Equal vectors are collapsed to one class first.  A list is cut into tiles, and
a task compares two tiles by matrix products, so no list has to fit one task.
A pair that meets in several lists is counted in the smallest common one only.
Tasks return, per class, its number of linked vectors and its local component,
never the pairs.

Cases: null vectors, zero vectors and vectors with null or non-finite
components link with nothing; repeated ids keep their rows (a tied id counts as
one more vector); null ids take part but are never a component's id unless
alone; vectors of another length than the most common one are compared only
with those of equal length; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import _components, connected_components, python_ready, written
from tandem.session import read_table

PIVOTS, CANDIDATES, DISTINCT = 512, 4, 0.9
NEAREST = 6
SHARED = 2
TILE = 512


def _distinct(p: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` rows that are not within DISTINCT of an earlier one."""
    near = p @ p.T >= DISTINCT
    free, kept = np.ones(len(p), bool), []
    for i in range(len(p)):
        if free[i] and len(kept) < most:
            kept.append(i)
            free &= ~near[i]
    return p[kept]


def _describe(pivots: np.ndarray, nearest: int, shared: int):
    combos = np.array(list(combinations(range(min(nearest, len(pivots))), min(shared, len(pivots)))))

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            out = []
            for dim, part in b.groupby(b["v"].map(len)):
                x = np.array(part["v"].to_list(), np.float64)
                # numbers of any size, without overflow
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                if dim == pivots.shape[1]:
                    near = np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :min(nearest, len(pivots))]
                    near = np.sort(near, axis=1).astype(np.int64)
                    keys = np.zeros((len(x), len(combos)), np.int64)
                    for c in combos.T:
                        keys = keys * len(pivots) + near[:, c]
                else:
                    keys = np.full((len(x), 1), -dim, np.int64)
                out.append(pd.DataFrame({"cls": part["cls"], "n": part["n"], "unit": list(x),
                                         "keys": list(np.sort(keys, axis=1))}))
            yield pd.concat(out)
    return run


def _compare(threshold: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        k, ta, tb = key
        pdf = pdf.sort_values(["tile", "cls"])
        x = np.array(pdf["unit"].to_list())
        keys, n = pdf["keys"].to_list(), pdf["n"].to_numpy()
        cls, tile = pdf["cls"].to_numpy(), pdf["tile"].to_numpy()
        cut = int((tile == ta).sum())
        if ta == tb:
            i, j = np.nonzero(np.triu(x @ x.T >= threshold, 1))
        else:
            i, j = np.nonzero(x[:cut] @ x[cut:].T >= threshold)
            j = j + cut
        if len(i) and len(keys[0]) > 1:
            kk = np.array(keys)
            mine = np.zeros(len(i), bool)
            for s in range(0, len(i), 8192):
                a, b = kk[i[s:s + 8192]], kk[j[s:s + 8192]]
                common = np.where((a[:, :, None] == b[:, None, :]).any(2), a, np.iinfo(np.int64).max)
                mine[s:s + 8192] = common.min(1) == k
        else:
            mine = np.ones(len(i), bool)
        links = np.bincount(i[mine], n[j[mine]], len(cls)) + np.bincount(j[mine], n[i[mine]], len(cls))
        low = cls[_components(len(cls), i, j)] if len(cls) else cls
        hit = (links > 0) | (low != cls)
        return pd.DataFrame({"cls": cls[hit], "links": links[hit].astype("int64"), "low": low[hit]})
    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding",
                 pivots: int = PIVOTS, nearest: int = NEAREST, shared: int = SHARED, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept: vectors of cosine >= threshold are linked."""
    spark = vectors.sparkSession
    v = python_ready(vectors).select(F.col(id_col).cast("long").alias("vec_id"),
                                     F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("v", lambda x: x != 0)
    v = v.withColumn("fine", F.coalesce(fine, F.lit(False)))
    v = v.withColumn("digest", F.when(F.col("fine"), F.sha2(F.concat_ws(
        ",", F.transform("v", lambda x: (x + F.lit(0.0)).cast("string"))), 256)))
    classes = v.where("fine").groupBy("digest").agg(
        F.min("vec_id").alias("cls"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    # a class is named by its smallest id; classes without any id are named by negative hashes
    name = F.coalesce("cls", -F.abs(F.xxhash64("digest")) - 1)
    classes = written(classes.withColumn("cls", name), "vector-classes")
    size = classes.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if size is None:
        return v.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                        F.lit(True).alias("kept"))
    picked = classes.where(F.size("v") == size["dim"]).orderBy(F.md5(F.col("digest"))).limit(pivots * CANDIDATES)
    p = np.array([r["v"] for r in picked.select("v").collect()], np.float64)
    p /= np.abs(p).max(axis=1, keepdims=True)
    p /= np.linalg.norm(p, axis=1, keepdims=True)
    p = _distinct(p, pivots)
    shared_pivots = spark.sparkContext.broadcast(p)

    def describe(batches):
        yield from _describe(shared_pivots.value, nearest, shared)(batches)

    index = written(classes.select("cls", "n", "v").mapInPandas(
        describe, "cls long, n long, unit array<double>, keys array<long>"), "pivot-index")
    lists = index.select("cls", F.explode("keys").alias("key"))
    sizes = lists.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    entry = lists.join(sizes, "key").withColumn("tiles", F.ceil(F.col("m") / tile).cast("int")) \
                 .withColumn("mine", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int"))
    # an entry goes to every pair of tiles that holds its own
    entry = entry.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    entry = entry.select("cls", "key", F.col("mine").alias("tile"), F.least("mine", "other").alias("ta"),
                         F.greatest("mine", "other").alias("tb"))
    rows = entry.join(index, "cls")
    found = rows.groupBy("key", "ta", "tb").applyInPandas(_compare(threshold), "cls long, links long, low long")
    found = written(found.groupBy("cls", "low").agg(F.sum("links").alias("links")), "vector-links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    comp = connected_components(found.select(F.col("cls").alias("a"), F.col("low").alias("b"))).toDF("cls", "c")
    per = classes.select("digest", "cls", "n").join(links, "cls", "left").join(comp, "cls", "left").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("c", "cls").alias("c"))
    out = v.select("vec_id", "digest").join(per, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("c") >= 0, F.col("c")).otherwise(F.coalesce("vec_id", "c")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op4_pivot_near_vectors(spark, sf_dir):
    return near_vectors(read_table(spark, sf_dir, "embeddings"))
