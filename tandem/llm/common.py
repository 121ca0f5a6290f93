"""Shared parts of the training-data operators: tables in the shared folder,
size-checked broadcasts, connected components, and the vectorised byte/word
helpers that run inside Arrow tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.session import read_table, scratch_path, ship_package

#: Rows up to which a table with one short row per key is broadcast.
BROADCAST_ROWS = 100_000
#: Text bytes that one vectorised step works on (bounds a worker's memory).
STEP_BYTES = 1 << 20
#: Rows of an Arrow batch that are converted at a time.
SLICE_ROWS = 256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, and
    any executor can read it again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
               rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join; ``small`` is broadcast only when its counted rows are few, else
    it is a shuffle join whose skewed partitions AQE splits."""
    few = small.limit(rows + 1).count() <= rows
    return big.join(F.broadcast(small) if few else small, on, how)


def unit(col: Column) -> Column:
    """Uniform double in (0, 1) from the first 13 hex digits of an MD5."""
    return (F.conv(F.substring(F.md5(col), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def _is_stars(e: DataFrame) -> bool:
    """Whether every child (u) has one root (v) that is no child itself."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(
        e.select("v", F.lit(0), F.lit(1)))
    t = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("root").alias("root"))
    return t.where("child + root > 1").limit(1).count() == 0


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (a, b),
    component being its smallest reachable node.

    Alternating large-star and small-star steps: each is one grouped minimum
    and one join on the node.  The edge table is rewritten to the shared folder
    after every round; the loop ends when the edges are stars, whose roots are
    then the smallest nodes.
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("u <> v").distinct(), "cc")
    for _ in range(rounds):
        if _is_stars(e):
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v"), "cc-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "cc")
    else:
        raise RuntimeError(f"components not stable after {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


# ---------------------------------------------------------------- in tasks

def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BASE, _INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_POW: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
BYTE_CODE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
LOWER_CODE = BYTE_CODE.copy()
LOWER_CODE[65:91] = BYTE_CODE[97:123]
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
NOT_WORD = np.ones(256, bool)
NOT_WORD[128:] = False
NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = False


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        with np.errstate(over="ignore"):
            for k, b in enumerate((_BASE, _INV)):
                out = np.full(n, b, np.uint64)
                out[0] = 1
                _POW[k] = np.multiply.accumulate(out)
    return _POW[0], _POW[1]


def steps(batches, column: str = "text", most: int = STEP_BYTES):
    """Slices of the incoming Arrow batches holding about ``most`` text bytes,
    as (record batch slice, byte array, document offsets).  A null text is empty."""
    for batch in (b.slice(s, SLICE_ROWS) for b in batches for s in range(0, len(b), SLICE_ROWS)):
        text = batch.column(column).cast(pa.large_string())
        if text.null_count:
            text = text.fill_null("")
        n = len(text)
        offs = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + n + 1]
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
            data = text.buffers()[2]
            bytes_ = (np.frombuffer(data, np.uint8)[offs[at]:offs[to]] if data is not None and offs[to] > offs[at]
                      else np.zeros(0, np.uint8))
            yield batch.slice(at, to - at), bytes_, offs[at:to + 1] - offs[at]
            at = to


def words(data: np.ndarray, offs: np.ndarray, sep: np.ndarray = SPACE, code: np.ndarray = BYTE_CODE):
    """Words of all documents of a step: (start byte, end byte, document
    index, 64-bit hash).  The hash is a polynomial over the word's bytes."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    inside = ~sep[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offs[1:-1]
    cut = cut[cut < n]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = cut[cut > 0]
    last[cut - 1] = inside[cut - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(n + 1)
    with np.errstate(over="ignore"):
        pre = np.zeros(n + 1, np.uint64)
        np.cumsum(code[data] * up[:n], out=pre[1:])
        h = _mix((pre[e] - pre[s]) * down[s] + (e - s).astype(np.uint64))
    return s, e, np.searchsorted(offs, s, "right") - 1, h


def ngrams(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words and a mask of those inside one document."""
    if len(h) < k:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    m = len(h) - k + 1
    out = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * np.uint64(_BASE) + h[j:j + m]
        return _mix(out), doc[:m] == doc[k - 1:]


def python_ready(df: DataFrame) -> DataFrame:
    """Make this package importable in the session's Python workers."""
    ship_package(df.sparkSession)
    return df


def _components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of n nodes."""
    lab = np.arange(n)
    while len(i):
        low = np.minimum(lab[i], lab[j])
        new = lab.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == lab).all():
            break
        lab = new
    return lab
