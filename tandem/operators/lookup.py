"""Arrays mapped through a table of any size (word to id, id to token, source id
to target id) without a shuffle of their elements.

The table's rows with the smallest ids go to every task, as many as fit a fixed
number of bytes: in a vocabulary in order of frequency these are the commonest
words.  Each Arrow batch looks its elements up in place.  If the table has more
rows, only the elements that were not found are shuffled: the rows are written
once, the missing elements are joined with the rest of the table (AQE splits the
commonest), and what is found is put back into its row by the row's number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.session import written

#: Bytes of a table that go to every task, and the longest value or key among them.
MOST_BYTES, MOST_LONG = 32 << 20, 64


def _rows_of(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """(all elements, bounds of the rows); a null row is empty."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten(), np.concatenate(([0], np.cumsum(lengths)))


def _lists(bounds: np.ndarray, flat: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat)


def _finder(keys: pa.Array):
    """The function that gives each element's place in ``keys``, -1 for none."""
    if pa.types.is_integer(keys.type):
        numbers = keys.to_numpy()  # ascending

        def find(flat):
            wanted = flat.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            if not len(numbers):
                return np.full(len(wanted), -1)
            at = np.minimum(np.searchsorted(numbers, wanted), len(numbers) - 1)
            return np.where(numbers[at] == wanted, at, -1)
    else:
        def find(flat):
            return pc.index_in(flat, keys).fill_null(-1).to_numpy(zero_copy_only=False)
    return find


def map_arrays(df: DataFrame, col: str, out: str, table: DataFrame, key: str, value: str, default,
               by: str, most: int = MOST_BYTES, read=None, first: str = "_first") -> DataFrame:
    """``df`` with ``out``: the arrays of ``col`` with each element replaced by the
    ``value`` of the row of ``table`` whose ``key`` it equals, by ``default`` where there
    is none.  A null array gives an empty one.  ``by`` is the table's id column (from 0,
    smallest to every task).

    With ``read`` the column is not an array: ``read`` makes (elements, bounds of the
    rows, an int for each row) of its Arrow array; the int goes to a column ``first``."""
    kinds = dict(table.dtypes)
    t = table.select(F.col(key).alias("k"), F.col(value).alias("v"), F.col(by).cast("long").alias("i"))
    if kinds[key] != "string":
        t = t.withColumn("k", F.col("k").cast("long"))
    long = [F.coalesce(F.octet_length(c) > MOST_LONG, F.lit(False)) for c, name in (("k", key), ("v", value)) if kinds[name] == "string"]
    few = (F.col("i") >= 0) & (F.col("i") < most // (2 * MOST_LONG))
    for x in long:
        few = few & ~x
    few = F.coalesce(few, F.lit(False))
    here = t.filter(few).select("k", "v").orderBy("k").limit(most // MOST_LONG).toArrow()  # bounded: see ``most``
    keys, values = (here[c].combine_chunks() for c in ("k", "v"))
    if len(keys) != len(keys.unique()) or len(keys) >= most // MOST_LONG:  # tied keys or ids: a join gives each its row
        few, keys, values = F.lit(False), keys[:0], values[:0]
    rest = t.filter(~few).select("k", "v")
    whole = rest.isEmpty()
    known = df.sparkSession.sparkContext.broadcast((keys, values))
    made: list = []

    def find(lists):
        if not made:
            made.append(_finder(known.value[0]))
        flat, bounds, ints = (*_rows_of(lists), np.zeros(len(lists))) if read is None else read(lists)
        at = made[0](flat)
        return flat, bounds, at, known.value[1].take(pa.array(at, mask=at < 0)), pa.array(ints, pa.int32())

    firsts = [] if read is None else [F.col("_l.n").alias(first)]
    kept = [c for c in df.columns if c != out]
    if whole:
        @F.arrow_udf(f"struct<v: array<{kinds[value]}>, n: int>")
        def replaced(lists: pa.Array) -> pa.Array:
            _, bounds, _, found, ints = find(lists)
            return pa.StructArray.from_arrays([_lists(bounds, found.fill_null(default)), ints], ["v", "n"])

        return df.select("*", replaced(col).alias("_l")).select(*kept, *firsts, F.col("_l.v").alias(out))

    @F.arrow_udf(f"struct<v: array<{kinds[value]}>, at: array<int>, k: array<{dict(t.dtypes)['k']}>, n: int>")
    def looked_up(lists: pa.Array) -> pa.Array:
        flat, bounds, at, found, ints = find(lists)
        miss = (at < 0) & flat.is_valid().to_numpy(zero_copy_only=False)
        row = np.searchsorted(bounds, np.flatnonzero(miss), "right") - 1
        cut = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(lists)))))
        spot = pa.array(np.flatnonzero(miss) - bounds[row], pa.int32())
        lost = flat.filter(pa.array(miss)).cast(keys.type)
        return pa.StructArray.from_arrays([_lists(bounds, found), _lists(cut, spot), _lists(cut, lost), ints], ["v", "at", "k", "n"])

    held = df.select("*", looked_up(col).alias("_l"))
    held = written(held.select(*kept, *firsts, F.col("_l.v").alias("_v"), F.col("_l.at").alias("_at"), F.col("_l.k").alias("_k"),
                               F.monotonically_increasing_id().alias("_row")), "looked-up")
    lost = held.select("_row", F.explode(F.arrays_zip(F.col("_at").alias("at"), F.col("_k").alias("k"))).alias("e"))
    found = lost.select("_row", "e.at", "e.k").join(rest, "k").groupBy("_row").agg(
        F.collect_list(F.struct("at", "v")).alias("f"))

    @F.arrow_udf(f"array<{kinds[value]}>")
    def put_back(lists: pa.Array, at: pa.Array, v: pa.Array) -> pa.Array:
        flat, bounds = _rows_of(lists)
        spots, of = _rows_of(at)
        more, _ = _rows_of(v)
        take = np.arange(len(flat))
        row = np.repeat(np.arange(len(lists)), np.diff(of))
        take[bounds[row] + spots.to_numpy(zero_copy_only=False)] = len(flat) + np.arange(len(more))
        return _lists(bounds, pa.concat_arrays([flat, more.cast(flat.type)]).take(pa.array(take)).fill_null(default))

    both = held.drop("_at", "_k").join(found, "_row", "left")
    return both.withColumn(out, put_back("_v", "f.at", "f.v")).select(*kept, *([] if read is None else [first]), out)
