"""Sharding by minimax contiguous partition (operator 10, native).

Rows with equal text form one atomic group.  Groups stand in the order of the
text's MD5 (a null text is a group of its own row id), and are cut into
``n_shards`` consecutive runs so that the largest run's bytes are least, and
under that bound the others are near equal: each run ends at the group end
nearest to its share of the bytes left, if the rest can still be held.  Groups
larger than a share count as a shard of their own and are left out of it.

The smallest feasible capacity is found by binary search with a greedy check.
The check needs only "the last group end at or before x".  Spark summarises
the ordered line of group ends in equal-width blocks (smallest and largest end
of each).  Taking ends known exactly gives an upper bound of the capacity,
taking any place inside an unresolved block a lower bound; only blocks that a
cut can still fall into are summarised again, 32 times finer, until both
bounds meet, and then until every cut is known.  The driver holds those block
summaries (65 536 at first, then a few thousand) and the ``n_shards`` largest
groups; no group list is collected.

Cases: null text has size 16 and checksum 0; empty text the same, but all
empty texts are one group; repeated rows and tied ids take consecutive slots;
null ids are allowed; an empty table gives no rows; other columns are ignored.
Shards are empty only where groups are fewer than shards or the bound leaves
no other cut.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tandem.llm.common import documents, written

N_SHARDS = 40
ROW_BYTES = 16
#: Parts in which a group's rows are numbered, so that no task gets a whole hot group.
GROUP_SPLITS = 64
FIRST_BLOCKS = 1 << 16
FINER = 32


class _Ends:
    """What is known of the group ends: exact ends, and open gaps between."""

    def __init__(self, n_shards: int, total: int):
        self.n, self.total, self.known, self.open = n_shards, total, [0, total], {}

    def add(self, rows) -> None:
        for r in rows:
            self.known += [r["lo"], r["hi"]]
            if r["lo"] + 1 < r["hi"]:
                self.open[r["lo"]] = r["hi"]
        self.known = sorted(set(self.known))

    def last(self, x: int, sure: bool) -> int:
        k = self.known[bisect_right(self.known, x) - 1]
        return k if sure or not (k < x < self.open.get(k, k)) else x

    def greedy(self, cap: int, sure: bool) -> list[int] | None:
        """Cuts of the greedy filling; None when ``n`` shards don't suffice."""
        cuts, at = [], 0
        for _ in range(self.n):
            to = self.last(min(at + cap, self.total), sure)
            if to == at:
                return None
            cuts.append(to)
            at = to
            if at == self.total:
                return cuts
        return None

    def least(self, sure: bool) -> int:
        lo, hi = -(-self.total // self.n), self.total
        while lo < hi:
            mid = (lo + hi) // 2
            if self.greedy(mid, sure):
                hi = mid
            else:
                lo = mid + 1
        return lo

    def at_or_before(self, x: int, doubt: set) -> int:
        """The last end up to x; a gap that hides it is put in doubt."""
        k = self.known[bisect_right(self.known, x) - 1]
        if k < x < self.open.get(k, k):
            doubt.add((k, self.open[k]))
        return k

    def at_or_after(self, x: int, doubt: set) -> int:
        at = bisect_left(self.known, x)
        k = self.known[at - 1] if at else x
        if k < x < self.open.get(k, k):
            doubt.add((k, self.open[k]))
        return self.known[at]

    def even(self, cap: int, large: list[tuple[int, int]]) -> tuple[list[int], set]:
        """Cuts near equal under the capacity, and the gaps that leave them in
        doubt.  ``large``: (start, end) of groups that count as a shard each."""
        doubt: set = set()
        least = [self.total]  # the smallest ends from which the rest fits, last shard first
        for _ in range(self.n - 1):
            least.append(self.at_or_after(max(0, least[-1] - cap), doubt))
        cuts, at = [], 0
        for left in range(self.n, 1, -1):
            if at == self.total:
                break
            ahead = [e - s for s, e in large if s >= at]
            small = self.total - at - sum(ahead)
            share = small // (left - len(ahead)) if left > len(ahead) and small else (self.total - at) // left
            aim = min(at + max(1, share), self.total)
            a, b = self.at_or_before(aim, doubt), self.at_or_after(aim, doubt)
            to = a if a > at and aim - a <= b - aim else b
            if to > at + cap:
                to = self.at_or_before(at + cap, doubt)
            to = max(to, least[left - 1])
            cuts.append(to)
            at = to
        return cuts if at == self.total else [*cuts, self.total], doubt

    def doubtful(self, lo: int, hi: int) -> list[tuple[int, int]]:
        """Open gaps that a cut can fall into for capacities lo..hi."""
        out, a, b, starts = set(), 0, 0, sorted(self.open)
        for _ in range(self.n):
            a, b = min(a + lo, self.total), min(b + hi, self.total)
            for i in range(max(0, bisect_left(starts, a) - 1), bisect_right(starts, b)):
                if starts[i] < b and self.open[starts[i]] > a:
                    out.add((starts[i], self.open[starts[i]]))
            a, b = self.last(a, True), self.last(b, False)
        return sorted(out)


def _large(ends: DataFrame, total: int, n_shards: int) -> list[tuple[int, int]]:
    """(start, end) of the groups above the mean of what the larger ones leave."""
    top = ends.groupBy("end").agg(F.min("start").alias("start")) \
              .orderBy(F.desc(F.col("end") - F.col("start")), "end").limit(n_shards).collect()
    out = []
    for r in top:
        if len(out) == n_shards - 1 or (r["end"] - r["start"]) * (n_shards - len(out)) <= total:
            break
        out.append((r["start"], r["end"]))
        total -= r["end"] - r["start"]
    return out


def minimax_cuts(ends: DataFrame, total: int, n_shards: int) -> list[int]:
    """Ends of the shards (a group end each) on the line of prefix sums."""
    line = _Ends(n_shards, total)
    width = max(1, -(-total // FIRST_BLOCKS))
    block = F.floor(F.col("end") / width)
    line.add(ends.groupBy(block).agg(F.min("end").alias("lo"), F.max("end").alias("hi")).collect())

    def finer(gaps) -> None:
        """Summarise the inside of some gaps again."""
        parts = F.array(*[F.struct(F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi"),
                                   F.lit(max(1, (hi - lo) // FINER)).cast("long").alias("w")) for lo, hi in gaps])
        part = ends.where(block.isin(sorted({lo // width for lo, _ in gaps}))).select("end")
        part = part.select("end", F.explode(F.filter(
            parts, lambda g: (g["lo"] < F.col("end")) & (F.col("end") < g["hi"]))).alias("g"))
        for lo, _ in gaps:
            del line.open[lo]
        line.add(part.groupBy("g", F.floor((F.col("end") - F.col("g.lo")) / F.col("g.w")))
                 .agg(F.min("end").alias("lo"), F.max("end").alias("hi")).select("lo", "hi").collect())

    while True:
        lo, hi = line.least(False), line.least(True)
        if lo == hi:
            break
        finer(line.doubtful(lo, hi))
    large = _large(ends, total, n_shards)
    while True:
        cuts, doubt = line.even(hi, large)
        if not doubt:
            return cuts
        finer(sorted(doubt))


def assign_shards(docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard."""
    text, rid = F.col(text_col), F.col(id_col)
    key = F.when(text.isNotNull(), F.unhex(F.md5(text))) \
           .otherwise(F.concat(F.unhex(F.md5(F.coalesce(rid.cast("string"), F.lit("")))), F.unhex(F.lit("00"))))
    rows = docs.select(
        rid.alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0).cast("long")).alias("text_crc32"),
        key.alias("g"),
        F.pmod(F.xxhash64(rid), F.lit(GROUP_SPLITS)).cast("int").alias("part"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("g", "part").orderBy("doc_id")))
    rows = written(rows, "shard-rows")
    cells = rows.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")) \
                .withColumn("bucket", F.conv(F.substring(F.hex("g"), 1, 3), 16, 10).cast("int"))
    w = Window.partitionBy("bucket")
    line = cells.select(
        "bucket", "g", "part", "n",
        F.sum("n").over(w.orderBy("g", "part").rowsBetween(Window.unboundedPreceding, 0)).alias("n_to"),
        F.sum("b").over(w.orderBy("g").rangeBetween(Window.unboundedPreceding, 0)).alias("end"),
        F.sum("b").over(Window.partitionBy("bucket", "g")).alias("bytes"))
    line = written(line, "shard-line")
    # one row per bucket, 4096 at most: an ordered window and a broadcast of proven size
    every = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    tops = line.groupBy("bucket").agg(F.max("n_to").alias("n_all"), F.max("end").alias("b_all"))
    tops = tops.select("bucket", F.coalesce(F.sum("n_all").over(every), F.lit(0)).alias("n_base"),
                       F.coalesce(F.sum("b_all").over(every), F.lit(0)).alias("b_base"))
    line = line.join(F.broadcast(tops), "bucket").select(
        "g", "part", (F.col("n_base") + F.col("n_to") - F.col("n")).alias("first"),
        (F.col("b_base") + F.col("end")).alias("end"),
        (F.col("b_base") + F.col("end") - F.col("bytes")).alias("start"))
    total = line.agg(F.max("end")).first()[0]
    cuts = minimax_cuts(line, total, n_shards) if total else [0]
    shard = sum(((F.col("start") >= F.lit(c)).cast("int") for c in cuts[:-1]), F.lit(0))
    line = line.withColumn("shard", shard)
    heads = line.groupBy("shard").agg(F.min("first").alias("head"))  # n_shards rows at most
    line = line.join(F.broadcast(heads), "shard")
    return rows.join(line, ["g", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") - F.col("head") + F.col("nth") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op10_sharding(spark, sf_dir):
    return assign_shards(documents(spark, sf_dir))
