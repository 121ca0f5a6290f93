"""A data source for line-aligned text files (X3, S1, J1): line i of one side
beside line i of the other without a join or a shuffle.

A first Spark job (``mark_lines``) counts the lines that start in each byte block of
either side and writes one row a block.  A partition of the source is then some
consecutive blocks of the first side (so many that small blocks don't make many
partitions); the marks say in which bytes of the second side its lines
lie, and the task reads both ranges in bounded steps.  As a batch,
``read_aligned`` gives all lines up to the end of the shorter side; as a stream,
the offset is a number of lines, and lines arrive when the marks are renewed
after the files have grown.

Lines end with LF, CR or CRLF; a byte-order mark at the start of a file is
dropped; bytes that are not UTF-8 become U+FFFD.  Files of a folder stand in order
of the number in their name.  Compressed files can't be cut and are refused.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tandem.session import scratch_path, ship_package
from tandem.sources.aligned import file_number

BLOCK = 64 << 20   # bytes of a block
STEP = 4 << 20     # bytes read at once
ROWS = 8192        # rows of a batch
PARTS = 64         # tasks of small files; of large ones a task has BLOCK bytes
PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".xz", ".deflate")
MARKS = "side string, file string, nth long, start long, size long, lines long, first long"


def _open(path: str):
    """The file system and path of a Hadoop URI or a plain path."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


# ------------------------------------------------------------------ marks

def _count_block(file, start: int, end: int) -> tuple[int, int | None]:
    """How many lines start in bytes ``start`` to ``end``, and where the first does."""
    n, first, at, before = 0, None, start, 10
    if start:
        file.seek(start - 1)
        before = file.read(1)[0]
    file.seek(start)
    while at < end:
        b = np.frombuffer(file.read(min(STEP, end - at)), np.uint8)
        if not len(b):
            break
        last = np.append(np.uint8(before), b[:-1])
        starts = np.flatnonzero((last == 10) | ((last == 13) & (b != 10)))
        if len(starts) and first is None:
            first = at + int(starts[0])
        n, at, before = n + len(starts), at + len(b), int(b[-1])
    return n, first


def _count(batches):
    for b in batches:
        out = []
        for r in b.to_pylist():
            fs, path = _open(r["file"])
            with fs.open_input_file(path) as f:
                r["lines"], r["first"] = _count_block(f, r["start"], min(r["start"] + r.pop("block"), r["size"]))
            out.append(r)
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
            ("side", pa.string()), ("file", pa.string()), ("nth", pa.int64()), ("start", pa.int64()),
            ("size", pa.int64()), ("lines", pa.int64()), ("first", pa.int64())]))


def mark_lines(spark: SparkSession, sides: dict, marks: str, block: int = BLOCK) -> None:
    """Write the marks of all files of ``sides`` (name: path), one row a block.
    ``nth`` is the file's place on its side."""
    ship_package(spark)
    files = None
    for side, path in sides.items():
        f = spark.read.format("binaryFile").load(path).select(
            F.lit(side).alias("side"), F.col("path").alias("file"), F.col("length").alias("size"))
        files = f if files is None else files.union(f)
    listed = files.orderBy("side", file_number(F.col("file")), "file").collect()  # one row a file
    packed = [r.file for r in listed if r.file.endswith(PACKED)]
    if packed:
        raise ValueError(f"compressed files can't be read in blocks: {packed[:3]}")
    rows = [(r.side, r.file, i, r.size) for i, r in enumerate(listed) if r.size]
    n = sum(-(-r[3] // block) for r in rows)
    blocks = (spark.createDataFrame(rows, "side string, file string, nth long, size long")
              .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(block).cast("long"))).alias("start"),
                      F.lit(block).cast("long").alias("block")))
    tasks = max(PARTS, sum(r[3] for r in rows) // BLOCK)
    # a coalesce would count all blocks in the few tasks that write the marks
    (blocks.repartition(max(1, min(n, tasks, 20_000))).mapInArrow(_count, MARKS)
     .repartition(max(1, n // 50_000)).write.mode("overwrite").parquet(marks))


# ------------------------------------------------------------------ ranges

@dataclass
class Piece:
    """Whole lines: bytes ``start`` to ``end`` of a file."""
    file: str
    start: int
    end: int


@dataclass
class Lines(InputPartition):
    """Lines ``first`` to ``last`` (not included): for each side the pieces that
    hold them and the number of lines to leave out at their start."""
    first: int
    last: int
    sides: list


class Side:
    """Line numbers and whole-line pieces of one side, from its marks."""

    def __init__(self, marks: list):
        marks = sorted((m for m in marks if m["lines"]), key=lambda m: (m["nth"], m["start"]))
        self.pieces, self.starts, n = [], [], 0
        for m, after in zip(marks, [*marks[1:], None]):
            end = after["first"] if after and after["nth"] == m["nth"] else m["size"]
            self.pieces.append(Piece(m["file"], m["first"], end))
            self.starts.append(n)
            n += m["lines"]
        self.n = n

    def cut(self, a: int, b: int) -> tuple[int, list]:
        """(lines to leave out, pieces) for lines ``a`` to ``b``."""
        i, j = bisect_right(self.starts, a) - 1, bisect_right(self.starts, b - 1)
        joined: list = []
        for p in self.pieces[i:j]:
            if joined and joined[-1].file == p.file:
                joined[-1] = Piece(p.file, joined[-1].start, p.end)
            else:
                joined.append(p)
        return a - self.starts[i], joined


def load_sides(marks: str, names: list) -> list:
    fs, path = _open(marks) if ":" in marks else (pafs.LocalFileSystem(), marks)
    rows = pads.dataset(path, filesystem=fs, format="parquet").to_table(use_threads=False).to_pylist()  # one a block
    return [Side([m for m in rows if m["side"] == s]) for s in names]


def ranges(sides: list, lo: int = 0, hi: int | None = None) -> list:
    """Partitions of lines ``lo`` to ``hi`` (default: to the shorter side's end),
    cut where blocks of the first side begin: PARTS of them, or one for each BLOCK bytes."""
    end = min(s.n for s in sides)
    hi = end if hi is None else min(hi, end)
    if lo >= hi:
        return []
    inside = [(s, p.end - p.start) for s, p in zip(sides[0].starts, sides[0].pieces) if lo < s < hi]
    part = min(BLOCK, sum(n for _, n in inside) / PARTS)
    edges, held = [lo], 0.0
    for s, n in inside:
        if held >= part:
            edges.append(s)
            held = 0.0
        held += n
    edges.append(hi)
    return [Lines(a, b, [s.cut(a, b) for s in sides]) for a, b in zip(edges, edges[1:])]


# ------------------------------------------------------------------ reading

def _lines(skip: int, pieces: list):
    """The lines of the pieces after the first ``skip``, read step by step."""
    for p in pieces:
        fs, path = _open(p.file)
        with fs.open_input_file(path) as f:
            at = 3 if p.start == 0 and p.end >= 3 and f.read(3) == b"\xef\xbb\xbf" else p.start
            rest = []
            f.seek(at)
            while at < p.end:
                found = f.read(min(STEP, p.end - at))
                if not found:
                    break
                at += len(found)
                whole = max(found.rfind(b"\n"), found.rfind(b"\r", 0, len(found) - 1)) + 1
                # a CR at the end of a step may be half a CRLF: it waits for the next step
                if at >= p.end:
                    whole = len(found)
                if not whole:
                    rest.append(found)
                    continue
                for line in (b"".join(rest) + found[:whole]).splitlines():
                    if skip:
                        skip -= 1
                    else:
                        yield line.decode("utf-8", "replace")
                rest = [found[whole:]] if whole < len(found) else []


def _read(part: Lines, names: list):
    readers = [_lines(skip, pieces) for skip, pieces in part.sides]
    schema = pa.schema([("id", pa.int64()), *((n, pa.string()) for n in names)])
    at = part.first
    while at < part.last:
        n = min(ROWS, part.last - at)
        cols = [pa.array([x for _, x in zip(range(n), r)], pa.string()) for r in readers]
        if any(len(c) != n for c in cols):
            raise OSError(f"lines {at} to {at + n} are not all there: the files have changed since they were marked")
        yield pa.RecordBatch.from_arrays([pa.array(range(at, at + n), pa.int64()), *cols], schema=schema)
        at += n


class _Batch(DataSourceReader):
    def __init__(self, options):
        self.marks, self.names = options["marks"], options["sides"].split(",")

    def partitions(self):
        # a source without lines still needs a partition
        return ranges(load_sides(self.marks, self.names)) or [Lines(0, 0, [(0, [])] * len(self.names))]

    def read(self, partition):
        yield from _read(partition, self.names)


class _Stream(DataSourceStreamReader):
    def __init__(self, options):
        self.marks, self.names = options["marks"], options["sides"].split(",")

    def initialOffset(self):
        return {"line": 0}

    def latestOffset(self):
        return {"line": min(s.n for s in load_sides(self.marks, self.names))}

    def partitions(self, start, end):
        return ranges(load_sides(self.marks, self.names), start["line"], end["line"])

    def read(self, partition):
        yield from _read(partition, self.names)

    def commit(self, end):
        pass


class AlignedText(DataSource):
    """``spark.read.format("aligned_text")`` with the options ``marks`` (a table of
    ``mark_lines``) and ``sides`` (comma-joined names, the columns beside ``id``)."""

    @classmethod
    def name(cls):
        return "aligned_text"

    def schema(self):
        return "id long, " + ", ".join(f"`{s}` string" for s in self.options["sides"].split(","))

    def reader(self, schema):
        return _Batch(self.options)

    def streamReader(self, schema):
        return _Stream(self.options)


def read_aligned(spark: SparkSession, sides: dict, marks: str | None = None, block: int = BLOCK) -> DataFrame:
    """``id`` and one column a side: line ``id`` of each, up to the shorter side's end."""
    marks = marks or scratch_path(spark, "line-marks")
    mark_lines(spark, sides, marks, block)
    spark.dataSource.register(AlignedText)
    return spark.read.format("aligned_text").option("marks", marks).option("sides", ",".join(sides)).load()


def stream_aligned(spark: SparkSession, sides: list, marks: str) -> DataFrame:
    """The same lines as a stream, up to where ``marks`` reach when a batch is planned."""
    ship_package(spark)
    spark.dataSource.register(AlignedText)
    return spark.readStream.format("aligned_text").option("marks", marks).option("sides", ",".join(sides)).load()
