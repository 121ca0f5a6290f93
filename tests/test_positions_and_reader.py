"""Row lookups in saved tables, and the aligned-file data source against the join."""

import os
import tempfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tandem.sources import aligned as A
from tandem.sources import aligned_reader as AR
from tandem.sources.saved import SavedRows, save_rows


def folder(name):
    return os.path.join(tempfile.mkdtemp(prefix="tandem-rows-"), name)


def test_saved_rows_read_only_their_files(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("id"), F.lit("x").alias("_pos"), F.lit(1).alias("n"))
    path = folder("t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        save_rows(df, path, ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    t = SavedRows(spark, path, df.schema)
    assert t.count() == 1000 and t.files.count() > 4
    for i in (0, 123, 999):
        row = t.row_at(i)
        assert [r.id for r in row.collect()] == [i] and row.columns == df.columns
        assert len(row.inputFiles()) == 1
        assert not [x for x in ("Sort", "Exchange hash") if x in row._jdf.queryExecution().executedPlan().toString()]
    assert t.row_at(1000).count() == 0 and t.row_at(-1).count() == 0 and t.row_at(1000).columns == df.columns
    last = t.tail(10)
    assert sorted((r.row_idx, r.id) for r in last.collect()) == [(i, i) for i in range(990, 1000)]
    assert len(last.inputFiles()) <= 2 and sorted(r.id for r in t.head(3).collect()) == [0, 1, 2]
    five = t.sample(5, seed=7)
    assert sorted(r.draw for r in five.collect()) == list(range(5)) and len(five.inputFiles()) <= 5
    assert all(r.id == r.row_idx for r in five.collect())
    many = t.sample(3000, seed=1).groupBy("row_idx").count().agg(F.max("count")).first()[0]
    assert t.sample(3000, seed=1).count() == 3000 and many > 1


def test_saved_rows_of_an_empty_table_and_broken_ones(spark):
    df = spark.range(0).toDF("id")
    path = folder("e")
    save_rows(df, path, ["id"])
    t = SavedRows(spark, path, df.schema)
    assert t.count() == 0 and t.row_at(0).count() == 0 and t.tail(3).count() == 0 and t.sample(3).count() == 0
    with pytest.raises(FileNotFoundError):
        SavedRows(spark, folder("none"), df.schema)


def write_parts(root, texts):
    os.makedirs(root)
    for i, t in texts.items():
        with open(f"{root}/part-{i}.txt", "wb") as f:
            f.write(t)
    return root


def random_text(rng, lines):
    ends = [b"\n", b"\r\n", b"\r"]
    out = b""
    for _ in range(lines):
        word = bytes(rng.choice(list("ab éệ".encode()[:3]), int(rng.integers(0, 12))).astype(np.uint8))
        out += word + "ệ".encode() * int(rng.integers(0, 2)) + ends[int(rng.integers(0, 3))]
    return out


@pytest.mark.parametrize("block,step", [(1, 3), (7, 2), (64, 5), (1 << 20, 1 << 20)])
def test_lines_equal_plain_reading_at_every_block_size(block, step, monkeypatch):
    monkeypatch.setattr(AR, "STEP", step)
    rng = np.random.default_rng(block)
    root = tempfile.mkdtemp(prefix="tandem-blocks-")
    texts = [random_text(rng, 40), b"\xef\xbb\xbfbom\nno end", b"\r\n\n\r", random_text(rng, 25)]
    marks, want = [], []
    for i, t in enumerate(texts):
        path = f"{root}/{i}"
        with open(path, "wb") as f:
            f.write(t)
        with open(path, "rb") as f:
            for s in range(0, len(t), block):
                n, first = AR._count_block(f, s, min(s + block, len(t)))
                marks.append(dict(file=path, nth=i, start=s, size=len(t), lines=n, first=first))
        want += [x.decode() for x in t.removeprefix(b"\xef\xbb\xbf").splitlines()]
    side = AR.Side(marks)
    assert side.n == len(want)
    for a in range(len(want)):
        for b in (a + 1, min(a + 9, len(want)), len(want)):
            lines = AR._lines(*side.cut(a, b))
            assert [x for _, x in zip(range(b - a), lines)] == want[a:b]


def test_reader_equals_the_join_on_unequal_files(spark):
    root = tempfile.mkdtemp(prefix="tandem-aligned-")
    rng = np.random.default_rng(3)
    en = write_parts(f"{root}/en", {0: random_text(rng, 90), 2: b"", 10: random_text(rng, 70), 9: b"one line, no end"})
    vi = write_parts(f"{root}/vi", {0: random_text(rng, 5), 1: random_text(rng, 200)})
    want = sorted(map(tuple, A.ingest_aligned_text(spark, en, vi, strip=False).select("id", "en", "vi").collect()))
    assert len(want) == 161
    for block in (50, 1 << 20):
        df = AR.read_aligned(spark, {"en": en, "vi": vi}, block=block)
        assert sorted(map(tuple, df.collect())) == want
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
    empty = write_parts(f"{root}/none", {0: b""})
    assert AR.read_aligned(spark, {"en": en, "vi": empty}).count() == 0
    with pytest.raises(ValueError):
        os.makedirs(f"{root}/gz")
        with open(f"{root}/gz/part-0.gz", "wb") as f:
            f.write(b"x")
        AR.read_aligned(spark, {"en": en, "vi": f"{root}/gz"})


def test_stream_follows_growing_files(spark):
    root = tempfile.mkdtemp(prefix="tandem-grow-")
    sides = {s: write_parts(f"{root}/{s}", {0: f"{s} 0\n{s} 1\n{s} 2\n".encode()}) for s in ("en", "vi")}
    marks = f"{root}/marks"

    def arrived():
        AR.mark_lines(spark, sides, marks, block=4)
        q = (AR.stream_aligned(spark, ["en", "vi"], marks).writeStream.format("parquet").option("path", f"{root}/out")
             .option("checkpointLocation", f"{root}/ck").trigger(once=True).start())
        q.awaitTermination()
        return sorted(map(tuple, spark.read.parquet(f"{root}/out").collect()))
    assert arrived() == [(i, f"en {i}", f"vi {i}") for i in range(3)]
    with open(f"{sides['en']}/part-0.txt", "ab") as f:
        f.write(b"en 3\nen 4\nen 5\n")
    with open(f"{sides['vi']}/part-1.txt", "wb") as f:
        f.write(b"vi 3\nvi 4")
    assert arrived() == [(i, f"en {i}", f"vi {i}") for i in range(5)]


def test_final_table_survives_a_broken_swap(spark, monkeypatch):
    path = folder("final")
    pairs = spark.createDataFrame([(1, "a", "b")], "id long, en string, vi string")
    A.write_final(pairs, path)
    fs, old = A._hadoop(spark, path)
    fs.rename(old, A._hadoop(spark, f"{path}.old")[1])  # as a crash between the two renames leaves it
    A.restore(spark, path)
    assert spark.read.parquet(path).count() == 1
    A.write_final(pairs.union(pairs), path)
    assert spark.read.parquet(path).count() == 2 and not A.path_exists(spark, f"{path}.old")


def test_small_blocks_do_not_make_many_tasks(spark, monkeypatch):
    """Blocks of 64 bytes: bounded partitions, and the counting is not left to one task."""
    root = tempfile.mkdtemp(prefix="tandem-many-")
    sides = {s: write_parts(f"{root}/{s}", {i: b"".join(b"%d %d\n" % (i, j) for j in range(900)) for i in range(4)})
             for s in ("en", "vi")}
    df = AR.read_aligned(spark, sides, marks=f"{root}/marks", block=64)
    assert spark.read.parquet(f"{root}/marks").count() > 500
    assert df.rdd.getNumPartitions() <= 2 * AR.PARTS
    rows = sorted(map(tuple, df.collect()))
    assert len(rows) == 3600 and all(r[0] == i and r[1] == r[2] == f"{i // 900} {i % 900}" for i, r in enumerate(rows))
    count = AR._count

    def marked(batches):
        from pyspark import TaskContext
        for b in count(batches):
            at = b.schema.get_field_index("first")
            yield b.set_column(at, "first", pa.array([TaskContext.get().partitionId()] * len(b), pa.int64()))
    monkeypatch.setattr(AR, "_count", marked)
    AR.mark_lines(spark, sides, f"{root}/tasks", block=64)
    assert spark.read.parquet(f"{root}/tasks").select("first").distinct().count() > 8
