"""Target masks and their text, many and wide: what a row costs grows with its mask alone."""

from pyspark.sql import functions as F

from tandem.operators import batching as B
from tandem.plans import QUERIES

SF = "/root/testdata/sf0.001"


def test_masks_and_their_text(spark):
    rows = [(1, [2, 7, 0, 0]), (2, [2]), (3, []), (4, [0, 5, 0]), (5, [9] * 30)]
    df = spark.createDataFrame(rows, "id long, ids array<int>").withColumn("m", B.target_mask("ids"))
    want = {i: [[x != 0 and k <= q for k, x in enumerate(ids)] for q in range(len(ids))] for i, ids in rows}
    assert {r.id: r.m for r in df.collect()} == want
    text = B.mask_strings(df.select("id", "m"), "m", rows=2)
    assert {r.id: r.m for r in text.collect()} == {
        i: "/".join("".join("01"[b] for b in r) for r in m) for i, m in want.items()}
    ahead = spark.range(4).select("id", B.look_ahead_mask(F.col("id").cast("int")).alias("m"))
    assert {r.id: r.m for r in B.mask_strings(ahead, "m").collect()} == {0: "", 1: "1", 2: "10/11", 3: "100/110/111"}
    null = spark.createDataFrame([(1, None)], "id long, m array<array<boolean>>")
    assert B.mask_strings(null, "m").first().m is None


def test_no_test_of_the_padding_for_each_cell(spark):
    """The padding is tested once an id, not once an id for each row of the mask."""
    df = spark.createDataFrame([([2, 0],)], "ids array<int>").select(B.target_mask("ids").alias("m"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(" in plan and plan.count("transform(") == 3 and plan.index("transform(ids") < plan.index("slice(")


def test_packed_masks_are_the_same_text(spark):
    """Packed masks give the text of the arrays, also where padding stands in the middle, and
    where an id or all ids are missing."""
    rows = [(1, [2, 7, 0, 0]), (2, [2]), (3, []), (4, [0, 5, 0]), (5, [9] * 30), (6, [4, None, 0, 6]), (7, None)]
    df = spark.createDataFrame(rows, "id long, ids array<int>")
    text = [{r.id: r.m for r in B.mask_strings(df.select("id", B.target_mask("ids", p).alias("m")), "m").collect()}
            for p in (False, True)]
    assert text[0] == text[1] and text[1][4] == "000/010/010" and text[1][6] == "1000/1000/1000/1001"
    assert text[1][3] == text[1][7] == ""
    null = spark.createDataFrame([(1, None)], "id long, m array<binary>")
    assert B.mask_strings(null, "m").first().m is None


def test_query_makes_no_object_for_each_cell(spark):
    """The query's masks are not arrays of arrays, and their text does not pass through Python."""
    plan = QUERIES["target_mask"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join(" in plan and "array<array<boolean>>" not in plan and "mapinarrow" not in plan.lower()


def test_sorted_rows_are_stored_with_their_places(spark):
    """Stored rows get the places of the checkpointed ones, and a step that needs one column
    of a batch reads no other array."""
    df = spark.range(0, 2000).select("id", (F.col("id") * 7919 % 2003).alias("k"), F.concat(F.lit("s"), F.col("id") % 3).alias(
        "split"), F.array(F.col("id").cast("int")).alias("src_ids"), F.array(F.lit(2), F.lit(3)).alias("tgt_ids")).repartition(7)
    got = [sorted((r.id, r.r) for r in B.index_within(df, "split", [F.col("k"), F.col("id")], "r", stored).collect())
           for stored in (False, True)]
    assert got[0] == got[1]
    b = B.collate(B.batch_assign(df), masks=True, packed=True).select("id", "tgt_mask")
    scans = [x for x in b._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in x]
    assert scans and not any("src_ids" in x for x in scans)
